import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from pixelchange.llm import sentencepiece_rounds as sr
from tests.llm.helpers import prose, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return sr.Codec(sr.read_model(MODEL))


def texts(n=1500):
    r, letters = random.Random(7), "ab  eth ▁\n\té日本😀\x00'　ßﬁinge"
    return (["", " ", "  ", "▁", " ▁ a", "thethe" * 400, "a" * 2000, " " * 1500, "\n\n", "日本語" * 300, " ".join(prose(1, 2000)), "x\r\ny\x0b\x85 "]
            + ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(n)])


def test_ids_and_text_are_the_librarys(codec, library):
    body = texts()
    ids = codec.encode(body)
    assert ids == library.encode(body, num_threads=1)
    assert [codec.decode(x) for x in ids] == [library.decode(x) for x in ids]


def merged(codec, words):
    ids, at = codec.merge_words(pa.array(words, pa.large_string()))
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def one_by_one(codec, word):
    """Merges of one word, one after another: best rank first, leftmost first."""
    word = word.replace(" ", sr.BLANK)
    s = [codec.symbol.get(c, codec.other) for c in word]
    table = {int(k): (int(r), int(m)) for k, r, m in zip(codec.keys, codec.ranks, codec.made)}
    while True:
        best = min(((table[a * codec.width + b][0], i) for i, (a, b) in enumerate(zip(s, s[1:])) if a * codec.width + b in table), default=None)
        if best is None:
            return [i for x, c in zip(s, word if max(s) >= codec.first_extra else s)
                    for i in ([x] if x < codec.first_extra else [codec.bytes[b] for b in c.encode()])]
        i = best[1]
        s[i:i + 2] = [table[s[i] * codec.width + s[i + 1]][1]]


def test_rounds_merge_as_one_by_one(codec):
    words = sorted({w for w in codec.words(sr.strings(pa.array(texts(300))))[0].to_pylist() if len(w) <= 300})
    assert merged(codec, words) == [one_by_one(codec, w) for w in words]


def test_very_long_words(codec, library):
    r = random.Random(11)
    body = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)), "the" * 20_000, "a" * 50_001,
            "".join(r.choice("ABCabc0123456789+/") for _ in range(30_000)), "".join(r.choice("the ing") for _ in range(20_000)).replace(" ", "▁▁")]
    assert codec.encode(body) == library.encode(body, num_threads=1)


def test_pieces_that_come_after_their_pairs_are_merged_one_at_a_time():
    """xyxy with xy before (xy)x and without that order: the second differs."""
    def small(scores):
        pieces = ["x", "y", "xy", "xyx", "xyxy"]
        return sr.Codec({"pieces": pieces + [f"<0x{i:02X}>" for i in range(256)], "scores": scores + [0.0] * 256,
                         "plain": [True] * 5 + [False] * 256, "bytes": list(range(5, 261))})
    for scores in ([0.0, 0.0, -1.0, -2.0, -3.0], [0.0, 0.0, -3.0, -2.0, -1.0], [0.0, 0.0, -2.0, -1.0, -3.0], [0.0, 0.0, -1.0, -3.0, -2.0]):
        codec = small(scores)
        for n in range(1, 9):
            for word in ("xy" * n, "x" + "xy" * n, "xy" * n + "x", "xyx" * n):
                assert merged(codec, [word]) == [one_by_one(codec, word)]


def test_decode_of_any_ids(codec, library):
    r = random.Random(3)
    for _ in range(300):
        ids = [r.choice([r.randrange(3, 32_000), r.randrange(3, 259)]) for _ in range(r.randrange(1, 12))]
        raw = b"".join(codec.surface[i] for i in ids)
        try:
            raw.decode()
        except UnicodeDecodeError:
            continue        # only whole characters come out of an encoder
        assert codec.decode(ids) == library.decode(ids)


def test_query_rows(spark, library):
    docs = [(i, t) for i, t in enumerate(texts(200))] + [(5000, None), (None, "no id"), (3, "▁")]
    df = table(spark, [(d, t, 1, "i") for d, t in docs], "doc_id long, text string, n_tokens int, ids string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["ids"]) for r in sr.encode_documents(df, MODEL).collect())
    want = []
    for d, t in docs:
        ids = library.encode(t or "")
        want.append((d is None, d or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest(), ids))
    assert got == sorted(want)
    back = sr.decode_documents(sr.encode_documents(df, MODEL), MODEL).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["decoded"]) for r in back) == sorted(
        (d is None, d or 0, library.decode(library.encode(t or ""))) for d, t in docs)
    assert sr.encode_documents(table(spark, []), MODEL).collect() == []
