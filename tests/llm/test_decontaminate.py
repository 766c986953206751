import random

import numpy as np

from pixelchange.llm import decontaminate as dc
from tests.llm.helpers import prose, table


def score(a, b):
    """Smith-Waterman, cell by cell."""
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_against_cells():
    r = random.Random(1)
    a = [np.array([r.randrange(5) for _ in range(r.randrange(1, 14))], np.uint64) for _ in range(200)]
    b = [np.array([r.randrange(5) for _ in range(r.randrange(1, 20))], np.uint64) for _ in range(200)]
    best, end = dc.align(a, b)
    assert best.tolist() == [score(x, y) for x, y in zip(a, b)]
    assert all(score(x, y[:e]) == s for x, y, s, e in zip(a, b, best, end))


def leaks(spark, docs, items, **how):
    rows = dc.find_leaks(table(spark, docs), table(spark, items, "item_id long, text string"), **how).collect()
    return sorted((r["row"]["doc_id"], x["item_id"], x["first_word"], x["end_word"]) for r in rows for x in r["leaks"]), rows


def items(n=30):
    return [(i, " ".join(prose(1000 + i, 15 + i)).capitalize() + ".") for i in range(n)]


def test_exact_edited_and_clean(spark):
    bench, docs, want = items(), [], set()
    for i, text in bench:
        w = text.lower().rstrip(".").split()
        docs.append((i, " ".join(prose(i, 50) + w + prose(i + 5000, 50))))
        edited = list(w)
        for k in range(3, len(edited), 9):
            edited[k] = f"other{k}"
        docs.append((100 + i, " ".join(prose(i + 200, 40)) + "\n" + ", ".join(x.upper() for x in edited)))
        docs.append((200 + i, " ".join(prose(i + 400, 40) + w[:6] + ["added"] + w[7:] + prose(i, 9))))
        docs.append((300 + i, " ".join(prose(i + 900, 300))))
        want |= {(i, i), (100 + i, i), (200 + i, i)}
    got, _ = leaks(spark, docs, bench)
    assert {(d, i) for d, i, _, _ in got} == want
    assert all((a, b) == (50, 65 + i) for d, i, a, b in got if d == i)
    # Blocks of items give the same leaks as all at once.
    assert leaks(spark, docs, bench, block_bytes=300)[0] == got


def test_common_words_alone_are_no_leak(spark):
    bench = [(1, "the of in the and of the in of and the of in a to of"), (2, " ".join(prose(3, 20)))]
    docs = [(i, " ".join(random.Random(i).choices(["the", "of", "in", "and"] + prose(7, 60), k=200))) for i in range(40)]
    assert leaks(spark, docs, bench)[0] == []


def test_part_of_a_long_item(spark):
    bench = [(1, " ".join(prose(11, 80)))]
    docs = [(1, " ".join(prose(12, 30) + prose(11, 80)[20:45] + prose(13, 30))), (2, " ".join(prose(12, 30) + prose(11, 80)[20:30] + prose(13, 30)))]
    assert [(d, i) for d, i, _, _ in leaks(spark, docs, bench)[0]] == [(1, 1)]


def test_edge_cases(spark):
    text = " ".join(prose(1, 20))
    docs = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "x y"), (5, " ".join(prose(2, 30_000) + prose(1, 20) + prose(3, 30_000))),
            (6, f"{text} and again {text}")]
    bench = [(7, text), (7, text), (8, None), (None, "a b"), (9, ""), (10, "x y")]
    rows = dc.op4_decontaminate(table(spark, docs), table(spark, bench, "item_id long, text string")).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["item_id"]) for r in rows) == sorted(
        [(False, 3, 7)] * 4 + [(True, 0, 7)] * 2 + [(False, 5, 7)] * 2 + [(False, 6, 7)] * 4)
    none = table(spark, [], "item_id long, text string")
    assert dc.op4_decontaminate(table(spark, docs), none).collect() == []
    assert dc.op4_decontaminate(table(spark, []), table(spark, bench, "item_id long, text string")).collect() == []


def test_clashing_columns(spark):
    df = table(spark, [(1, " ".join(prose(1, 20)), 5, "l")], "doc_id long, text string, item_id int, leaks string")
    out = dc.find_leaks(df, table(spark, [(7, " ".join(prose(1, 20)))], "item_id long, text string")).first()
    assert out["row"]["item_id"] == 5 and out["row"]["leaks"] == "l" and out["leaks"][0]["item_id"] == 7


def test_every_stretch_has_a_seed():
    index = dc.Items([(i, t) for i, t in items(10)])
    chosen = index.choose(np.arange(len(index.keys)) % 7)
    for i in range(10):
        at = np.flatnonzero(index.item == i)
        for x in range(len(at) - dc.SPAN + 1):
            assert chosen[at[x:x + dc.SPAN]].any()


def edited_copies(n, how):
    """Items and documents with one copy each, edited by ``how`` (word number, word) -> words."""
    bench, docs = items(n), []
    for i, text in bench:
        w = text.lower().rstrip(".").split()
        docs.append((i, " ".join(prose(i + 300, 30) + [y for k, x in enumerate(w) for y in how(k, x)] + prose(i + 700, 30))))
    return bench, docs


def accepted(bench, docs):
    """Pairs that alignment of every item with every document accepts, cell by cell."""
    out = set()
    for i, text in bench:
        w = text.lower().rstrip(".").split()
        out |= {(d, i) for d, t in docs if score(np.array(w), np.array(t.split())) >= min(np.ceil(dc.MIN_SHARE * len(w)), dc.MIN_SCORE)}
    return out


def test_dense_edits_against_alignment_of_all(spark):
    r = random.Random(5)
    edits = [lambda k, x, n=n: ["other"] if k % n == n - 1 else [x] for n in (3, 4, 5, 6, 7)]         # replaced
    edits += [lambda k, x, n=n: [x, "added"] if k % n == n - 1 else [x] for n in (2, 3, 4)]           # put in
    edits += [lambda k, x, n=n: [] if k % n == n - 1 else [x] for n in (4, 5)]                        # left out
    edits += [lambda k, x: r.choice([[x], [x], [x], [x], ["other"], [x, "added"], []]) for _ in range(3)]
    bench, docs, sure = items(16), [], 0
    for e, how in enumerate(edits):
        docs += [(100 * e + d, t) for d, t in edited_copies(16, how)[1]]
    want = accepted(bench, docs)
    got = leaks(spark, docs, bench)[0]
    assert {(d, i) for d, i, _, _ in got} == want
    for e in (1, 2, 3, 4, 5, 6):                   # dense copies are among them
        sure += len({d for d, _ in want if d // 100 == e})
    assert sure >= 80


def test_passages_of_one_document_do_not_overlap(spark):
    text = prose(1, 30)
    repeats = ["a1", "b1", "c1"] * 5
    docs = [(1, " ".join(text + prose(2, 9) + text + text[:8] + prose(3, 5) + text)), (2, " ".join(["a1", "b1", "c1"] * 200))]
    got, _ = leaks(spark, docs, [(7, " ".join(text)), (8, " ".join(repeats))])
    assert {(0, 30), (39, 69), (82, 112)} <= {(a, b) for d, i, a, b in got if (d, i) == (1, 7)}
    for pair in ((1, 7), (2, 8)):
        spans = [(a, b) for d, i, a, b in got if (d, i) == pair]
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
    assert len([g for g in got if g[:2] == (2, 8)]) >= 30
