import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from pixelchange.llm import relative_lz as rl
from tests.llm.helpers import prose, removed_words, table, words


def check(spark, docs):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rl.op3_substring_dedup(table(spark, docs)).collect())
    want = sorted((d is None, d or 0, len(words(t)), len(words(t)) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest())
                  for (d, t), k in zip(docs, removed_words(docs)))
    assert got == want


def corpus(seed):
    r = random.Random(seed)
    passages = [prose(seed * 100 + i, r.choice([12, 13, 14, 30, 80])) for i in range(12)]
    docs = []
    for i in range(120):
        text = []
        for _ in range(r.randrange(5)):
            text += prose(r.random(), r.randrange(20))
            p = r.choice(passages)
            a = r.randrange(len(p))
            text += p[a:a + r.randrange(1, 60)] if r.random() < 0.5 else p
        docs.append((r.randrange(10_000), " ".join(text)))
    ids = {}
    return [d for d in docs if ids.setdefault(d[0], d) is d]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, monkeypatch, seed):
    """Small slices, buckets and hot seeds, so that copies meet in the shuffle."""
    monkeypatch.setattr(rl, "SLICE", 2000)
    monkeypatch.setattr(rl, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(rl, "SAMPLE", 2)
    check(spark, corpus(seed))


def test_hot_seeds_change_nothing(spark, monkeypatch):
    docs = corpus(3)
    of, start, whole, seed, place = rl.seeded_windows(pa.array([t for _, t in docs]), rl.WINDOW, rl.SEED)
    hot = np.unique(seed & rl.LOW48)[::2].astype(np.int64).tolist()
    monkeypatch.setattr(rl, "_plan", lambda *a: (5, hot))
    monkeypatch.setattr(rl, "SLICE", 3000)
    check(spark, docs)


def test_edge_cases(spark):
    p13, p12 = " ".join(prose(1, 13)), " ".join(prose(2, 12))
    same = " ".join(["again"] * 200)
    docs = [(5, p13), (3, f"x {p13} y"), (7, p13), (8, p12), (9, p12), (10, ""), (11, None), (12, " \n "), (13, same), (14, same),
            (None, p13), (None, None), (15, f"{p13}\n\x0b{p13}"), (16, "a\x1cb c\x85d"), (3, f"x {p13} y"), (17, " ".join(prose(4, 20_000))), (18, " ".join(prose(4, 20_000)))]
    check(spark, docs)
    assert rl.remove_repeats(table(spark, [])).collect() == []


def test_rows_of_one_id_with_different_texts(spark):
    a, b = " ".join(prose(1, 40)), " ".join(prose(2, 40))
    check(spark, [(1, a), (2, a), (2, b), (3, b)])


def test_clashing_columns_and_factors(spark):
    a, b = " ".join(prose(1, 30)), " ".join(prose(2, 30))
    df = table(spark, [(1, a, 0, "r"), (2, b, 0, "r"), (3, f"{a} {b} own words", 0, "r")], "doc_id long, text string, n_words int, row string")
    got = {r["row"]["doc_id"]: r for r in rl.remove_repeats(df).collect()}
    assert got[3]["n_factors"] == 2 and got[3]["kept_text"] == "own words" and got[3]["row"]["n_words"] == 0
    assert got[1]["n_factors"] == 0 and got[1]["kept_text"] == a


def test_factors_end_where_the_source_ends():
    runs = np.array([(1, 0, ref, start, n) for start, n, ref in ((0, 5, 1), (5, 3, 2), (8, 2, 2), (40, 1, 2))], rl.RUN)
    assert rl.factors(runs) == [(0, 17, 1), (5, 22, 2), (40, 53, 2)]
