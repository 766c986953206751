"""Exact top-k search against all inner products."""

import math

import duckdb
import numpy as np
import pytest

from pixelchange.llm import norm_search as ns
from pixelchange.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import table, write

SCHEMA = "vec_id long, embedding array<double>"
EVERY = 50


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * float(x)) for x in v]


def expected(rows, step=EVERY, k=5):
    """Rows (query_id, rank, vec_id, score) over all pairs, in whole numbers of Python."""
    there = [(i, w) for i, v in rows if (w := whole(v)) is not None]
    asking = {}
    for i, w in there:
        if i is not None and i % step == 0:
            packed = np.array(w, "<i4").tobytes()
            asking[i] = min(asking.get(i, packed), packed)
    out = []
    for q, packed in asking.items():
        v = np.frombuffer(packed, "<i4").tolist()
        scored = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for i, w in there if i != q and len(w) == len(v)]
        out += [(q, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def asks(vec_id):
    return vec_id % EVERY == 0


def vectors(seed, n, dim, lengths):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, dim))
    return v / np.linalg.norm(v, axis=1)[:, None] * lengths(r, n)[:, None]


@pytest.mark.parametrize("lengths", [lambda r, n: np.ones(n), lambda r, n: np.exp(r.normal(size=n)), lambda r, n: r.pareto(1.0, n) + 0.01])
def test_all_pairs(spark, lengths):
    v = vectors(1, 1200, 16, lengths)
    rows = list(enumerate(v.tolist()))
    assert found(ns.search(table(spark, rows, SCHEMA), asks)) == expected(rows)


def test_groups_of_copies_go_by_coordinate(spark):
    """Copies give thresholds near 1: few candidates are left, all results right."""
    r = np.random.default_rng(2)
    v = vectors(2, 3000, 24, lambda r, n: np.ones(n))
    v[::5] = v[0] + r.normal(size=(600, 24)) * 0.003
    v[1::50] = v[::50]
    rows = list(enumerate(v.tolist()))
    assert found(ns.search(table(spark, rows, SCHEMA), asks)) == expected(rows)


def test_pruning_leaves_out_most_pairs():
    r = np.random.default_rng(3)
    c = vectors(3, 2000, 32, lambda r, n: np.ones(n))
    c[:20] = c[0] + r.normal(size=(20, 32)) * 0.002
    c = np.floor(256 * c)
    order = np.argsort(-np.linalg.norm(c, axis=1))
    ids, c = order.astype(np.int64), c[order]
    norms = np.linalg.norm(c, axis=1)
    q = c[np.isin(ids, np.arange(20))]
    slab = ns.Slab(ids[np.isin(ids, np.arange(20))], q, np.linalg.norm(q, axis=1), np.full(len(q), 0.999 * 256 ** 2), 5)
    counts = slab.bucket(ids, c, norms)
    assert counts["coord"] > 0
    assert counts["coord"] + counts["length"] < 0.2 * len(q) * len(c)
    far = ns.Slab(np.array([-1]), q[:1], norms[:1], np.array([2.0 * norms[0] ** 2]), 5)
    assert far.bucket(ids, c, norms) == {"length": 0, "coord": 0}      # local threshold above 1
    short = ns.Slab(np.array([-1]), q[:1], np.linalg.norm(q[:1], axis=1), np.array([0.4 * 256 ** 2]), 5)
    scaled = c * np.linspace(1, 0.05, len(c))[:, None]
    left = short.bucket(ids, scaled, np.linalg.norm(scaled, axis=1))
    assert 0 < left["length"] < 0.7 * len(c)                           # only the long ones


def test_parts_slabs_and_small_buckets_give_the_same_rows(monkeypatch, spark):
    monkeypatch.setattr(ns, "BUCKET", 17)
    monkeypatch.setattr(ns, "ROWS", 3)
    monkeypatch.setattr(ns, "SEEDS", 20)
    v = vectors(4, 900, 8, lambda r, n: r.pareto(1.5, n) + 0.1)
    rows = list(enumerate(v.tolist()))
    got = ns.search(table(spark, rows, SCHEMA), lambda i: i % 10 == 0, part_bytes=3000, slab_bytes=700)
    assert found(got) == expected(rows, step=10)


def test_nulls_ties_repeats_dimensions_and_zero_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, [-1.0, -1.0]), (100, [1.0, 2.0]), (100, [1.0, 2.0])]
    rows += [(i, [0.5, 0.5]) for i in range(1, 12)] + [(3, [0.5, 0.5]), (None, [0.5, 0.5]), (None, [9.0, 9.0])]
    rows += [(13, None), (14, [1.0, None]), (15, [nan, 1.0]), (16, [inf, 1.0]), (17, [1.0, -inf]), (150, [nan, 0.0]), (200, None)]
    rows += [(18, [1.0, 2.0, 3.0]), (250, [0.1, 0.2, 0.3]), (300, []), (19, []), (350, [1.0] * 5)]
    assert found(ns.search(table(spark, rows, SCHEMA), asks)) == expected(rows)


def test_products_beyond_float64(spark):
    rows = [(0, [8e6, 8e6 - 1.5]), (1, [8e6, 8e6 - 0.25]), (2, [8e6, 8e6 - 0.125]), (3, [8e6 - 1, 8e6]), (4, [1.0, 1.0])]
    assert found(ns.search(table(spark, rows, SCHEMA), asks)) == expected(rows)
    with pytest.raises(Exception, match="leaves 32 bits"):
        ns.search(table(spark, [(0, [1e12, 0.0]), (1, [1.0, 1.0])], SCHEMA), asks).collect()


def test_empty_table_floats_and_extra_columns(spark, tmp_root):
    assert ns.search(table(spark, [], SCHEMA), asks).collect() == []
    assert ns.search(table(spark, [(50, [1.0])], SCHEMA), asks).collect() == []
    v = vectors(6, 200, 6, lambda r, n: np.exp(r.normal(size=n))).astype(np.float32)
    df = table(spark, list(enumerate(v.tolist())), "vec_id long, embedding array<float>")
    path = write(spark, tmp_root, embeddings=df.selectExpr("*", "1 AS part", "2 AS slab", "3 AS norm", "4 AS score", "5 AS v"))
    assert found(QUERIES["op11_norm_search"](spark, path)) == expected(list(enumerate(v.tolist())))


def test_the_query_and_its_sql_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = expected(rows)
    assert found(QUERIES["op11_norm_search"](spark, SF_SMALL)) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    assert sorted(con.execute(ORACLE["op11_norm_search"]).fetchall(), key=repr) == want
