from collections import Counter

import duckdb
import numpy as np
import pytest

from pixelchange.llm import ngram_jaccard as nj
from tests.llm.helpers import links_and_classes, prose, table


def edited(base, k, tag):
    out = list(base)
    for i in range(k):
        out[(37 * tag + 29 * i) % len(out)] = f"x{tag}_{i}"
    return out


def rows_of(df):
    return sorted((r["doc_id"] is None, r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect())


def expected(docs):
    return sorted((d is None, d, c, n) for (d, _), (c, n) in zip(docs, links_and_classes(docs)))


def test_against_all_pairs(spark, monkeypatch):
    """Groups of near copies, exact copies, edge cases; small leaves and blocks,
    so that splitting and block comparisons run too."""
    monkeypatch.setattr(nj, "LEAF", 6)
    monkeypatch.setattr(nj, "BLOCK", 16)
    docs = []
    for g in range(4):
        base = prose(g, 150)
        docs += [(1000 * g + 7 * i, " ".join(edited(base, i % 4, i))) for i in range(1, 40)]
    docs += [(9000 + i, " ".join(prose(100 + i, 60))) for i in range(40)]
    docs += [(9100 + i, "the same line of more than five words") for i in range(5)]
    docs += [(9200, "one"), (9201, "one"), (9202, "two words"), (9203, ""), (9204, None), (9205, " \n\t")]
    docs += [(9206, "a b c d"), (9206, "a b c d"), (None, "a b c d"), (9300, " ".join(prose(0, 150))), (9300, "another text of this id entirely")]
    assert rows_of(nj.near_duplicates(table(spark, docs))) == expected(docs)


def test_empty_table_and_clashing_columns(spark):
    assert nj.near_duplicates(table(spark, [])).collect() == []
    text = " ".join(prose(1, 50))
    df = table(spark, [(1, text, 5, 6, "x"), (2, text, 5, 6, "x")], "doc_id long, text string, class_id int, rep int, path string")
    assert rows_of(nj.near_duplicates(df)) == [(False, 1, 1, 1), (False, 2, 1, 1)]


def test_long_text_and_small_edit(spark):
    base = prose(5, 30_000)
    df = table(spark, [(1, " ".join(base)), (2, " ".join(edited(base, 300, 1))), (3, " ".join(prose(6, 30_000)))])
    assert rows_of(nj.near_duplicates(df)) == [(False, 1, 1, 1), (False, 2, 1, 1), (False, 3, 3, 0)]


def test_pair_counts_once(spark):
    """Links are symmetric: their sum is even, whatever buckets a pair meets in."""
    base = prose(9, 100)
    docs = [(i, " ".join(edited(base, i % 3, i))) for i in range(30)]
    got = nj.near_duplicates(table(spark, docs)).collect()
    assert sum(r["n_links"] for r in got) % 2 == 0
    assert Counter((r["doc_id"], r["n_links"]) for r in got) == Counter((d, n) for (d, _), (_, n) in zip(docs, links_and_classes(docs)))


def test_runs_reach_the_target_recall():
    """Pairs whose sketches agree in 8 of 10 coordinates, through all levels of all runs."""
    r = np.random.default_rng(0)
    n = 4000
    a = r.integers(0, 2 ** 32, (n, nj.COORDINATES), dtype=np.uint32)
    b = np.where(r.random(a.shape) < 0.8, a, r.integers(0, 2 ** 32, a.shape, dtype=np.uint32))
    met = np.zeros(n, bool)
    for run in range(nj.runs_for(nj.RECALL)):
        start = np.full(n, nj.mix(np.array([run + 1], np.uint64))[0])
        here = (np.arange(n), start)
        for _ in range(nj.DEPTH + 1):
            sides = []
            for sketch in (a, b):
                row, path = nj._children(here[1], sketch[here[0]])
                sides.append(set(zip(here[0][row].tolist(), path.tolist())))
            both = sorted(sides[0] & sides[1])
            here = np.array([x for x, _ in both], np.int64), np.array([y for _, y in both], np.uint64)
        met[here[0]] = True
    assert met.mean() >= nj.RECALL - 0.005
    assert nj.runs_for(0.5) < nj.runs_for(0.9) < nj.runs_for(0.999)


def test_a_large_group_of_near_copies_is_dealt_once(spark, monkeypatch):
    """Rows that are split or compared grow with the group, not with its square."""
    made = {}

    def counted(df, name):
        out = written(df, name)
        made.setdefault(name, []).append(out.count())
        return out

    written = nj.materialise
    monkeypatch.setattr(nj, "materialise", counted)
    for n in (300, 600):
        made.clear()
        base = prose(3, 120)
        got = nj.near_duplicates(table(spark, [(i, " ".join(edited(base, 1 + i % 2, i))) for i in range(n)])).collect()
        assert {r["class_id"] for r in got} == {0}
        assert sum(made["join-level"]) < 40 * n and sum(made["join-leaves"]) < 12 * n


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8)], [(i, i + 1) for i in range(40)], [(50, i) for i in range(40)]])
def test_components(spark, edges):
    got = {r["node"]: r["label"] for r in nj.components(table(spark, edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e}
    label = {x: x for x in nodes}
    for _ in nodes:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_sql_of_the_query(spark, tmp_root):
    base = prose(12, 40)
    docs = [(i, " ".join(edited(base, i % 3, i))) for i in range(12)] + [(20, ""), (21, None), (22, "a b"), (23, "a b"), (24, "a b c d e")]
    df = table(spark, docs)
    con = duckdb.connect()
    df.write.parquet(f"{tmp_root}/documents.parquet")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_root}/documents.parquet/*.parquet')")
    got = con.execute(f"SELECT doc_id, class_id, n_links FROM ({nj.links_sql()}) q").fetchall()
    assert sorted((d is None, d, c, n) for d, c, n in got) == expected(docs)


def test_texts_that_nothing_asks_for_stay(spark, monkeypatch):
    """The join that brings texts sends those of the classes to compare, not the table."""
    texts = spark.range(20_000).selectExpr("id AS doc_id", "concat('text ', id) AS _text")
    wanted = spark.range(0, 20_000, 40).selectExpr("id AS first_doc", "id % 7 AS path").unionByName(spark.range(1).selectExpr("id AS first_doc", "id AS path"))
    got = {r["first_doc"]: r["text"] for r in nj.wanted_texts(texts, wanted).collect()}
    assert all(got[i] == f"text {i}" for i in range(0, 20_000, 40)) and len(got) < 4_000
    monkeypatch.setattr(nj, "MOST_BITS", 1 << 8)        # a full map lets others pass, and loses none
    assert {r["first_doc"] for r in nj.wanted_texts(texts, wanted).collect()} >= set(range(0, 20_000, 40))
    assert nj.wanted_texts(texts, wanted.where("false")).count() == 0


def test_same_links_without_broadcast_joins(spark):
    docs = [(i, " ".join(edited(prose(i // 10, 80), i % 3, i))) for i in range(120)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(nj.near_duplicates(table(spark, docs))) == expected(docs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sketches_by_byte():
    sketch = np.random.default_rng(3).integers(0, 2 ** 32, (5, nj.COORDINATES), dtype=np.uint64).astype(np.uint32)
    stored = [r.tobytes() for r in nj._planes(sketch)]
    assert (nj._sketches_of(nj.pa.array(stored)) == sketch).all()
    assert (np.frombuffer(stored[0][:nj.COORDINATES], np.uint8) == sketch[0] % 256).all()
