"""Ranked lexical search against plain scoring of every document for every item."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np

from pixelchange.llm import lexical_rank as lr
from pixelchange.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import table, write

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def expected(docs, items, k=10):
    """Rows (item_id, rank, doc_id, score) in order, ids of equal score ascending."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    n_terms = sum(sum(c.values()) for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    out, wanted = [], {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    for i, want in wanted.items():
        scored = []
        for d, c in counted:
            if not c:
                continue
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in want if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed, n, words=300):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Ünï", "ÉCOLE", "école", "漢字", "A1b", "x"]
    draw = lambda m: " ".join(r.choice(vocabulary) + r.choice(["", ",", ". ", "-"]) for _ in range(m))
    docs = [(i, draw(r.randrange(1, 60))) for i in range(n)]
    items = [(i, draw(r.randrange(1, 30))) for i in range(70)]
    return docs, items


def test_all_pairs(spark):
    docs, items = corpus(1, 2500)
    docs += [(9000 + i, docs[7][1]) for i in range(40)]      # ties beyond the tenth
    assert found(lr.search(table(spark, docs), table(spark, items, "item_id long, text string"))) == expected(docs, items)


def test_blocks_of_items_give_the_same_rows(spark):
    docs, items = corpus(2, 300)
    got = lr.search(table(spark, docs), table(spark, items, "item_id long, text string"), block_bytes=1500)
    assert found(got) == expected(docs, items)


def test_narrow_tiles_give_the_same_scores(monkeypatch, spark):
    docs, items = corpus(3, 200)
    monkeypatch.setattr(lr, "TERMS", 7)
    monkeypatch.setattr(lr, "ITEMS", 3)
    monkeypatch.setattr(lr, "DOCS", 11)
    assert found(lr.search(table(spark, docs), table(spark, items, "item_id long, text string"))) == expected(docs, items)


def test_nulls_empty_and_long_texts_ties_and_repeats(spark):
    long = "alpha beta " * 60_000
    docs = [(1, None), (2, ""), (3, "!!! \x00"), (None, "alpha beta"), (None, "alpha beta"), (5, "alpha beta"), (5, "alpha beta"),
            (4, "ALPHA, beta"), (6, long), (7, "ÀLPHA alpha"), (8, "gamma")]
    items = [(1, "Alpha alpha beta"), (1, "gamma"), (2, None), (None, "alpha"), (3, "nowhere"), (4, ""), (1, "gamma")]
    assert found(lr.search(table(spark, docs), table(spark, items, "item_id long, text string"))) == expected(docs, items)


def test_a_term_of_every_document(spark):
    """w is small, not negative, where all documents hold the term."""
    docs = [(i, "same " + "word " * i) for i in range(30)]
    items = [(1, "same word")]
    assert found(lr.search(table(spark, docs), table(spark, items, "item_id long, text string"))) == expected(docs, items)


def test_empty_tables_and_extra_columns(spark, tmp_root):
    empty_docs, empty_items = table(spark, []), table(spark, [], "item_id long, text string")
    docs, items = corpus(4, 20)
    assert lr.search(table(spark, docs), empty_items).collect() == []
    assert lr.search(empty_docs, table(spark, items, "item_id long, text string")).collect() == []
    extra = table(spark, docs).selectExpr("*", "1 AS n", "2 AS score", "3 AS rank", "'x' AS term", "4 AS item_id")
    more = table(spark, items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS score", "3 AS block")
    path = write(spark, tmp_root, documents=extra, benchmark=more)
    assert found(QUERIES["op13_lexical_rank"](spark, path)) == expected(docs, items)


def test_the_query_and_its_sql_on_the_given_tables(spark):
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{name}.parquet").select(*c).collect()]
    want = expected(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    assert found(QUERIES["op13_lexical_rank"](spark, SF_SMALL)) == want
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    assert sorted(con.execute(ORACLE["op13_lexical_rank"]).fetchall(), key=repr) == want


def test_best_breaks_ties_by_id():
    row, score, ident = np.array([0, 0, 0, 1, 1]), np.array([5, 9, 5, 2, 2]), np.array([3, 8, 1, 6, 4])
    kept = lr.best(row, score, ident, 2)
    assert sorted(zip(row[kept], score[kept], ident[kept])) == [(0, 5, 1), (0, 9, 8), (1, 2, 4), (1, 2, 6)]
