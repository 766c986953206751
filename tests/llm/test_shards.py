import hashlib
from collections import defaultdict

import pytest

from pixelchange.llm import shards
from tests.llm.helpers import prose, table


def expected(docs, limit):
    """Split one bit at a time."""
    rows = []
    for d, t in docs:
        digest = hashlib.md5(b"\x01".join(((str(d) if d is not None else "\x00").encode(), (t if t is not None else "\x00").encode()))).hexdigest()
        rows.append((d, len((t or "").encode()), int(digest[:15], 16)))
    size_of = defaultdict(int)
    for _, n, h in rows:
        size_of[h] += n
    out = [(d, n, 60, h) for d, n, h in rows if size_of[h] > limit]

    def split(part, depth, prefix):
        if not part:
            return
        if sum(n for _, n, _ in part) <= limit:
            out.extend((d, n, depth, prefix) for d, n, _ in part)
            return
        for bit in (0, 1):
            split([r for r in part if (r[2] >> (59 - depth)) & 1 == bit], depth + 1, prefix * 2 + bit)

    split([r for r in rows if size_of[r[2]] <= limit], 0, 0)
    return sorted((d is None, d or 0, n, depth, prefix) for d, n, depth, prefix in out)


DOCS = [(i, " ".join(prose(i, 1 + i * i % 60))) for i in range(300)] + [(1000, None), (1001, ""), (None, "x"), (None, None), (1002, "long " * 5000), (5, " ".join(prose(5, 26)))]


@pytest.mark.parametrize("limit,slack", [(1 << 20, 5), (4000, 5), (4000, 0), (700, 1)])
def test_against_splitting_bit_by_bit(spark, monkeypatch, limit, slack):
    monkeypatch.setattr(shards.assign, "__defaults__", (shards.LIMIT_BYTES, slack))
    got = shards.shard_documents(table(spark, DOCS), limit).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["depth"], r["prefix"]) for r in got) == expected(DOCS, limit)
    total = defaultdict(int)
    for r in got:
        total[r["depth"], r["prefix"], r["page"]] += r["n_bytes"]
    assert all(total[r["depth"], r["prefix"], r["page"]] == r["shard_bytes"] for r in got)
    assert all(n <= limit or k[0] == 60 for k, n in total.items())


def test_repeated_rows_go_to_pages(spark):
    docs = [(1, "same text here")] * 500 + [(i, "short") for i in range(2, 30)]
    got = shards.shard_documents(table(spark, docs).repartition(7), 100).collect()
    total = defaultdict(int)
    for r in got:
        total[r["depth"], r["prefix"], r["page"]] += r["n_bytes"]
    assert len(got) == len(docs) and max(total.values()) <= 100
    assert all(total[r["depth"], r["prefix"], r["page"]] == r["shard_bytes"] for r in got)


def test_empty_table_and_clashing_columns(spark):
    assert shards.shard_documents(table(spark, [])).collect() == []
    df = table(spark, [(1, "abc", 5, "h")], "doc_id long, text string, n_bytes int, h string")
    assert [tuple(r) for r in shards.shard_documents(df).collect()] == [(1, 3, 0, 0, 0, 3)]


def test_written_shards_hold_all_rows(spark, tmp_path):
    path = str(tmp_path / "shards")
    shards.write_shards(table(spark, DOCS), path, 4000)
    back = spark.read.parquet(path)
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in back.collect())) == sorted((d is None, d or 0, t or "") for d, t in DOCS)
    assert back.select("shard").distinct().count() > 4
