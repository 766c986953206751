"""Sharding by extendible hashing.

Every row has a 60-bit hash.  A shard is a prefix of hash bits; a prefix
whose rows are over the byte limit is split on the next bit, others stay.
Bytes are added up per prefix of ``slack`` bits more than the total asks
for, so rows are read once; only what is still over the limit there goes a
few bits deeper.  Rows of equal hash (repeated rows) can't be split by
bits; they are dealt to numbered pages of their prefix.  The directory is
a table and is joined, never collected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelchange.llm.common import materialise

BITS = 60
LIMIT_BYTES = 1 << 20
SLACK = 5           # bits that the first histogram has beyond log2(total / limit)


def hash60(*columns: str) -> Column:
    """First 60 bits of the MD5 of the columns' texts (null: a mark of its own)."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("\x01", *texts)), 1, 15), 16, 10).cast("long")


def _lowest(hist: DataFrame, top: int, depth: int, limit: int) -> int:
    """The fewest bits with which some prefix fits: sums of siblings, from ``depth``
    bits up to where none is within the limit.  So no prefix of so few bits that all
    rows share it is ever a key, unless they fit it."""
    level = hist.select(F.col("p").alias("prefix"), "bytes")
    while depth > top:
        level = materialise(level.groupBy(F.shiftright("prefix", 1).alias("prefix")).agg(F.sum("bytes").alias("bytes")), "shard-level")
        if level.where(F.col("bytes") <= limit).isEmpty():
            break
        depth -= 1
    return depth


def _settle(hist: DataFrame, top: int, depth: int, limit: int) -> DataFrame:
    """Directory of all prefixes of ``depth`` bits: the fewest bits, from ``top``
    on, with which the bytes fit (null: not even with all)."""
    levels = (hist.select("p", "bytes", F.explode(F.sequence(F.lit(_lowest(hist, top, depth, limit)), F.lit(depth))).alias("depth"))
              .withColumn("prefix", F.expr(f"shiftright(p, {depth} - depth)")))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes")).where(F.col("shard_bytes") <= limit)
    best = (levels.join(fits, ["depth", "prefix"])
            .groupBy("p").agg(F.min(F.struct("depth", "prefix", "shard_bytes")).alias("s")))
    return hist.select("p").join(best, "p", "left").select(
        "p", F.col("s.depth").alias("depth"), F.col("s.prefix").alias("prefix"), F.col("s.shard_bytes").alias("shard_bytes"))


def assign(rows: DataFrame, limit_bytes: int = LIMIT_BYTES, slack: int = SLACK) -> DataFrame:
    """Shard of each row of ``rows`` (columns ``h``, a hash of ``BITS`` bits, and
    ``n_bytes``; others are kept).

    Adds ``depth``, ``prefix``, ``page`` and ``shard_bytes``.  Rows of equal
    hash that are over the limit together take no part in the splitting:
    they have all bits as prefix and are dealt to pages; ``page`` is 0 for
    all others.  A shard exceeds the limit only where one row does.  An empty
    table gives none."""
    leaves = materialise(rows.groupBy("h").agg(F.sum("n_bytes").alias("bytes")), "shard-hashes")
    light, heavy = leaves.where(F.col("bytes") <= limit_bytes), leaves.where(F.col("bytes") > limit_bytes)
    total = light.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit_bytes)))) + slack)
    place = heavy.select("h", F.lit(None).cast("int").alias("depth"), F.col("h").alias("prefix"), F.lit(None).cast("long").alias("shard_bytes"))
    pending, top = light, 0
    while True:
        hist = pending.groupBy(F.shiftright("h", BITS - depth).alias("p")).agg(F.sum("bytes").alias("bytes"))
        directory = materialise(_settle(hist, top, depth, limit_bytes), "shard-directory")
        known = directory.where("depth IS NOT NULL")
        place = place.unionByName(pending.join(known, F.shiftright("h", BITS - depth) == F.col("p")).select("h", "depth", "prefix", "shard_bytes"))
        over = directory.where("depth IS NULL").select("p")
        if depth == BITS or over.isEmpty():
            break
        pending = pending.join(over, F.shiftright("h", BITS - depth) == F.col("p"), "left_semi")
        top, depth = depth + 1, min(BITS, depth + slack + 3)
    settled = rows.join(place, "h")
    fine = settled.where("depth IS NOT NULL").withColumn("page", F.lit(0).cast("long"))
    if heavy.isEmpty():
        return fine
    return fine.unionByName(_pages(settled.where("depth IS NULL"), limit_bytes))


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Pages for rows of equal hash that don't fit one shard together.

    Numbers go up within a partition and from partition to partition, so no
    task holds a group.  Rows of one hash are of one size or take the largest."""
    at = rows.withColumn("_id", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_id", 33))
    at = materialise(at, "shard-pages")
    counts = at.groupBy("h", "_task").agg(F.count(F.lit(1)).alias("c"), F.min("_id").alias("_first"), F.max("n_bytes").alias("_size"))
    by_hash = counts.groupBy("h").agg(F.sort_array(F.collect_list(F.struct("_task", "c"))).alias("tasks"), F.max("_size").alias("_size"))
    start = by_hash.select("h", "_size", F.posexplode("tasks").alias("i", "t"), "tasks").select(
        "h", "_size", F.col("t._task").alias("_task"),
        F.expr("aggregate(slice(tasks, 1, i), 0L, (a, x) -> a + x.c)").alias("_before"))
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("_size"), F.lit(1))))
    w = Window.partitionBy("h", "_task").orderBy("_id")
    numbered = at.join(start, ["h", "_task"]).withColumn("_n", F.row_number().over(w) - 1 + F.col("_before"))
    paged = numbered.withColumn("page", F.floor(F.col("_n") / per_page).cast("long")).withColumn("depth", F.lit(BITS))
    sizes = paged.groupBy("h", "page").agg(F.sum("n_bytes").alias("_bytes"))
    return (paged.join(sizes, ["h", "page"]).withColumn("shard_bytes", F.col("_bytes"))
            .drop("_id", "_task", "_size", "_before", "_n", "_bytes"))


def shard_documents(docs: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """Shard of each document, by hash of id and whole text.

    ``doc_id``, ``n_bytes`` (UTF-8; null: 0), ``depth``, ``prefix``, ``page``,
    ``shard_bytes``."""
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       hash60("doc_id", "text").alias("h"))
    return assign(rows, limit_bytes).select("doc_id", "n_bytes", "depth", "prefix", "page", "shard_bytes")


def write_shards(docs: DataFrame, path: str, limit_bytes: int = LIMIT_BYTES) -> None:
    """Write whole documents as Parquet, one folder a shard."""
    rows = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).withColumn("h", hash60("doc_id", "text"))
    named = assign(rows, limit_bytes).withColumn(
        "shard", F.concat_ws("-", F.lpad(F.col("depth").cast("string"), 2, "0"), F.lpad(F.hex("prefix"), 15, "0"), F.col("page").cast("string")))
    (named.drop("h", "n_bytes", "depth", "prefix", "page", "shard_bytes")
     .repartition("shard").write.partitionBy("shard").parquet(path))


def shard_sql(limit_bytes: int = LIMIT_BYTES) -> str:
    """The assignment as DuckDB SQL (for tables where no hash occurs twice)."""
    return f"""
    WITH d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
                      ('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0)) || chr(1) || coalesce(text, chr(0))), 1, 15))::BIGINT AS h
               FROM documents),
    e AS (SELECT *, sum(n_bytes) OVER (PARTITION BY h) > {limit_bytes} AS heavy FROM d),
    l AS (SELECT doc_id, n_bytes, h, heavy, depth, h >> ({BITS} - depth) AS prefix
          FROM e, (SELECT unnest(range(0, {BITS} + 1))::INT AS depth) WHERE depth = {BITS} OR NOT heavy),
    b AS (SELECT depth, prefix, heavy, sum(n_bytes)::BIGINT AS shard_bytes FROM l GROUP BY 1, 2, 3),
    f AS (SELECT l.*, b.shard_bytes, row_number() OVER (PARTITION BY l.doc_id, l.h ORDER BY l.depth) AS i
          FROM l JOIN b USING (depth, prefix, heavy) WHERE b.shard_bytes <= {limit_bytes} OR depth = {BITS})
    SELECT doc_id, n_bytes, depth, prefix, 0::BIGINT AS page, shard_bytes FROM f WHERE i = 1"""
