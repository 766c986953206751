"""Catalogue namespaces and bucketed tables (S1, S3, J6, J7 by ``spark.table``).

A namespace is a database of the session's catalogue, named by
``functions.names``.  Its tables are bucketed and sorted by the pixel key, with one
file a bucket, so frames of one namespace (or of two with the same number of
buckets) that are joined on the pixel meet where they lie: the shuffle is paid once,
when a table is saved, not in each of the classifier's joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AUX_TABLE, CHIP_KEY, DETECTION_TABLE, PIXEL_KEY, PIXEL_TABLE, SEGMENT_TABLE
from . import tables as T

# Key that a table is bucketed by; a chip table by its chip.
BUCKET_KEYS = {AUX_TABLE: PIXEL_KEY, PIXEL_TABLE: PIXEL_KEY, SEGMENT_TABLE: PIXEL_KEY, DETECTION_TABLE: PIXEL_KEY}
# Uncompressed bytes that a bucket should hold.
BUCKET_BYTES = 256 * 1024 * 1024


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def create(spark: SparkSession, name: str, location: str | None = None) -> str:
    """S3: the database ``name``, made if it isn't there; ``location``: a shared folder
    (default: the warehouse)."""
    where = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}{where}")
    return name


def tables(spark: SparkSession, name: str) -> list[str]:
    """Names of a namespace's tables, in order; none if there is no such namespace."""
    if not spark.catalog.databaseExists(_quoted(name)):
        return []
    return sorted(t.name for t in spark.catalog.listTables(_quoted(name)) if not t.isTemporary)


def buckets_for(rows: int, row_bytes: int) -> int:
    """Buckets for a number of rows, at ``BUCKET_BYTES`` each; a power of two, so that the
    buckets of one table are whole parts of another's."""
    need = -(-rows * row_bytes // BUCKET_BYTES)
    return 1 << max(0, need - 1).bit_length()


def save(df: DataFrame, name: str, table: str, buckets: int, key=None) -> DataFrame:
    """Write ``df`` as a table of the namespace, in place of one of that name, and read it.

    Rows are dealt by the bucket hash first, so a task writes one bucket, one file.
    A plan that reads the table to be replaced raises an error (Spark's own check)."""
    spark = df.sparkSession
    key = list(key or BUCKET_KEYS.get(table, CHIP_KEY))
    dealt = df.repartition(buckets, *key)
    dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, *key).sortBy(*key).saveAsTable(_quoted(name, table))
    return read(spark, name, table)


def read(spark: SparkSession, name: str, table: str) -> DataFrame:
    """A table of a namespace."""
    return spark.table(_quoted(name, table))


def publish(spark: SparkSession, root: str, name: str, table: str, buckets: int, ids: DataFrame | None = None) -> DataFrame:
    """The newest rows of a stored table (of some chips) as a table of the namespace."""
    rows = T.scan_table(spark, root, table).drop(*T.PARTITION_COLUMNS) if ids is None else T.read_by_ids(spark, root, table, ids)
    return save(rows, name, table, buckets)


def join_in_place(left: DataFrame, right: DataFrame, key=None, also=()) -> DataFrame:
    """Inner join of two tables bucketed by ``key`` (default: the pixel) on it and on ``also``.

    Spark keeps buckets only if they are by all columns of the equality, so ``also``
    (a segment's days: a pixel has few) is compared as a range of one value.  Columns
    of ``right`` that ``left`` has too, other than these, must be dropped before."""
    key = list(key or PIXEL_KEY)
    other = right.select(*key, *[F.col(c).alias(f"_also_{c}") for c in also], *[c for c in right.columns if c not in key and c not in also])
    out = left.join(other.hint("merge"), key, "inner")
    for c in also:
        out = out.where((F.col(c) <= F.col(f"_also_{c}")) & (F.col(c) >= F.col(f"_also_{c}")))
    return out.drop(*[f"_also_{c}" for c in also])
