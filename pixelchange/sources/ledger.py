"""Ledger of finished chips, so that a stopped detection run goes on where it was.

A row says that a chip is done for a date range and a set of detector parameters.
Rows are only ever appended, by tile, after all tables of a chunk are written: a run
that ends in between does the chunk again, and its keyed writes replace themselves.
A run begins with an anti join of its chips and the ledger.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LEDGER_TABLE
from .tables import PARTITION_COLUMNS, _exists, table_path, with_tile

SCHEMA = "cx int, cy int, acquired string, params string, tx int, ty int"


def params_key(params) -> str:
    """Name of a set of detector parameters: equal sets, equal names."""
    return hashlib.sha256(repr(params).encode()).hexdigest()[:16]


def finished(spark: SparkSession, root: str, acquired: str, params) -> DataFrame:
    """Chips (cx, cy) that are done for a date range and parameters."""
    path = table_path(root, LEDGER_TABLE)
    if not _exists(spark, path):
        return spark.createDataFrame([], "cx int, cy int")
    rows = spark.read.schema(SCHEMA).option("basePath", path).parquet(path)
    return rows.where((F.col("acquired") == acquired) & (F.col("params") == params_key(params))).select("cx", "cy").distinct()


def open_chips(chips: DataFrame, root: str, acquired: str, params) -> DataFrame:
    """The chips that the ledger does not have."""
    return chips.join(finished(chips.sparkSession, root, acquired, params), ["cx", "cy"], "left_anti")


def record(chips: DataFrame, root: str, acquired: str, params) -> None:
    """Note chips as done (one small file a tile and call)."""
    rows = with_tile(chips.select(F.col("cx").cast("int").alias("cx"), F.col("cy").cast("int").alias("cy")).distinct())
    (rows.withColumn("acquired", F.lit(acquired)).withColumn("params", F.lit(params_key(params)))
     .coalesce(1).write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(table_path(root, LEDGER_TABLE)))
