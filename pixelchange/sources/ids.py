"""Chip and tile id frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import chip_id_schema, tile_id_schema


def chip_schema():
    return chip_id_schema()


def tile_schema():
    return tile_id_schema()


def ids_frame(spark: SparkSession, xys, schema=None, partitions: int | None = None) -> DataFrame:
    """A small local list of (x, y) -> id DataFrame of the given schema.

    For lists that come from a query use the DataFrame itself (see
    ``conform_ids``); this is only for ids typed in by a user.
    """
    schema = schema or chip_id_schema()
    rows = [tuple(int(v) for v in xy) for xy in xys]
    df = spark.createDataFrame(rows, schema)
    return df.repartition(partitions) if partitions else df


def conform_ids(df: DataFrame, x="cx", y="cy", names=("cx", "cy")) -> DataFrame:
    """Cast any (x, y) id columns to the non-null int id schema."""
    return df.select(F.col(x).cast("int").alias(names[0]), F.col(y).cast("int").alias(names[1])) \
             .where(F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull())
