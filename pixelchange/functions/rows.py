"""one JSON string per row, the canonical form the original tests compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_json(df: DataFrame, columns=None) -> Column:
    """``to_json(struct(...))`` over the given (default: all) columns, in order."""
    cols = columns or df.columns
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]))


def json_rows(df: DataFrame, columns=None) -> DataFrame:
    return df.select(row_json(df, columns).alias("json"))
