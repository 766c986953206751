"""Projections, filters and joins of detection results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..config import BAND_PREFIX, CHIP_KEY, PIXEL_KEY, SEGMENT_KEY, SENTINEL_DAY
from ..functions.dates import ordinal_to_iso


def project_chip(ccd: DataFrame) -> DataFrame:
    """Wide result -> one (cx, cy, dates) row per chip.

    The chip's dates are the sorted union of its pixels' dates (equal to
    any pixel's dates when, as with raster chips, all pixels share them).
    Days are made distinct map side first, so hot chips are pre-reduced and only
    their distinct days are collected.
    """
    d = ccd.select(*CHIP_KEY, F.explode("dates").alias("d")).distinct()
    return d.groupBy(*CHIP_KEY).agg(F.array_sort(F.collect_list("d")).alias("dates"))


def project_pixel(ccd: DataFrame) -> DataFrame:
    """Wide result -> one (cx, cy, px, py, mask) row per pixel."""
    return ccd.select(*schemas.pixel_schema().fieldNames()).dropDuplicates(PIXEL_KEY)


def project_segment(ccd: DataFrame) -> DataFrame:
    """Wide result -> the 38 segment columns."""
    return ccd.select(*schemas.segment_schema().fieldNames())


def filter_period(df: DataFrame, msday: int, meday: int) -> DataFrame:
    """Segments lying inside [msday, meday] (day numbers).  Days are
    ISO strings, so the bounds are turned into ISO strings too (string
    order equals date order for four digit years)."""
    lo = ordinal_to_iso(F.lit(msday))
    hi = ordinal_to_iso(F.lit(meday))
    return df.where((F.col("sday") >= lo) & (F.col("eday") <= hi))


def filter_detected(df: DataFrame) -> DataFrame:
    """Drop the day-1 sentinel segments of pixels without a model."""
    return df.where(F.col("eday") > F.lit("0001-01-01"))


def join_predictions(segments: DataFrame, predictions: DataFrame) -> DataFrame:
    """The prediction's rfrawp replaces the stored one."""
    return segments.drop("rfrawp").join(predictions, SEGMENT_KEY, "inner")


# Names of the fields of nested change models and the ending
# that each gets in the flat row.
MODEL_FIELDS = {"magnitude": "mag", "rmse": "rmse", "coefficients": "coef", "intercept": "int"}


def change_model_type() -> str:
    """DDL of one nested change model."""
    band = "struct<magnitude:float,rmse:float,coefficients:array<float>,intercept:float>"
    return ("struct<start_day:int,end_day:int,break_day:int,observation_count:int,change_probability:float,curve_qa:float,"
            + ",".join(f"{b}:{band}" for b in BAND_PREFIX) + ">")


def format_change_models(results: DataFrame) -> DataFrame:
    """D4/D5/F6 for nested results: pixel keys, ``dates`` (day numbers),
    ``change_models`` (array of ``change_model_type``) and
    ``processing_mask`` -> one flat row per model.

    Without models a pixel gets the sentinel model of day 1.  Absent fields
    (null bands, days, models) give null."""
    sentinel = F.array(F.named_struct(*[x for f in ("start_day", "end_day", "break_day") for x in (F.lit(f), F.lit(SENTINEL_DAY))]))
    kind = f"array<{change_model_type()}>"
    known = results.schema["change_models"].dataType.elementType.fieldNames()
    full = F.transform(F.coalesce("change_models", F.array().cast(results.schema["change_models"].dataType)), lambda m: F.struct(*[
        (m[f.name] if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name) for f in _fields(kind)]))
    empty = F.transform(sentinel, lambda m: F.struct(*[
        (m[f.name] if f.name in ("start_day", "end_day", "break_day") else F.lit(None).cast(f.dataType)).alias(f.name) for f in _fields(kind)]))
    models = F.when(F.size(full) > 0, full.cast(kind)).otherwise(empty.cast(kind))
    rows = results.select(*PIXEL_KEY, "dates", "processing_mask", F.explode(models).alias("m"))
    cols = [ordinal_to_iso(F.col(f"m.{a}")).alias(b) for a, b in (("start_day", "sday"), ("end_day", "eday"), ("break_day", "bday"))]
    cols += [F.col("m.change_probability").alias("chprob"), F.col("m.curve_qa").cast("int").alias("curqa")]
    cols += [F.col(f"m.{b}.{field}").alias(p + end) for field, end in MODEL_FIELDS.items() for b, p in BAND_PREFIX.items()]
    return rows.select(*PIXEL_KEY, *cols, F.transform("dates", lambda d: ordinal_to_iso(d)).alias("dates"),
                       F.col("processing_mask").cast("array<tinyint>").alias("mask"), F.lit(None).cast("array<float>").alias("rfrawp"))


def _fields(kind: str):
    return StructType.fromDDL(f"a {kind}")["a"].dataType.elementType.fields
