"""Declared schemas of ids, series, detection results and stored tables."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, ByteType, FloatType, IntegerType,
                               StringType, StructField, StructType)

from .config import BAND_PREFIX, BANDS, FEATURE_COLUMNS


def _int(name, nullable=False):
    return StructField(name, IntegerType(), nullable)


def chip_id_schema() -> StructType:
    return StructType([_int("cx"), _int("cy")])


def tile_id_schema() -> StructType:
    return StructType([_int("tx"), _int("ty")])


def _int_array(name, nullable=False):
    return StructField(name, ArrayType(IntegerType(), False), nullable)


def _float_array(name, nullable=True):
    return StructField(name, ArrayType(FloatType(), False), nullable)


def series_schema(name: str | None = None):
    """'ard' or 'aux' series schema; unknown name gives None, no name gives both."""
    keys = [_int("cx"), _int("cy"), _int("px"), _int("py"), _int_array("dates")]
    schemas = {
        "ard": StructType(keys + [_int_array(c) for c in
                                  ["blues", "greens", "reds", "nirs", "swir1s",
                                   "swir2s", "thermals", "qas"]]),
        "aux": StructType(keys + [_float_array("dem"), _int_array("trends"),
                                  _int_array("aspect", True), _float_array("posidex"),
                                  _float_array("slope"), _int_array("mpw", True)]),
    }
    return schemas.get(name) if name else schemas


def _segment_fields():
    f = lambda n: StructField(n, FloatType(), True)
    fields = [_int("cx"), _int("cy"), _int("px"), _int("py"),
              StructField("sday", StringType(), False),
              StructField("eday", StringType(), False),
              StructField("bday", StringType(), True),
              f("chprob"), StructField("curqa", IntegerType(), True)]
    fields += [f(BAND_PREFIX[b] + "mag") for b in BANDS]
    fields += [f(BAND_PREFIX[b] + "rmse") for b in BANDS]
    fields += [StructField(BAND_PREFIX[b] + "coef", ArrayType(FloatType()), True) for b in BANDS]
    fields += [f(BAND_PREFIX[b] + "int") for b in BANDS]
    return fields


def segment_schema() -> StructType:
    """The 38 column segment table."""
    return StructType(_segment_fields() + [StructField("rfrawp", ArrayType(FloatType()), True)])


def detection_schema() -> StructType:
    """Wide detection result: segment columns + dates + mask (+ rfrawp)."""
    return StructType(_segment_fields() + [
        StructField("dates", ArrayType(StringType()), False),
        StructField("mask", ArrayType(ByteType()), True),
        StructField("rfrawp", ArrayType(FloatType()), True)])


def chip_schema() -> StructType:
    return StructType([_int("cx"), _int("cy"),
                       StructField("dates", ArrayType(StringType()), False)])


def pixel_schema() -> StructType:
    return StructType([_int("cx"), _int("cy"), _int("px"), _int("py"),
                       StructField("mask", ArrayType(ByteType()), True)])


def tile_schema() -> StructType:
    return StructType([_int("tx"), _int("ty"),
                       StructField("name", StringType(), False),
                       StructField("model", StringType(), False),
                       StructField("updated", StringType(), False)])


def feature_columns() -> list[str]:
    return list(FEATURE_COLUMNS)
