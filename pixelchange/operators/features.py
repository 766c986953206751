"""Features for the classifier."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..config import EXCLUDED_TRENDS, FEATURE_COLUMNS, PIXEL_KEY

FEATURE_KEYS = ["cx", "cy", "px", "py", "sday", "eday"]


def first_trend():
    """trends[0], null for an empty or missing array (no ANSI error)."""
    return F.get(F.col("trends"), 0)


def filter_labels(aux: DataFrame) -> DataFrame:
    """P5: drop pixels whose first trends value is 0 or 9 (or missing)."""
    return aux.where(~first_trend().isin(*EXCLUDED_TRENDS))


def dependent(df: DataFrame) -> DataFrame:
    """label = trends[0]."""
    return df.withColumn("label", first_trend())


def _scalar_columns(df: DataFrame, columns):
    """Each feature as a double column: arrays give their first element."""
    out = []
    for c in columns:
        dt = df.schema[c].dataType
        v = F.get(F.col(c), 0) if isinstance(dt, ArrayType) else F.col(c)
        out.append(v.cast("double").alias(f"_f_{c}"))
    return out


def independent(df: DataFrame, columns=None, output: str = "features") -> DataFrame:
    """dense feature vector of the first element of each array
    column and each scalar column, in ``FEATURE_COLUMNS`` order.  Null
    becomes NaN (VectorAssembler 'keep'), all in the JVM, no Python UDF."""
    columns = columns or FEATURE_COLUMNS
    scal = _scalar_columns(df, columns)
    tmp = df.select("*", *scal)
    va = VectorAssembler(inputCols=[f"_f_{c}" for c in columns], outputCol=output, handleInvalid="keep")
    return va.transform(tmp).drop(*[f"_f_{c}" for c in columns])


def join_features(aux: DataFrame, ccd: DataFrame) -> DataFrame:
    """Aux series inner join detection rows on the pixel key."""
    return aux.join(ccd, PIXEL_KEY, "inner")


def features(aux: DataFrame, ccd: DataFrame) -> DataFrame:
    """M1: join -> label -> vector -> keys, label, features."""
    df = independent(dependent(join_features(aux, ccd)))
    return df.select(*FEATURE_KEYS, "label", "features")
