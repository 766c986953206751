"""S3: output namespace (database) name from the two source paths and the version."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..config import NAMESPACE_FORMAT, VERSION


def namespace_column(ard_path, aux_path, version) -> Column:
    """Paths without slashes and the version, put into the namespace format,
    lower case, everything but letters, digits and '_' replaced by '_', and
    nothing of that in front."""
    part = [F.regexp_replace(F.col(p) if isinstance(p, str) else p, "/", "") for p in (ard_path, aux_path)]
    last = F.trim(F.col(version) if isinstance(version, str) else version)
    form = F.format_string(NAMESPACE_FORMAT.replace("{0}", "%1$s").replace("{1}", "%2$s").replace("{2}", "%3$s"), *part, last)
    return F.ltrim(F.lower(F.regexp_replace(form, "[^A-Za-z0-9_]", "_")), F.lit("_"))


def url_path(url) -> Column:
    """Path of a URL; a text without scheme is a path itself."""
    u = F.col(url) if isinstance(url, str) else url
    bare = F.regexp_replace(u, "[?#].*$", "")
    return F.when(u.contains("://"), F.regexp_replace(bare, "^[^:]*://[^/]*", "")).otherwise(bare)


def namespace_name(spark: SparkSession, ard_url: str = "", aux_url: str = "", version: str = VERSION) -> str:
    """The name for two URLs: ('', '', '1.0') gives 'ccdc_1_0'."""
    row = spark.range(1).select(namespace_column(url_path(F.lit(ard_url)), url_path(F.lit(aux_url)), F.lit(version)).alias("n"))
    return row.first()["n"]
