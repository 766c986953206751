"""Adapters from the driver's tables to the pixel data model.

The queries read real, growing tables (``/root/testdata/sf*/``):

* ``customer`` rows are points (x, y) spread over 5 x 5 tiles,
* ``part`` rows are pixels (the same placement rule on p_partkey) and
  carry the auxiliary layers,
* ``lineitem`` rows are acquisitions of their part's pixel: one
  observation per (part, ship day), bands from quantity, price, discount
  and tax, quality from the return flag,
* ``events`` rows are layers keyed by type (for band pivoting).

Every mapping is a column expression, so the stand-ins are narrow
projections and partial aggregates of the scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TILE_GRID
from ..functions.dates import date_to_ordinal, in_acquired_time
from ..functions.grid import chip_of_point

# Placement rule of keys on the grid: 25,000 x 25,000 pixels of 30 units
# starting at the grid origin, i.e. 5 x 5 tiles.  x is given by the key's
# remainder, y by remainder and quotient; the factors have no divisor in
# common with 25,000, so keys below 25,000^2 have a pixel each.
PLACE_X_MUL = 7919
PLACE_Y_MUL = 104729
PLACE_Y_STEP = 9973
PLACE_CELLS = 25000
PIXEL_SIZE = 30

# Quality values of the stand-in series: clear, and cloud.
QA_CLEAR = 66
QA_CLOUD = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def place_x(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return (F.lit(-int(TILE_GRID["tx"])) + F.lit(PIXEL_SIZE) * ((k * PLACE_X_MUL) % PLACE_CELLS)).cast("bigint")


def place_y(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return (F.lit(int(TILE_GRID["ty"])) - F.lit(PIXEL_SIZE) * (
        (k * PLACE_Y_MUL + F.floor(k / PLACE_CELLS) * PLACE_Y_STEP) % PLACE_CELLS)).cast("bigint")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> (c_custkey, x, y)."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", place_x("c_custkey").alias("x"), place_y("c_custkey").alias("y"))


def pixel_keys(key: str):
    """(cx, cy, px, py) int columns of the pixel a key is placed on."""
    x, y = place_x(key), place_y(key)
    cx, cy = chip_of_point(x, y)
    return [cx, cy, x.cast("int").alias("px"), y.cast("int").alias("py")]


# Bytes of (compressed) line files whose rows a task reduces.
LINE_BYTES = 8 * 1024 * 1024


def _by_part(li: DataFrame) -> DataFrame:
    """Lines dealt by part, in as many partitions as their size asks for: a task's
    table of (part, day) stays the same however large the files are."""
    size = int(str(li._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return li.repartition(int(max(li.sparkSession.sparkContext.defaultParallelism, -(-size // LINE_BYTES))), "l_partkey")


def observations(spark: SparkSession, sf_dir: str, acquired: str | None = None) -> DataFrame:
    """lineitem -> one ARD observation per (pixel, day), long form.

    Columns: cx, cy, px, py, t (day number), blues .. thermals, qas.
    Several lines of a part may ship on one day; they are reduced with
    max/min/avg so the day is unique per pixel.  ``acquired`` filters the
    scan by ship date.
    """
    li = table(spark, sf_dir, "lineitem")
    if acquired:
        li = li.where(in_acquired_time(F.col("l_shipdate"), acquired))
    g = (_by_part(li.select("l_partkey", date_to_ordinal("l_shipdate").alias("t"), "l_quantity",
                            "l_extendedprice", "l_discount", "l_tax", "l_returnflag"))
           .groupBy("l_partkey", "t")
           .agg(F.round(F.max("l_quantity") * 100).cast("int").alias("blues"),
                F.round(F.max("l_extendedprice") / 10).cast("int").alias("greens"),
                F.round(F.max("l_discount") * 10000).cast("int").alias("reds"),
                F.round(F.max("l_tax") * 10000).cast("int").alias("nirs"),
                F.round(F.min("l_quantity") * 100).cast("int").alias("swir1s"),
                F.round(F.min("l_extendedprice") / 10).cast("int").alias("swir2s"),
                F.round(F.avg("l_quantity") * 100).cast("int").alias("thermals"),
                F.when(F.max((F.col("l_returnflag") == "R").cast("int")) == 1, QA_CLOUD)
                 .otherwise(QA_CLEAR).alias("qas")))
    return g.select(*pixel_keys("l_partkey"), "t", "blues", "greens", "reds", "nirs",
                    "swir1s", "swir2s", "thermals", "qas")


def aux_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> AUX series rows (one static acquisition per pixel)."""
    p = table(spark, sf_dir, "part")
    one = lambda c, t: F.array(c.cast(t))
    return p.select(*pixel_keys("p_partkey"),
                    F.array(F.lit(1)).alias("dates"),
                    one(F.col("p_retailprice"), "float").alias("dem"),
                    one(F.col("p_size") % 10, "int").alias("trends"),
                    one(F.col("p_size"), "int").alias("aspect"),
                    one((F.col("p_size") % 7) / 7.0, "float").alias("posidex"),
                    one(F.col("p_partkey") % 45, "float").alias("slope"),
                    one(F.col("p_size") % 2, "int").alias("mpw"))
