"""Grid operators as column expressions.

A grid is affine: cell (h, v) of a point (x, y) is
``h = floor((rx*x + tx) / sx)``, ``v = floor((ry*y + ty) / sy)`` and its
upper-left corner is ``((h*sx - tx) / rx, (v*sy - ty) / ry)``.  All
operators work on DataFrames of points, so a million points snap in one
narrow projection; the chip lists of tiles are generated with
``sequence`` + ``explode`` on the executors, never on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CHIP_GRID, TILE_GRID


def definition(level: str | None = None):
    """G1: grid parameters; both levels, or one by name."""
    grids = {"tile": dict(TILE_GRID), "chip": dict(CHIP_GRID)}
    return grids[level] if level else [grids["tile"], grids["chip"]]


def definition_frame(spark: SparkSession) -> DataFrame:
    """G1 as a two row DataFrame."""
    return spark.createDataFrame([tuple(g[k] for k in ("name", "rx", "ry", "sx", "sy", "tx", "ty"))
                                  for g in definition()],
                                 "name string, rx double, ry double, sx double, sy double, tx double, ty double")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grid_h(x, grid) -> Column:
    """Column index of the cell holding x."""
    return F.floor((F.lit(grid["rx"]) * _col(x) + F.lit(grid["tx"])) / F.lit(grid["sx"]))


def grid_v(y, grid) -> Column:
    """Row index of the cell holding y."""
    return F.floor((F.lit(grid["ry"]) * _col(y) + F.lit(grid["ty"])) / F.lit(grid["sy"]))


def ul_x(h, grid) -> Column:
    """Upper-left x of column h."""
    return (_col(h) * F.lit(grid["sx"]) - F.lit(grid["tx"])) / F.lit(grid["rx"])


def ul_y(v, grid) -> Column:
    """Upper-left y of row v."""
    return (_col(v) * F.lit(grid["sy"]) - F.lit(grid["ty"])) / F.lit(grid["ry"])


def snap(df: DataFrame, x="x", y="y", level="tile", prefix=None) -> DataFrame:
    """Add h, v and the upper-left corner (as ints) of the cell of (x, y)."""
    g = definition(level)
    p = prefix if prefix is not None else level[0]
    return (df.withColumn(f"{p}h", grid_h(x, g))
              .withColumn(f"{p}v", grid_v(y, g))
              .withColumn(f"{p}x", ul_x(F.col(f"{p}h"), g).cast("int"))
              .withColumn(f"{p}y", ul_y(F.col(f"{p}v"), g).cast("int")))


def extents(df: DataFrame, ulx="tx", uly="ty", level="tile") -> DataFrame:
    """Ulx, uly, lrx, lry of the cell whose upper-left is (ulx, uly)."""
    g = definition(level)
    return (df.withColumn("ulx", _col(ulx).cast("double"))
              .withColumn("uly", _col(uly).cast("double"))
              .withColumn("lrx", F.col("ulx") + F.lit(g["sx"]))
              .withColumn("lry", F.col("uly") - F.lit(g["sy"])))


def chips_per_side(outer="tile", inner="chip") -> int:
    return int(definition(outer)["sx"] // definition(inner)["sx"])


def coordinates(df: DataFrame, ulx="ulx", uly="uly") -> DataFrame:
    """One row per chip inside the tile extent, as int (cx, cy).

    The chip upper-lefts are generated, not snapped one by one; they are
    already on the chip grid because tile and chip grids share tx/ty.
    """
    n = chips_per_side()
    g = definition("chip")
    steps = F.sequence(F.lit(0), F.lit(n - 1))
    return (df.withColumn("_i", F.explode(steps))
              .withColumn("_j", F.explode(steps))
              .withColumn("cx", (_col(ulx) + F.col("_i") * F.lit(g["sx"]) * F.lit(g["rx"])).cast("int"))
              .withColumn("cy", (_col(uly) + F.col("_j") * F.lit(g["sy"]) * F.lit(g["ry"])).cast("int"))
              .drop("_i", "_j"))


def tile(df: DataFrame, x="x", y="y") -> DataFrame:
    """Point -> tile record (tx, ty, th, tv, ulx, uly, lrx, lry)."""
    return extents(snap(df, x, y, "tile"), "tx", "ty")


def chips(df: DataFrame) -> DataFrame:
    """Tile records -> one row per chip id (cx, cy)."""
    return coordinates(df, "ulx", "uly")


def near(df: DataFrame, x="x", y="y", level="tile") -> DataFrame:
    """The 3x3 block of cells around the cell of each point.

    Output columns nh, nv (cell index) and nx, ny (upper-left, int).
    """
    g = definition(level)
    d = F.sequence(F.lit(-1), F.lit(1))
    return (snap(df, x, y, level, prefix="_s")
            .withColumn("_dh", F.explode(d))
            .withColumn("_dv", F.explode(d))
            .withColumn("nh", F.col("_sh") + F.col("_dh"))
            .withColumn("nv", F.col("_sv") + F.col("_dv"))
            .withColumn("nx", ul_x(F.col("nh"), g).cast("int"))
            .withColumn("ny", ul_y(F.col("nv"), g).cast("int"))
            .drop("_sh", "_sv", "_sx", "_sy", "_dh", "_dv"))


def training_chips(df: DataFrame, x="x", y="y") -> DataFrame:
    """All chip ids of the 9 tiles around each point (distinct, as the tiles are)."""
    tiles = near(df, x, y, "tile").select(F.col("nx").alias("tx"), F.col("ny").alias("ty")).distinct()
    return chips(extents(tiles, "tx", "ty")).select("cx", "cy")


def classification_chips(df: DataFrame, x="x", y="y") -> DataFrame:
    """Chip ids of the tile of each point (distinct, as the tiles are)."""
    return chips(tile(df, x, y).select("ulx", "uly").distinct()).select("cx", "cy")


def tile_of_chip(cx="cx", cy="cy"):
    """(tx, ty) of the tile holding chip (cx, cy), as int columns."""
    g = definition("tile")
    return (ul_x(grid_h(cx, g), g).cast("int").alias("tx"),
            ul_y(grid_v(cy, g), g).cast("int").alias("ty"))


def chip_of_point(x="x", y="y"):
    """(cx, cy) of the chip holding (x, y), as int columns."""
    g = definition("chip")
    return (ul_x(grid_h(x, g), g).cast("int").alias("cx"),
            ul_y(grid_v(y, g), g).cast("int").alias("cy"))
