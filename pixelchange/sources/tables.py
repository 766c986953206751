"""Keyed result tables on Parquet.

The original store was keyed: a write replaced the rows with an equal primary
key.  Here a write only appends, and reading merges.  A table is a set of folders

    {root}/{table}/kind={write|whole|base}/v={version}/tx=/ty=/block=

by tile and by block of 100 chips in it:

* a write makes one folder with its rows, newest of each key, in one job and with
  one exchange.  It reads nothing of what is stored, so it costs its own rows,
  whatever its tiles hold.  The folder is written aside and appears by one rename,
  which also fixes its version: a write that dies is not seen, and two jobs may
  write the same tile (the later rename counts).
* ``whole`` marks writes that replace all older rows of their chips.
* a base holds the merged rows of a tile up to its version (``compact``); older
  folders of that tile no longer count, and ``vacuum`` deletes them.

Readers list the folders and read those they found: a snapshot.  A tile with one
live folder (written once, or compacted) is read as it is.  Only tiles with several
are merged, by one aggregate with partial combine (``max_by`` of the version).
The rename is atomic on HDFS and local disks; object stores need a committer that
makes it so.  Versions are the writers' clocks in nanoseconds, never below one that
is listed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .. import schemas
from ..config import (CHIP_KEY, CHIP_TABLE, DETECTION_TABLE, PIXEL_KEY, PIXEL_TABLE,
                      SEGMENT_KEY, SEGMENT_TABLE, TILE_KEY, TILE_TABLE)
from ..functions.grid import chips_per_side, definition, tile_of_chip

PARTITION_COLUMNS = ["tx", "ty"]
BLOCK_COLUMNS = ["tx", "ty", "block"]
# Chips of a block along a side: a block has at most 100 chips, a million pixels, and
# is one task's work and one file of a write.
BLOCK_SIDE = 10
# Ids that a keyed read broadcasts at most (two numbers each); their number is
# counted first, and more than these are joined by a shuffle.
MAX_BROADCAST_CHIPS = 2_000_000
WRITE, WHOLE, BASE = "write", "whole", "base"

KEYS = {CHIP_TABLE: CHIP_KEY, PIXEL_TABLE: PIXEL_KEY, SEGMENT_TABLE: SEGMENT_KEY,
        TILE_TABLE: TILE_KEY, DETECTION_TABLE: SEGMENT_KEY}
SCHEMAS = {CHIP_TABLE: schemas.chip_schema, PIXEL_TABLE: schemas.pixel_schema,
           SEGMENT_TABLE: schemas.segment_schema, TILE_TABLE: schemas.tile_schema,
           DETECTION_TABLE: schemas.detection_schema}


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as one of its own."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


class Part(NamedTuple):
    """A tile's folder inside one write or base."""
    kind: str
    version: int
    tx: int
    ty: int

    @property
    def folder(self) -> str:
        return f"kind={self.kind}/v={self.version}"

    @property
    def path(self) -> str:
        return f"{self.folder}/tx={self.tx}/ty={self.ty}"

    @property
    def tile(self) -> tuple[int, int]:
        return self.tx, self.ty


def _parts(spark: SparkSession, root: str, table: str) -> list[Part]:
    """All tile folders of a table: names only, as many as tiles times open writes."""
    fs, p = _fs(spark, f"{table_path(root, table)}/kind=*/v=*/tx=*/ty=*")
    out = []
    for status in fs.globStatus(p) or []:
        names = dict(x.split("=", 1) for x in status.getPath().toString().split("/")[-4:])
        out.append(Part(names["kind"], int(names["v"]), int(names["tx"]), int(names["ty"])))
    return out


def _live(parts: list[Part]) -> list[Part]:
    """What counts: of each tile the newest base and the writes after it."""
    base: dict = {}
    for x in parts:
        if x.kind == BASE:
            base[x.tile] = max(x.version, base.get(x.tile, 0))
    newest = lambda x: base.get(x.tile, 0)
    return [x for x in parts if x.version > newest(x) or (x.kind == BASE and x.version == newest(x))]


def _split(parts: list[Part]) -> tuple[list[Part], list[Part]]:
    """Live folders of tiles with one of them, and of tiles with several."""
    live = _live(parts)
    count: dict = {}
    for x in live:
        count[x.tile] = count.get(x.tile, 0) + 1
    return [x for x in live if count[x.tile] == 1], [x for x in live if count[x.tile] > 1]


def _read(spark: SparkSession, root: str, table: str, parts: list[Part], every: list[Part]) -> DataFrame:
    """Rows of some tile folders with ``kind``, ``v``, tile and block.  A write of which
    all tiles are wanted is one path."""
    path = table_path(root, table)
    left = {x.folder: 0 for x in parts}
    for x in every:
        if x.folder in left:
            left[x.folder] += 1
    for x in parts:
        left[x.folder] -= 1
    paths = sorted({x.path if left[x.folder] else x.folder for x in parts})
    types = {"kind": StringType(), "v": LongType()}
    given = SCHEMAS[table]()
    more = [StructField(c, types.get(c, IntegerType())) for c in ["kind", "v", *BLOCK_COLUMNS] if c not in given.names]
    full = StructType(given.fields + more)
    return spark.read.option("basePath", path).schema(full).parquet(*[f"{path}/{x}" for x in paths])


def _merged(rows: DataFrame, key, whole: bool) -> DataFrame:
    """The newest row of each key; rows older than a whole replacement of their chip go."""
    if whole:
        since = rows.where(F.col("kind") == WHOLE).groupBy(*CHIP_KEY).agg(F.max("v").alias("_since"))
        rows = rows.join(since, CHIP_KEY, "left").where(F.col("_since").isNull() | (F.col("v") >= F.col("_since"))).drop("_since")
    place = [c for c in BLOCK_COLUMNS if c not in key]
    return latest_by_key(rows.drop("kind"), [*place, *key], ["v"])


def _rows(spark: SparkSession, root: str, table: str, restrict: Callable | None = None, key=None) -> DataFrame:
    """The table's rows (declared columns, tile, block).  ``restrict`` maps a frame of
    stored rows to those wanted, and must keep or drop whole chips."""
    every = _parts(spark, root, table)
    names = SCHEMAS[table]().fieldNames()
    cols = names + [c for c in BLOCK_COLUMNS if c not in names]
    restrict = restrict or (lambda x: x)
    single, several = _split(every)
    out = None
    if single:
        out = restrict(_read(spark, root, table, single, every)).select(*cols)
    if several:
        rows = restrict(_read(spark, root, table, several, every))
        merged = _merged(rows, key or KEYS[table], any(x.kind == WHOLE for x in several)).select(*cols)
        out = merged if out is None else out.unionByName(merged)
    if out is None:
        types = SCHEMAS[table]().fields + [StructField(c, IntegerType()) for c in cols[len(names):]]
        out = spark.createDataFrame([], StructType(types))
    return out


def scan_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The whole table, declared schema (+ tile columns)."""
    return _rows(spark, root, table).drop("block")


def with_tile(df: DataFrame) -> DataFrame:
    tx, ty = tile_of_chip("cx", "cy")
    return df.withColumn("tx", tx).withColumn("ty", ty)


def _block():
    """Number of the square of chips that a chip lies in, inside its tile."""
    tx, ty = tile_of_chip("cx", "cy")
    g = definition("chip")
    i = F.floor((F.col("cx") - tx) / F.lit(int(g["sx"]) * BLOCK_SIDE))
    j = F.floor((ty - F.col("cy")) / F.lit(int(g["sy"]) * BLOCK_SIDE))
    return (i * F.lit(-(-chips_per_side() // BLOCK_SIDE)) + j).cast("int")


def with_block(df: DataFrame) -> DataFrame:
    """Tile and block of rows with (cx, cy); a tile record is a block of its own."""
    return with_tile(df).withColumn("block", _block()) if "cx" in df.columns else df.withColumn("block", F.lit(0))


def latest_by_key(df: DataFrame, key, order) -> DataFrame:
    """One row per key, the greatest by ``order`` (list of columns).

    Uses ``max_by`` over a struct, an aggregate with partial (map side)
    combine, so a hot key is pre-reduced in every task before the shuffle.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in df.columns if c not in key]
    packed = F.struct(*[F.col(c) for c in rest]).alias("_row")
    ordering = F.struct(*order).alias("_ord")
    return (df.select(*key, packed, ordering)
              .groupBy(*key).agg(F.max_by("_row", "_ord").alias("_row"))
              .select(*key, "_row.*"))


def _tasks(spark: SparkSession) -> int:
    """Tasks of a write.  A number that is given is not coalesced: small rows of many
    blocks are many small files, which one task would write one after another."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _commit(spark: SparkSession, df: DataFrame, root: str, table: str, kind: str, version: int | None = None) -> int | None:
    """Write rows aside, then let them appear as one folder; its version (None: no rows)."""
    path = table_path(root, table)
    aside = f"{path}/_writing-{uuid.uuid4().hex}"
    # tasks put their files in place themselves: nothing of the folder is seen before the rename
    df.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(*BLOCK_COLUMNS).parquet(aside)
    fs, source = _fs(spark, aside)
    if not fs.globStatus(_fs(spark, f"{aside}/tx=*")[1]):
        fs.delete(source, True)
        return None
    # the clock at the rename: a compaction that has listed newer writes can't have missed this one
    version = version or max([time.time_ns(), *[x.version + 1 for x in _parts(spark, root, table)]])
    target = _fs(spark, f"{path}/kind={kind}/v={version}")[1]
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        raise RuntimeError(f"{target.toString()} was written by another job")
    return version


def upsert_table(df: DataFrame, root: str, table: str, key=None,
                 replace_chips: bool = False, order=None) -> DataFrame:
    """Write ``df`` so rows with an equal key replace stored ones.

    Of incoming rows with an equal key the greatest by ``order`` (columns of
    ``df``, stored or not) counts; without it, the greatest by all other
    columns.  ``replace_chips`` drops every stored row of the incoming chips
    first, which removes segments whose (sday, eday) changed on
    re-detection.  Returns ``df`` (like the original writers).
    """
    key = key or KEYS[table]
    cols = SCHEMAS[table]().fieldNames()
    order = list(order or [c for c in cols if c not in key])
    wide = with_block(df.select(*cols, *[c for c in order if c not in cols]))
    # dealt by blocks, which the grouping below keeps: one exchange
    wide = wide.repartition(_tasks(df.sparkSession), *BLOCK_COLUMNS)
    place = [c for c in BLOCK_COLUMNS if c not in key]
    new = latest_by_key(wide, [*place, *key], order)
    _commit(df.sparkSession, new.select(*cols, *[c for c in BLOCK_COLUMNS if c not in cols]), root, table, WHOLE if replace_chips else WRITE)
    return df


def compact(spark: SparkSession, root: str, table: str) -> int:
    """Merge the tiles with several live folders into bases; the number of tiles.

    Costs those tiles.  Readers and writers may go on; nothing is deleted."""
    every = _parts(spark, root, table)
    several = _split(every)[1]
    if not several:
        return 0
    rows = _read(spark, root, table, several, every)
    merged = _merged(rows, KEYS[table], any(x.kind == WHOLE for x in several))
    cols = SCHEMAS[table]().fieldNames()
    out = merged.select(*cols, *[c for c in BLOCK_COLUMNS if c not in cols])
    _commit(spark, out.repartition(_tasks(spark), *BLOCK_COLUMNS), root, table, BASE, max(x.version for x in several))
    return len({x.tile for x in several})


def vacuum(spark: SparkSession, root: str, table: str) -> int:
    """Delete the tile folders that no longer count; their number.  For when no reader
    holds a frame from before the last ``compact``."""
    every = _parts(spark, root, table)
    dead = set(every) - set(_live(every))
    for x in dead:
        fs, p = _fs(spark, f"{table_path(root, table)}/{x.path}")
        fs.delete(p, True)
    return len(dead)


def _only(spark: SparkSession, ids: DataFrame, on) -> Callable:
    """Restriction of stored rows to ids: a semi join on tile, block and ``on``.  With
    ids broadcast, Spark prunes the folders of other blocks while the query runs."""
    if ids.limit(MAX_BROADCAST_CHIPS + 1).count() <= MAX_BROADCAST_CHIPS:
        ids = F.broadcast(ids)
    return lambda rows: rows.join(ids, list(dict.fromkeys([*BLOCK_COLUMNS, *on])), "left_semi")


def read_by_ids(spark: SparkSession, root: str, table: str, ids: DataFrame) -> DataFrame:
    """Ids (cx, cy) inner join the table on (cx, cy).

    Ids are counted, and broadcast while they are few (``MAX_BROADCAST_CHIPS``).  Only
    folders of their blocks are scanned, by runtime pruning of the partition columns;
    no list of tiles passes the driver.
    """
    ids = with_block(ids.select(F.col("cx").cast("int").alias("cx"), F.col("cy").cast("int").alias("cy")).distinct())
    # a bounded block is what makes the planner take the ids for a filter
    rows = _rows(spark, root, table, _only(spark, ids.where(F.col("block") >= 0), CHIP_KEY))
    return rows.select(*CHIP_KEY, *[c for c in SCHEMAS[table]().fieldNames() if c not in CHIP_KEY])


def read_tile(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """Tile ids (tx, ty) inner join the tile table."""
    ids = with_block(ids.select(*[F.col(c).cast("int").alias(c) for c in TILE_KEY]).distinct())
    rows = _rows(spark, root, TILE_TABLE, _only(spark, ids, TILE_KEY))
    return rows.select(*SCHEMAS[TILE_TABLE]().fieldNames())


def tile_row(spark: SparkSession, tx: int, ty: int, name: str, model: str, updated: str) -> DataFrame:
    """One tile record with the declared schema."""
    return spark.createDataFrame([(int(tx), int(ty), name, model, updated)], schemas.tile_schema())


# Writers return their input, like the original ones.
def write_chip(df: DataFrame, root: str, order=None) -> DataFrame:
    return upsert_table(df, root, CHIP_TABLE, order=order)


def write_pixel(df: DataFrame, root: str, order=None) -> DataFrame:
    return upsert_table(df, root, PIXEL_TABLE, order=order)


def write_segment(df: DataFrame, root: str, replace_chips: bool = False, order=None) -> DataFrame:
    return upsert_table(df, root, SEGMENT_TABLE, replace_chips=replace_chips, order=order)


def write_tile(df: DataFrame, root: str, order=None) -> DataFrame:
    return upsert_table(df, root, TILE_TABLE, order=order)


def write_detection(df: DataFrame, root: str, order=None) -> DataFrame:
    return upsert_table(df, root, DETECTION_TABLE, order=order)


def read_chip(spark, root, ids):
    return read_by_ids(spark, root, CHIP_TABLE, ids)


def read_pixel(spark, root, ids):
    return read_by_ids(spark, root, PIXEL_TABLE, ids)


def read_segment(spark, root, ids):
    return read_by_ids(spark, root, SEGMENT_TABLE, ids)


def read_detection(spark, root, ids):
    return read_by_ids(spark, root, DETECTION_TABLE, ids)
