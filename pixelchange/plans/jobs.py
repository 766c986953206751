"""User level jobs (E1-E5): change detection and classification of a tile.

A job takes the observations as a DataFrame (long ARD rows, see
``operators.detect``) and restricts them to its chips with a semi join;
the chip list of a tile (2,500 ids) is generated by Spark, and broadcast
because its size is fixed by the grid.  All chips run as one plan; the
optional ``chunk_size`` only bounds how many chips one detection pass
holds (the original ran chunks one after another).  Failures raise; the
caller's session is never stopped.
"""

from __future__ import annotations

import dataclasses
import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CHIP_SHAPE, NUM_TREES
from ..functions import grid
from ..functions.dates import acquired_default, date_to_ordinal, in_acquired_days
from ..operators import detect as D
from ..operators import features as FT
from ..operators import forest as RF
from ..operators import segments as SG
from ..operators import series as SR
from ..session import checkpoint_dir
from ..sources import ledger, rasters
from ..sources import tables as T


def detect_batch(obs: DataFrame, root: str, params: D.DetectParams | None = None,
                 replace_chips: bool = False, keys=D.PID) -> DataFrame:
    """Observations -> detect -> chip, pixel, segment tables.

    The three tables come from ``detect_tables`` (no wide per-segment
    rows); each reads the detector's checkpoints, so nothing is persisted
    in executor memory.  Segment is written last: it is the completion
    marker.  Returns the distinct chip ids done.
    """
    chip, pixel, segment = D.detect_tables(obs, params, keys)
    T.write_chip(chip, root)
    T.write_pixel(pixel, root)
    T.write_segment(segment, root, replace_chips=replace_chips)
    return chip.select("cx", "cy").checkpoint(eager=True)


def take_chips(chips: DataFrame, number: int | None) -> DataFrame:
    """A4: the first ``number`` chips in (cx, cy) order (all when None)."""
    ordered = chips.orderBy("cx", F.desc("cy"))
    return ordered.limit(number) if number is not None else ordered


def chunk_chips(chips: DataFrame, chunk_size: int) -> DataFrame:
    """A5: number of a chip's batch inside its tile.

    The place of a chip in its tile, column by column from the top, is
    arithmetic on its corner, so no rows are sorted or numbered."""
    tx, ty = grid.tile_of_chip("cx", "cy")
    side = int(grid.definition("chip")["sx"])
    i, j = F.floor((F.col("cx") - tx) / side), F.floor((ty - F.col("cy")) / side)
    return chips.withColumn("batch", F.floor((i * grid.chips_per_side() + j) / F.lit(chunk_size)))


def chips_of_a_tile() -> int:
    return grid.chips_per_side() ** 2


def tile_chips(spark: SparkSession, x: float, y: float) -> DataFrame:
    """G5+G6 for one point given by the user."""
    pt = spark.createDataFrame([(float(x), float(y))], "x double, y double")
    return grid.classification_chips(pt)


def _restrict(obs: DataFrame, chips: DataFrame) -> DataFrame:
    # chips of a tile or of its 3x3 neighbourhood: at most 22,500 distinct ids
    return obs.join(F.broadcast(chips.select("cx", "cy").distinct()), ["cx", "cy"], "left_semi")


def change_detection(spark: SparkSession, x: float, y: float, obs: DataFrame, root: str,
                     acquired: str | None = None, number: int | None = None,
                     chunk_size: int | None = None, params: D.DetectParams | None = None,
                     resume: bool = False) -> DataFrame:
    """Detect every chip of the tile holding (x, y) (the first ``number`` if given).

    Chips are noted in the ledger when their chunk is written; ``resume`` leaves out
    those it has for the same dates and parameters.  Returns the chips done now."""
    acquired = acquired or acquired_default()
    chips = take_chips(tile_chips(spark, x, y), number)
    if resume:
        chips = ledger.open_chips(chips, root, acquired, params)
    obs = obs.where(in_acquired_days("t", acquired))
    checkpoint_dir(spark)
    batched = chunk_chips(chips, chunk_size or chips_of_a_tile()).checkpoint(eager=True)
    # a tile has 2,500 chips, so there are at most so many batches
    batches = sorted(r["batch"] for r in batched.select("batch").distinct().collect())
    done = spark.createDataFrame([], "cx int, cy int")
    for b in batches:
        chunk = batched.where(F.col("batch") == b)
        done = done.unionByName(detect_batch(_restrict(obs, chunk), root, params))
        ledger.record(chunk, root, acquired, params)
    return done


def detect_chips(spark: SparkSession, ids: DataFrame, chips_path: str, registry: DataFrame, root: str,
                 acquired: str | None = None, params: D.DetectParams | None = None, fmt: str = "json") -> DataFrame:
    """E1 from chip ids and raster chip files: scan, decode, assemble, detect, write.

    Packed layers are dealt once, by strips of a chip; no row of a pixel is shuffled
    behind that.  The number of partitions follows from the number of acquisitions
    (their packed rasters are counted, not decoded)."""
    chips = rasters.scan_chips(spark, chips_path, ids, acquired or acquired_default(), fmt)
    params = params or D.DetectParams()
    if params.partitions is None:
        rows = chips.select("x", "y", "acquired").distinct().count() * CHIP_SHAPE[0] * CHIP_SHAPE[1]
        size = -(-rows * D.ROW_BYTES // params.partition_bytes)
        params = dataclasses.replace(params, partitions=max(spark.sparkContext.defaultParallelism, size))
    return detect_batch(SR.strip_observations(chips, registry, params.partitions), root, params, keys=D.STRIP)


def aux_for_chips(spark: SparkSession, ids: DataFrame, chips_path: str, registry: DataFrame,
                  acquired: str | None = None, fmt: str = "json") -> DataFrame:
    """AUX series of chip ids from raster chip files, for training and classification."""
    return SR.aux(rasters.scan_chips(spark, chips_path, ids, None, fmt), registry, acquired or acquired_default())


def _aux_acquired(aux: DataFrame, acquired: str | None) -> DataFrame:
    """AUX rows with an acquisition inside the range (all without a range)."""
    return aux if acquired is None else aux.where(F.exists("dates", lambda d: in_acquired_days(d, acquired)))


def training(aux: DataFrame, root: str, msday: int, meday: int,
             num_trees: int = NUM_TREES, seed: int = RF.SEED, acquired: str | None = None):
    """Aux -> labels filter -> stored segments of those chips inside
    the period -> features -> forest (None when nothing to train on)."""
    spark = aux.sparkSession
    aux = FT.filter_labels(_aux_acquired(aux, acquired))
    ids = aux.select("cx", "cy").distinct()                                  # A1
    ccd = SG.filter_period(SG.filter_detected(T.read_segment(spark, root, ids)), msday, meday)
    fdf = FT.features(aux, ccd)
    return RF.fit(fdf, num_trees, seed)


def classification(spark: SparkSession, x: float, y: float, msday: int, meday: int,
                   aux: DataFrame, root: str, num_trees: int = NUM_TREES,
                   model_path: str | None = None, acquired: str | None = None) -> DataFrame | None:
    """Train on the 3x3 tiles around (x, y), classify the segments of
    the tile, write them back with rfrawp, save the model (by default under
    the store) and record it in the tile table.  Returns the classified
    segments (None without a model)."""
    pt = spark.createDataFrame([(float(x), float(y))], "x double, y double")
    train_aux = _restrict(aux, grid.training_chips(pt))
    model = training(train_aux, root, msday, meday, num_trees, acquired=acquired)
    if model is None:
        return None
    out = _classify_tile(spark, x, y, model, _aux_acquired(aux, acquired), root)
    tile = grid.tile(pt).select("tx", "ty").first()
    path = model_path or f"{root.rstrip('/')}/models/{tile.tx}_{tile.ty}"
    RF.save_model(model, path)
    tile_metadata(spark, root, tile.tx, tile.ty, msday, meday, path, classes=RF.labels(model))
    return out


def _classify_tile(spark: SparkSession, x: float, y: float, model, aux: DataFrame, root: str) -> DataFrame:
    """Votes of a model for all detected segments of a tile, written to the store."""
    ids = tile_chips(spark, x, y)
    segs = SG.filter_detected(T.read_segment(spark, root, ids))
    preds = RF.dedensify(RF.classify(model, FT.features(_restrict(aux, ids), segs)))
    # written and returned: computed once
    out = SG.join_predictions(segs, preds).checkpoint(eager=True)
    T.write_segment(out, root)
    return out


def classify_stored(spark: SparkSession, x: float, y: float, aux: DataFrame, root: str,
                    acquired: str | None = None) -> DataFrame | None:
    """E4 without training: classify the tile's segments with the model that its tile
    record names (S17), as after a new detection.  None if no model is recorded."""
    pt = spark.createDataFrame([(float(x), float(y))], "x double, y double")
    record = T.read_tile(spark, root, grid.tile(pt).select("tx", "ty")).first()
    if record is None or not record["model"]:
        return None
    checkpoint_dir(spark)
    return _classify_tile(spark, x, y, RF.load_model(record["model"]), _aux_acquired(aux, acquired), root)


def tile_metadata(spark: SparkSession, root: str, tx: int, ty: int, msday: int, meday: int,
                  model: str, name: str = "random-forest", aux_source: str | None = None,
                  classes: list | None = None) -> DataFrame:
    """E5: read the tile's record, merge, write it back.

    The record's name is 'name:key=value;...'.  Entries given here (period,
    classes in the order of the vote slots, AUX source) replace those of
    the same key, others stay; so does the model if ``model`` is empty."""
    period = f"{datetime.date.fromordinal(msday).isoformat()}/{datetime.date.fromordinal(meday).isoformat()}"
    at = spark.createDataFrame([(int(tx), int(ty))], "tx int, ty int")
    stored = T.read_tile(spark, root, at).first()
    entries = {}
    if stored is not None and ":" in (stored["name"] or ""):
        entries = dict(x.split("=", 1) for x in stored["name"].split(":", 1)[1].split(";") if "=" in x)
    entries["period"] = period
    if classes is not None:
        entries["classes"] = ",".join(str(c) for c in classes)
    if aux_source is not None:
        entries["aux"] = aux_source
    row = T.tile_row(spark, tx, ty, f"{name}:" + ";".join(f"{k}={v}" for k, v in sorted(entries.items())),
                     model or (stored["model"] if stored is not None else ""),
                     datetime.datetime.now(datetime.timezone.utc).isoformat())
    return T.write_tile(row, root)


__all__ = ["detect_batch", "detect_chips", "aux_for_chips", "change_detection", "training", "classification", "classify_stored", "tile_metadata",
           "take_chips", "chunk_chips", "date_to_ordinal"]
