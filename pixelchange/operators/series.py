"""Time-series construction.

Rasters arrive as long rows (pixel, day, layer, value).  Band assembly is
a pivot on (pixel, day) with an explicit band list (no extra job to find
the values), then one row per pixel with parallel arrays, newest first.
The pivot and the per pixel arrays are grouped aggregates, so they combine
map side; a pixel's series is bounded by the number of acquisitions.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .. import schemas
from ..functions.dates import date_to_ordinal, in_acquired
from ..config import CHIP_SHAPE
from ..sources import rasters

PIXEL = ["cx", "cy", "px", "py"]
ARD_BANDS = ["blues", "greens", "reds", "nirs", "swir1s", "swir2s", "thermals", "qas"]
AUX_BANDS = ["dem", "trends", "aspect", "posidex", "slope", "mpw"]
AUX_REQUIRED = ["trends"]


def filter_acquired(df: DataFrame, acquired: str, column: str = "acquired") -> DataFrame:
    """Keep rows whose acquisition date is inside 'start/end' (inclusive)."""
    return df.where(in_acquired(column, acquired))


def pivot_bands(long: DataFrame, bands, keys=PIXEL, date="t", band="band", value="value",
                required=None) -> DataFrame:
    """Long (keys, date, band, value) -> one row per (keys, date)
    with a column per band; a date is kept only if every ``required``
    band (default: all) is present."""
    required = bands if required is None else required
    wide = long.groupBy(*keys, date).pivot(band, list(bands)).agg(F.max(value))
    cond = F.lit(True)
    for b in required:
        cond = cond & F.col(b).isNotNull()
    return wide.where(cond)


def assemble(wide: DataFrame, columns, keys=PIXEL, date="t", descending=True,
             dates_name="dates") -> DataFrame:
    """One row per pixel, parallel arrays ordered by date (newest
    first by default), dates as day numbers."""
    s = F.sort_array(F.collect_list(F.struct(F.col(date).alias("_d"), *[F.col(c) for c in columns])),
                     asc=not descending)
    g = wide.groupBy(*keys).agg(s.alias("_s"))
    return g.select(*keys, F.col("_s._d").alias(dates_name), *[F.col(f"_s.{c}").alias(c) for c in columns])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast to the named series schema."""
    schema = schemas.series_schema(name)
    cols = []
    for f in schema.fields:
        t = ArrayType(f.dataType.elementType, True) if isinstance(f.dataType, ArrayType) else f.dataType
        cols.append(F.col(f.name).cast(t).alias(f.name))
    return df.select(*cols)


def decoded_pixels(chips: DataFrame, registry: DataFrame) -> DataFrame:
    """T3 + T4 + T5: chip records -> (cx, cy, px, py, t, band, value)."""
    c = rasters.layer_to_band(chips, registry)
    c = c.select(F.col("x").alias("cx"), F.col("y").alias("cy"),
                 date_to_ordinal(F.substring("acquired", 1, 10)).alias("t"), "band",
                 rasters.decode(F.col("data"), F.col("data_type")).alias("values"))
    return rasters.pixel_rows(c, "values", "cx", "cy").drop("i")


def chip_observations(chips: DataFrame, registry: DataFrame, bands=ARD_BANDS, required=ARD_BANDS,
                      partitions: int | None = None) -> DataFrame:
    """T3-T6 on packed rasters: chip records -> one row per (pixel, day)
    with a column per band, only days where every ``required`` band is
    present.

    The compact records, not exploded pixel values, are what moves: they
    are (optionally) hash partitioned by chip, grouped by (chip, day) so
    the layers of one acquisition meet, decoded together and zipped, and
    exploded once.  The grouping keys contain the chip, so it reuses the
    chip partitioning, and a later per pixel grouping needs no shuffle.
    """
    c = rasters.layer_to_band(chips, registry)
    if partitions:
        c = c.repartition(partitions, "x", "y")
    g = _acquisitions(c.withColumn("raw", F.unbase64("data")), ["x", "y"], bands, required)
    return _pixels(g, bands, required, F.lit(0))


# Values of a band that a batch of series holds.
VALUES_AT_ONCE = 100_000


def seen_series(chips: DataFrame, registry: DataFrame, bands, required, seen: tuple, partitions: int | None = None) -> DataFrame:
    """T3-T6 on packed rasters: chip records -> one row per pixel, newest day first (as
    ``assemble`` of ``chip_observations``), without the pixels where a required band
    holds nothing but its filler; ``seen``: the band and the filler.

    Layers are compacted (``rasters.compact``) as they are read and move once, to their
    chip.  There the pixels with data are found and only their values looked up, some
    pixels of all days at a time: a chip costs its data, not its area, and neither
    pixel values nor whole rasters are rows of Spark.
    """
    c = rasters.layer_to_band(chips, registry)
    c = rasters.compact(c.select("x", "y", "acquired", "ubid", "band", "data_type", "data"))
    if partitions:
        c = c.repartition(partitions, "x", "y")
    g = _acquisitions(c, ["x", "y"], bands, required)
    for b in required:
        g = g.where(F.col(f"{b}.data_type").isNotNull())
    days = g.select("x", "y", date_to_ordinal(F.substring("acquired", 1, 10)).cast("int").alias("t"),
                    *[F.col(f"{b}.{f}").alias(f"{b}_{f}") for b in bands for f in ("raw", "data_type")])
    whole = [_element_type(b).typeName() == "integer" for b in bands]
    schema = ", ".join([*(f"{k} int" for k in PIXEL), "dates array<int>", *(f"{b} array<float>" for b in bands)])

    def series(chip: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        cx, cy = (k.as_py() for k in chip)
        t = table.column("t").to_numpy()
        layers = {b: _by_type(table.column(f"{b}_raw").to_pylist(), table.column(f"{b}_data_type").to_pylist()) for b in bands}
        places = [r.places(seen[1]) for _, r in layers[seen[0]]]
        places = np.unique(np.concatenate(places)) if places else np.zeros(0, np.int64)
        step = max(1, VALUES_AT_ONCE // len(t))
        for k in range(0, len(places), step):
            yield _series_batch(cx, cy, places[k:k + step], t, layers, whole)

    return days.groupBy("x", "y").applyInArrow(series, schema)


def _by_type(packed: list, kinds: list) -> list:
    """(positions, their ``CompactRasters``) for each type among the layers of a band."""
    alike = defaultdict(list)
    for i, (p, k) in enumerate(zip(packed, kinds)):
        if p is not None and k is not None:
            alike[k].append(i)
    return [(np.array(rows), rasters.CompactRasters([packed[i] for i in rows], k)) for k, rows in alike.items()]


def _series_batch(cx: int, cy: int, places, t, layers, whole) -> pa.RecordBatch:
    """Series of some pixels of a chip: days and values newest first, two acquisitions of
    a day in descending order of their values (none last), as sorting structs does."""
    n, days = len(places), len(t)
    values, there = {}, {}
    for b, parts in layers.items():
        values[b], there[b] = np.zeros((n, days), np.float32), np.zeros((n, days), bool)
        for rows, r in parts:
            v, known = r.at(places)
            values[b][:, rows], there[b][:, rows] = np.where(known, v, 0).T, known.T
    dates = np.broadcast_to(t, (n, days))
    if len(np.unique(t)) == days:
        order = np.broadcast_to(np.argsort(-t), (n, days))
    else:
        keys = [dates]
        for b, w in zip(values, whole):
            keys += [there[b], np.trunc(values[b]) if w else values[b]]
        order = np.lexsort(keys[::-1], axis=-1)[:, ::-1]
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * days)
    lists = lambda v, missing=None: pa.ListArray.from_arrays(
        offsets, pa.array(np.take_along_axis(v, order, 1).ravel(), mask=missing))
    columns = [np.full(n, cx, np.int32), np.full(n, cy, np.int32), (cx + 30 * (places % CHIP_SHAPE[1])).astype(np.int32),
               (cy - 30 * (places // CHIP_SHAPE[1])).astype(np.int32)]
    bands = [lists(values[b], None if there[b].all() else ~np.take_along_axis(there[b], order, 1).ravel()) for b in values]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), lists(dates.astype(np.int32)), *bands], [*PIXEL, "dates", *values])


# Strips that a chip is cut into; a divisor of its rows.
STRIPS = 10


def strip_observations(chips: DataFrame, registry: DataFrame, partitions: int, bands=ARD_BANDS, required=ARD_BANDS,
                       strips: int = STRIPS) -> DataFrame:
    """``chip_observations`` dealt by strips of a chip, with ``sid``, the strip's key.

    Each packed layer is cut into the bytes of ``strips`` bands of pixel rows before
    the one exchange (by ``sid``), and decoded behind it.  So a chip is the work of
    several tasks, packed bytes are all that moves, and a pixel's rows come out in the
    partition of its strip, where the detector's rounds (keys ``sid``, ``pid``) leave them."""
    c = rasters.layer_to_band(chips, registry)
    part = rasters.value_bytes(F.col("data_type")) * F.lit(CHIP_SHAPE[0] * CHIP_SHAPE[1] // strips)
    c = c.select("x", "y", "acquired", "ubid", "band", "data_type", F.unbase64("data").alias("whole"), part.alias("part"))
    pieces = F.transform(F.sequence(F.lit(0), F.lit(strips - 1)),
                         lambda i: F.struct(i.alias("strip"), F.substring("whole", i * F.col("part") + 1, F.col("part")).alias("raw")))
    cut = c.select("x", "y", "acquired", "ubid", "band", "data_type", F.explode(pieces).alias("p")).select("*", "p.strip", "p.raw").drop("p")
    dealt = cut.withColumn("sid", F.xxhash64("x", "y", "strip")).repartition(partitions, "sid")
    g = _acquisitions(dealt, ["sid", "x", "y", "strip"], bands, required)
    return _pixels(g, bands, required, F.col("strip") * F.lit(CHIP_SHAPE[0] // strips), ["sid"])


def _acquisitions(layers: DataFrame, keys, bands, required) -> DataFrame:
    """Rows (keys, acquired) with the packed bytes and type of each band, where every
    required band is there.  Layers of one sensor only: two sensors may see a chip at
    the same time; of complete acquisitions the first sensor by name counts."""
    packed = F.struct(F.col("raw"), F.col("data_type"))
    g = layers.withColumn("sensor", F.upper(F.substring("ubid", 1, 4))).groupBy(*keys, "acquired", "sensor").agg(
        *[F.max(F.when(F.col("band") == b, packed)).alias(b) for b in bands])
    for b in required:
        g = g.where(F.col(f"{b}.raw").isNotNull())
    return (g.groupBy(*keys, "acquired").agg(F.min_by(F.struct(*bands), "sensor").alias("s"))
            .select(*keys, "acquired", "s.*"))


def _pixels(g: DataFrame, bands, required, first_row, carry=()) -> DataFrame:
    """Acquisitions decoded, one row per pixel; ``first_row``: of the chip's rows."""
    dec = g.select(*carry, F.col("x").alias("cx"), F.col("y").alias("cy"), first_row.alias("first_row"),
                   date_to_ordinal(F.substring("acquired", 1, 10)).alias("t"),
                   *[rasters.decode_bytes(F.col(f"{b}.raw"), F.col(f"{b}.data_type")).alias(b) for b in bands])
    for b in required:
        dec = dec.where(F.col(b).isNotNull())
    size = F.size(F.col(required[0]))
    full = [F.coalesce(F.col(b), F.array_repeat(F.lit(None).cast("float"), size)).alias(b) for b in bands]
    z = dec.select(*carry, "cx", "cy", "first_row", "t", F.posexplode(F.arrays_zip(*full)).alias("i", "v"))
    ncols = CHIP_SHAPE[1]
    return z.select(*carry, "cx", "cy",
                    (F.col("cx") + F.lit(30) * (F.col("i") % ncols)).cast("int").alias("px"),
                    (F.col("cy") - F.lit(30) * (F.col("first_row") + F.floor(F.col("i") / ncols))).cast("int").alias("py"),
                    "t", *[F.col(f"v.{b}").cast(_element_type(b)).alias(b) for b in bands])


def _element_type(band: str):
    """Element type of a band in the declared ard/aux series schemas."""
    for name in ("ard", "aux"):
        schema = schemas.series_schema(name)
        if band in schema.names:
            return schema[band].dataType.elementType
    return "double"


def series_for_chips(chips: DataFrame, registry: DataFrame, name: str,
                     partitions: int | None = None, seen: tuple | None = None) -> DataFrame:
    """Chip records -> series rows of 'ard' or 'aux' (see
    ``chip_observations``; the assembly groups by pixel inside chips).
    ``seen``: a required band and its filler; only pixels where the band holds
    something else (see ``seen_series``)."""
    bands = ARD_BANDS if name == "ard" else AUX_BANDS
    required = ARD_BANDS if name == "ard" else AUX_REQUIRED
    if seen:
        return conform(seen_series(chips, registry, bands, required, seen, partitions), name)
    return conform(assemble(chip_observations(chips, registry, bands, required, partitions), bands), name)


def ard(chips: DataFrame, registry: DataFrame, acquired: str | None = None, partitions=None, seen=None) -> DataFrame:
    """ARD series of the given chip records."""
    if acquired:
        chips = filter_acquired(chips, acquired)
    return series_for_chips(chips, registry, "ard", partitions, seen)


def aux(chips: DataFrame, registry: DataFrame, acquired: str | None = None, partitions=None, seen=None) -> DataFrame:
    """AUX series; bands other than trends may be missing (null)."""
    if acquired:
        chips = filter_acquired(chips, acquired)
    return series_for_chips(chips, registry, "aux", partitions, seen)


def ard_from_observations(obs: DataFrame) -> DataFrame:
    """Long ARD observations (see sources.standins) -> ARD series rows."""
    return conform(assemble(obs, ARD_BANDS), "ard")
