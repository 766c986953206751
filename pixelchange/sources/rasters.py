"""Raster chips and the layer registry.

A chip record holds one layer of one chip at one acquisition: x, y (chip
upper-left), acquired (ISO timestamp string), data (base64 of the packed
100 x 100 raster, little endian), hash, source, ubid (layer name).

Decoding (T3) is the only per-record numeric work Spark has no built-in
for: ``unbase64`` runs in the JVM, then one Arrow-batched pandas UDF turns
each chip's bytes into an array with ``np.frombuffer`` (dtype from the
registry), and ``posexplode`` + column math (T5) give one row per pixel.
"""

from __future__ import annotations

import base64
import binascii
from collections import defaultdict
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, FloatType, IntegerType,
                               StringType, StructField, StructType)

from ..config import CHIP_SHAPE, FILL
from ..functions.dates import in_acquired
from ..session import settings

CHIP_RECORD_SCHEMA = StructType([
    StructField("x", IntegerType()), StructField("y", IntegerType()),
    StructField("acquired", StringType()), StructField("data", StringType()),
    StructField("hash", StringType()), StructField("source", StringType()),
    StructField("ubid", StringType())])

REGISTRY_SCHEMA = StructType([
    StructField("ubid", StringType()), StructField("data_type", StringType()),
    StructField("data_shape", ArrayType(IntegerType())), StructField("data_fill", IntegerType()),
    StructField("tags", ArrayType(StringType()))])

# Chip ids that a scan broadcasts at most (a tile has 2,500).
MAX_BROADCAST_IDS = 1_000_000

# numpy dtypes of registry data types (little endian); each fits a 32-bit float.
DTYPES = {"INT16": "<i2", "UINT16": "<u2", "UINT8": "u1", "BYTE": "u1", "FLOAT32": "<f4"}

# ---------------------------------------------------------------------------
# Layer families, band names and tags of the registry.
# ---------------------------------------------------------------------------
SR_BANDS = {  # sensor -> surface reflectance layer suffixes for blue..swir2
    "LT04": ["SRB1", "SRB2", "SRB3", "SRB4", "SRB5", "SRB7"],
    "LT05": ["SRB1", "SRB2", "SRB3", "SRB4", "SRB5", "SRB7"],
    "LE07": ["SRB1", "SRB2", "SRB3", "SRB4", "SRB5", "SRB7"],
    "LC08": ["SRB2", "SRB3", "SRB4", "SRB5", "SRB6", "SRB7"],
}
THERMAL = {"LT04": ["BTB6"], "LT05": ["BTB6"], "LE07": ["BTB6"], "LC08": ["BTB10", "BTB11"]}
QA_FILL = {"LE07": FILL}
REFLECTANCE_NAMES = ["blue", "green", "red", "nir", "swir1", "swir2"]
AUX_LAYERS = [("AUX_DEM", "FLOAT32", "dem"), ("AUX_TRENDS", "BYTE", "trends"),
              ("AUX_ASPECT", "INT16", "aspect"), ("AUX_POSIDEX", "FLOAT32", "posidex"),
              ("AUX_SLOPE", "FLOAT32", "slope"), ("AUX_MPW", "BYTE", "mpw")]


def registry_rows():
    """The layer registry, generated from the family rule above."""
    rows = []
    shape = list(CHIP_SHAPE)
    for sensor, bands in SR_BANDS.items():
        for suffix, name in zip(bands, REFLECTANCE_NAMES):
            rows.append((f"{sensor}_{suffix}", "INT16", shape, FILL,
                         [sensor.lower(), "sr", name, suffix.lower().replace("sr", "")]))
            # top of atmosphere layer carrying the same colour tag (not 'sr')
            rows.append((f"{sensor}_{suffix.replace('SR', 'TA')}", "INT16", shape, FILL,
                         [sensor.lower(), "ta", name, suffix.lower().replace("sr", "")]))
        for suffix in THERMAL[sensor]:
            rows.append((f"{sensor}_{suffix}", "INT16", shape, FILL,
                         [sensor.lower(), "bt", "thermal", suffix.lower().replace("bt", "")]))
        rows.append((f"{sensor}_PIXELQA", "UINT16", shape, QA_FILL.get(sensor), [sensor.lower(), "pixelqa", "qa"]))
    for ubid, dtype, name in AUX_LAYERS:
        rows.append((ubid, dtype, shape, None, ["aux", name]))
    return rows


def registry(spark: SparkSession) -> DataFrame:
    """S5 (generated): the layer catalogue as a DataFrame."""
    return spark.createDataFrame(registry_rows(), REGISTRY_SCHEMA)


def scan_registry(spark: SparkSession, path: str) -> DataFrame:
    """A registry stored as a JSON array file."""
    as_stored = StructType([StructField(f.name, StringType()) if f.name == "data_fill" else f for f in REGISTRY_SCHEMA.fields])
    raw = spark.read.schema(as_stored).option("multiLine", True).json(path)      # fills are texts, "-9999"
    return raw.withColumn("data_fill", F.col("data_fill").cast("double").cast("int"))


def band_of(tags: Column) -> Column:
    """T4: series column of a layer from its tags.

    A colour tag alone is ambiguous (top of atmosphere layers carry it
    too), so reflectance needs 'sr'; thermal needs 'bt' and, for sensors
    with two thermal layers, 'b10'; AUX layers need 'aux'.
    """
    has = lambda t: F.array_contains(tags, t)
    expr = F.when(F.lit(False), F.lit(None))
    for name in REFLECTANCE_NAMES:
        expr = expr.when(has("sr") & has(name), F.lit(name + "s"))
    expr = expr.when(has("bt") & (~has("lc08") | has("b10")), F.lit("thermals"))
    expr = expr.when(has("pixelqa"), F.lit("qas"))
    for _, _, name in AUX_LAYERS:
        expr = expr.when(has("aux") & has(name), F.lit(name))
    return expr


def layer_bands(reg: DataFrame) -> DataFrame:
    """Registry -> (ubid upper, band, data_type, data_fill) for mapped layers."""
    return (reg.select(F.upper("ubid").alias("layer"), band_of(F.col("tags")).alias("band"),
                       "data_type", "data_fill")
               .where(F.col("band").isNotNull()))


def layer_to_band(df: DataFrame, reg: DataFrame, ubid="ubid") -> DataFrame:
    """T4: add band (and registry type) to rows carrying a layer name.

    The registry side is a catalogue of layers (about a hundred rows,
    independent of data size), so it is broadcast.
    """
    lb = F.broadcast(layer_bands(reg))
    return df.join(lb, F.upper(F.col(ubid)) == lb.layer, "inner").drop("layer")


def scan_chips(spark: SparkSession, path: str, ids: DataFrame | None = None,
               acquired: str | None = None, fmt: str = "json") -> DataFrame:
    """Chip records of the given chip ids and date range."""
    df = spark.read.schema(CHIP_RECORD_SCHEMA).format(fmt).load(path)
    if acquired:
        df = df.where(in_acquired("acquired", acquired))
    if ids is not None:
        ids = ids.select(F.col("cx").alias("x"), F.col("cy").alias("y")).distinct()
        # counted ids stay small (two numbers each); beyond the limit the records are shuffled
        if ids.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS:
            ids = F.broadcast(ids)
        df = df.join(ids, ["x", "y"], "left_semi")
    return df


@F.pandas_udf(ArrayType(FloatType()))
def _decode(raw: pd.Series, dtype: pd.Series) -> pd.Series:
    out = [None] * len(raw)
    for t in dtype.dropna().unique():
        idx = np.flatnonzero((dtype == t).to_numpy())
        dt = np.dtype(DTYPES[t])
        for i in idx:
            b = raw.iat[i]
            if b is not None:
                out[i] = np.frombuffer(b, dtype=dt).astype(np.float32)
    return pd.Series(out, dtype=object)


def decode(data: Column, data_type: Column) -> Column:
    """base64 packed raster -> array<float> of pixel values."""
    return _decode(F.unbase64(data), data_type)


def decode_bytes(raw: Column, data_type: Column) -> Column:
    """T3 on bytes (of a whole raster or some of its rows)."""
    return _decode(raw, data_type)


# Rasters that Python packs or compacts at once.
RASTERS_AT_ONCE = 32

# Bytes of a block of a compact raster: whole values of any type, sixteen characters of base64.
BLOCK = 12
_ENTRY, _TOP = BLOCK + 4, 0xFFFFFFFF

_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


@lru_cache(64)
def _filled_text(kind: str, filler: float) -> np.ndarray:
    """The base64 text (as bytes) of a raster that holds only the filler."""
    return np.frombuffer(base64.b64encode(np.full(CHIP_SHAPE[0] * CHIP_SHAPE[1], filler, DTYPES[kind]).tobytes()), np.uint8)


# A run of a compact raster.  Byte strings of one length are ordered as their bytes are.
_RUN = np.dtype([("block", f"S{BLOCK}"), ("length", ">u4")])


def _run_starts(words: np.ndarray, width: int) -> np.ndarray:
    """Rows of words -> numbers (all rows' blocks counted on) of the blocks, of ``width``
    words each, unlike the one before in their row."""
    differs = words[:, width:] != words[:, :-width]
    new = np.ones((len(words), words.shape[1] // width), bool)
    new[:, 1:] = differs[:, ::width]
    for k in range(1, width):
        new[:, 1:] |= differs[:, k::width]
    return new.ravel().nonzero()[0]


def _written(first: np.ndarray, blocks: bytes, tails: list, full: int) -> list:
    """Compact rasters of ``full`` blocks each: numbers and bytes of the blocks that begin
    a run, and the bytes after each raster's last block."""
    runs = np.empty(len(first), _RUN)
    runs["block"] = block = np.frombuffer(blocks, _RUN["block"])
    end = np.cumsum(np.bincount(first // full))
    length, up = np.empty(len(first), np.int64), np.empty(len(first), bool)
    length[:-1], length[-1] = first[1:] - first[:-1], full * len(tails) - first[-1]
    up[:-1] = block[1:] > block[:-1]
    up[end - 1] = [t > blocks[BLOCK * (e - 1):BLOCK * e][:len(t)] for t, e in zip(tails, end.tolist())]
    runs["length"] = np.where(up, _TOP - length, length)
    out, at = runs.tobytes(), [0, *(_ENTRY * end).tolist()]
    return [out[i:j] + t for i, j, t in zip(at, at[1:], tails)]


def _compact_raw(raw: bytes) -> bytes:
    full = len(raw) // BLOCK
    if not full:
        return raw
    first = _run_starts(np.frombuffer(raw, np.uint32, 3 * full).reshape(1, -1), 3)
    return _written(first, np.frombuffer(raw, f"V{BLOCK}", full)[first].tobytes(), [raw[full * BLOCK:]], full)[0]


def _compact_alike(texts: list) -> list:
    """Base64 texts of one length -> compact rasters; only the first block of each run is
    decoded, unless a text isn't plain base64 (line breaks, say)."""
    size, pads = len(texts[0]), {(t[-1:] == b"=") + (t[-2:] == b"==") for t in texts}
    full = (size // 4 * 3 - min(pads)) // BLOCK
    try:
        if size % 4 or full < 1 or len(pads) > 1:
            raise binascii.Error
        words = np.frombuffer(b"".join(texts), np.uint32).reshape(len(texts), -1)
        first = _run_starts(words[:, :4 * full], 4)
        at = first // full * words.shape[1] + first % full * 4
        blocks = binascii.a2b_base64(words.ravel()[at[:, None] + np.arange(4)].tobytes(), strict_mode=True)
        tails = [binascii.a2b_base64(t[16 * full:], strict_mode=True) for t in texts]
    except binascii.Error:
        return [_compact_raw(base64.b64decode(t)) for t in texts] if len(texts) == 1 else [c for t in texts for c in _compact_alike([t])]
    return _written(first, blocks, tails, full)


def compact_texts(texts: list) -> list:
    """``compact`` of some base64 texts (None stays)."""
    out, alike = [None] * len(texts), defaultdict(list)
    for i, t in enumerate(texts):
        if t is not None:
            alike[len(t)].append(i)
    for rows in alike.values():
        for i, c in zip(rows, _compact_alike([texts[i].encode() for i in rows])):
            out[i] = c
    return out


# Rows that a reader of columns holds: 4,096 whole rasters, Spark's own number, take 110 MB
# of a task's memory and twice that as they grow.
_READ_AT_ONCE = {"spark.sql.parquet.columnarReaderBatchSize": "64", "spark.sql.orc.columnarReaderBatchSize": "64"}


def compact(chips: DataFrame) -> DataFrame:
    """Chip records with a column ``raw`` for the base64 ``data``: the packed raster's
    bytes as runs of equal blocks.

    For each run of blocks of twelve bytes (from the raster's start): the block and the
    run's length, a big endian number; then the bytes after the last whole block.  Lengths
    of runs that something greater follows are counted down from the largest number, so
    compact rasters are ordered as the raw bytes are.  Any raster comes back whole; one
    without runs takes 4/3 of its bytes, as base64 does.

    Records pass through Python as an RDD, whose batches have a few MB at most: an Arrow
    batch has 64 MB, several times over in both processes, and the queue of rows behind a
    Python function spills whole rasters to disk."""
    at = chips.columns.index("data")

    def compacted(records):
        while some := list(islice(records, RASTERS_AT_ONCE)):
            for r, c in zip(some, compact_texts([r[at] for r in some])):
                yield (*r[:at], *r[at + 1:], c)

    schema = StructType([f for f in chips.schema.fields if f.name != "data"] + [StructField("raw", BinaryType())])
    with settings(chips.sparkSession, _READ_AT_ONCE):
        records = chips.rdd
    return chips.sparkSession.createDataFrame(records.mapPartitions(compacted), schema, verifySchema=False)


class CompactRasters:
    """The values of some compact rasters of one type, without unpacking them.

    A run's block stays once; the bytes after the last whole block are a run of one."""

    def __init__(self, packed: list, kind: str):
        dtype = np.dtype(DTYPES[kind])
        data = np.frombuffer(b"".join(packed), np.uint8)
        size = np.array([len(p) for p in packed], np.int64)
        runs, rest = size // _ENTRY, size % _ENTRY
        last = np.cumsum(runs + 1) - 1
        block, length = np.zeros((last[-1] + 1, BLOCK), np.uint8), np.ones(last[-1] + 1, np.int64)
        row = np.repeat(np.arange(len(packed)), runs)
        at = _ENTRY * np.arange(len(row)) + (np.cumsum(rest) - rest)[row]
        key = data[at[:, None] + np.arange(BLOCK, _ENTRY)].view(">u4")[:, 0].astype(np.int64)
        block[np.arange(len(row)) + row] = data[at[:, None] + np.arange(BLOCK)]
        length[np.arange(len(row)) + row] = np.where(key > _TOP // 2, _TOP - key, key)
        end = np.cumsum(size)
        for n in np.unique(rest):
            which = np.flatnonzero(rest == n)
            block[last[which], :n] = data[(end[which] - n)[:, None] + np.arange(n)]
        self.ends = np.cumsum(length)                                        # of runs, in blocks
        self.begin = np.concatenate([[0], self.ends[last][:-1]])             # of rasters, in blocks
        nbytes = BLOCK * (self.ends[last] - self.begin - 1) + rest
        if (nbytes % dtype.itemsize).any():
            raise ValueError(f"a raster isn't of whole {kind} values")
        self.size = nbytes // dtype.itemsize                                 # of rasters, in values
        self.values, self.length = block.view(dtype), length

    def places(self, filler: float) -> np.ndarray:
        """The places where some raster holds another value than the filler, in order."""
        other = self.values != filler
        which = np.flatnonzero(other.any(axis=1))
        run = np.repeat(which, self.length[which])
        number = (self.ends - self.length)[run] + np.arange(len(run)) - np.repeat(np.cumsum(self.length[which]) - self.length[which], self.length[which])
        raster = np.searchsorted(self.begin, number, "right") - 1
        place = (number - self.begin[raster])[:, None] * other.shape[1] + np.arange(other.shape[1])
        return np.unique(place[other[run] & (place < self.size[raster][:, None])])

    def at(self, places: np.ndarray):
        """Values (rasters, places) as floats, and where there are any: a raster may end early."""
        n = self.values.shape[1]
        there = places < self.size[:, None]
        run = np.searchsorted(self.ends, self.begin[:, None] + np.where(there, places // n, 0), "right")
        return self.values[run, places % n].astype(np.float32), there


def value_bytes(data_type: Column) -> Column:
    """Bytes of one value of a registry type."""
    out = F.when(F.lit(False), F.lit(0))
    for name, dtype in DTYPES.items():
        out = out.when(data_type == name, F.lit(np.dtype(dtype).itemsize))
    return out


def _encode_cells(n: int, rows, cells, values, kind: str, filler: float) -> np.ndarray:
    """(n, length) base64 texts of whole rasters that hold the values at (rows, cells).

    Only the characters of these cells are worked out, the others are the filler's."""
    raster = np.full((n, CHIP_SHAPE[0] * CHIP_SHAPE[1]), filler, DTYPES[kind])
    raster[rows, cells] = values
    raw, size = raster.view(np.uint8), raster.itemsize
    if len(cells) > raster.size // 16:
        return np.stack([np.frombuffer(base64.b64encode(r), np.uint8) for r in raw])
    out = np.tile(_filled_text(kind, filler), (n, 1))
    first = (cells % raster.shape[1]) * size
    rows, group = np.concatenate([rows, rows]), np.concatenate([first // 3, (first + size - 1) // 3])
    at = 3 * group[:, None] + np.arange(3)
    b = np.where(at < raw.shape[1], raw[rows[:, None], np.minimum(at, raw.shape[1] - 1)], 0).astype(np.uint32)
    w = b[:, 0] << 16 | b[:, 1] << 8 | b[:, 2]
    out[rows[:, None], 4 * group[:, None] + np.arange(4)] = _ALPHABET[np.stack([w >> 18, w >> 12 & 63, w >> 6 & 63, w & 63], axis=1)]
    pad = -raw.shape[1] % 3
    out[:, out.shape[1] - pad:] = ord("=")
    return out


def packed_batches(batches, layers):
    """Arrow batches of acquisitions -> batches of chip records, some acquisitions of a layer each."""
    for batch in batches:
        for start in range(0, batch.num_rows, RASTERS_AT_ONCE):
            b = batch.slice(start, RASTERS_AT_ONCE)
            n = b.num_rows
            cells = b.column("cells").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(n), b.column("cells").value_lengths().to_numpy(zero_copy_only=False))
            nothing = pa.array([""] * n)
            for ubid, kind, band, filler in layers:
                values = b.column(band).flatten()
                there = values.is_valid().to_numpy(zero_copy_only=False)
                values = values.to_numpy(zero_copy_only=False)
                texts = _encode_cells(n, rows[there], cells[there], values[there], kind, float(filler))
                offsets = np.arange(n + 1, dtype=np.int32) * texts.shape[1]
                data = pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(texts))
                yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y"), b.column("acquired"), data, nothing, nothing,
                                                  pa.array([ubid] * n)], CHIP_RECORD_SCHEMA.names)


def pack_cells(df: DataFrame, layers) -> DataFrame:
    """Rows (x, y, acquired, cells, an array of values for each layer) -> chip records,
    a whole packed raster for each layer (name, type, values' column, filler).

    Cells that a row doesn't list, or whose value is null, hold the filler.  Records come
    out of Python a few at a time: a row in is small, but its rasters aren't."""
    given = df.select(F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), F.col("acquired").cast("string").alias("acquired"),
                      F.col("cells").cast("array<int>").alias("cells"), *[F.col(b).cast("array<double>").alias(b) for _, _, b, _ in layers])
    return given.mapInArrow(lambda batches: packed_batches(batches, layers), CHIP_RECORD_SCHEMA)


@F.pandas_udf(StringType())
def _encode(values: pd.Series, dtype: pd.Series) -> pd.Series:
    return pd.Series([None if v is None else base64.b64encode(np.asarray(v, DTYPES[t]).tobytes()).decode()
                      for v, t in zip(values, dtype)], dtype=object)


def encode(values: Column, data_type: Column) -> Column:
    """Inverse of T3 for any registry type: array of numbers -> base64."""
    return _encode(values, data_type)


def encode_int16(values: Column) -> Column:
    """Inverse of T3 for int16 rasters, in SQL expressions (used to build
    chips from tables): array<int> -> base64 of little endian int16."""
    hexed = F.transform(values, lambda v: F.concat(F.lpad(F.hex(v.bitwiseAND(255)), 2, "0"),
                                                   F.lpad(F.hex(F.shiftright(v, 8).bitwiseAND(255)), 2, "0")))
    return F.base64(F.unhex(F.array_join(hexed, "")))


def pixel_rows(df: DataFrame, values: str = "values", cx="x", cy="y",
               ncols: int = CHIP_SHAPE[1], pixel_size: int = 30) -> DataFrame:
    """T5: one row per array element with its pixel coordinates.

    px = cx + size * (i mod ncols), py = cy - size * (i div ncols).
    """
    rest = [c for c in df.columns if c != values]
    e = df.select(*rest, F.posexplode(values).alias("i", "value"))
    return (e.withColumn("px", (F.col(cx) + F.lit(pixel_size) * (F.col("i") % ncols)).cast("int"))
             .withColumn("py", (F.col(cy) - F.lit(pixel_size) * F.floor(F.col("i") / ncols)).cast("int")))
