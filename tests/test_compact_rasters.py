"""Whole rasters pass through Python a few at a time, and move as runs of equal blocks."""

import base64

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pixelchange.operators import series as SR
from pixelchange.plans import catalogue as C
from pixelchange.sources import rasters

BAND_UBIDS = ["SRB2", "SRB3", "SRB4", "SRB5", "SRB6", "SRB7", "BTB10"]


def _rasters(kind, fill, rng):
    """Sparse, dense, empty, short and near-equal rasters of a type, as bytes."""
    dt = np.dtype(rasters.DTYPES[kind])
    out = []
    for n in (0, 1, 3, 60, 5000, 10000):
        r = np.full(10000, fill, dt)
        r[rng.choice(10000, n, replace=False)] = np.frombuffer(rng.bytes(n * dt.itemsize), dt)
        out.append(r.tobytes())
    out += [np.full(n, fill, dt).tobytes() for n in (0, 1, 2, 6, 7, 12, 100)] + [rng.bytes(n * dt.itemsize) for n in (1, 6, 13)]
    for _ in range(40):
        r = np.full(10000, fill, dt).view(np.uint8).copy()
        for at in rng.choice([0, 1, 11, 12, 13, len(r) - 9, len(r) - 1], 3):
            r[at] = (int(r[at]) + int(rng.integers(-1, 2))) % 256
        out.append(r.tobytes())
    return out


@pytest.mark.parametrize("kind", list(rasters.DTYPES))
def test_compact_rasters_keep_every_value_and_their_order(kind):
    rng, fill = np.random.default_rng(3), 1 if kind != "INT16" else -9999
    raws = _rasters(kind, fill, rng)
    texts = [base64.b64encode(r).decode() for r in raws]
    packed = rasters.compact_texts(texts)
    assert [rasters.compact_texts([t])[0] for t in texts] == packed
    broken = [base64.encodebytes(r).decode() for r in raws]       # with line breaks
    assert rasters.compact_texts([*broken, None]) == [*packed, None]
    # and one with line breaks among others of its length
    less = base64.b64encode(raws[3][:-3]).decode()
    odd = less[:500] + "\r\n\r\n" + less[500:]
    assert len(odd) == len(texts[3])
    assert rasters.compact_texts([texts[3], odd, texts[4]]) == [packed[3], *rasters.compact_texts([less]), packed[4]]
    by = lambda key: sorted(range(len(raws)), key=lambda i: (key[i], i))
    assert by(packed) == by(raws)
    c = rasters.CompactRasters(packed, kind)
    values, there = c.at(np.arange(10_005))
    want = [np.frombuffer(r, rasters.DTYPES[kind]) for r in raws]
    for v, t, w in zip(values, there, want):
        assert t.sum() == len(w) and t[:len(w)].all() and np.array_equal(v[:len(w)], w.astype(np.float32), equal_nan=True)
    assert c.places(float(fill)).tolist() == sorted(set(np.concatenate([np.flatnonzero(w != fill) for w in want]).tolist()))
    assert len(packed[0]) < 40 and max(map(len, packed)) <= max(map(len, raws)) * 4 / 3


@pytest.mark.parametrize("kind", list(rasters.DTYPES))
def test_packed_records_come_in_small_batches(kind):
    """However many acquisitions a batch has; few cells or many, a null value is the filler."""
    rng, rows = np.random.default_rng(4), []
    for n in [0, 1, 4] * 30 + [9000]:
        cells = rng.choice(10000, n, replace=False).tolist()
        rows.append((cells, [None if c % 5 == 0 else float(c % 200) for c in cells]))
    batch = pa.RecordBatch.from_arrays([pa.array([k] * len(rows), t) for k, t in ((0, pa.int32()), (0, pa.int32()), ("d", pa.string()))]
                                       + [pa.array([c for c, _ in rows], pa.list_(pa.int32())), pa.array([v for _, v in rows], pa.list_(pa.float64()))],
                                       ["x", "y", "acquired", "cells", "band"])
    out = list(rasters.packed_batches([batch.slice(1, 89), batch.slice(90)], [("U", kind, "band", 7)]))
    assert max(b.num_rows for b in out) <= rasters.RASTERS_AT_ONCE
    texts = [t for b in out for t in b.column("data").to_pylist()]
    for text, (cells, values) in zip(texts, rows[1:], strict=True):
        r = np.full(10000, 7, rasters.DTYPES[kind])
        for c, v in zip(cells, values):
            r[c] = 7 if v is None else v
        assert text == base64.b64encode(r.tobytes()).decode()


def test_whole_rasters_are_in_no_arrow_batch_of_spark(spark, tmp_root):
    """By Spark's own limits a batch of packed or decoded rasters took hundreds of MB."""
    cells = spark.range(5).selectExpr("cast(id as int) cx", "0 cy", "730000 t", "cast(id as int) cell", "1 band")
    chips = C._packed(cells, [("LC08_SRB2", "INT16", "band", -9999)])
    assert "EvalPython" not in chips._jdf.queryExecution().executedPlan().toString()      # packed_batches, above
    chips.write.parquet(tmp_root + "/chips")
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    out = rasters.compact(rasters.scan_chips(spark, tmp_root + "/chips", fmt="parquet"))
    assert spark.conf.get(key) == before
    assert "Arrow" not in out._jdf.queryExecution().executedPlan().toString() and "data" not in out.columns
    assert [len(r.raw) < 80 for r in out.collect()] == [True] * 5


def test_series_of_odd_records_are_those_of_whole_chips(spark):
    """Repeated layers, two acquisitions a day, two sensors at once, line breaks, a short
    raster, a missing layer: as the exploded and grouped pixels."""
    rng, rows = np.random.default_rng(6), []
    data = lambda r: base64.b64encode(r.tobytes()).decode()

    def acquisition(x, when, sensor="LC08", leave=(), short=False):
        qa = np.ones(10000, "<u2")
        qa[rng.choice(10000, 5, replace=False)] = 66
        names = BAND_UBIDS if sensor == "LC08" else ["SRB1", "SRB2", "SRB3", "SRB4", "SRB5", "SRB7", "BTB6"]
        for u in names:
            if u not in leave:
                rows.append((x, 0, when, data(rng.integers(-2, 2, 9990 if short and u == names[2] else 10000).astype("<i2")), "", "", f"{sensor}_{u}"))
        rows.append((x, 0, when, data(qa), "", "", f"{sensor}_PIXELQA"))

    for x in (0, 3000):
        acquisition(x, "2000-01-01T00:00:00Z")
        for hour in (9, 10, 11):
            acquisition(x, f"2000-02-01T{hour:02d}:00:00Z")
        acquisition(x, "2000-03-01T00:00:00Z")
        acquisition(x, "2000-03-01T00:00:00Z")                     # the same layers again, with other values
        acquisition(x, "2000-04-01T00:00:00Z", "LC08")
        acquisition(x, "2000-04-01T00:00:00Z", "LE07")
        acquisition(x, "2000-05-01T00:00:00Z", leave=("SRB5",))    # not complete
    acquisition(6000, "2000-06-01T00:00:00Z", short=True)
    acquisition(6000, "2000-07-01T00:00:00Z")
    acquisition(9000, "2000-07-01T00:00:00Z", leave=("SRB5",))
    rows.append((6000, 0, "2000-08-01T00:00:00Z", None, "", "", "LC08_SRB2"))
    rows[3] = (*rows[3][:3], base64.encodebytes(base64.b64decode(rows[3][3])).decode(), *rows[3][4:])
    chips = spark.createDataFrame(rows, rasters.CHIP_RECORD_SCHEMA)
    reg = rasters.registry(spark)
    key = lambda df: sorted(map(str, df.collect()))
    for parts in (None, 3):
        some = SR.ard(chips, reg, partitions=parts, seen=("qas", 1))
        assert key(some) == key(SR.ard(chips, reg).where(F.exists("qas", lambda q: q > 1)))
    assert some.select("cx").distinct().count() == 3
    few = SR.series_for_chips(chips, reg, "ard", 3, ("qas", 1))
    SR.VALUES_AT_ONCE, old = 10, SR.VALUES_AT_ONCE
    try:
        assert key(SR.series_for_chips(chips, reg, "ard", 3, ("qas", 1))) == key(few)
    finally:
        SR.VALUES_AT_ONCE = old
