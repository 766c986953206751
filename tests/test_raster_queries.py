"""The raster queries keep each chip and each day of their tables."""

import base64

import numpy as np
from pyspark.sql import functions as F

from pixelchange.functions import grid
from pixelchange.functions.dates import date_to_ordinal, in_acquired_days
from pixelchange.operators import series as SR
from pixelchange.plans import catalogue as C
from pixelchange.sources import rasters, standins

from .conftest import SF_SMALL


def test_q38_has_the_chip_of_each_customer_and_the_day_of_each_order(spark):
    x, y = grid.chip_of_point("x", "y")
    o = standins.table(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey", date_to_ordinal("o_orderdate").alias("t"))
    lines = (standins.table(spark, SF_SMALL, "lineitem").join(o.where(in_acquired_days("t", C.ACQUIRED)), F.col("l_orderkey") == F.col("o_orderkey"))
             .join(standins.points(spark, SF_SMALL), F.col("o_custkey") == F.col("c_custkey"))
             .select(x.alias("cx"), y.alias("cy"), "t", (F.col("l_partkey") % C.CELLS).alias("cell")))
    want = {(r.cx, r.cy, r.t) for r in lines.collect()}
    cells = {(r.cx, r.cy, r.cell) for r in lines.collect()}
    got = C.q38_raster_ard(spark, SF_SMALL).collect()
    assert {(r.cx, r.cy, int(t)) for r in got for t in r.dates.split(",")} == want
    assert {(r.cx, r.cy, (r.px - r.cx) // 30 + 100 * ((r.cy - r.py) // 30)) for r in got} == cells
    assert len(got) == len(cells) and len({(c[0], c[1]) for c in want}) > 25


def test_q39_has_the_chip_of_each_part(spark):
    want = {tuple(r) for r in standins.table(spark, SF_SMALL, "part").select(*standins.pixel_keys("p_partkey")[:2]).collect()}
    got = C.q39_raster_aux(spark, SF_SMALL)
    assert {(r.cx, r.cy) for r in got.collect()} == want and len(want) > 25


def test_pixels_without_data_can_be_left_out_of_a_series(spark):
    """As all pixels of whole chips, without those that hold the filler on every day."""
    rng = np.random.default_rng(5)
    rows = []
    for x in (0, 3000):
        for day in ("2000-01-01", "2000-02-01"):
            qa = np.ones(10000, "<u2")
            qa[rng.choice(10000, 7)] = 66
            for ubid, kind in zip(["LC08_SRB2", "LC08_SRB3", "LC08_SRB4", "LC08_SRB5", "LC08_SRB6", "LC08_SRB7", "LC08_BTB10"], ["<i2"] * 7):
                rows.append((x, 0, day + "T00:00:00Z", base64.b64encode(rng.integers(-9, 9, 10000).astype(kind).tobytes()).decode(), "", "", ubid))
            rows.append((x, 0, day + "T00:00:00Z", base64.b64encode(qa.tobytes()).decode(), "", "", "LC08_PIXELQA"))
    chips = spark.createDataFrame(rows, rasters.CHIP_RECORD_SCHEMA)
    reg = rasters.registry(spark)
    whole = SR.ard(chips, reg).where(F.exists("qas", lambda q: q > 1))
    some = SR.ard(chips, reg, partitions=3, seen=("qas", 1))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(some) == key(whole) and 14 < some.count() <= 28
