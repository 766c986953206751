"""Stable start in batches of whole pixels; rounds that keep the partitioning by pixel."""

import numpy as np
from pyspark.sql import functions as F

from pixelchange.operators import batches, start
from pixelchange.operators import detect as D
from pixelchange.sources import standins

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _prepared(spark, p):
    return D.materialise(D.prepare(standins.observations(spark, SF_SMALL), p, D.PID))


def test_first_windows_are_the_least_stable_ones_and_no_row_is_framed(spark, monkeypatch):
    p = D.DetectParams(stable=True, stable_sigma=0.6)
    prepared = _prepared(spark, p)
    first = start.first_windows(prepared, p, D.PID)
    assert "Window" not in _plan(first) and "Window" not in _plan(start.windows(prepared, p, D.PID))
    want = (start.windows(prepared, p, D.PID).where("stable").groupBy("pid")
            .agg(F.min(F.struct("s", "t")).alias("w")).select("pid", "w.s", "w.t"))
    got = sorted(map(tuple, first.collect()))
    assert got == sorted(map(tuple, want.collect())) and len(got) > 20
    monkeypatch.setattr(start, "by_pixel", lambda keys, work: batches.by_pixel(keys, work, 8))
    assert sorted(map(tuple, start.first_windows(prepared, p, D.PID).collect())) == got


def test_windows_of_a_year_that_has_more_rows_than_the_least(spark):
    """Rows every 8 days: a window is the year's 46 rows, of several pixels in one batch; a pixel of a
    few rows, one without a whole year and an empty table have none."""
    rng = np.random.default_rng(5)
    rows = []
    for k, (n, step) in enumerate([(120, 8), (5, 40), (30, 8), (90, 8)]):
        y = 1000 + rng.normal(0, 10, n) + (np.arange(n) >= 20) * 900 * (k == 3)
        rows += [(k, i + 1, 730000 + step * i, 730000, float(v), 5.0) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "pid long, n int, t int, t0 int, greens double, vario_greens double")
    df = D.materialise(df.repartition(1, "pid"))
    p = D.DetectParams(bands=["greens"], detection_bands=["greens"], stable=True)
    seen = {}
    for r in start.windows(df, p, D.PID).collect():
        seen.setdefault(r.pid, []).append(r.s)
    # 365.25 days or more up to the last row
    assert {k: (min(v), max(v), len(v)) for k, v in seen.items()} == {0: (1, 74, 74), 3: (1, 44, 44)}
    got = {r.pid: (r._s, r._t0) for r in start.first_windows(df, p, D.PID).collect()}
    assert got[0] == (1, 730000) and 8 < got[3][0] <= 21
    assert start.first_windows(df.where("pid < 0"), p, D.PID).count() == 0


def test_rounds_with_a_stable_start_keep_the_partitioning(spark):
    """A start moves the rows' numbers; rows are not dealt anew for breaks, refits or the next round."""
    p = D.DetectParams(stable=True, stable_sigma=0.6)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scored = D._score(_prepared(spark, p), p, D.PID)
        refined = D._refine(scored, p, D.PID)
        for df in (scored, refined, D._next_active(refined, p, D.PID)):
            assert "Exchange" not in _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
