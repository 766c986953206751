"""Stable start, look-back, robust screening and model order of the detector."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelchange.config import DAYS_PER_YEAR
from pixelchange.operators import detect as D
from pixelchange.operators import screen, start
from pixelchange.sources import standins

from .conftest import SF_SMALL
from .test_detect import BANDS7, W, _design, _fit, _synthetic


def iso(day):
    return datetime.date.fromordinal(int(day)).isoformat()


def _segments(spark, series, **given):
    out = {}
    for r in D.detect(_synthetic(spark, series), D.complete_params(**given)).collect():
        out.setdefault(r.px // 30, []).append(r)
    return {k: sorted(v, key=lambda r: r.sday) for k, v in out.items()}


def test_a_change_in_the_first_year_gets_its_day(spark):
    rng = np.random.default_rng(3)
    days = np.arange(730000, 730000 + 16 * 180, 16)
    noise = lambda: rng.normal(0, 10, len(days))
    season = 200 * np.cos(W * days)
    k = np.arange(len(days))
    series = {0: (days, 1000 + season + noise() + np.where(k >= 11, 900, 0)),     # change in the first year
              1: (days, 1000 + season + noise()),                                 # none
              2: (days, 1000 + season + noise() + np.where(k >= 100, 900, 0)),    # change later
              3: (days, 1000 + season + noise() + np.where(k >= 8, -700, 0) + np.where(k >= 90, 700, 0))}
    got = _segments(spark, series, screen=())
    assert [(r.sday, r.eday, r.bday) for r in got[0]] == [(iso(days[0]), iso(days[10]), iso(days[11])), (iso(days[11]), iso(days[-1]), iso(days[-1]))]
    assert got[0][0].curqa == D.CURVE_START and got[0][0].grmag > 500 and got[0][0].chprob == 1.0
    assert [(r.sday, r.curqa) for r in got[1]] == [(iso(days[0]), 8)]
    assert [r.bday for r in got[2]] == [iso(days[100]), iso(days[-1])]
    assert [r.bday for r in got[3]] == [iso(days[8]), iso(days[90]), iso(days[-1])]
    assert {len(r.grcoef) for rs in got.values() for r in rs} == {7}
    # every day is of some segment but for outliers
    assert all(sum(r.mask) >= len(days) - 8 for rs in got.values() for r in rs)


def test_start_is_the_first_stable_of_all_windows(spark):
    """Every window of every pixel against numpy, on the given tables."""
    p = D.DetectParams(stable=True, stable_sigma=0.6)      # strict: windows of both kinds
    prepared = D.prepare(standins.observations(spark, SF_SMALL), p, D.PID)
    got = {(r.pid, r.s): r.stable for r in start.windows(prepared, p, D.PID).collect()}
    pixels = {}
    for r in prepared.select("pid", "n", "t", *BANDS7, *[f"vario_{b}" for b in p.detection_bands]).collect():
        pixels.setdefault(r.pid, []).append(r)
    at = [BANDS7.index(b) for b in p.detection_bands]
    span, seen = p.min_years * DAYS_PER_YEAR, 0
    for pid, rows in pixels.items():
        rows.sort(key=lambda r: r.t)
        t = np.array([r.t for r in rows], float)
        y = np.array([[getattr(r, b) for b in BANDS7] for r in rows], float)[:, at]
        vario = np.array([getattr(rows[0], f"vario_{b}") for b in p.detection_bands])
        for s in range(len(t)):
            end = max(s + p.min_obs, int((t - t[s] < span)[s:].sum()) + s)
            whole = s + p.min_obs <= len(t) and t[-1] - t[s] >= span
            assert ((pid, s + 1) in got) == whole
            if not whole:
                continue
            b, rmse = _fit(t[s:end], y[s:end], t[0], 4, p.ridge)
            rm = np.maximum(rmse, vario)
            off = y[s:end] - _design(t[s:end], t[0], 4) @ b
            tests = [np.abs(x) / (p.stable_sigma * rm) for x in (b[1] * (t[end - 1] - t[s]) / DAYS_PER_YEAR, off[0], off[-1])]
            if min(abs(x.mean() - 1) for x in tests) > 1e-6:
                assert got[pid, s + 1] == all(x.mean() <= 1 for x in tests)
                seen += 1
    assert seen > 1000 and set(got.values()) == {True, False}


def _clouds(rng, days, k):
    at = rng.choice(np.arange(5, len(days) - 5), k, replace=False)
    at = at[np.all(np.abs(at[:, None] - at[None, :]) + 99 * np.eye(k) > 2, axis=1)]
    return at


def test_cloud_that_quality_missed_is_masked_and_clean_series_stay(spark):
    rng = np.random.default_rng(8)
    days = np.arange(730000, 730000 + 16 * 200, 16)
    season = 200 * np.cos(W * days)
    series, planted = {}, {}
    for k in range(12):
        y = 1000 + season + rng.normal(0, 12, len(days)) + np.where(np.arange(len(days)) >= 110, 600 * (k % 3 == 2), 0)
        planted[k] = _clouds(rng, days, 6) if k % 2 else np.zeros(0, int)
        planted[k] = planted[k][np.abs(planted[k] - 110) > 8]
        y[planted[k]] += 500
        series[k] = (days, y)
    p = D.complete_params()
    obs = _synthetic(spark, series)
    out = screen.residuals(D.clear_observations(obs, p), p, D.PIXEL).where(screen.cloudy(p)).select("px", "t").collect()
    taken = {}
    for r in out:
        taken.setdefault(r.px // 30, set()).add(r.t)
    for k in series:
        clouds = set(days[planted[k]].tolist())
        assert clouds <= taken.get(k, set())
        assert len(taken.get(k, set()) - clouds) <= (2 if k % 2 else 0)
    for k, rs in _segments(spark, series).items():
        off = [iso(d) for d in days[planted[k]]]
        assert all(r.mask[r.dates.index(d)] == 0 for r in rs for d in off)
        assert [r.bday for r in rs] == ([iso(days[110])] if k % 3 == 2 else []) + [iso(days[-1])]


def test_a_lasting_change_is_no_cloud(spark):
    rng = np.random.default_rng(2)
    days = np.arange(730000, 730000 + 16 * 160, 16)
    series = {k: (days, 1000 + rng.normal(0, 8, len(days)) + np.where(np.arange(len(days)) >= 40 + 7 * k, 700, 0)) for k in range(8)}
    p = D.complete_params()
    rows = screen.residuals(D.clear_observations(_synthetic(spark, series), p), p, D.PIXEL)
    assert rows.where(screen.cloudy(p)).count() == 0


def test_new_parts_add_no_shuffle(spark):
    p = D.complete_params()
    base = D.partition_observations(standins.observations(spark, SF_SMALL), p, D.PID)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        prepared = D.prepare(base, p, D.PID, partitioned=True)
        for df in (prepared, start.first_windows(D.materialise(prepared), p, D.PID)):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("given", [dict(screen=()), dict(stable=False), dict(alpha=1.0)])
def test_parts_can_be_left_out(spark, given):
    rng = np.random.default_rng(4)
    days = np.arange(730000, 730000 + 16 * 120, 16)
    series = {0: (days, 1000 + rng.normal(0, 9, len(days)) + np.where(np.arange(len(days)) >= 70, 800, 0)),
              1: (days, np.full(len(days), -9999)), 2: (days[:9], 500 + rng.normal(0, 9, 9)), 3: (days, np.full(len(days), 700))}
    got = _segments(spark, series, **given)
    assert [r.bday for r in got[0]] == [iso(days[70]), iso(days[-1])]
    assert all([(r.sday, r.curqa) for r in got[k]] == [("0001-01-01", None)] for k in (1, 2))
    assert [(r.sday, r.eday) for r in got[3]] == [(iso(days[0]), iso(days[-1]))]
