"""Detector checks: synthetic truth and a brute-force numpy run of the same
rules, pixel by pixel, against the relational rounds."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelchange.config import DAYS_PER_YEAR
from pixelchange.operators import detect as D
from pixelchange.operators import fit as fitmod
from pixelchange.sources import standins

from .conftest import SF_SMALL

W = 2 * math.pi / DAYS_PER_YEAR
BANDS7 = ["blues", "greens", "reds", "nirs", "swir1s", "swir2s", "thermals"]


def _design(t, t0, terms):
    cols = [np.ones_like(t, dtype=float), (t - t0) / DAYS_PER_YEAR, np.cos(W * t), np.sin(W * t)]
    return np.stack(cols[:terms], axis=1)


def _fit(t, Y, t0, terms, ridge):
    X = _design(t, t0, terms)
    A = X.T @ X + ridge * np.diag([0.0] + [1.0] * (terms - 1))
    B = np.linalg.solve(A, X.T @ Y)
    res = Y - X @ B
    rmse = np.sqrt((res ** 2).sum(axis=0) / max(len(t) - terms, 1))
    return B, rmse


def brute_force(t, Y, p, det_idx):
    """The detector's rules for one pixel (clear rows, sorted by t)."""
    vario = np.array([np.median(np.abs(np.diff(Y[:, j]))) if len(t) > 1 else 0.0
                      for j in range(Y.shape[1])])
    out = []
    start = 0
    while len(t) - start >= p.min_obs:
        tt, yy = t[start:], Y[start:]
        t0 = tt[0]
        span = p.min_years * DAYS_PER_YEAR
        if tt[-1] - t0 < span:
            break
        init_n = int(((np.arange(1, len(tt) + 1) <= p.min_obs) | (tt - t0 < span)).sum())
        B, rmse = _fit(tt[:init_n], yy[:init_n], t0, p.terms, p.ridge)
        rm = np.maximum(rmse, vario) if p.variogram_floor else rmse
        r = yy - _design(tt, t0, p.terms) @ B
        z = np.zeros(len(tt))
        for j in det_idx:
            if rm[j] > 0:
                z += (r[:, j] / rm[j]) ** 2
        n = np.arange(1, len(tt) + 1)

        def find(z):
            flag = (n > init_n) & (z > p.threshold)
            for i in range(len(tt) - p.peek + 1):
                if flag[i:i + p.peek].all():
                    return flag, i
            return flag, None

        def score(B, rmse):
            rm = np.maximum(rmse, vario) if p.variogram_floor else rmse
            r = yy - _design(tt, t0, p.terms) @ B
            z = np.zeros(len(tt))
            for j in det_idx:
                if rm[j] > 0:
                    z += (r[:, j] / rm[j]) ** 2
            return z

        flag, brk = find(z)
        for _ in range(p.refine):
            end = brk if brk is not None else len(tt)
            use = np.arange(end)[~flag[:end]]
            B, rmse = _fit(tt[use], yy[use], t0, p.terms, p.ridge)
            flag, brk = find(score(B, rmse))
        end = brk if brk is not None else len(tt)
        seg = np.arange(end)
        inl = seg[~flag[:end]]
        B2, rmse2 = _fit(tt[inl], yy[inl], t0, p.terms, p.ridge)
        if brk is not None:
            pr = yy[brk:brk + p.peek] - _design(tt[brk:brk + p.peek], t0, p.terms) @ B2
            mag = np.median(pr, axis=0)
            chprob, bday = 1.0, tt[brk]
        else:
            mag = np.zeros(Y.shape[1])
            ok = n[~flag]
            last_ok = ok.max() if len(ok) else 0
            chprob = min(len(tt) - max(last_ok, init_n), p.peek) / p.peek
            bday = tt[end - 1]
        out.append(dict(sday=tt[0], eday=tt[end - 1], bday=bday, chprob=chprob, rmse=rmse2, mag=mag, b=B2))
        if brk is None:
            break
        start += brk
    return out


def test_rounds_match_brute_force(spark):
    p = D.DetectParams()
    obs = standins.observations(spark, SF_SMALL)
    seg, _ = D.detect_rounds(obs, p)
    got = {}
    for r in seg.collect():
        got.setdefault((r.px, r.py), []).append(r)
    rows = obs.where(D.clear_flag(p)).select("px", "py", "t", *BANDS7).collect()
    pix = {}
    for r in rows:
        pix.setdefault((r.px, r.py), []).append(r)
    det_idx = [BANDS7.index(b) for b in p.detection_bands]
    checked = 0
    for key, rs in pix.items():
        rs.sort(key=lambda r: r.t)
        t = np.array([r.t for r in rs], dtype=float)
        Y = np.array([[getattr(r, b) for b in BANDS7] for r in rs], dtype=float)
        want = brute_force(t, Y, p, det_idx)
        have = sorted(got.get(key, []), key=lambda r: r.sday_n)
        assert len(have) == len(want), key
        for h, w in zip(have, want):
            assert (h.sday_n, h.eday_n, h.bday_n) == (w["sday"], w["eday"], w["bday"])
            assert h.chprob == pytest.approx(w["chprob"])
            for j, b in enumerate(BANDS7):
                assert getattr(h, f"rmse_{b}") == pytest.approx(w["rmse"][j], rel=1e-6, abs=1e-6)
                assert getattr(h, f"mag_{b}") == pytest.approx(w["mag"][j], rel=1e-6, abs=1e-6)
                assert getattr(h, f"b_{b}_0") == pytest.approx(w["b"][0, j], rel=1e-6, abs=1e-6)
            checked += 1
    assert checked > 50


def _synthetic(spark, series):
    """series: {pixel index: (days, values of one band)} -> 7 band obs."""
    rows = []
    for k, (days, vals) in series.items():
        for d, v in zip(days, vals):
            rows.append((0, 0, 30 * k, 0, int(d), *([int(v)] * 7), 66))
    return spark.createDataFrame(rows, "cx int, cy int, px int, py int, t int, blues int, greens int, reds int, "
                                       "nirs int, swir1s int, swir2s int, thermals int, qas int")


def test_synthetic_truth(spark):
    rng = np.random.default_rng(7)
    days = np.arange(730000, 730000 + 16 * 300, 16)
    season = 300 * np.cos(W * days)
    noise = lambda: rng.normal(0, 10, len(days))
    step_day = days[150]
    series = {
        0: (days, 1000 + season + noise()),                                  # season only
        1: (days, 1000 + season + noise() + np.where(days >= step_day, 800, 0)),  # one step
        2: (days, np.full(len(days), -9999)),                                # all fill
        3: (days[:8], 1000 + noise()[:8]),                                   # too few
        4: (days, 1000 + season + noise() + np.where(np.arange(len(days)) == 100, 3000, 0)),  # spike
    }
    ccd = D.detect(_synthetic(spark, series))
    by = {}
    for r in ccd.collect():
        by.setdefault(r.px // 30, []).append(r)
    assert len(by[0]) == 1 and by[0][0].chprob < 1
    one = sorted(by[1], key=lambda r: r.sday)
    assert len(one) == 2
    assert one[0].bday == str(__import__("datetime").date.fromordinal(int(step_day)))
    assert one[0].chprob == 1.0 and one[0].grmag > 500
    for k in (2, 3):
        assert [(r.sday, r.eday, r.bday) for r in by[k]] == [("0001-01-01",) * 3]
        assert by[k][0].chprob is None
    # the spike is an outlier (masked), not a break near it
    import datetime
    spike = datetime.date.fromordinal(int(days[100])).isoformat()
    near = {datetime.date.fromordinal(int(d)).isoformat() for d in days[95:110]}
    assert not any(r.bday in near and r.chprob == 1.0 for r in by[4])
    r4 = by[4][0]
    assert len(r4.mask) == len(days) and r4.mask[r4.dates.index(spike)] == 0


def test_fit_matches_lstsq(spark):
    rng = np.random.default_rng(3)
    t = np.sort(rng.choice(np.arange(730000, 733000), 40, replace=False)).astype(float)
    y = 500 + 20 * (t - t[0]) / DAYS_PER_YEAR + 80 * np.cos(W * t) + rng.normal(0, 1, len(t))
    df = spark.createDataFrame([(1, int(a), float(b)) for a, b in zip(t, y)], "k int, t int, y double")
    got = fitmod.fit(df, ["k"], ["y"], terms=4, ridge=0.0).first()
    X = _design(t, t[0], 4)
    want = np.linalg.lstsq(X, y, rcond=None)[0]
    assert [got[f"b_y_{i}"] for i in range(4)] == pytest.approx(list(want), rel=1e-6, abs=1e-5)


def test_default_and_format(spark):
    px = spark.createDataFrame([(1, 2, 3, 4)], "cx int, cy int, px int, py int")
    none = spark.createDataFrame([], "cx int, cy int, px int, py int")
    tmpl = spark.createDataFrame([], "cx int, cy int, px int, py int, sday string, eday string, bday string, "
                                     "chprob float")
    r = D.default_segments(px, none, tmpl).first()
    assert (r.sday, r.eday, r.bday, r.chprob) == ("0001-01-01", "0001-01-01", "0001-01-01", None)


def test_plan_reuses_pixel_partitioning(spark):
    """After the one repartition by pixel, a round adds no shuffle."""
    p = D.DetectParams()
    a = D.materialise(D.prepare(standins.observations(spark, SF_SMALL), p))
    plan = D._score(a, p)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    nxt = D._score(D._next_active(D.materialise(D._score(a, p)), p), p)
    assert "Exchange" not in nxt._jdf.queryExecution().executedPlan().toString()


def test_raster_chips_to_segments(spark, tmp_path):
    """The raster path end to end: base64 chip files -> decode -> band
    assembly -> long observations -> detector finds the planted step."""
    import base64
    import datetime
    import json

    from pixelchange.operators import series as SR
    from pixelchange.sources import rasters

    cx, cy = -1815585, 1064805
    days = np.arange(730000, 730000 + 16 * 120, 16)
    step_at = 80
    records = []
    layers = {"le07_srb1": "blues", "le07_srb2": "greens", "le07_srb3": "reds", "le07_srb4": "nirs",
              "le07_srb5": "swir1s", "le07_srb7": "swir2s", "le07_btb6": "thermals", "le07_pixelqa": "qas"}
    for k, d in enumerate(days):
        base = 1000 + 300 * np.cos(W * d) + (700 if k >= step_at else 0)
        acq = datetime.date.fromordinal(int(d)).isoformat() + "T00:00:00Z"
        for ubid, band in layers.items():
            if band == "qas":
                raster, dt = np.full(10000, 66), "<u2"
            else:
                raster = np.full(10000, -9999)
                raster[:3] = int(base) + np.arange(3)        # three pixels carry data
                dt = "<i2"
            data = base64.b64encode(np.asarray(raster, dtype=dt).tobytes()).decode()
            records.append(dict(x=cx, y=cy, acquired=acq, data=data, hash="", source="", ubid=ubid))
    path = tmp_path / "chips.json"
    path.write_text("\n".join(json.dumps(r) for r in records))
    ids = spark.createDataFrame([(cx, cy)], "cx int, cy int")
    chips = rasters.scan_chips(spark, str(path), ids, acquired="1990-01-01/2030-01-01")
    ard = SR.ard(chips, rasters.registry(spark))
    assert ard.count() == 10000
    obs = D.observations_from_series(ard)
    direct = SR.chip_observations(chips, rasters.registry(spark), partitions=4)
    assert direct.count() == obs.count() == 10000 * len(days)
    ccd = D.detect(direct)
    data_px = (F.col("px") < cx + 90) & (F.col("py") == cy)
    real = ccd.where(data_px).collect()
    assert {r.px for r in real} == {cx, cx + 30, cx + 60}
    for px in (cx, cx + 30, cx + 60):
        segs = sorted((r for r in real if r.px == px), key=lambda r: r.sday)
        assert len(segs) == 2
        assert segs[0].bday == datetime.date.fromordinal(int(days[step_at])).isoformat()
    fill = ccd.where(~data_px)
    assert fill.count() == 10000 - 3
    assert fill.where("sday = '0001-01-01'").count() == 10000 - 3


def _series_of(rng, n, years=3.0):
    t = np.sort(rng.choice(np.arange(730000, 730000 + int(years * 365)), n, replace=False)).astype(float)
    y = 500 + 30 * (t - t[0]) / DAYS_PER_YEAR + 80 * np.cos(W * t) + 40 * np.sin(2 * W * t) + 25 * np.cos(3 * W * t) + rng.normal(0, 5, n)
    return t, y


def _design8(t, t0):
    cols = [np.ones_like(t), (t - t0) / DAYS_PER_YEAR]
    for h in (1, 2, 3):
        cols += [np.cos(h * W * t), np.sin(h * W * t)]
    return np.stack(cols, axis=1)


def test_order_follows_the_observations_and_lasso_matches_numpy(spark):
    """4, 6 and 8 terms; the descent on the sums against one on the rows."""
    rng = np.random.default_rng(5)
    sizes = [8, 12, 17, 18, 23, 24, 40, 90]
    rows, want = [], {}
    for k, n in enumerate(sizes):
        t, y = _series_of(rng, n)
        rows += [(k, int(a), float(b), float(2 * b - 100)) for a, b in zip(t, y)]
        order = 8 if n >= 24 else 6 if n >= 18 else 4
        for band, v in (("y", y), ("z", 2 * y - 100)):
            x = _design8(t, t[0])[:, :order]
            ridge = np.linalg.solve(x.T @ x + fitmod.RIDGE * np.diag([0.0] + [1.0] * (order - 1)), x.T @ v)
            b = ridge.copy()
            for _ in range(fitmod.SWEEPS):
                for j in range(order):
                    rho = x[:, j] @ (v - x @ b) + (x[:, j] @ x[:, j]) * b[j]
                    b[j] = (rho if j == 0 else np.sign(rho) * max(abs(rho) - 2.0 * n, 0)) / (x[:, j] @ x[:, j])
            want[k, band] = order, ridge, b, np.sqrt(((v - x @ b) ** 2).sum() / max(n - order, 1))
    df = spark.createDataFrame(rows, "k int, t int, y double, z double")
    plain = {r.k: r for r in fitmod.fit(df, ["k"], ["y", "z"], terms=8, orders=(4, 6, 8)).collect()}
    lasso = {r.k: r for r in fitmod.fit(df, ["k"], ["y", "z"], terms=8, orders=(4, 6, 8), alpha=2.0).collect()}
    for (k, band), (order, ridge, b, rmse) in want.items():
        assert plain[k].order == lasso[k].order == order
        for got, coefs in ((plain[k], ridge), (lasso[k], b)):
            assert [got[f"b_{band}_{i}"] for i in range(8)] == pytest.approx(list(coefs) + [0.0] * (8 - order), rel=1e-6, abs=1e-6)
        assert lasso[k][f"rmse_{band}"] == pytest.approx(rmse, rel=1e-6)
    # the Lasso's own conditions: correlations with the residual are bounded by the weight
    t, y = _series_of(np.random.default_rng(9), 200)
    x = _design8(t, t[0])
    b = fitmod.descend((x.T @ x)[None], (x.T @ y)[None, None], np.zeros((1, 1, 8)), np.array([200 * 6.0]), 2000)[0, 0]
    grad = x.T @ (y - x @ b)
    assert abs(grad[0]) < 1e-4 and (np.abs(grad[1:]) <= 1200 + 1e-4).all() and (b == 0).any()
    assert np.abs(np.abs(grad[1:][b[1:] != 0]) - 1200).max() < 1e-3
