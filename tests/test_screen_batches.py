"""Robust screening in batches of whole pixels."""

import numpy as np
from pyspark.sql import functions as F

from pixelchange.operators import detect as D
from pixelchange.operators import fit, screen


def _rows(spark, pixels, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for k, n in enumerate(pixels):
        t = 730000 + np.cumsum(rng.integers(1, 40, n))
        y = rng.integers(0, 3000, (n, 2))
        y[rng.random(n) < 0.1] += 9000
        out += [(k * 30, -k, int(a), int(b), int(c), bool(rng.random() < 0.9)) for a, (b, c) in zip(t, y)]
    return spark.createDataFrame(out, "px int, py int, t int, greens int, swir1s int, _clear boolean").repartition(3)


def _plain(t, y, p):
    """The definition, row by row."""
    c, s = np.cos(fit.OMEGA * t), np.sin(fit.OMEGA * t)
    w, n = np.ones(len(t)), len(t)
    x = np.column_stack([np.ones(n), c, s])
    for _ in range(p.screen_rounds + 1):
        r = np.full(n, np.nan)
        for i in range(n):
            off = []
            for rows in (slice(max(0, i - p.screen_rows + 1), i + 1), slice(i, i + p.screen_rows)):
                if (w[rows] > 0).sum() >= screen.LEAST_ROWS:
                    g = (x[rows] * w[rows][:, None]).T @ x[rows] + np.diag([0, screen.RIDGE, screen.RIDGE])
                    off.append(y[i] - x[i] @ np.linalg.solve(g, (x[rows] * w[rows][:, None]).T @ y[rows]))
            r[i] = min(off, key=abs) if off else np.nan
        known = np.abs(r[~np.isnan(r)])
        m = np.median(known) if len(known) else np.nan
        u = r / (screen.BISQUARE * m) if m > 0 else np.full(n, np.nan)
        w = np.where(np.isnan(u), 1.0, np.where(np.abs(u) < 1, (1 - u * u) ** 2, 0.0))
    steps = np.abs(np.diff(y))
    return r, np.fmax(screen.DEVIATION * m, np.median(steps) if len(steps) else np.nan)


def test_residuals_are_those_of_the_definition(spark):
    p = D.DetectParams(screen=(("greens", 1), ("swir1s", -1)))
    rows = _rows(spark, [1, 5, 6, 7, 16, 17, 40, 90, 400])
    got = {}
    for r in screen.residuals(rows, p, ["px", "py"], "_clear").collect():
        got.setdefault(r.px, []).append(r)
    assert sum(map(len, got.values())) == rows.count()
    seen = 0
    for rs in got.values():
        rs = sorted(rs, key=lambda r: r.t)
        assert all(r.r_greens is None and r.s_swir1s is None for r in rs if not r._clear)
        clear = [r for r in rs if r._clear]
        for b in ("greens", "swir1s"):
            t, y = np.array([r.t for r in clear]), np.array([float(r[b]) for r in clear])
            if not len(t):
                continue
            want, dev = _plain(t, y, p)
            assert np.allclose(np.array([r[f"r_{b}"] for r in clear], float), want, rtol=1e-6, atol=1e-6, equal_nan=True)
            assert np.allclose(np.array([r[f"s_{b}"] for r in clear], float), dev, rtol=1e-6, equal_nan=True)
            seen += int((~np.isnan(want)).sum())
    assert seen > 700


def test_batches_end_between_pixels_and_no_row_is_framed(spark, monkeypatch):
    p = D.DetectParams(screen=(("greens", 1), ("swir1s", -1)))
    rows = _rows(spark, [30] * 40 + [300], seed=2)
    whole = screen.residuals(rows, p, ["px", "py"])
    assert "Window" not in whole._jdf.queryExecution().executedPlan().toString()
    want = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(screen, "BATCH_ROWS", 64)
    assert sorted(map(tuple, screen.residuals(rows, p, ["px", "py"]).collect())) == want


def test_screened_rows_are_not_clear_in_the_partitioned_rows(spark):
    p = D.complete_params(bands=["greens", "swir1s"], detection_bands=["greens", "swir1s"], qa=None)
    rows = _rows(spark, [60] * 5, seed=3).drop("_clear").withColumns({"cx": F.lit(0), "cy": F.lit(0)})
    base = D.partition_observations(rows, p, D.PID)
    kept = screen.screened(D.clear_observations(rows, p), p, ["px", "py"])
    key = lambda df: sorted(map(tuple, df.select("px", "py", "t").collect()))
    assert base.count() == 300 and key(base.where("_clear")) == key(kept) and 200 < kept.count() < 300
