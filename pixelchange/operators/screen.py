"""Robust screening of cloud and shadow that the quality band missed.

Each row has two local fits of a band (intercept and one annual harmonic): over the
``screen_rows`` rows up to it and over those from it on.  Its residual is the smaller
of the two, so a lasting change, which one side agrees with, is none.  Fits are
iteratively reweighted: rows far off (bisquare of 6 median absolute residuals of the
pixel) lose their weight in the fits of their neighbours, ``screen_rounds`` times.  A
row that is then more than ``screen_factor`` deviations off on a band's cloudy side is
taken out; the deviation is 1.4826 median absolute residuals and at least the median
step from one row to the next.

Rows are dealt by pixel and sorted by Spark; a task then takes them in batches of whole
pixels, and a round is some sums of shifted arrays and one sort for the medians, for
all pixels of a batch together.  (As window frames each row was added up in 16 frames
of 40 sums a round, which took more than the rest of the detector.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import fit as fitmod
from .batches import BATCH_ROWS, by_pixel

# Rows that a local fit needs.
LEAST_ROWS = 6
# Weight of the ridge on the harmonic (few rows may not determine it).
RIDGE = 1e-2
BISQUARE, DEVIATION = 6.0, 1.4826


def _screener(keys, bands, clear, rows, rounds):
    """Batches of rows sorted by pixel and day -> the same with the residuals and
    deviations of each band.  Self-contained, so that it is shipped by value."""
    ridge, least, far, deviation = RIDGE, LEAST_ROWS, BISQUARE, DEVIATION

    def medians(x, pixel, count):
        """Median of the values of each pixel that aren't NaN (NaN if none is)."""
        none = np.isnan(x)
        both = np.empty(len(x), complex)     # sorted by pixel, then value
        both.real, both.imag = pixel, np.where(none, np.inf, x)
        x = np.sort(both).imag
        known = np.bincount(pixel, ~none, count).astype(np.int64)
        first = np.searchsorted(pixel, np.arange(count))
        some = known > 0
        low, high = first + (np.maximum(known, 1) - 1) // 2, first + known // 2
        out = np.full(count, np.nan)
        out[some] = x[low[some]] * 0.5 + x[high[some]] * 0.5
        return out

    def local_fit(k, w, xc, xs, cc, cs, ss, y, yc, ys):
        """The three normal equations by elimination; NaN where there is no solution."""
        part = lambda a, b: np.divide(a, b, out=np.full(len(b), np.nan), where=b != 0)
        p, q = part(xc, w), part(xs, w)
        cc1, cs1, ss1 = cc + ridge - p * xc, cs - p * xs, ss + ridge - q * xs
        yc1, ys1 = yc - p * y, ys - q * y
        f = part(cs1, cc1)
        b2 = part(ys1 - f * yc1, ss1 - f * cs1)
        b1 = part(yc1 - cs1 * b2, cc1)
        return part(y - xc * b1 - xs * b2, w), b1, b2

    def trailing(part):
        """Sums of each value and the ``rows - 1`` before it, from sums of 1, 2, 4, ... values."""
        out, taken, width, left = np.zeros(len(part)), 0, 1, rows
        while left:
            if left % 2:
                out[taken:] += part[:len(part) - taken]
                taken += width
            left //= 2
            if left:
                wider = part.copy()
                wider[width:] += part[:-width]
                part, width = wider, 2 * width
        return out

    def screen_rows(pixel, c, s, values):
        n, count = len(pixel), pixel[-1] + 1
        # ``rows - 1`` zeros around each pixel: sums of shifted arrays stay inside it
        at = np.arange(n) + (rows - 1) * (pixel + 1)
        size = n + (rows - 1) * (count + 1)
        later = np.flatnonzero(pixel[1:] == pixel[:-1]) + 1
        out = []
        for y in values:
            w = np.ones(n)
            for _ in range(rounds + 1):
                wc, ws, wy = w * c, w * s, w * y
                sums = []
                for part in (w > 0, w, wc, ws, wc * c, wc * s, ws * s, wy, wy * c, wy * s):
                    padded = np.zeros(size)
                    padded[at] = part
                    sums.append(trailing(padded))
                off = []
                for side in (at, at + rows - 1):       # rows up to it, rows from it on
                    part = [x[side] for x in sums]
                    b0, b1, b2 = local_fit(*part)
                    off.append(np.where(part[0] >= least, y - (b0 + b1 * c + b2 * s), np.nan))
                a, z = off
                r = np.where(np.isnan(a) | (np.abs(z) < np.abs(a)), np.where(np.isnan(z), a, z), a)
                m = medians(np.abs(r), pixel, count)
                mr = m[pixel]
                flat = np.isnan(r) | ~(mr > 0)
                ratio = np.divide(r, far * mr, out=np.zeros(n), where=~flat)
                w = np.where(flat, 1.0, np.where(np.abs(ratio) < 1, (1 - ratio * ratio) ** 2, 0.0))
            step = np.full(n, np.nan)
            step[later] = np.abs(y[later] - y[later - 1])
            out += [r, np.fmax(deviation * m, medians(step, pixel, count))[pixel]]
        return out

    def screened_batch(t):
        size = t.num_rows
        use = np.arange(size) if clear is None else np.flatnonzero(t.column(clear).to_numpy())
        found = [np.full(size, np.nan) for _ in range(2 * len(bands))]
        if len(use):
            new = np.zeros(len(use), bool)
            for k in keys:
                v = t.column(k).to_numpy()[use]
                new[1:] |= v[1:] != v[:-1]
            of = lambda name: t.column(name).to_numpy()[use].astype(float)
            for whole, some in zip(found, screen_rows(np.cumsum(new), of("_c"), of("_s"), [of(b) for b in bands])):
                whole[use] = some
        for (name, kind), v in zip([(f"{x}_{b}", pa.float64()) for b in bands for x in "rs"], found):
            t = t.append_column(name, pa.array(v, kind, from_pandas=True))
        return t.drop_columns(["_c", "_s"])

    return by_pixel(keys, screened_batch, BATCH_ROWS)


def residuals(rows: DataFrame, p, keys, clear: str | None = None, dealt: bool = False) -> DataFrame:
    """``rows`` with r_{band} (null: too few rows on either side) and s_{band}, its deviation.

    Rows have values in the bands, all or (with ``clear``, a flag) those that count; the
    others stay, with nulls.  ``dealt``: a pixel's rows are in one partition already."""
    bands = [b for b, _ in p.screen]
    own = rows.select("*", F.expr(fitmod.regressor_sql(2)).alias("_c"), F.expr(fitmod.regressor_sql(3)).alias("_s"))
    if not dealt:
        own = own.repartition(*keys)
    schema = StructType(rows.schema.fields + [StructField(f"{x}_{b}", DoubleType()) for b in bands for x in "rs"])
    run = _screener(list(keys), bands, clear, p.screen_rows, p.screen_rounds)
    out = own.sortWithinPartitions(*keys, "t").mapInArrow(run, schema)
    return out.select(*rows.columns, *[f"r_{b}" for b in bands], *[f"s_{b}" for b in bands])


def cloudy(p):
    """A row that is too far off on the cloudy side of a band."""
    out = F.lit(False)
    for b, side in p.screen:
        out = out | F.coalesce((F.col(f"s_{b}") > 0) & (F.lit(float(side)) * F.col(f"r_{b}") > F.lit(p.screen_factor) * F.col(f"s_{b}")), F.lit(False))
    return out


def screened(clear: DataFrame, p, keys) -> DataFrame:
    """Clear rows without those that local robust fits rule out."""
    return residuals(clear, p, keys).where(~cloudy(p)).select(*clear.columns)


def marked(rows: DataFrame, p, keys, clear: str, dealt: bool = False) -> DataFrame:
    """All rows, those that local robust fits rule out no longer ``clear``."""
    out = residuals(rows, p, keys, clear, dealt)
    return out.select(*[(F.col(c) & ~cloudy(p)).alias(c) if c == clear else F.col(c) for c in rows.columns])
