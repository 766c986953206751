"""Least squares fits of many small series at once, as aggregates.

Per group (pixel, segment) the model of each band is

    y = b0 + b1 * (t - t0) / 365.25 + b2 * cos(w t) + b3 * sin(w t),  w = 2 pi / 365.25

(``terms=2`` keeps the trend only; 6 and 8 add the second and third harmonic).
``orders`` lets the number of terms follow the number of observations, and
``alpha`` gives the Lasso instead of the ridge solution, by cyclic coordinate
descent on the same sums.  The regressors are shared by all
bands, so one ``groupBy().agg()`` collects the sums of products X'X
(terms*(terms+1)/2 sums), X'y and y'y per band; Catalyst runs it as a
partial aggregate, so no series is ever gathered in one place.  The
normal equations (with a small ridge on the non-intercept terms) are then
solved by an unrolled Cholesky factorisation written as SQL expressions,
which keeps the solve inside whole-stage codegen.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..config import DAYS_PER_YEAR

OMEGA = 2.0 * math.pi / DAYS_PER_YEAR
RIDGE = 1e-3
# Observations for each term of a model whose order follows their number.
PER_TERM = 3
# Sweeps of the coordinate descent, from the ridge solution.
SWEEPS = 30


def dbl(x: float) -> str:
    """A DOUBLE literal in SQL text (a plain '1.5' is DECIMAL in Spark SQL)."""
    return f"{float(x):.17e}"


def regressor_sql(i: int, t: str = "t", t0: str = "t0") -> str:
    """SQL text of regressor i for day column t and reference day t0."""
    if i == 0:
        return dbl(1.0)
    if i == 1:
        return f"(({t}) - ({t0})) / {dbl(DAYS_PER_YEAR)}"
    if i > 7:
        raise ValueError(i)
    return f"{'cos' if i % 2 == 0 else 'sin'}({dbl(OMEGA * (i // 2))} * ({t}))"


def orders_of(n: np.ndarray, orders) -> np.ndarray:
    """Terms of models of ``n`` observations: the most of ``orders`` that have
    ``PER_TERM`` observations each, else the fewest."""
    out = np.full(len(n), min(orders))
    for k in sorted(orders):
        out[n >= PER_TERM * k] = k
    return out


def descend(gram: np.ndarray, xy: np.ndarray, b: np.ndarray, weight: np.ndarray, sweeps: int) -> np.ndarray:
    """Cyclic coordinate descent for the Lasso on the sums of many series at once.

    gram (m, k, k), xy and b (m, bands, k), weight (m): n * alpha.  Minimises
    |y - Xb|^2 / 2 + weight * sum |b_i| over the terms but the intercept."""
    b = b.copy()
    rest = xy - np.einsum("mjk,mbk->mbj", gram, b)        # X'(y - Xb)
    for _ in range(sweeps):
        for j in range(b.shape[2]):
            own = gram[:, j, j][:, None]
            rho = rest[:, :, j] + own * b[:, :, j]
            new = rho if j == 0 else np.sign(rho) * np.maximum(np.abs(rho) - weight[:, None], 0.0)
            step = new / own - b[:, :, j]
            rest -= step[:, :, None] * gram[:, None, j, :]
            b[:, :, j] += step
    return b


def batch_solver(bands: int, terms: int, ridge: float, orders, alpha: float | None, sweeps: int):
    """(sums of a row as one array, n) -> coefficients and errors of all bands.

    For models whose order differs from row to row, and for the Lasso: a batch of rows
    goes through numpy together.  Up to 155 steps of SQL a row took the planner longer
    than the work, and the descent as array expressions thirty times as long.  Terms from
    a row's order on get a row and column of the unit matrix, so they come out as 0."""
    pairs = [(i, j) for i in range(terms) for j in range(i + 1)]

    @F.arrow_udf(ArrayType(DoubleType()))
    def solve_batch(sums: pa.Array, count: pa.Array) -> pa.Array:
        m = len(sums)
        flat = sums.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(m, -1)
        n = count.to_numpy(zero_copy_only=False)
        gram = np.empty((m, terms, terms))
        for c, (i, j) in enumerate(pairs):
            gram[:, i, j] = gram[:, j, i] = flat[:, c]
        xy = flat[:, len(pairs):len(pairs) + bands * terms].reshape(m, bands, terms)
        yy = flat[:, len(pairs) + bands * terms:]
        used = orders_of(n, orders) if orders else np.full(m, terms)
        rest = np.arange(terms)[None, :] >= used[:, None]
        gram = np.where(rest[:, :, None] | rest[:, None, :], np.eye(terms), gram)
        xy = np.where(rest[:, None, :], 0.0, xy)
        b = np.linalg.solve(gram + ridge * np.diag([0.0] + [1.0] * (terms - 1)), xy.transpose(0, 2, 1)).transpose(0, 2, 1)
        if alpha is not None:
            b = descend(gram, xy, b, n * alpha, sweeps)
        rss = yy - 2 * (b * xy).sum(axis=2) + np.einsum("mbj,mjk,mbk->mb", b, gram, b)
        error = np.sqrt(np.maximum(rss, 0.0) / np.maximum(n - used, 1)[:, None])
        out = np.concatenate([b.reshape(m, -1), error], axis=1)
        return pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * out.shape[1]), pa.array(out.reshape(-1), from_pandas=True))

    return solve_batch


def cholesky_sql(terms: int, ridge: float = RIDGE) -> list[tuple[str, str]]:
    """(alias, SQL) for the factor L of X'X + ridge*I' (lower triangle)."""
    a = lambda i, j: f"xx_{max(i, j)}{min(i, j)}" + (f" + {dbl(ridge)}" if i == j and i > 0 else "")
    out = []
    for i in range(terms):
        for j in range(i + 1):
            s = " - ".join([f"({a(i, j)})"] + [f"l_{i}{k} * l_{j}{k}" for k in range(j)])
            if i == j:
                out.append((f"l_{i}{i}", f"sqrt(greatest({s}, {dbl(1e-12)}))"))
            else:
                out.append((f"l_{i}{j}", f"({s}) / l_{j}{j}"))
    return out


def solve_sql(terms: int, band: str) -> list[tuple[str, str]]:
    """(alias, SQL) of z (forward) then beta (backward) for one band."""
    out = []
    for i in range(terms):
        s = " - ".join([f"xy_{band}_{i}"] + [f"l_{i}{k} * z_{band}_{k}" for k in range(i)])
        out.append((f"z_{band}_{i}", f"({s}) / l_{i}{i}"))
    for i in reversed(range(terms)):
        s = " - ".join([f"z_{band}_{i}"] + [f"l_{k}{i} * b_{band}_{k}" for k in range(i + 1, terms)])
        out.append((f"b_{band}_{i}", f"({s}) / l_{i}{i}"))
    return out


def rss_sql(terms: int, band: str) -> str:
    """Residual sum of squares y'y - 2 b'X'y + b'X'X b (exact for any b)."""
    lin = " + ".join(f"b_{band}_{i} * xy_{band}_{i}" for i in range(terms))
    quad = " + ".join(
        (f"b_{band}_{i} * b_{band}_{j} * xx_{i}{j}" if i == j else f"2 * b_{band}_{i} * b_{band}_{j} * xx_{i}{j}")
        for i in range(terms) for j in range(i + 1))
    return f"greatest(yy_{band} - 2 * ({lin}) + ({quad}), {dbl(0.0)})"


def solution_steps(terms: int, bands, ridge: float = RIDGE, n: str = "n") -> list[tuple[str, str]]:
    """Every derived column after the sums, in dependency order; ends with
    b_{band}_{i} and rmse_{band} = sqrt(rss / max(n - terms, 1))."""
    steps = cholesky_sql(terms, ridge)
    for b in bands:
        steps += solve_sql(terms, b)
        steps.append((f"rmse_{b}", f"sqrt(({rss_sql(terms, b)}) / greatest({n} - {terms}, 1))"))
    return steps


def fit(df: DataFrame, keys, bands, terms: int = 4, t: str = "t",
        ridge: float = RIDGE, t0: str | None = None, orders=None, alpha: float | None = None) -> DataFrame:
    """One row per group with n, t0, b_{band}_{i}, rmse_{band} (and with
    ``orders`` the number of terms used, ``order``).

    ``t0`` names a column constant per group holding the reference day;
    without it the group's first day is used (a second pass is then
    needed, so pass it whenever the caller knows it).
    """
    if t0 is None:
        first = df.groupBy(*keys).agg(F.min(t).alias("t0"))
        df = df.join(first, keys)
        t0 = "t0"
    # regressors once per row, then plain products inside the aggregate
    xs = with_regressors(df.select(*keys, t, F.col(t0).alias("_t0"),
                                   *[F.col(b).cast("double").alias(b) for b in bands]),
                         terms, t, "_t0")
    aggs = [F.count(F.lit(1)).alias("n"), F.first("_t0").alias("t0")] + sum_aggs(terms, bands)
    sums = xs.groupBy(*keys).agg(*aggs)
    return solve(sums, keys, bands, terms, ridge, orders=orders, alpha=alpha)


def sum_names(terms: int, bands) -> list[str]:
    """Names of the sums, in the order of ``sum_aggs``."""
    return [f"xx_{i}{j}" for i in range(terms) for j in range(i + 1)] + [
        x for b in bands for x in (*[f"xy_{b}_{i}" for i in range(terms)], f"yy_{b}")]


def sum_aggs(terms: int, bands, where=None, named: bool = True):
    """Aggregates X'X, X'y, y'y over rows carrying _x columns; with
    ``where`` only rows meeting it count (conditional sums let one pass
    fit one subset while computing other per group statistics)."""
    x = [None] + [F.col(f"_x{i}") for i in range(1, terms)]
    keep = (lambda c: F.when(where, c)) if where is not None else (lambda c: c)
    products = []
    for i in range(terms):
        for j in range(i + 1):
            products.append(F.lit(1.0) if i == j == 0 else (x[i] if j == 0 else x[i] * x[j]))
    for b in bands:
        y = F.col(b).cast("double")
        products += [*[y if i == 0 else x[i] * y for i in range(terms)], y * y]
    sums = [F.sum(keep(c)) for c in products]
    return [s.alias(n) for s, n in zip(sums, sum_names(terms, bands))] if named else sums


def with_regressors(df: DataFrame, terms: int, t: str = "t", t0: str = "t0") -> DataFrame:
    """Add _x1.._x{terms-1} (the non-constant regressors) as columns."""
    return df.select("*", *[F.expr(regressor_sql(i, t, t0)).alias(f"_x{i}") for i in range(1, terms)])


def residual_cols(band: str, terms: int = 4):
    """D11 on rows carrying _x columns and the joined b_{band}_i."""
    fit_ = F.col(f"b_{band}_0")
    for i in range(1, terms):
        fit_ = fit_ + F.col(f"b_{band}_{i}") * F.col(f"_x{i}")
    return F.col(band) - fit_


def solve(sums: DataFrame, keys, bands, terms: int = 4, ridge: float = RIDGE, carry=("n", "t0"),
          orders=None, alpha: float | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """One projection; later steps refer to earlier ones by lateral alias,
    so the plan is analysed once and each value is computed once.
    ``carry`` names the other columns of ``sums`` to keep.  With ``orders`` the number
    of terms follows ``n`` (column ``order`` of the result), with ``alpha`` the ridge
    solution starts the Lasso's descent; ``batch_solver`` does both."""
    carry = list(carry)
    coefs, errors = [f"b_{b}_{i}" for b in bands for i in range(terms)], [f"rmse_{b}" for b in bands]
    if not orders and alpha is None:
        steps = [f"{sql} AS {alias}" for alias, sql in solution_steps(terms, bands, ridge)]
        return sums.selectExpr(*keys, *carry, *steps).select(*keys, *carry, *coefs, *errors)
    known = [f"xx_{i}{j}" for i in range(terms) for j in range(i + 1)] + [f"xy_{b}_{i}" for b in bands for i in range(terms)]
    packed = F.array(*[F.col(c).cast("double") for c in known + [f"yy_{b}" for b in bands]])
    own = batch_solver(len(bands), terms, ridge, tuple(orders) if orders else None, alpha, sweeps)
    order = F.lit(min(orders or [terms]))
    for k in sorted(orders or []):
        order = F.when(F.col("n") >= PER_TERM * k, k).otherwise(order)
    found = sums.select(*keys, *carry, own(packed, F.col("n")).alias("_b"), *[order.alias("order")] * bool(orders))
    return found.select(*keys, *carry, *["order"] * bool(orders), *[F.col("_b")[i].alias(c) for i, c in enumerate(coefs + errors)])
