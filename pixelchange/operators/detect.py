"""Change detection as table work.

Input is long: one row per (pixel, day) with band values and a quality
value.  The detector runs in *rounds over segment number*, never over
pixels: round r fits the next segment of every still-active pixel at once.

Round r, for all active pixels together:

0. (``screen``, once) D9 local robust fits take out cloud that QA missed,
   (``stable``) the round starts at the first stable window of a pixel,
1. D10 fit each band on the initial window: the first ``min_obs`` clear
   observations, extended to span ``min_years`` (a grouped aggregate of
   sums of products, solved by Cholesky; ``orders`` and ``alpha``: 4, 6 or 8
   terms by the number of observations, Lasso),
2. D11 score every later observation: sum over detection bands of
   (residual / rmse)^2, rmse floored by the pixel's variogram,
3. D12 a break starts at the first observation from which ``peek``
   consecutive scores exceed the threshold (a forward ``rows between``
   window), isolated exceedances are outliers,
4. D13 the segment is everything before the break; it is refitted on its
   inliers (coefficients, rmse), and
5. D14 the magnitude of each band is the median residual of the peek
   window after the break,
6. observations from the break on form round r+1's input.

The observations are hash partitioned by pixel once; every aggregate,
window and join of a round groups by the pixel key, so rounds add no
shuffle.  Each round's scored table is checkpointed to the shared
checkpoint folder, which cuts lineage and lets lost executors recompute
only the current round.  The number of rounds is the largest number of
segments of any pixel (a segment consumes at least ``min_obs + 1``
observations); it is never capped.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..config import (BAND_PREFIX, BAND_SERIES, BANDS, CHI2_99_5, DAYS_PER_YEAR, DETECTION_BANDS, FILL,
                      MIN_OBSERVATIONS, PEEK_SIZE, SENTINEL_DAY)
from ..functions.dates import ordinal_to_iso
from ..session import checkpoint_dir, scratch_path
from . import fit as fitmod
from . import screen, start

PIXEL = ["cx", "cy", "px", "py"]
# Inside the rounds a pixel is one bigint key (grouping and hashing one
# long instead of four ints); cx, cy, px, py travel along as payload.
PID = ["pid"]
# Observations that come in strips of a chip stay in their strip's partition.
STRIP = ["sid", "pid"]
# Bytes of an observation row inside the rounds, and how much larger rows
# are there than in the (compressed) files that a size estimate is of.
ROW_BYTES = 100
EXPANSION = 6


def pixel_id():
    """px in the high 32 bits, py in the low 32 bits (two's complement)."""
    return (F.shiftleft(F.col("px").cast("long"), 32)
            .bitwiseOR(F.col("py").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))).alias("pid")


def _payload(keys):
    return [c for c in PIXEL if c not in keys]

# Curve quality of a segment before the first stable window.
CURVE_START = 14
# Landsat pixel QA bits: 0 fill, 3 cloud shadow, 5 cloud.
QA_FILL_BIT = 1
QA_CLOUD_BITS = 8 | 32


@dataclass
class DetectParams:
    bands: list = field(default_factory=lambda: [BAND_SERIES[b] for b in BANDS])
    detection_bands: list = field(default_factory=lambda: [BAND_SERIES[b] for b in DETECTION_BANDS])
    qa: str | None = "qas"
    threshold: float = CHI2_99_5
    peek: int = PEEK_SIZE
    min_obs: int = MIN_OBSERVATIONS
    terms: int = 4
    ridge: float = fitmod.RIDGE
    variogram_floor: bool = True
    min_years: float = 1.0
    refine: int = 1
    fill: int = FILL
    # model order by number of observations (``terms`` is the most), Lasso weight
    orders: tuple | None = None
    alpha: float | None = None
    # first stable window, found among all windows of a round, with look-back
    stable: bool = False
    stable_sigma: float = 3.0
    # robust screening: band and side (1 too bright, -1 too dark) of what is taken out
    screen: tuple = ()
    screen_rows: int = 16
    screen_rounds: int = 3
    screen_factor: float = 4.89
    partitions: int | None = None
    partition_bytes: int = 128 * 1024 * 1024


# ---------------------------------------------------------------------------
# D9
# ---------------------------------------------------------------------------

def clear_flag(p: DetectParams):
    """An observation is clear if no band is fill and QA has no
    fill/cloud/shadow bit."""
    ok = F.lit(True)
    for b in p.bands:
        ok = ok & F.col(b).isNotNull() & (F.col(b) != F.lit(p.fill))
    if p.qa:
        ok = ok & ((F.col(p.qa).bitwiseAND(QA_FILL_BIT | QA_CLOUD_BITS)) == 0)
    return ok


def clear_observations(obs: DataFrame, p: DetectParams) -> DataFrame:
    return obs.where(clear_flag(p))


def complete_params(**given) -> DetectParams:
    """The detector with all parts: screening of bright green and dark short wave
    infrared, stable start with look-back, 4, 6 or 8 terms."""
    return DetectParams(**{**dict(terms=8, orders=(4, 6, 8), stable=True, screen=(("greens", 1), ("swir1s", -1))), **given})


# ---------------------------------------------------------------------------
# One round
# ---------------------------------------------------------------------------

def _solve(sums: DataFrame, keys, p: DetectParams, carry, bands=None) -> DataFrame:
    return fitmod.solve(sums, keys, bands or p.bands, p.terms, p.ridge, carry=carry, orders=p.orders, alpha=p.alpha)


def _score(active: DataFrame, p: DetectParams, keys=PIXEL) -> DataFrame:
    """Steps 1-3 for every active pixel.

    One aggregate per pixel gives the model of the initial window (all
    rows of the first ``min_years``, at least ``min_obs``) by conditional
    sums, the row count and the reach of the series; the model is joined
    back (same partitioning, no shuffle) to score every row.  Breaks are
    found as islands of consecutive flagged rows: only flagged rows (few)
    are numbered, runs are grouped by ``n - row_number``, and the first
    run of at least ``peek`` rows starts the break.  Returns the active
    rows with flag, init_n, last_n, brk_n/brk_t (null: no break) and the
    length of a trailing run of flags.
    """
    span = F.lit(p.min_years * DAYS_PER_YEAR)
    if p.stable:
        # a row per pixel; the frames of all windows stay out of the round's plan
        active = start.from_window(active, materialise(start.first_windows(active, p, keys)), keys)
    xs = fitmod.with_regressors(active, p.terms)
    in_init = (F.col("n") >= 1) & ((F.col("n") <= p.min_obs) | ((F.col("t") - F.col("t0")) < span))
    sums = xs.groupBy(*keys).agg(
        F.count(F.when(in_init, 1)).alias("n"),
        F.max("n").alias("last_n"),
        (F.max("t") - F.min("t0")).alias("_reach"),
        *fitmod.sum_aggs(p.terms, p.detection_bands, where=in_init))
    sums = sums.where((F.col("n") >= p.min_obs) & (F.col("_reach") >= span))
    # only the bands that are scored; a segment's other models come from its summary
    model = _solve(sums, keys, p, ("n", "last_n"), p.detection_bands).withColumnRenamed("n", "init_n").drop("order")
    scored = xs.join(model.hint("shuffle_hash"), keys, "inner")
    # the flagged rows are checkpointed once: the break search and the
    # rows it is joined back to then read it, instead of fitting twice
    return _breaks(materialise(_flag(scored, p)), p, keys)


def _flag(scored: DataFrame, p: DetectParams) -> DataFrame:
    """z = sum over detection bands of (residual / rmse)^2 (rmse floored
    by the variogram); flag = beyond the initial window and z > threshold."""
    z = F.lit(0.0)
    for b in p.detection_bands:
        rm = F.col(f"rmse_{b}")
        if p.variogram_floor:
            rm = F.greatest(rm, F.col(f"vario_{b}"))
        r = fitmod.residual_cols(b, p.terms)
        z = z + F.when(rm > 0, (r / rm) * (r / rm)).otherwise(F.lit(0.0))
    # only what later steps read: the model itself stays out of the rows
    keep = [c for c in scored.columns if not c.startswith(("_x", "b_", "rmse_"))]
    scored_rows = (F.col("n") > F.col("init_n")) | (F.col("n") < 1)
    return scored.select(*keep, (scored_rows & (z > p.threshold)).cast("int").alias("flag"))


def _refine(scored: DataFrame, p: DetectParams, keys=PIXEL) -> DataFrame:
    """Refit each band on the inliers before the current break (all rows
    when none), re-score and find the break again: a model of the whole
    stable stretch drifts less than one of the first year."""
    before = (F.col("brk_n").isNull() | (F.col("n") < F.col("brk_n"))) & (F.col("flag") == 0)
    base = scored.select("*", before.alias("_before")).drop("flag", "brk_n", "brk_t", "trailing", "back_n")
    xs = fitmod.with_regressors(base, p.terms)
    use = F.col("_before")
    sums = xs.groupBy(*keys).agg(F.count(F.when(use, 1)).alias("n"),
                                 *fitmod.sum_aggs(p.terms, p.detection_bands, where=use))
    model = _solve(sums, keys, p, ("n",), p.detection_bands).drop("n", "order")
    xs2 = xs.drop("_before").join(model.hint("shuffle_hash"), keys, "inner")
    return _breaks(materialise(_flag(xs2, p)), p, keys)


def _breaks(scored: DataFrame, p: DetectParams, keys=PIXEL) -> DataFrame:
    """brk_n / brk_t of the first run of ``peek`` consecutive flags and
    the length of a run of flags that reaches the last row; ``back_n``: the
    last row of such a run before the stable start."""
    flagged = scored.where(F.col("flag") == 1).select(*keys, "n", "t")
    w = Window.partitionBy(*keys).orderBy("n")
    runs = (flagged.select(*keys, "n", "t", (F.col("n") - F.row_number().over(w)).alias("_g"))
                   .groupBy(*keys, "_g")
                   .agg(F.min("n").alias("start"), F.count(F.lit(1)).alias("len"),
                        F.min_by("t", "n").alias("t_start")))
    brk = (runs.groupBy(*keys)
               .agg(F.min(F.when((F.col("len") >= p.peek) & (F.col("start") >= 1), F.struct("start", "t_start"))).alias("_b"),
                    F.max(F.when((F.col("len") >= p.peek) & (F.col("start") < 1), F.col("start") + F.col("len") - 1)).alias("back_n"),
                    F.max(F.struct("start", "len")).alias("_l"))
               .select(*keys, "back_n", F.col("_b.start").alias("brk_n"), F.col("_b.t_start").alias("brk_t"),
                       (F.col("_l.start") + F.col("_l.len") - 1).alias("_last_end"),
                       F.col("_l.len").alias("_last_len")))
    # one narrow row per pixel with a flag; every reader joins it anew
    scored = scored.join(materialise(brk).hint("shuffle_hash"), keys, "left")
    trailing = F.when(F.col("_last_end") == F.col("last_n"), F.col("_last_len")).otherwise(F.lit(0))
    return scored.select("*", trailing.alias("trailing")).drop("_last_end", "_last_len")


def _summarise(scored: DataFrame, p: DetectParams, keys=PIXEL) -> DataFrame:
    """Steps 4-5: one row per pixel segment, long per band columns.

    The refit of the segment's inliers and the segment's days come from
    one conditional aggregate; the median residuals of the peek window
    are computed for break pixels only."""
    in_seg = F.col("brk_n").isNull() | (F.col("n") < F.col("brk_n"))
    inl = in_seg & (F.col("flag") == 0)
    xs = fitmod.with_regressors(scored, p.terms)
    sums = xs.groupBy(*keys).agg(
        F.count(F.when(inl, 1)).alias("n"),
        F.min("t").alias("sday_n"),
        F.max(F.when(in_seg, F.col("t"))).alias("eday_n"),
        F.max("brk_n").alias("brk_n"),
        F.max("brk_t").alias("brk_t"),
        F.max("trailing").alias("trailing"),
        F.max("t0").alias("t0"),
        *[F.first(c).alias(c) for c in _payload(keys)],
        *fitmod.sum_aggs(p.terms, p.bands, where=inl))
    refit = _solve(sums, keys, p, ("n", "sday_n", "eday_n", "brk_n", "brk_t", "trailing", "t0", *_payload(keys)))
    peek_rows = scored.where(F.col("brk_n").isNotNull() & (F.col("n") >= F.col("brk_n"))
                             & (F.col("n") < F.col("brk_n") + p.peek))
    out = refit.join(_magnitudes(peek_rows, refit, p, keys).hint("shuffle_hash"), keys, "left")
    broke = F.col("brk_n").isNotNull()
    out = (out.withColumn("bday_n", F.coalesce(F.col("brk_t"), F.col("eday_n")))
              .withColumn("chprob", F.when(broke, F.lit(1.0))
                          .otherwise(F.least(F.col("trailing"), F.lit(p.peek)) / F.lit(float(p.peek))))
              .withColumn("curqa", F.col("order") if p.orders else F.lit(p.terms)))
    for b in p.bands:
        out = out.withColumn(f"mag_{b}", F.when(broke, F.col(f"mag_{b}")).otherwise(F.lit(0.0)))
    return _from_first_day(out, p)


def _magnitudes(rows: DataFrame, model: DataFrame, p: DetectParams, keys) -> DataFrame:
    """Median residual of each band over some rows of each pixel."""
    b = model.select(*keys, *[f"b_{b}_{i}" for b in p.bands for i in range(p.terms)])
    near = rows.select(*keys, "t", "t0", *p.bands).join(b.hint("shuffle_hash"), keys)
    resid = fitmod.with_regressors(near, p.terms).select(
        *keys, *[fitmod.residual_cols(b, p.terms).alias(f"r_{b}") for b in p.bands])
    return resid.groupBy(*keys).agg(*[F.median(f"r_{b}").alias(f"mag_{b}") for b in p.bands])


def _from_first_day(seg: DataFrame, p: DetectParams) -> DataFrame:
    """Intercepts at the segment's first day: look-back may put it before the day
    that the trend counts from."""
    if p.stable:
        for b in p.bands:
            moved = F.col(f"b_{b}_0") + F.col(f"b_{b}_1") * (F.col("sday_n") - F.col("t0")) / F.lit(DAYS_PER_YEAR)
            seg = seg.withColumn(f"b_{b}_0", moved)
    return seg.drop("t0", "order")


def _start_segments(scored: DataFrame, p: DetectParams, keys) -> DataFrame:
    """Segments of what lies before the look-back's end, for pixels whose first stable
    window comes after a change: they end there, and the change is the next row."""
    early = F.col("n") <= F.col("back_n")
    xs = fitmod.with_regressors(scored.where(F.col("back_n").isNotNull()), p.terms)
    sums = xs.groupBy(*keys).agg(
        F.count(F.when(early, 1)).alias("n"), F.min("t").alias("sday_n"), F.max(F.when(early, F.col("t"))).alias("eday_n"),
        F.lit(None).cast("int").alias("brk_n"), F.min(F.when(~early, F.col("t"))).alias("brk_t"), F.lit(0).cast("bigint").alias("trailing"),
        F.max("t0").alias("t0"), *[F.first(c).alias(c) for c in _payload(keys)], *fitmod.sum_aggs(p.terms, p.bands, where=early))
    fitted = _solve(sums, keys, p, ("n", "sday_n", "eday_n", "brk_n", "brk_t", "trailing", "t0", *_payload(keys)))
    after = scored.where((F.col("n") > F.col("back_n")) & (F.col("n") <= F.col("back_n") + p.peek))
    out = fitted.join(_magnitudes(after, fitted, p, keys).hint("shuffle_hash"), keys)
    return _from_first_day(out.withColumn("bday_n", F.col("brk_t")).withColumn("chprob", F.lit(1.0))
                           .withColumn("curqa", F.lit(CURVE_START)), p)


def _next_active(scored: DataFrame, p: DetectParams, keys=PIXEL) -> DataFrame:
    """Rows from the break on, renumbered; the break day starts the next
    segment (no window: brk_n and brk_t are on every row)."""
    rest = scored.where(F.col("brk_n").isNotNull() & (F.col("n") >= F.col("brk_n")))
    cols = [*keys, *_payload(keys), "t", *p.bands] + \
        ([f"vario_{b}" for b in p.detection_bands] if p.variogram_floor else [])
    return rest.select(*cols, (F.col("n") - F.col("brk_n") + 1).alias("n"), F.col("brk_t").alias("t0"))


def _used(scored: DataFrame, keys=PIXEL) -> DataFrame:
    in_seg = F.col("brk_n").isNull() | (F.col("n") < F.col("brk_n"))
    return scored.where(in_seg & (F.col("flag") == 0)).select(*keys, *_payload(keys), "t")


# ---------------------------------------------------------------------------
# Driver of rounds
# ---------------------------------------------------------------------------

def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint that keeps the pixel hash partitioning.

    An adaptive plan reports unknown output partitioning, so a checkpoint
    taken under AQE would make the next round shuffle by pixel again.  A
    round has no shuffle for AQE to re-plan, so its checkpoint is planned
    with AQE off (restored at once); later reads see the partitioning.
    """
    conf = df.sparkSession.conf
    with _PLANNING:
        old = {k: conf.get(k, "true") for k in _PLANNED_WITHOUT}
        for k in old:
            conf.set(k, "false")
        try:
            return df.checkpoint(eager=True)
        finally:
            for k, v in old.items():
                conf.set(k, v)


# The switch above holds for a whole session; detectors that run in other
# threads of the driver wait for their turn.
_PLANNING = threading.RLock()
# The second lets joins by (strip, pixel) use a partitioning by strip.
_PLANNED_WITHOUT = ("spark.sql.adaptive.enabled", "spark.sql.requireAllClusterKeysForCoPartition")


def _partitions(spark, p: DetectParams, df: DataFrame) -> int:
    """Pixel partitions: ``p.partitions`` if given, else rows over
    ``p.partition_bytes`` (rounds run with AQE off, so the count must fit
    the data), never fewer than the default parallelism.

    Rows are taken from the plan's size estimate; without one (rasters
    joined with a generated registry have none) they are counted."""
    if p.partitions:
        return p.partitions
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    size = df.count() * ROW_BYTES if size >= UNKNOWN_BYTES else size * EXPANSION
    return int(max(spark.sparkContext.defaultParallelism, -(-size // p.partition_bytes)))


# Estimates from here on are products of the planner's "unknown" size.
UNKNOWN_BYTES = 2 ** 60


def partition_observations(obs: DataFrame, p: DetectParams, keys=PID) -> DataFrame:
    """Every input row (pixel, day, bands, flag: clear and not screened out), hash
    partitioned by pixel and checkpointed once: the rounds, the sentinel pixels and the
    masks all read it without shuffling or recomputing the input.  Rows with a
    strip (keys ``STRIP``) are where they belong."""
    if "pid" in keys and "pid" not in obs.columns:
        obs = obs.select("*", pixel_id())
    columns = [*keys, *_payload(keys), "t", *p.bands, clear_flag(p).alias("_clear")]
    rows = obs.select(*columns)
    if p.screen:
        rows = screen.marked(rows, p, keys, "_clear", dealt="sid" in keys)
    if "sid" in keys:
        return stored_by_strip(rows, p.partitions)
    return materialise(rows.repartition(_partitions(obs.sparkSession, p, obs), *keys))


def stored_by_strip(obs: DataFrame, buckets: int) -> DataFrame:
    """Observations that are dealt by strip, as a bucketed table in the scratch folder.

    Decoding is Python work, behind which Spark no longer knows how rows are dealt; the
    buckets (each written by the one task that has its strips) tell it again, so the
    rounds read them without an exchange."""
    spark = obs.sparkSession
    path = scratch_path(spark, "strips")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    # stored under other names: a checkpoint forgets a partitioning by columns that are
    # qualified by a table, and only a real renaming takes the qualifier off
    stored = {"sid": "strip_key", "pid": "pixel_key"}
    (obs.select(*[F.col(c).alias(stored.get(c, c)) for c in obs.columns])
        .write.format("parquet").bucketBy(buckets, "strip_key").option("path", path).saveAsTable(name))
    return spark.table(name).select(*[F.col(stored.get(c, c)).alias(c) for c in obs.columns])


def prepare(obs: DataFrame, p: DetectParams, keys=PIXEL, partitioned: bool = False) -> DataFrame:
    """Partition by pixel once, keep clear rows, number them per pixel.

    ``partitioned``: ``obs`` is the output of ``partition_observations``, screened there."""
    if partitioned:
        clear = obs.where(F.col("_clear"))
    else:
        if "pid" in keys and "pid" not in obs.columns:
            obs = obs.select("*", pixel_id())
        parts = _partitions(obs.sparkSession, p, obs)
        if p.screen:
            # behind Python work Spark doesn't know how rows are dealt: dealt once more
            obs = screen.screened(clear_observations(obs, p).select(*keys, *_payload(keys), "t", *p.bands), p, keys)
            clear = obs.repartition(parts, *keys)
        else:
            clear = clear_observations(obs.repartition(parts, *keys), p)
    w = Window.partitionBy(*keys).orderBy("t")
    # one window operator: row number, first day and lag differences
    diffs = [F.abs(F.col(b) - F.lag(b).over(w)).alias(f"_d_{b}") for b in p.detection_bands] if p.variogram_floor else []
    num = clear.select(*keys, *_payload(keys), "t", *p.bands, F.row_number().over(w).alias("n"),
                       F.first("t").over(w).alias("t0"), *diffs)
    if not p.variogram_floor:
        return num
    # the same partitioning and order, so neither a shuffle nor a second sort
    whole = Window.partitionBy(*keys)
    vario = [F.coalesce(F.median(f"_d_{b}").over(whole), F.lit(0.0)).alias(f"vario_{b}") for b in p.detection_bands]
    return num.select("*", *vario).drop(*[f"_d_{b}" for b in p.detection_bands])


def detect_rounds(obs: DataFrame, p: DetectParams | None = None, keys=PIXEL, partitioned: bool = False):
    """All segments of all pixels.

    Returns (segments, used): ``segments`` has one row per pixel segment
    (long per band: b_{band}_{i}, rmse_{band}, mag_{band}; ``seg`` counts
    the pixel's segments from 1, 0 is one before the first stable window), ``used`` one row per (pixel, day) that
    some segment used.  Rounds go on until no pixel is left.
    """
    p = p or DetectParams()
    checkpoint_dir(obs.sparkSession)
    # every branch of a round reads a checkpoint, never a recomputed
    # aggregate: prepared rows, flagged rows of each fit, breaks, summaries
    active = materialise(prepare(obs, p, keys, partitioned))
    segments, used = [], []
    while True:
        scored = _score(active, p, keys)
        if p.stable:
            if not segments:
                starts = materialise(_start_segments(scored, p, keys).withColumn("seg", F.lit(0)))
                used.append(scored.where(F.col("n") <= F.col("back_n")).select(*keys, *_payload(keys), "t"))
            scored = scored.where(F.col("back_n").isNull() | (F.col("n") > F.col("back_n")))
        for _ in range(p.refine):
            scored = _refine(scored, p, keys)
        segments.append(materialise(_summarise(scored, p, keys).withColumn("seg", F.lit(len(segments) + 1))))
        used.append(_used(scored, keys))
        active = _next_active(scored, p, keys)
        if active.where(F.col("n") == p.min_obs).isEmpty():
            break
    seg = segments[0]
    for s in segments[1:] + ([starts] if p.stable else []):
        seg = seg.unionByName(s)
    u = used[0]
    for s in used[1:]:
        u = u.unionByName(s)
    return seg, u


# ---------------------------------------------------------------------------
# Defaults and formatting
# ---------------------------------------------------------------------------

def algorithm() -> str:
    """Name and version of the detector."""
    return "pixelchange-relational-ccd:0.1"


def _f(c):
    return c.cast("float")


def format_segments(seg: DataFrame, p: DetectParams, keys=PIXEL) -> DataFrame:
    """Long per band segment rows -> flat segment columns (ISO days,
    float32 values, coefficient arrays without the intercept)."""
    cols = [*[k for k in keys if k not in PIXEL], *PIXEL,
            ordinal_to_iso("sday_n").alias("sday"),
            ordinal_to_iso("eday_n").alias("eday"),
            ordinal_to_iso("bday_n").alias("bday"),
            _f(F.col("chprob")).alias("chprob"),
            F.col("curqa").cast("int").alias("curqa")]
    # bands not detected on (e.g. a one band run) give null columns
    by_band = {b: BAND_SERIES[b] if BAND_SERIES[b] in p.bands else None for b in BANDS}
    null_f = F.lit(None).cast("float")
    for part, src in (("mag", "mag_{}"), ("rmse", "rmse_{}")):
        cols += [(_f(F.col(src.format(s))) if s else null_f).alias(BAND_PREFIX[b] + part)
                 for b, s in by_band.items()]
    cols += [(F.array(*[_f(F.col(f"b_{s}_{i}")) for i in range(1, p.terms)]) if s
              else F.lit(None).cast("array<float>")).alias(BAND_PREFIX[b] + "coef")
             for b, s in by_band.items()]
    cols += [(_f(F.col(f"b_{s}_0")) if s else null_f).alias(BAND_PREFIX[b] + "int")
             for b, s in by_band.items()]
    return seg.select(*cols)


def default_segments(pixels: DataFrame, segments: DataFrame, template: DataFrame,
                     keys=PIXEL) -> DataFrame:
    """Every pixel without a segment gets one sentinel segment with
    start = end = break = day 1 and every other value null."""
    pay = _payload(keys)
    ids = (pixels.groupBy(*keys).agg(*[F.first(c).alias(c) for c in pay]) if pay
           else pixels.select(*keys).distinct())
    # columns of their own: segments come from the same rows as the pixels
    missing = ids.join(segments.select(*[F.col(k).alias(k) for k in keys]), keys, "left_anti")
    iso = ordinal_to_iso(F.lit(SENTINEL_DAY))
    fill = []
    for f in template.schema.fields:
        if f.name in PIXEL or f.name in keys:
            fill.append(F.col(f.name))
        elif f.name in ("sday", "eday", "bday"):
            fill.append(iso.alias(f.name))
        else:
            fill.append(F.lit(None).cast(f.dataType).alias(f.name))
    return missing.select(*fill)


def processing_mask(obs: DataFrame, used: DataFrame, keys=PIXEL, payload: bool = True) -> DataFrame:
    """Per pixel: all input days ascending as ISO strings, and the 0/1
    mask of those used by a segment (aligned with the dates).  Without ``payload``
    a row has the keys only."""
    k = [*keys, *_payload(keys)] if payload else list(keys)
    rows = obs.select(*k, "t", F.lit(0).alias("m")).unionByName(
        used.select(*k, "t", F.lit(1).alias("m")))
    days = rows.groupBy(*k, "t").agg(F.max("m").alias("m"))
    g = days.groupBy(*k).agg(F.sort_array(F.collect_list(F.struct("t", "m"))).alias("_s"))
    return g.select(*k,
                    F.transform(F.col("_s.t"), lambda o: ordinal_to_iso(o)).alias("dates"),
                    F.transform(F.col("_s.m"), lambda m: m.cast("tinyint")).alias("mask"))


def detect(obs: DataFrame, p: DetectParams | None = None) -> DataFrame:
    """D1-D3 + D4 + D5 + D7: observations -> wide detection result
    (segment columns, dates, mask, rfrawp = null), one row per segment,
    sentinel rows for pixels without a model.  Columns of the detection
    schema (D6), then the algorithm's name (D8)."""
    p = p or DetectParams()
    checkpoint_dir(obs.sparkSession)
    base = partition_observations(obs, p, PID)
    seg, used = detect_rounds(base, p, keys=PID, partitioned=True)
    flat = format_segments(seg, p, PID)
    flat = flat.unionByName(default_segments(base, seg, flat, PID))
    # one narrow row per key: where dates and mask aren't read, Spark leaves the join out
    masks = processing_mask(base, used, PID, payload=False)
    wide = flat.join(masks, PID, "left").withColumn("rfrawp", F.lit(None).cast("array<float>"))
    return wide.select(*schemas.detection_schema().names, F.lit(algorithm()).alias("algorithm"))


def detect_tables(obs: DataFrame, p: DetectParams | None = None, keys=PID):
    """D1 + D4 + D5 straight into the three stored tables (``keys``: ``STRIP`` for
    observations that are dealt by strips).

    Returns (chip, pixel, segment) frames with the table schemas.  Unlike
    ``detect`` no wide per-segment rows are built, so a pixel's dates and
    mask arrays are never copied onto each of its segments: segments come
    from the round summaries, masks from the pixel-partitioned input and
    the used days, chip dates from a partial ``collect_set`` of the input.
    """
    p = p or DetectParams()
    checkpoint_dir(obs.sparkSession)
    base = partition_observations(obs, p, keys)
    seg, used = detect_rounds(base, p, keys=keys, partitioned=True)
    flat = format_segments(seg, p, keys)
    flat = flat.unionByName(default_segments(base, seg, flat, keys)) \
               .withColumn("rfrawp", F.lit(None).cast("array<float>"))
    segment = flat.select(*schemas.segment_schema().names)
    pixel = processing_mask(base, used, keys).select(*schemas.pixel_schema().names)
    days = base.groupBy("cx", "cy").agg(F.array_sort(F.collect_set("t")).alias("_d"))
    chip = days.select("cx", "cy", F.transform("_d", lambda o: ordinal_to_iso(o)).alias("dates"))
    return chip, pixel, segment


def observations_from_series(ard: DataFrame, bands=None, qa="qas") -> DataFrame:
    """ARD series rows (parallel arrays) -> long observations, the input
    of ``detect``; ``arrays_zip`` + ``explode`` in one projection."""
    bands = bands or [BAND_SERIES[b] for b in BANDS]
    cols = ["dates", *bands] + ([qa] if qa else [])
    z = F.explode(F.arrays_zip(*[F.col(c) for c in cols])).alias("o")
    e = ard.select(*PIXEL, z)
    return e.select(*PIXEL, F.col("o.dates").alias("t"), *[F.col(f"o.{c}").alias(c) for c in cols[1:]])
