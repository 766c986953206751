"""The query catalogue: every operator run on the driver's tables.

Each entry takes (spark, sf_dir) and returns a DataFrame; ``oracle.py``
holds the equivalent DuckDB SQL under the same key and column names.
Integral outputs are BIGINT and real outputs DOUBLE rounded in both, so
the engines' results compare value by value.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType)

from ..config import BAND_PREFIX, CHIP_SHAPE, PIXEL_TABLE, TILE_GRID
from ..functions import grid
from ..functions.dates import date_to_ordinal, ordinal_to_date, ordinal_to_iso
from ..functions.names import namespace_column, namespace_name
from ..operators import detect as D
from ..operators import features as FT
from ..operators import fit as fitmod
from ..operators import screen, start
from ..operators import forest as RF
from ..operators import segments as SG
from ..operators import series as SR
from ..session import checkpoint_dir, scratch_path, settings
from ..sources import namespaces, rasters, standins
from ..sources import tables as T
from . import jobs

# Query parameters (shared with oracle.py).
ACQUIRED = "1996-01-01/1997-12-31"
MSDAY = 728445          # 1995-06-01
MEDAY = 730666          # 2001-06-30
CHUNK = 1000
TAKE = 2500
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# Cells of a whole chip's raster.
CELLS = CHIP_SHAPE[0] * CHIP_SHAPE[1]

# One band, trend only, 3 consecutive |residual| > 2 rmse after 12
# observations: many pixels get several segments (q14, q15, q19, q28).
TREND = D.DetectParams(bands=["greens"], detection_bands=["greens"], qa=None, threshold=4.0,
                       peek=3, min_obs=12, terms=2, variogram_floor=False, min_years=0.0, refine=0)


# Errors within which a window is stable (q44, q45): strict, as the lines have no seasons.
STRICT = 0.6
# All parts of the detector on three bands: chi-square 0.99 of 3 degrees of freedom.
COMPLETE = D.complete_params(bands=["greens", "nirs", "swir1s"], detection_bands=["greens", "nirs", "swir1s"], threshold=11.345, stable_sigma=STRICT)
# Weight of the Lasso's penalty, per observation (q43).
LASSO = 50.0


def _norm(df: DataFrame) -> DataFrame:
    """Integral columns -> BIGINT, FLOAT -> DOUBLE (the oracle's types)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            c = c.cast(LongType())
        elif isinstance(f.dataType, FloatType):
            c = c.cast(DoubleType())
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _obs(spark, sf):
    return standins.observations(spark, sf)


def _points(spark, sf):
    return standins.points(spark, sf)


# ---------------------------------------------------------------------------
# Grid
# ---------------------------------------------------------------------------

def q01_snap_tile(spark: SparkSession, sf: str) -> DataFrame:
    d = grid.snap(_points(spark, sf), "x", "y", "tile", prefix="t")
    return _norm(d.select("c_custkey", "x", "y", F.col("th").alias("h"), F.col("tv").alias("v"),
                          "tx", "ty"))


def q02_snap_chip(spark, sf):
    d = grid.snap(_points(spark, sf), "x", "y", "chip", prefix="c")
    return _norm(d.select("c_custkey", F.col("ch").alias("h"), F.col("cv").alias("v"), "cx", "cy"))


def q03_extents(spark, sf):
    t = grid.tile(_points(spark, sf)).select("tx", "ty", "ulx", "uly", "lrx", "lry").distinct()
    return _norm(t.select("tx", "ty", *[F.col(c).cast("bigint").alias(c) for c in ("ulx", "uly", "lrx", "lry")]))


def q04_tile_chips(spark, sf):
    tiles = grid.tile(_points(spark, sf)).select("tx", "ty", "ulx", "uly").distinct()
    return _norm(grid.chips(tiles).select("tx", "ty", "cx", "cy"))


def q05_near_tiles(spark, sf):
    n = grid.near(_points(spark, sf), "x", "y", "tile")
    return _norm(n.select("c_custkey", "nh", "nv", "nx", "ny"))


def q06_training_chips(spark, sf):
    return _norm(grid.training_chips(_points(spark, sf)))


# ---------------------------------------------------------------------------
# Series
# ---------------------------------------------------------------------------

def q07_acquired_filter(spark, sf):
    # a day outside the range can't be of a row inside it: the filter holds for the lines
    o = standins.observations(spark, sf, acquired=ACQUIRED)
    g = o.groupBy("px", "py").agg(F.count(F.lit(1)).alias("n_acq"), F.min("t").alias("first_t"),
                                  F.max("t").alias("last_t"))
    return _norm(g)


def q08_ordinal_iso(spark, sf):
    days = _obs(spark, sf).select("t").distinct()
    days = days.unionByName(spark.range(1).select(F.lit(1).alias("t")))
    return _norm(days.select("t", ordinal_to_iso("t").alias("iso")).distinct())


def q09_assemble_series(spark, sf):
    s = SR.ard_from_observations(_obs(spark, sf))
    return _norm(s.select("cx", "cy", "px", "py", F.size("dates").alias("n"),
                          F.array_join(F.transform("dates", lambda d: d.cast("string")), ",").alias("dates"),
                          F.array_join(F.transform("greens", lambda d: d.cast("string")), ",").alias("greens")))


def q10_layer_to_band(spark, sf):
    ev = standins.table(spark, sf, "events")
    long = ev.select("user_id", F.floor(F.unix_date(F.to_date("ts")) / 7).alias("week"),
                     F.col("event_type").alias("band"), "value")
    wide = SR.pivot_bands(long, EVENT_TYPES, keys=["user_id"], date="week")
    return _norm(wide.select("user_id", "week", *[F.round(c, 4).alias(c) for c in EVENT_TYPES]))


# ---------------------------------------------------------------------------
# Fits, scores, breaks, segments
# ---------------------------------------------------------------------------

def q11_trend_fit(spark, sf):
    o = _obs(spark, sf)
    g = o.groupBy("px", "py").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.regr_slope("greens", "t"), 6).alias("slope"),
        F.round(F.regr_intercept("greens", "t"), 2).alias("intercept"))
    return _norm(g)


SCORE_BANDS = ["blues", "greens", "reds", "nirs"]
# Bytes of rows that a task fits and scores: partitions follow the size of the table.
SCORE_BYTES = 32 * 1024 * 1024


def q12_scores(spark, sf):
    o = _obs(spark, sf)
    # dealt by pixel once: the aggregate and the join work inside these partitions
    o = o.repartition(D._partitions(spark, D.DetectParams(partition_bytes=SCORE_BYTES), o), "px", "py")
    # slope, intercept and rmse of a line come from one aggregate: rss = syy - sxy^2 / sxx
    fits = o.groupBy("px", "py").agg(F.count(F.lit(1)).alias("_n"), *[x for b in SCORE_BANDS for x in (
        F.regr_slope(b, "t").alias(f"s_{b}"), F.regr_intercept(b, "t").alias(f"i_{b}"),
        (F.regr_syy(b, "t") - F.when(F.regr_sxx(b, "t") > 0, F.pow(F.regr_sxy(b, "t"), 2) / F.regr_sxx(b, "t"))).alias(f"e_{b}"))])
    z = F.lit(0.0)
    for b in SCORE_BANDS:
        r = F.col(b) - (F.col(f"i_{b}") + F.col(f"s_{b}") * F.col("t"))
        # an exact fit leaves rounding noise, not an error to divide by
        z = z + F.when(F.col(f"e_{b}") > 1e-9, r * r / (F.col(f"e_{b}") / F.col("_n"))).otherwise(0.0)
    out = o.join(fits, ["px", "py"]).select("px", "py", "t", F.round(z, 4).alias("z"))
    return _norm(out)


def q13_harmonic_fit(spark, sf):
    o = _obs(spark, sf)
    f = fitmod.fit(o, ["px", "py"], ["greens"], terms=4)
    return _norm(f.select("px", "py", "n", *[F.round(f"b_greens_{i}", 3).alias(f"b{i}") for i in range(4)],
                          F.round("rmse_greens", 3).alias("rmse")))


def _segments(spark, sf):
    return D.detect_rounds(_obs(spark, sf), TREND, D.PID)[0]


def q14_break_days(spark, sf):
    b = _segments(spark, sf).where(F.col("brk_t").isNotNull())
    return _norm(b.select("px", "py", "seg", F.col("brk_t").alias("bday")))


def q15_segments(spark, sf):
    seg = _segments(spark, sf)
    return _norm(seg.select("px", "py", "seg", ordinal_to_iso("sday_n").alias("sday"),
                            ordinal_to_iso("eday_n").alias("eday"), ordinal_to_iso("bday_n").alias("bday"),
                            F.col("n").alias("nobs"), F.round("chprob", 4).alias("chprob"),
                            F.round("mag_greens", 2).alias("mag"), F.round("rmse_greens", 2).alias("rmse")))


def q16_default_sentinel(spark, sf):
    p = D.DetectParams()
    checkpoint_dir(spark)
    modelled = D._score(D.prepare(_obs(spark, sf), p, D.PID), p, D.PID).select(*D.PIXEL).distinct()
    pixels = standins.table(spark, sf, "part").select(*standins.pixel_keys("p_partkey"))
    tmpl = spark.createDataFrame([], "cx int, cy int, px int, py int, sday string, eday string, bday string")
    return _norm(D.default_segments(pixels, modelled, tmpl))


# ---------------------------------------------------------------------------
# Projections of the wide result
# ---------------------------------------------------------------------------

def q17_project_chip(spark, sf):
    ccd = D.detect(_obs(spark, sf))
    c = SG.project_chip(ccd)
    return _norm(c.select("cx", "cy", F.array_join("dates", ",").alias("dates")))


def q18_project_pixel(spark, sf):
    ccd = D.detect(_obs(spark, sf))
    p = SG.project_pixel(ccd)
    return _norm(p.select("cx", "cy", "px", "py", F.array_join(F.transform("mask", lambda m: m.cast("string")), "").alias("mask")))


def q19_project_segment(spark, sf):
    ccd = D.detect(_obs(spark, sf), TREND)
    s = SG.project_segment(ccd)
    return _norm(s.select("cx", "cy", "px", "py", "sday", "eday", "bday",
                          F.round(F.col("chprob").cast("double"), 4).alias("chprob"), "curqa",
                          F.round(F.col("grrmse").cast("double"), 1).alias("grrmse"),
                          F.round(F.col("grmag").cast("double"), 1).alias("grmag"),
                          F.when(F.col("grcoef").isNotNull(), F.size("grcoef")).alias("ncoef"),
                          F.col("blmag").isNull().alias("bl_null")))


# ---------------------------------------------------------------------------
# Store
# ---------------------------------------------------------------------------

def q20_upsert_latest(spark, sf):
    li = standins.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        date_to_ordinal("l_shipdate").alias("t"))
    out = T.latest_by_key(li, ["l_orderkey", "l_linenumber"],
                          ["t", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return _norm(out)


def _pixel_table(spark, sf, root):
    o = _obs(spark, sf)
    rows = o.groupBy(*D.PIXEL).agg(F.collect_list(F.lit(1).cast("tinyint")).alias("mask"))
    T.upsert_table(rows, root, PIXEL_TABLE)
    return root


def q21_read_by_ids(spark, sf):
    root = _pixel_table(spark, sf, scratch_path(spark, "store"))
    ids = grid.classification_chips(_points(spark, sf))
    r = T.read_pixel(spark, root, ids)
    return _norm(r.select("cx", "cy", "px", "py", F.size("mask").alias("n_mask")))


def q22_filter_labels(spark, sf):
    a = FT.filter_labels(standins.aux_layers(spark, sf))
    return _norm(a.select("px", "py", FT.first_trend().alias("label")))


def _spans(spark, sf):
    """Segments stand-in: the span of a pixel's observations in each year."""
    o = _obs(spark, sf).withColumn("yr", F.year(ordinal_to_date(F.col("t"))))
    g = o.groupBy(*D.PIXEL, "yr").agg(F.min("t").alias("s"), F.max("t").alias("e"))
    return g.select(*D.PIXEL, ordinal_to_iso("s").alias("sday"), ordinal_to_iso("e").alias("eday"))


def q23_filter_period(spark, sf):
    return _norm(SG.filter_period(_spans(spark, sf), MSDAY, MEDAY))


def q24_filter_detected(spark, sf):
    spans = _spans(spark, sf)
    pixels = standins.table(spark, sf, "part").select(*standins.pixel_keys("p_partkey"))
    tmpl = spans.withColumn("bday", F.lit(None).cast("string"))
    sentinel = D.default_segments(pixels, spans, tmpl).select(*D.PIXEL, "sday", "eday")
    return _norm(SG.filter_detected(spans.unionByName(sentinel)))


def q25_distinct_ids(spark, sf):
    a = FT.filter_labels(standins.aux_layers(spark, sf))
    return _norm(a.select("cx", "cy").distinct())


def q26_take_chunk(spark, sf):
    chips = grid.classification_chips(_points(spark, sf))
    return _norm(jobs.chunk_chips(jobs.take_chips(chips, TAKE), CHUNK))


# ---------------------------------------------------------------------------
# Features and classification
# ---------------------------------------------------------------------------

def q27_join_features(spark, sf):
    j = FT.dependent(FT.join_features(standins.aux_layers(spark, sf), _spans(spark, sf)))
    firsts = [F.round(F.get(F.col(c), 0).cast("double"), 4).alias(c)
              for c in ("dem", "aspect", "slope", "mpw", "posidex")]
    return _norm(j.select("px", "py", "sday", "eday", "label", *firsts))


def q28_feature_vector(spark, sf):
    ccd = D.detect(_obs(spark, sf), TREND)
    f = FT.features(standins.aux_layers(spark, sf), SG.filter_detected(ccd))
    e = f.select("px", "py", "sday", F.posexplode(vector_to_array("features")).alias("i", "v"))
    e = e.where(~F.isnan("v"))
    return _norm(e.select("px", "py", "sday", "i", F.round("v", 1).alias("v")))


def _train_frames(spark, sf):
    ccd = SG.filter_detected(D.detect(_obs(spark, sf)))
    return FT.features(standins.aux_layers(spark, sf), ccd)


def q29_train_classify(spark, sf):
    fdf = _train_frames(spark, sf)
    labelled = FT.filter_labels(standins.aux_layers(spark, sf)).select(*D.PIXEL)
    model = RF.fit(fdf.join(labelled, D.PIXEL, "left_semi"))
    out = RF.dedensify(RF.classify(model, fdf))
    return _votes(out)


def _votes(out):
    """Slots and votes of each segment: a forest gives as many votes as it has trees."""
    return _norm(out.select(*FT.FEATURE_KEYS, F.size("rfrawp").alias("slots"),
                            F.round(F.aggregate("rfrawp", F.lit(0.0), lambda a, x: a + x), 1).alias("votes")))


def q30_join_predictions(spark, sf):
    spans = _spans(spark, sf).withColumn("rfrawp", F.lit(None).cast("array<float>"))
    part = standins.table(spark, sf, "part").select(*standins.pixel_keys("p_partkey"), "p_size",
                                                    "p_retailprice")
    preds = spans.select(*FT.FEATURE_KEYS).join(part, D.PIXEL).select(
        *FT.FEATURE_KEYS, F.array(F.col("p_size").cast("float"), F.col("p_retailprice").cast("float"))
        .alias("rfrawp"))
    j = SG.join_predictions(spans, preds)
    return _norm(j.select(*FT.FEATURE_KEYS,
                          *[F.round(F.col("rfrawp")[i].cast("double"), 2).alias(f"r{i}") for i in range(2)]))


# ---------------------------------------------------------------------------
# Full detector and jobs
# ---------------------------------------------------------------------------

def _flat(seg):
    """Segment rows with every value as a rounded number."""
    cols = []
    for b in BAND_PREFIX.values():
        cols += [F.round(F.col(f"{b}{x}").cast("double"), 1).alias(f"{b}{x}") for x in ("mag", "rmse", "int")]
        cols += [F.round(F.get(F.col(f"{b}coef"), i).cast("double"), 1).alias(f"{b}coef{i}") for i in range(3)]
    return _norm(seg.select(*D.PIXEL, "sday", "eday", "bday", F.round(F.col("chprob").cast("double"), 4).alias("chprob"), "curqa", *cols))


def q31_full_detector(spark, sf):
    return _flat(SG.project_segment(D.detect(_obs(spark, sf))))


def _first_point(spark, sf):
    return _points(spark, sf).orderBy("c_custkey").select("x", "y").first()


def q32_change_detection_job(spark, sf):
    root = scratch_path(spark, "store")
    pt = _first_point(spark, sf)
    jobs.change_detection(spark, pt.x, pt.y, _obs(spark, sf), root,
                          acquired="1990-01-01/2005-12-31", number=TAKE)
    return _flat(T.scan_table(spark, root, "segment"))


def q33_classification_job(spark, sf):
    root = scratch_path(spark, "store")
    pt = _first_point(spark, sf)
    p1 = spark.createDataFrame([(float(pt.x), float(pt.y))], "x double, y double")
    area = grid.training_chips(p1)
    obs = _obs(spark, sf).join(F.broadcast(area), ["cx", "cy"], "left_semi")
    jobs.detect_batch(obs, root)
    out = jobs.classification(spark, pt.x, pt.y, MSDAY, MEDAY, standins.aux_layers(spark, sf), root)
    if out is None:
        out = spark.createDataFrame([], T.SCHEMAS["segment"]())
    return _votes(out)


def q34_tile_metadata(spark, sf):
    root = scratch_path(spark, "store")
    tiles = grid.tile(_points(spark, sf)).select("tx", "ty").distinct()
    rows = tiles.select("tx", "ty",
                        F.lit("random-forest:1995-06-01/2001-06-30").alias("name"),
                        F.concat(F.lit("models/"), F.col("tx").cast("string"), F.lit("_"),
                                 F.col("ty").cast("string")).alias("model"),
                        F.lit("2001-07-01T00:00:00").alias("updated"))
    T.write_tile(rows, root)
    back = T.read_tile(spark, root, tiles)
    return _norm(back.select("tx", "ty", "name", "model"))


def q35_namespace(spark, sf):
    n = standins.table(spark, sf, "nation").join(standins.table(spark, sf, "region"),
                                                 F.col("n_regionkey") == F.col("r_regionkey"))
    out = n.select("n_nationkey",
                   namespace_column(F.concat(F.lit("/"), F.col("n_name")),
                                    F.concat(F.lit("/"), F.col("r_name"), F.lit("/aux")),
                                    F.lit("1.0")).alias("namespace"))
    return _norm(out)


def _quarter(day):
    """First day of a date's quarter: an acquisition of the raster queries."""
    return date_to_ordinal(F.trunc(F.to_date(day), "quarter"))


def _corner_chip():
    """The first chip of the tile of a point (x, y)."""
    return grid.tile_of_chip("x", "y")       # snaps any point


def q36_decode_chip(spark, sf):
    """A whole raster for each tile and quarter, a line's cell by its order and number."""
    o = standins.table(spark, sf, "orders").select("o_orderkey", "o_custkey", _quarter("o_orderdate").alias("t"))
    tx, ty = _corner_chip()
    at = o.join(_points(spark, sf), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "t", tx.alias("cx"), ty.alias("cy"))
    cells = (standins.table(spark, sf, "lineitem").join(at, F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy("cx", "cy", "t", ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % CELLS).cast("int").alias("cell"))
             .agg(F.max(F.round(F.col("l_quantity") * 100).cast("int")).alias("blues")))
    typed = rasters.layer_to_band(_packed(cells, [("le07_srb1", "INT16", "blues", -9999)]), rasters.registry(spark))
    dec = typed.select("x", "y", "acquired", rasters.decode(F.col("data"), F.col("data_type")).alias("values"))
    px = rasters.pixel_rows(dec, "values", "x", "y")
    return _norm(px.where(F.col("value") != -9999).select("acquired", "i", "px", "py", F.col("value").cast("bigint").alias("value")))


def q37_upsert_batches(spark, sf):
    """Odd lines first, then even ones over them."""
    root = scratch_path(spark, "store")
    li = standins.table(spark, sf, "lineitem")
    iso = ordinal_to_iso(date_to_ordinal("l_shipdate"))
    given = dict(sday=iso, eday=iso, chprob=F.col("l_quantity").cast("float"), curqa=F.col("l_linenumber").cast("int"))
    given.update(zip(D.PIXEL, standins.pixel_keys("l_partkey")))
    rows = li.select("l_orderkey", "l_linenumber", "l_quantity", *[
        given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in T.SCHEMAS["segment"]().fields])
    for odd in (1, 0):
        T.write_segment(rows.where(F.col("l_linenumber") % 2 == odd), root, order=["l_orderkey", "l_linenumber", "l_quantity"])
    back = T.read_segment(spark, root, grid.classification_chips(_points(spark, sf)))
    return _norm(back.select(*D.PIXEL, "sday", "eday", F.col("chprob").cast("double").alias("chprob"), "curqa"))


def _packed(cells, layers):
    """Rows (cx, cy, t, cell, one column per layer) -> raster records of whole chips.

    A cell without a row has the layer's filler."""
    by_chip = cells.groupBy("cx", "cy", "t").agg(F.collect_list(F.struct("cell", *[band for _, _, band, _ in layers])).alias("m"))   # a chip's cells
    return rasters.pack_cells(by_chip.select(
        F.col("cx").alias("x"), F.col("cy").alias("y"), F.concat(ordinal_to_iso("t"), F.lit("T00:00:00Z")).alias("acquired"),
        F.col("m.cell").alias("cells"), *[F.col(f"m.{band}").alias(band) for _, _, band, _ in layers]), layers)


def _write_chips(spark, cells, layers):
    """The records of ``_packed`` as chip files; where they are."""
    path = scratch_path(spark, "chips")
    # columnar and compressed: most of a sparse chip is filler; a dictionary of whole rasters would only cost their hashes
    # what was shuffled for them goes with the job, else it is on disk together with what is read from them
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        _packed(cells, layers).write.option("compression", "zstd").option("parquet.enable.dictionary#data", "false").parquet(path)
    return path


def _text(c):
    return F.array_join(F.transform(c, lambda x: x.cast("bigint").cast("string")), ",").alias(c)


# Lines whose rasters (up to 8 whole layers an order) a task packs.
LINES_A_TASK = 40_000
# Rows of a table whose rasters (up to 8 compact layers a row) a task assembles.
ROWS_A_TASK = 10_000


def _chip_partitions(spark, sf, table, rows=ROWS_A_TASK):
    """Partitions by chip: no table has more acquisitions than rows."""
    return max(spark.sparkContext.defaultParallelism, -(-standins.table(spark, sf, table).count() // rows))


def q38_raster_ard(spark, sf):
    """Lines packed into INT16 and UINT16 rasters, decoded, assembled."""
    layers = [(f"LC08_SRB{i + 2}", "INT16", b, -9999) for i, b in enumerate(["blues", "greens", "reds", "nirs", "swir1s", "swir2s"])]
    layers += [("LC08_BTB10", "INT16", "thermals", -9999), ("LC08_PIXELQA", "UINT16", "qas", 1)]
    o = standins.table(spark, sf, "orders").select("o_orderkey", "o_custkey", date_to_ordinal("o_orderdate").alias("t"))
    x, y = grid.chip_of_point("x", "y")
    at = o.join(_points(spark, sf), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "t", x.alias("cx"), y.alias("cy"))
    lines = standins.table(spark, sf, "lineitem").join(at, F.col("l_orderkey") == F.col("o_orderkey"))
    # dealt by acquisition once, for its cells and its rasters
    lines = lines.select("cx", "cy", "t", "l_partkey", "l_quantity", "l_linenumber").repartition(
        _chip_partitions(spark, sf, "lineitem", LINES_A_TASK), "cx", "cy", "t")
    cells = lines.groupBy("cx", "cy", "t", (F.col("l_partkey") % CELLS).cast("int").alias("cell")).agg(
        *[F.max((F.col("l_quantity").cast("int") * 100 + F.lit(i))).alias(b) for i, (_, _, b, _) in enumerate(layers[:7])],
        F.max(F.lit(40000) + F.col("l_linenumber")).alias("qas"))
    path = _write_chips(spark, cells, layers)
    chips = rasters.scan_chips(spark, path, grid.classification_chips(_points(spark, sf)), fmt="parquet")
    ard = SR.ard(chips, rasters.registry(spark), ACQUIRED, _chip_partitions(spark, sf, "orders"), seen=("qas", 1))
    full = F.exists("qas", lambda q: q > 1)
    return _norm(ard.where(full).select(*D.PIXEL, *[_text(c) for c in ("dates", "greens", "thermals", "qas")]))


def q39_raster_aux(spark, sf):
    """Parts packed into FLOAT32, BYTE and INT16 rasters; a layer that a chip lacks is null."""
    layers = [("AUX_DEM", "FLOAT32", "dem", -1), ("AUX_TRENDS", "BYTE", "trends", 255), ("AUX_ASPECT", "INT16", "aspect", -9999), ("AUX_MPW", "BYTE", "mpw", 255)]
    cx, cy = standins.pixel_keys("p_partkey")[:2]
    cells = standins.table(spark, sf, "part").groupBy(cx, cy, F.lit(1).alias("t"), (F.col("p_partkey") % CELLS).cast("int").alias("cell")).agg(
        F.max(F.col("p_size") + 0.5).alias("dem"), F.max(F.col("p_size") % 10).alias("trends"),
        F.max(-F.col("p_size")).alias("aspect"), F.max(F.col("p_size") % 2).alias("mpw"))
    chips = rasters.scan_chips(spark, _write_chips(spark, cells, layers), fmt="parquet")
    aux = SR.aux(chips, rasters.registry(spark), "0001-01-01/0001-12-31", _chip_partitions(spark, sf, "part"), seen=("trends", 255))
    first = lambda c: F.get(F.col(c), 0).cast("double").alias(c)
    return _norm(aux.where(F.get("trends", 0) < 255).select(*D.PIXEL, first("dem"), first("trends"), first("aspect"), first("mpw"), F.get("slope", 0).isNull().alias("no_slope")))


def q40_nested_models(spark, sf):
    """Parts as nested change models; every seventh has none, every third no thermal band."""
    part = standins.table(spark, sf, "part")
    size = F.col("p_size").cast("float")
    band = F.struct(size.alias("magnitude"), (size / 2).alias("rmse"), F.array(size, -size).alias("coefficients"), (size + 1).alias("intercept"))
    model = F.struct((F.col("p_size") + 730000).alias("start_day"), (F.col("p_size") + 730100).alias("end_day"),
                     F.when(F.col("p_size") % 2 == 0, F.col("p_size") + 730050).alias("break_day"), (size / 64).alias("change_probability"),
                     *[(F.when(F.col("p_partkey") % 3 > 0, band) if b == "thermal" else band).alias(b) for b in BAND_PREFIX])
    rows = part.select(*standins.pixel_keys("p_partkey"), F.array(F.lit(730000), F.col("p_size") + 730001).alias("dates"),
                       F.array(F.lit(0), F.lit(1)).alias("processing_mask"),
                       F.when(F.col("p_partkey") % 7 > 0, F.array(model)).alias("change_models"))
    flat = SG.format_change_models(rows)
    return _norm(flat.select(*D.PIXEL, "sday", "eday", "bday", F.col("chprob").cast("double").alias("chprob"), F.col("blmag").cast("double").alias("blmag"),
                             F.get("s2coef", 1).cast("double").alias("s2coef1"), F.col("thint").cast("double").alias("thint"),
                             F.array_join("dates", ",").alias("dates"), F.col("mask")[1].alias("m1"), F.col("curqa").isNull().alias("no_qa")))


def q41_detection_round_trip(spark, sf):
    """The wide result and its chips written and read back."""
    root = scratch_path(spark, "store")
    ids = grid.classification_chips(_points(spark, sf))
    ccd = D.detect(_obs(spark, sf), TREND)
    T.write_detection(ccd, root)
    T.write_chip(SG.project_chip(T.read_detection(spark, root, ids)), root)
    return _norm(T.read_chip(spark, root, ids).select("cx", "cy", F.array_join("dates", ",").alias("dates")))


# ---------------------------------------------------------------------------
# Parts of the complete detector
# ---------------------------------------------------------------------------

def q42_screened_days(spark, sf):
    """Clear observations that local robust fits take for cloud or shadow."""
    p = D.DetectParams(screen=COMPLETE.screen)
    clear = D.clear_observations(_obs(spark, sf), p)
    # a narrow key and the two bands are all that the fits need
    rows = clear.select(D.pixel_id(), "px", "py", "t", *[b for b, _ in p.screen])
    return _norm(screen.residuals(rows, p, D.PID).where(screen.cloudy(p)).select("px", "py", "t"))


def q43_model_order(spark, sf):
    """4, 6 or 8 terms by the number of observations, Lasso."""
    clear = D.clear_observations(_obs(spark, sf), D.DetectParams())
    t0 = F.min("t").over(Window.partitionBy("px", "py"))      # the grouping has the same partitions
    f = fitmod.fit(clear.select("px", "py", "t", "greens", t0.alias("_first")), ["px", "py"], ["greens"], terms=8, t0="_first",
                   orders=(4, 6, 8), alpha=LASSO)
    return _norm(f.select("px", "py", "n", "order", *[F.round(f"b_greens_{i}", 2).alias(f"b{i}") for i in range(8)],
                          F.round("rmse_greens", 2).alias("rmse")))


def q44_stable_start(spark, sf):
    """The first stable window of each pixel."""
    p = D.DetectParams(stable=True, stable_sigma=STRICT)
    checkpoint_dir(spark)
    prepared = D.materialise(D.prepare(_obs(spark, sf), p, D.PID))
    pixel = prepared.where("n = 1").select("pid", "px", "py")
    first = start.first_windows(prepared, p, D.PID)
    return _norm(first.join(pixel, D.PID).select("px", "py", F.col("_s").alias("s"), F.col("_t0").alias("t")))


def q45_complete_detector(spark, sf):
    """D1-D14 with screening, stable start, look-back and model order."""
    seg = D.detect_rounds(_obs(spark, sf), COMPLETE, D.PID)[0]
    return _norm(seg.select("px", "py", "seg", ordinal_to_iso("sday_n").alias("sday"), ordinal_to_iso("eday_n").alias("eday"),
                            ordinal_to_iso("bday_n").alias("bday"), F.col("n").alias("nobs"), "curqa", F.round("chprob", 4).alias("chprob"),
                            *[F.round(f"{x}_{b}", 1).alias(f"{x}_{b}") for b in COMPLETE.bands for x in ("mag", "rmse")],
                            F.round("b_greens_0", 1).alias("int_greens")))


# ---------------------------------------------------------------------------
# Store and catalogue
# ---------------------------------------------------------------------------

def _namespace(spark, version):
    """A namespace of its own, with its tables in the shared folder."""
    place = scratch_path(spark, "namespace")
    name = namespace_name(spark, "http://host/" + place.rsplit("-", 1)[1], "http://host/aux", version)
    return namespaces.create(spark, name, place)


def _buckets(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def q46_namespace_tables(spark, sf):
    """One table name in two namespaces; the second one is stored, replaced and published."""
    root, one, two = scratch_path(spark, "store"), _namespace(spark, "1.0"), _namespace(spark, "2.0")
    spans = _spans(spark, sf)
    slot = F.expr(f"(px + {int(TILE_GRID['tx'])}) div {standins.PIXEL_SIZE} % 4")
    cols = [c for c in T.SCHEMAS["segment"]().fieldNames() if c not in spans.columns]
    rows = spans.select("*", *[F.lit(None).cast(T.SCHEMAS["segment"]()[c].dataType).alias(c) for c in cols])
    namespaces.save(spans, one, "segment", _buckets(spark))
    T.write_segment(rows.where(slot != 0), root)
    T.write_segment(rows.withColumn("curqa", F.lit(8)).where(slot != 1), root)
    T.compact(spark, root, "segment")
    T.write_segment(rows.withColumn("curqa", F.lit(14)).where(slot == 2), root, replace_chips=True)
    namespaces.publish(spark, root, two, "segment", _buckets(spark))
    at = lambda name, version: namespaces.read(spark, name, "segment").select(F.lit(version).alias("version"), *FT.FEATURE_KEYS)
    qa = namespaces.read(spark, two, "segment").select(*FT.FEATURE_KEYS, "curqa")
    return _norm(at(one, "1.0").unionByName(at(two, "2.0")).join(qa, FT.FEATURE_KEYS, "left"))


def q47_joins_in_place(spark, sf):
    """J6, J7 on bucketed tables: features and predictions meet the segments without a shuffle."""
    name = _namespace(spark, "1.0")
    spans = namespaces.save(_spans(spark, sf).withColumn("rfrawp", F.lit(None).cast("array<float>")), name, "segment", _buckets(spark))
    aux = namespaces.save(standins.aux_layers(spark, sf), name, "aux", _buckets(spark))
    given = namespaces.join_in_place(spans.drop("rfrawp"), aux.select(*D.PIXEL, "aspect", "dem")).select(
        *FT.FEATURE_KEYS, F.array(F.get("aspect", 0).cast("float"), F.get("dem", 0)).alias("rfrawp"))
    preds = namespaces.save(given, name, "prediction", _buckets(spark), D.PIXEL)
    return _norm(_in_place(spans, aux, preds))


def _in_place(spans, aux, preds):
    done = namespaces.join_in_place(spans.drop("rfrawp"), preds, also=("sday", "eday"))
    j = FT.dependent(namespaces.join_in_place(aux, done))
    first = lambda c: F.round(F.get(F.col(c), 0).cast("double"), 4).alias(c)
    return j.select(*FT.FEATURE_KEYS, "label", first("slope"), first("mpw"),
                    *[F.round(F.col("rfrawp")[i].cast("double"), 2).alias(f"r{i}") for i in range(2)])


QUERIES = {name: fn for name, fn in sorted(globals().items())
           if name[:1] == "q" and name[1:3].isdigit() and callable(fn)}
