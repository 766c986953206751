"""DuckDB SQL for the query catalogue (same keys, same column names).

Tables are the driver's views (lineitem, part, customer, ...).  Helper
macros below restate the stand-in mappings of ``sources.standins`` in SQL;
the detector's SQL (``detector_sql``) shares no expression with the engine.
Integral outputs are cast to BIGINT; ``+ 0.0`` after ``round`` turns a
negative zero into zero.
"""

from __future__ import annotations

from ..config import BAND_PREFIX, BAND_SERIES, BANDS, NUM_TREES
from ..operators.detect import DetectParams
from . import catalogue as C
from ..operators.fit import SWEEPS
from .detector_sql import FINISHED, REGRESSORS, _fit, detector_ctes, screened, stable_start


def PX(k):
    return f"(-2565585 + 30 * (({k} * 7919) % 25000))"


def PY(k):
    return f"(3314805 - 30 * (({k} * 104729 + ({k} // 25000) * 9973) % 25000))"


def CX(x):
    return f"(CAST(floor(({x} + 2565585) / 3000.0) AS BIGINT) * 3000 - 2565585)"


def CY(y):
    return f"(3314805 - CAST(floor((3314805 - ({y})) / 3000.0) AS BIGINT) * 3000)"


def TX(x):
    return f"(CAST(floor(({x} + 2565585) / 150000.0) AS BIGINT) * 150000 - 2565585)"


def TY(y):
    return f"(3314805 - CAST(floor((3314805 - ({y})) / 150000.0) AS BIGINT) * 150000)"


def DAY(ts):
    return f"((CAST({ts} AS DATE) - DATE '1970-01-01') + 719163)"


def ISO(o):
    return f"CAST(DATE '1970-01-01' + CAST(({o}) - 719163 AS INTEGER) AS VARCHAR)"


def R(x, d):
    return f"(round({x}, {d}) + 0.0)"


def F32(x):
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


OBS = f"""obs AS (
  SELECT {CX('x')} AS cx, {CY('y')} AS cy, x AS px, y AS py, t,
         blues, greens, reds, nirs, swir1s, swir2s, thermals, qas
  FROM (
    SELECT {PX('l_partkey')} AS x, {PY('l_partkey')} AS y, t,
           CAST(round(max(l_quantity) * 100) AS INTEGER) AS blues,
           CAST(round(max(l_extendedprice) / 10) AS INTEGER) AS greens,
           CAST(round(max(l_discount) * 10000) AS INTEGER) AS reds,
           CAST(round(max(l_tax) * 10000) AS INTEGER) AS nirs,
           CAST(round(min(l_quantity) * 100) AS INTEGER) AS swir1s,
           CAST(round(min(l_extendedprice) / 10) AS INTEGER) AS swir2s,
           CAST(round(avg(l_quantity) * 100) AS INTEGER) AS thermals,
           CASE WHEN max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 THEN 32 ELSE 66 END AS qas
    FROM (SELECT *, {DAY('l_shipdate')} AS t FROM lineitem) li
    GROUP BY l_partkey, t) g)"""

PTS = f"""pts AS (SELECT c_custkey, {PX('c_custkey')} AS x, {PY('c_custkey')} AS y FROM customer)"""

PARTPIX = f"""partpix AS (
  SELECT {CX(PX('p_partkey'))} AS cx, {CY(PY('p_partkey'))} AS cy,
         {PX('p_partkey')} AS px, {PY('p_partkey')} AS py, p_partkey, p_size, p_retailprice
  FROM part)"""

SPANS = f"""spans AS (
  SELECT cx, cy, px, py, {ISO('min(t)')} AS sday, {ISO('max(t)')} AS eday
  FROM (SELECT *, year(DATE '1970-01-01' + CAST(t - 719163 AS INTEGER)) AS yr FROM obs) o
  GROUP BY cx, cy, px, py, yr)"""

CLEAR7 = ("blues <> -9999 AND greens <> -9999 AND reds <> -9999 AND nirs <> -9999 AND swir1s <> -9999 "
          "AND swir2s <> -9999 AND thermals <> -9999 AND (qas & 41) = 0")

TILES = f"""tiles AS (SELECT DISTINCT {TX('x')} AS tx, {TY('y')} AS ty FROM pts)"""


def _with(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


FULL = DetectParams()


# Rounds that are enough at the size the SQL runs at; if not, the results say so.
FULL_ROUNDS = 3


def _detected(p, *more):
    return _with(OBS, *detector_ctes(p, rounds=FULL_ROUNDS if p is FULL else 5), *more)


# Pixels and days of the lines, read once more: DuckDB doesn't finish in minutes
# when a table of the rounds and the observations that they start from meet again.
DAYS = f"""(SELECT DISTINCT {CX('x')} AS cx, {CY('y')} AS cy, x AS px, y AS py, t
  FROM (SELECT {PX('l_partkey')} AS x, {PY('l_partkey')} AS y, {DAY('l_shipdate')} AS t FROM lineitem) l)"""


def _q14():
    return _detected(C.TREND) + f"""SELECT px, py, CAST(seg AS BIGINT) AS seg, CAST(brk_t AS BIGINT) AS bday
FROM segs WHERE brk_t IS NOT NULL AND {FINISHED}"""


def _q15():
    return _detected(C.TREND) + f"""SELECT px, py, CAST(seg AS BIGINT) AS seg, {ISO('sday_n')} AS sday, {ISO('eday_n')} AS eday,
  {ISO('bday_n')} AS bday, CAST(nobs AS BIGINT) AS nobs, {R('chprob', 4)} AS chprob,
  {R('mag_greens', 2)} AS mag, {R('rmse_greens', 2)} AS rmse FROM segs WHERE {FINISHED}"""


def _q19():
    return _detected(C.TREND) + f"""SELECT cx, cy, px, py, {ISO('sday_n')} AS sday, {ISO('eday_n')} AS eday,
  {ISO('bday_n')} AS bday, {R(F32('chprob'), 4)} AS chprob, CAST(2 AS BIGINT) AS curqa,
  {R(F32('rmse_greens'), 1)} AS grrmse, {R(F32('mag_greens'), 1)} AS grmag, CAST(1 AS BIGINT) AS ncoef, TRUE AS bl_null
FROM segs WHERE {FINISHED}
UNION ALL
SELECT DISTINCT o.cx, o.cy, o.px, o.py, '0001-01-01', '0001-01-01', '0001-01-01', NULL, NULL, NULL, NULL,
  CAST(NULL AS BIGINT), TRUE
FROM obs o LEFT JOIN segs s USING (cx, cy, px, py) WHERE s.px IS NULL"""


def _q28():
    cols = [(1, "mag_greens"), (8, "rmse_greens"), (15, "b_greens_1"), (22, "b_greens_0"), (28, "p_retailprice"), (29, "p_size"),
            (30, "p_partkey % 45"), (31, "p_size % 2"), (32, "(p_size % 7) / 7.0")]
    sel = [f"SELECT px, py, {ISO('sday_n')} AS sday, CAST({i} AS BIGINT) AS i, {R(F32(c), 1)} AS v FROM j" for i, c in cols]
    return _detected(C.TREND, PARTPIX, f"j AS MATERIALIZED (SELECT * FROM segs JOIN partpix USING (cx, cy, px, py) WHERE {FINISHED})") + \
        "SELECT * FROM (" + "\nUNION ALL\n".join(sel) + ") u WHERE v IS NOT NULL AND NOT isnan(v)"


def _flat(source=DAYS):
    """All segments with every value as a rounded number, sentinels included."""
    names, values, nulls = [], [], []
    for b in BANDS:
        s, x = BAND_SERIES[b], BAND_PREFIX[b]
        for name, value in [(f"{x}mag", f"mag_{s}"), (f"{x}rmse", f"rmse_{s}"), *[(f"{x}coef{i}", f"b_{s}_{i + 1}") for i in range(3)], (f"{x}int", f"b_{s}_0")]:
            names.append(name)
            values.append(f"{R(F32(value), 1)} AS {name}")
            nulls.append("NULL")
    # a window, as joins over the rounds take DuckDB's planner minutes
    return f"""SELECT * EXCLUDE (found) FROM (
  SELECT cx, cy, px, py, {ISO('sday_n')} AS sday, {ISO('eday_n')} AS eday, {ISO('bday_n')} AS bday,
    {R(F32('chprob'), 4)} AS chprob, CAST(4 AS BIGINT) AS curqa, {', '.join(values)}, 1 AS found FROM segs
  UNION ALL
  SELECT DISTINCT cx, cy, px, py, '0001-01-01', '0001-01-01', '0001-01-01', NULL, NULL, {', '.join(nulls)}, 0 FROM {source} d
  UNION ALL
  SELECT {', '.join(['NULL'] * (9 + len(nulls)))}, 1 FROM unfinished WHERE n > 0) u
QUALIFY found = 1 OR max(found) OVER (PARTITION BY px, py) = 0"""


def _mask():
    return _detected(FULL) + f"""SELECT cx, cy, px, py, string_agg(CASE WHEN hit THEN '1' ELSE '0' END, '' ORDER BY t) AS mask
FROM (SELECT any_value(cx) AS cx, any_value(cy) AS cy, px, py, t, bool_or(hit) AS hit
      FROM (SELECT cx, cy, px, py, t, FALSE AS hit FROM {DAYS} d UNION ALL SELECT NULL, NULL, px, py, t, TRUE FROM used
            UNION ALL SELECT 0, 0, 0, 0, 0, TRUE FROM unfinished WHERE n > 0) u GROUP BY px, py, t) v
GROUP BY cx, cy, px, py"""


# The tile of the first customer, and the 3 x 3 tiles around it.
HOME = PTS + f""",
home AS (SELECT {TX('x')} AS tx, {TY('y')} AS ty FROM pts ORDER BY c_custkey LIMIT 1)"""


def _q32():
    near = f"""near AS MATERIALIZED (SELECT obs.* FROM obs, home WHERE {TX('cx')} = tx AND {TY('cy')} = ty
  AND t BETWEEN {DAY("DATE '1990-01-01'")} AND {DAY("DATE '2005-12-31'")})"""
    return _with(OBS, HOME, near, *detector_ctes(FULL, "near", FULL_ROUNDS)) + _flat("near")


def _votes(rows):
    """Segments with the number of vote slots (classes seen in training and one for others) and their sum."""
    return f"""SELECT cx, cy, px, py, {ISO('sday_n')} AS sday, {ISO('eday_n')} AS eday,
  CAST((SELECT count(DISTINCT p_size % 10) + 1 FROM train) AS BIGINT) AS slots, {float(NUM_TREES)!r} AS votes
FROM {rows} WHERE (SELECT count(*) FROM train) > 0
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM unfinished WHERE n > 0"""


def _q29():
    return _detected(FULL, PARTPIX, "j AS MATERIALIZED (SELECT * FROM segs JOIN partpix USING (cx, cy, px, py))",
                     "train AS (SELECT * FROM j WHERE p_size % 10 NOT IN (0, 9))") + _votes("j")


def _q13():
    p = DetectParams(bands=["greens"], detection_bands=["greens"], qa=None)
    first = "row_number() OVER (PARTITION BY px, py ORDER BY t) AS n, min(t) OVER (PARTITION BY px, py) AS t0"
    xs = ", ".join(f"{x} AS x{i}" for i, x in enumerate(REGRESSORS))
    return _with(OBS, f"a AS (SELECT px, py, t, greens, {first} FROM obs)", f"x AS MATERIALIZED (SELECT *, {xs} FROM a)", *_fit("f", "x", "TRUE", p)) + \
        f"SELECT px, py, nfit AS n, {', '.join(f'{R(f"b_greens_{i}", 3)} AS b{i}' for i in range(4))}, {R('rmse_greens', 3)} AS rmse FROM f"


SEEN = f"seen AS MATERIALIZED (SELECT * FROM obs WHERE {CLEAR7})"


def _q42():
    return _with(OBS, SEEN, *screened(DetectParams(screen=C.COMPLETE.screen), "seen", "kept")) + \
        "SELECT px, py, CAST(t AS BIGINT) AS t FROM kept_r WHERE cloudy"


def _q43():
    """The ridge solution by elimination, then one row of the recursion a sweep."""
    p = DetectParams(bands=["greens"], detection_bands=["greens"], qa=None, terms=8, orders=(4, 6, 8))
    xs = ", ".join(f"{x} AS x{i}" for i, x in enumerate(REGRESSORS))
    g = lambda i, j: f"g{min(i, j)}{max(i, j)}"
    gram = ", ".join(f"CASE WHEN ord > {j} THEN q{i}{j} ELSE {float(i == j)!r}::DOUBLE END AS g{i}{j}" for i in range(8) for j in range(i, 8))
    xy = ", ".join(f"CASE WHEN ord > {i} THEN w_greens_{i} ELSE 0.0 END AS v{i}" for i in range(8))
    held = ", ".join([f"g{i}{j}" for i in range(8) for j in range(i, 8)] + [f"v{i}" for i in range(8)])
    new = []
    for i in range(8):
        rest = f"(v{i}" + "".join(f" - {g(i, j)} * {'n' if j < i else 'b'}{j}" for j in range(8) if j != i) + ")"
        new.append(f"{rest if i == 0 else f'sign({rest}) * greatest(abs({rest}) - {C.LASSO!r} * nfit, 0.0)'} / {g(i, i)} AS n{i}")
    chain = "d"
    for i in range(8):
        chain = f"(SELECT *, {new[i]} FROM {chain}) l{i}"
    model = " + ".join(f"b{i} * x{i}" for i in range(8))
    body = [OBS, f"a AS (SELECT px, py, t, greens, min(t) OVER (PARTITION BY px, py) AS t0 FROM obs WHERE {CLEAR7})",
            f"x AS MATERIALIZED (SELECT *, {xs} FROM a)", *_fit("f", "x", "TRUE", p),
            f"d(px, py, nfit, ord, step, {held}, {', '.join(f'b{i}' for i in range(8))}) AS (SELECT px, py, nfit, ord, 0, {held}, {', '.join(f'b_greens_{i}' for i in range(8))} "
            f"FROM (SELECT px, py, nfit, ord, {gram}, {xy} FROM f_s) q JOIN (SELECT px, py, {', '.join(f'b_greens_{i}' for i in range(8))} FROM f) r USING (px, py) "
            f"UNION ALL SELECT px, py, nfit, ord, step + 1, {held}, {', '.join(f'n{i}' for i in range(8))} FROM {chain} WHERE step < {SWEEPS})",
            f"last AS MATERIALIZED (SELECT * FROM d WHERE step = {SWEEPS})",
            f"e AS MATERIALIZED (SELECT px, py, sqrt(sum(pow(greens - ({model}), 2)) / greatest(any_value(nfit) - any_value(ord), 1)) AS rmse FROM x JOIN last USING (px, py) GROUP BY px, py)"]
    return "WITH RECURSIVE " + ",\n".join(body) + f"""
SELECT px, py, nfit AS n, CAST(ord AS BIGINT) AS "order", {', '.join(f'{R(f"b{i}", 2)} AS b{i}' for i in range(8))}, {R('rmse', 2)} AS rmse FROM last JOIN e USING (px, py)"""


def _q44():
    p = DetectParams(stable=True, stable_sigma=C.STRICT)
    xs = ", ".join(f"{x} AS x{i}" for i, x in enumerate(REGRESSORS[:4]))
    steps = ", ".join(f"abs({b} - lag({b}) OVER (PARTITION BY px, py ORDER BY t)) AS {b}" for b in p.detection_bands)
    vario = ", ".join(f"coalesce(median({b}), 0.0) AS vario_{b}" for b in p.detection_bands)
    return _with(OBS, SEEN, f"vario AS MATERIALIZED (SELECT px, py, {vario} FROM (SELECT px, py, {steps} FROM seen) q GROUP BY px, py)",
                 "a AS (SELECT s.*, row_number() OVER (PARTITION BY px, py ORDER BY t) AS n, min(t) OVER (PARTITION BY px, py) AS t0, vario.* EXCLUDE (px, py) FROM seen s JOIN vario USING (px, py))",
                 f"v AS MATERIALIZED (SELECT *, {xs} FROM a)", *stable_start(p, "v", "st")) + "SELECT px, py, CAST(s AS BIGINT) AS s, CAST(ts AS BIGINT) AS t FROM st"


def _q45():
    p = C.COMPLETE
    parts = ", ".join(f"{R(f'{x}_{b}', 1)} AS {x}_{b}" for b in p.bands for x in ("mag", "rmse"))
    return _with(OBS, *detector_ctes(p, rounds=FULL_ROUNDS)) + f"""SELECT px, py, CAST(seg AS BIGINT) AS seg, {ISO('sday_n')} AS sday, {ISO('eday_n')} AS eday,
  {ISO('bday_n')} AS bday, CAST(nobs AS BIGINT) AS nobs, CAST(curqa AS BIGINT) AS curqa, {R('chprob', 4)} AS chprob, {parts}, {R('b_greens_0', 1)} AS int_greens
FROM segs WHERE {FINISHED}"""


QUARTER = DAY("date_trunc('quarter', CAST(o_orderdate AS DATE))")
CELLS38 = f"""cells AS MATERIALIZED (
  SELECT {CX('p.x')} AS cx, {CY('p.y')} AS cy, {DAY('o_orderdate')} AS t, l_partkey % {C.CELLS} AS cell,
         max(CAST(l_quantity AS INTEGER)) * 100 + 1 AS g, max(CAST(l_quantity AS INTEGER)) * 100 + 6 AS th, 40000 + max(l_linenumber) AS qa
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN pts p ON o_custkey = c_custkey
  WHERE {DAY('o_orderdate')} BETWEEN {DAY(f"DATE '{C.ACQUIRED[:10]}'")} AND {DAY(f"DATE '{C.ACQUIRED[11:]}'")}
  GROUP BY 1, 2, 3, 4)"""


ORACLE = {
    "q01_snap_tile": _with(PTS) + """SELECT c_custkey, x, y, h, v, h * 150000 - 2565585 AS tx, 3314805 - v * 150000 AS ty
FROM (SELECT *, CAST(floor((x + 2565585) / 150000.0) AS BIGINT) AS h,
             CAST(floor((3314805 - y) / 150000.0) AS BIGINT) AS v FROM pts) s""",

    "q02_snap_chip": _with(PTS) + """SELECT c_custkey, h, v, h * 3000 - 2565585 AS cx, 3314805 - v * 3000 AS cy
FROM (SELECT *, CAST(floor((x + 2565585) / 3000.0) AS BIGINT) AS h,
             CAST(floor((3314805 - y) / 3000.0) AS BIGINT) AS v FROM pts) s""",

    "q03_extents": _with(PTS, TILES) + """SELECT tx, ty, tx AS ulx, ty AS uly, tx + 150000 AS lrx, ty - 150000 AS lry FROM tiles""",

    "q04_tile_chips": _with(PTS, TILES) + """SELECT tx, ty, tx + i * 3000 AS cx, ty - j * 3000 AS cy
FROM tiles, (SELECT range AS i FROM range(0, 50)) a, (SELECT range AS j FROM range(0, 50)) b""",

    "q05_near_tiles": _with(PTS) + """SELECT c_custkey, h + dh AS nh, v + dv AS nv, (h + dh) * 150000 - 2565585 AS nx,
       3314805 - (v + dv) * 150000 AS ny
FROM (SELECT *, CAST(floor((x + 2565585) / 150000.0) AS BIGINT) AS h,
             CAST(floor((3314805 - y) / 150000.0) AS BIGINT) AS v FROM pts) s,
     (SELECT range AS dh FROM range(-1, 2)) a, (SELECT range AS dv FROM range(-1, 2)) b""",

    "q06_training_chips": _with(PTS) + """SELECT DISTINCT nx + i * 3000 AS cx, ny - j * 3000 AS cy
FROM (SELECT DISTINCT (h + dh) * 150000 - 2565585 AS nx, 3314805 - (v + dv) * 150000 AS ny
      FROM (SELECT CAST(floor((x + 2565585) / 150000.0) AS BIGINT) AS h,
                   CAST(floor((3314805 - y) / 150000.0) AS BIGINT) AS v FROM pts) s,
           (SELECT range AS dh FROM range(-1, 2)) a, (SELECT range AS dv FROM range(-1, 2)) b) n,
     (SELECT range AS i FROM range(0, 50)) c, (SELECT range AS j FROM range(0, 50)) d""",

    "q07_acquired_filter": _with(OBS) + f"""SELECT px, py, count(*) AS n_acq, CAST(min(t) AS BIGINT) AS first_t,
       CAST(max(t) AS BIGINT) AS last_t
FROM obs WHERE DATE '1970-01-01' + CAST(t - 719163 AS INTEGER) BETWEEN DATE '{C.ACQUIRED[:10]}' AND DATE '{C.ACQUIRED[11:]}'
GROUP BY px, py""",

    "q08_ordinal_iso": _with(OBS) + f"""SELECT DISTINCT CAST(t AS BIGINT) AS t, {ISO('t')} AS iso
FROM (SELECT DISTINCT t FROM obs UNION ALL SELECT 1 AS t) d""",

    "q09_assemble_series": _with(OBS) + """SELECT cx, cy, px, py, count(*) AS n,
       string_agg(CAST(t AS VARCHAR), ',' ORDER BY t DESC) AS dates,
       string_agg(CAST(greens AS VARCHAR), ',' ORDER BY t DESC) AS greens
FROM obs GROUP BY cx, cy, px, py""",

    "q10_layer_to_band": "SELECT user_id, week, " + ", ".join(f"{R(e, 4)} AS {e}" for e in C.EVENT_TYPES) + """
FROM (SELECT user_id, CAST(floor((CAST(ts AS DATE) - DATE '1970-01-01') / 7.0) AS BIGINT) AS week, """ +
    ", ".join(f"max(CASE WHEN event_type = '{e}' THEN value END) AS {e}" for e in C.EVENT_TYPES) + """
      FROM events GROUP BY 1, 2) w
WHERE """ + " AND ".join(f"{e} IS NOT NULL" for e in C.EVENT_TYPES),

    "q11_trend_fit": _with(OBS) + f"""SELECT px, py, count(*) AS n, {R('regr_slope(greens, t)', 6)} AS slope,
       {R('regr_intercept(greens, t)', 2)} AS intercept FROM obs GROUP BY px, py""",

    "q12_scores": _with(OBS,
                        "fits AS (SELECT px, py, " + ", ".join(
                            f"regr_slope({b}, t) AS s_{b}, regr_intercept({b}, t) AS i_{b}" for b in C.SCORE_BANDS)
                        + " FROM obs GROUP BY px, py)",
                        "res AS (SELECT px, py, t, " + ", ".join(
                            f"{b} - (i_{b} + s_{b} * t) AS r_{b}" for b in C.SCORE_BANDS)
                        + " FROM obs JOIN fits USING (px, py))",
                        "rms AS (SELECT px, py, " + ", ".join(
                            f"sqrt(avg(r_{b} * r_{b})) AS m_{b}" for b in C.SCORE_BANDS)
                        + " FROM res GROUP BY px, py)") +
    "SELECT px, py, CAST(t AS BIGINT) AS t, " + R(" + ".join(
        f"CASE WHEN m_{b} > 0 THEN pow(r_{b} / m_{b}, 2) ELSE 0.0 END" for b in C.SCORE_BANDS), 4) +
    " AS z FROM res JOIN rms USING (px, py)",

    "q13_harmonic_fit": _q13(),
    "q14_break_days": _q14(),
    "q15_segments": _q15(),

    "q16_default_sentinel": _with(OBS, PARTPIX,
                                  f"modelled AS (SELECT cx, cy, px, py FROM obs WHERE {CLEAR7} "
                                  f"GROUP BY cx, cy, px, py HAVING count(*) >= {C.TREND.min_obs} "
                                  f"AND max(t) - min(t) >= 365.25)") +
    """SELECT DISTINCT p.cx, p.cy, p.px, p.py, '0001-01-01' AS sday, '0001-01-01' AS eday, '0001-01-01' AS bday
FROM partpix p LEFT JOIN modelled m USING (cx, cy, px, py) WHERE m.px IS NULL""",

    "q17_project_chip": _with(OBS) + f"""SELECT cx, cy, string_agg({ISO('t')}, ',' ORDER BY t) AS dates
FROM (SELECT DISTINCT cx, cy, t FROM obs) d GROUP BY cx, cy""",

    "q18_project_pixel": _mask(),

    "q19_project_segment": _q19(),

    "q20_upsert_latest": f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       l_quantity, l_extendedprice, CAST(t AS BIGINT) AS t
FROM (SELECT *, {DAY('l_shipdate')} AS t FROM lineitem) li
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY t DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""",

    "q21_read_by_ids": _with(OBS, PTS, TILES) + f"""SELECT cx, cy, px, py, count(*) AS n_mask
FROM obs o JOIN tiles t ON {TX('o.cx')} = t.tx AND {TY('o.cy')} = t.ty
GROUP BY cx, cy, px, py""",

    "q22_filter_labels": _with(PARTPIX) + """SELECT px, py, CAST(p_size % 10 AS BIGINT) AS label FROM partpix
WHERE p_size % 10 NOT IN (0, 9)""",

    "q23_filter_period": _with(OBS, SPANS) + f"""SELECT cx, cy, px, py, sday, eday FROM spans
WHERE sday >= {ISO(str(C.MSDAY))} AND eday <= {ISO(str(C.MEDAY))}""",

    "q24_filter_detected": _with(OBS, SPANS) + """SELECT cx, cy, px, py, sday, eday FROM spans WHERE eday > '0001-01-01'""",

    "q25_distinct_ids": _with(PARTPIX) + """SELECT DISTINCT cx, cy FROM partpix WHERE p_size % 10 NOT IN (0, 9)""",

    "q26_take_chunk": _with(PTS, TILES,
                            """chips AS (SELECT DISTINCT tx + i * 3000 AS cx, ty - j * 3000 AS cy
  FROM tiles, (SELECT range AS i FROM range(0, 50)) a, (SELECT range AS j FROM range(0, 50)) b)""",
                            f"""taken AS (SELECT * FROM chips ORDER BY cx, cy DESC LIMIT {C.TAKE})""") +
    f"""SELECT cx, cy, ((cx - {TX('cx')}) // 3000 * 50 + ({TY('cy')} - cy) // 3000) // {C.CHUNK} AS batch
FROM taken""",

    "q27_join_features": _with(OBS, SPANS, PARTPIX) + f"""SELECT px, py, sday, eday, CAST(p_size % 10 AS BIGINT) AS label,
       {R(F32('p_retailprice'), 4)} AS dem, {R('CAST(p_size AS DOUBLE)', 4)} AS aspect,
       {R(F32('p_partkey % 45'), 4)} AS slope, {R('CAST(p_size % 2 AS DOUBLE)', 4)} AS mpw,
       {R(F32('(p_size % 7) / 7.0'), 4)} AS posidex
FROM partpix JOIN spans USING (cx, cy, px, py)""",

    "q28_feature_vector": _q28(),

    "q29_train_classify": _q29(),

    "q30_join_predictions": _with(OBS, SPANS, PARTPIX) + f"""SELECT cx, cy, px, py, sday, eday,
       {R(F32('p_size'), 2)} AS r0, {R(F32('p_retailprice'), 2)} AS r1
FROM spans JOIN partpix USING (cx, cy, px, py)""",

    "q31_full_detector": _detected(FULL) + _flat(),

    "q32_change_detection_job": _q32(),

    "q34_tile_metadata": _with(PTS, TILES) + """SELECT tx, ty, 'random-forest:1995-06-01/2001-06-30' AS name,
       'models/' || CAST(tx AS VARCHAR) || '_' || CAST(ty AS VARCHAR) AS model FROM tiles""",

    "q35_namespace": """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey,
       regexp_replace(lower(regexp_replace(concat_ws('_', replace('/' || n_name, '/', ''),
                                                     replace('/' || r_name || '/aux', '/', ''), 'ccdc', '1.0'),
                                           '[^A-Za-z0-9_]', '_', 'g')), '^_+', '') AS namespace
FROM nation JOIN region ON n_regionkey = r_regionkey""",

    "q36_decode_chip": _with(PTS) + f"""SELECT {ISO('t')} || 'T00:00:00Z' AS acquired, CAST(cell AS BIGINT) AS i,
       cx + 30 * (cell % 100) AS px, cy - 30 * (cell // 100) AS py, CAST(q AS BIGINT) AS value
FROM (SELECT {TX('p.x')} AS cx, {TY('p.y')} AS cy, {QUARTER} AS t, (l_orderkey * 7 + l_linenumber) % {C.CELLS} AS cell,
             max(CAST(round(l_quantity * 100) AS INTEGER)) AS q
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN pts p ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4) l
WHERE q <> -9999""",

    "q37_upsert_batches": _with(PTS, TILES) + f"""SELECT {CX('x')} AS cx, {CY('y')} AS cy, x AS px, y AS py, {ISO('t')} AS sday, {ISO('t')} AS eday,
       CAST(l_quantity AS DOUBLE) AS chprob, CAST(l_linenumber AS BIGINT) AS curqa
FROM (SELECT *, {PX('l_partkey')} AS x, {PY('l_partkey')} AS y, {DAY('l_shipdate')} AS t FROM lineitem) l
JOIN tiles ON {TX('x')} = tx AND {TY('y')} = ty
QUALIFY row_number() OVER (PARTITION BY l_partkey, t ORDER BY l_linenumber % 2, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1""",

    "q38_raster_ard": _with(PTS, CELLS38) + f"""SELECT cx, cy, cx + 30 * (cell % 100) AS px, cy - 30 * (cell // 100) AS py,
       string_agg(CAST(t AS VARCHAR), ',' ORDER BY t DESC) AS dates, string_agg(CAST(g AS VARCHAR), ',' ORDER BY t DESC) AS greens,
       string_agg(CAST(th AS VARCHAR), ',' ORDER BY t DESC) AS thermals, string_agg(CAST(qa AS VARCHAR), ',' ORDER BY t DESC) AS qas
FROM (SELECT d.cx, d.cy, d.t, c.cell, coalesce(g, -9999) AS g, coalesce(th, -9999) AS th, coalesce(qa, 1) AS qa
      FROM (SELECT DISTINCT cx, cy, t FROM cells) d
      JOIN (SELECT DISTINCT cx, cy, cell FROM cells) c USING (cx, cy)
      LEFT JOIN cells USING (cx, cy, t, cell)) r
GROUP BY cx, cy, cell""",

    "q39_raster_aux": _with(PARTPIX) + f"""SELECT cx, cy, cx + 30 * (cell % 100) AS px, cy - 30 * (cell // 100) AS py,
       max(p_size) + 0.5::DOUBLE AS dem, CAST(max(p_size % 10) AS DOUBLE) AS trends, CAST(max(-p_size) AS DOUBLE) AS aspect,
       CAST(max(p_size % 2) AS DOUBLE) AS mpw, TRUE AS no_slope
FROM (SELECT cx, cy, p_size, p_partkey % {C.CELLS} AS cell FROM partpix) p GROUP BY cx, cy, cell""",

    "q40_nested_models": _with(PARTPIX) + f"""SELECT cx, cy, px, py,
       CASE WHEN has THEN {ISO('p_size + 730000')} ELSE '0001-01-01' END AS sday, CASE WHEN has THEN {ISO('p_size + 730100')} ELSE '0001-01-01' END AS eday,
       CASE WHEN NOT has THEN '0001-01-01' WHEN p_size % 2 = 0 THEN {ISO('p_size + 730050')} END AS bday,
       CASE WHEN has THEN p_size / 64.0::DOUBLE END AS chprob, CASE WHEN has THEN p_size::DOUBLE END AS blmag, CASE WHEN has THEN -p_size::DOUBLE END AS s2coef1,
       CASE WHEN has AND p_partkey % 3 > 0 THEN p_size + 1.0::DOUBLE END AS thint,
       {ISO('730000')} || ',' || {ISO('p_size + 730001')} AS dates, CAST(1 AS BIGINT) AS m1, TRUE AS no_qa
FROM (SELECT *, p_partkey % 7 > 0 AS has FROM partpix) p""",

    "q42_screened_days": _q42(),
    "q43_model_order": _q43(),
    "q44_stable_start": _q44(),
    "q45_complete_detector": _q45(),

    "q46_namespace_tables": _with(OBS, SPANS) + """, slots AS (SELECT *, (px + 2565585) // 30 % 4 AS slot FROM spans),
two AS (SELECT cx, cy, px, py, sday, eday, CASE slot WHEN 2 THEN 14 WHEN 1 THEN NULL ELSE 8 END AS curqa FROM slots s
        WHERE slot = 2 OR (cx, cy) NOT IN (SELECT (cx, cy) FROM slots WHERE slot = 2))
SELECT '1.0' AS version, cx, cy, px, py, sday, eday, CAST(curqa AS BIGINT) AS curqa
FROM spans LEFT JOIN two USING (cx, cy, px, py, sday, eday)
UNION ALL SELECT '2.0', cx, cy, px, py, sday, eday, CAST(curqa AS BIGINT) FROM two""",

    "q47_joins_in_place": _with(OBS, SPANS, PARTPIX) + f"""SELECT cx, cy, px, py, sday, eday, CAST(p_size % 10 AS BIGINT) AS label,
       {R(F32('p_partkey % 45'), 4)} AS slope, {R('CAST(p_size % 2 AS DOUBLE)', 4)} AS mpw,
       {R(F32('p_size'), 2)} AS r0, {R(F32('p_retailprice'), 2)} AS r1
FROM spans JOIN partpix USING (cx, cy, px, py)""",

    "q41_detection_round_trip": _with(OBS, PTS, TILES) + f"""SELECT cx, cy, string_agg({ISO('t')}, ',' ORDER BY t) AS dates
FROM (SELECT DISTINCT cx, cy, o.t FROM obs o JOIN tiles ON {TX('o.cx')} = tx AND {TY('o.cy')} = ty) d GROUP BY cx, cy""",
}
