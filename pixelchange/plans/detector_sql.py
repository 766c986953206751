"""The whole detector as DuckDB SQL, written apart from ``operators``.

Rounds are unrolled.  Models come from cofactors of the normal equations
(the engine factorises them), errors from the residuals themselves (the
engine expands the quadratic form), breaks from windows over every row
(the engine numbers islands of flagged rows).  The last table says whether
some pixel would need one round more; a query that sees it fails.
"""

from __future__ import annotations

YEAR = 365.25
TURN = 2.0 * 3.141592653589793 / YEAR
REGRESSORS = ["1.0::DOUBLE", f"(t - t0) / {YEAR!r}::DOUBLE"] + [f"{f}({h * TURN!r}::DOUBLE * t)" for h in (1, 2, 3) for f in ("cos", "sin")]


def _det(m: list[list[str]]) -> str:
    """Determinant of a matrix of SQL terms, by its first row."""
    if len(m) == 1:
        return m[0][0]
    parts = []
    for j, a in enumerate(m[0]):
        minor = [[x for k, x in enumerate(row) if k != j] for row in m[1:]]
        parts.append(f"{'-' if j % 2 else '+'} {a} * ({_det(minor)})")
    return "(" + " ".join(parts) + ")"


def _fit(name: str, rows: str, where: str, p, carry: str = "", having: str = "") -> list[str]:
    """Tables {name}_s (sums), {name}_b (coefficients) and {name} (with errors)
    of the rows of ``rows`` that meet ``where``, per pixel."""
    if p.orders:
        return _fit_by_elimination(name, rows, where, p, carry, having)
    k = p.terms
    sums = [f"count(*) FILTER (WHERE {where}) AS nfit"]
    sums += [f"sum(x{i} * x{j}) FILTER (WHERE {where}) AS q{i}{j}" for i in range(k) for j in range(i, k)]
    sums += [f"sum(x{i} * {b}) FILTER (WHERE {where}) AS w_{b}_{i}" for b in p.bands for i in range(k)]
    m = [[f"q{min(i, j)}{max(i, j)}" if i != j or i == 0 else f"(q{i}{i} + {p.ridge!r}::DOUBLE)" for j in range(k)] for i in range(k)]
    cof = []
    for i in range(k):
        for j in range(i, k):
            minor = [[x for c, x in enumerate(row) if c != j] for r, row in enumerate(m) if r != i]
            cof.append(f"{'-' if (i + j) % 2 else ''}{_det(minor) if minor else '1.0'} AS c{i}{j}")
    det = " + ".join(f"{m[0][j]} * c0{j}" for j in range(k))
    b = [f"({' + '.join(f'c{min(i, j)}{max(i, j)} * w_{x}_{j}' for j in range(k))}) / det AS b_{x}_{i}" for x in p.bands for i in range(k)]
    error = [f"sqrt(sum(pow({x} - ({' + '.join(f'b_{x}_{i} * x{i}' for i in range(k))}), 2)) / greatest(any_value(nfit) - {k}, 1)) AS rmse_{x}" for x in p.bands]
    return [
        f"{name}_s AS MATERIALIZED (SELECT px, py, {carry} {', '.join(sums)} FROM {rows} GROUP BY px, py {having})",
        f"{name}_b AS MATERIALIZED (SELECT *, {', '.join(cof)}, {det} AS det, {', '.join(b)} FROM {name}_s)",
        f"{name}_e AS MATERIALIZED (SELECT px, py, {', '.join(error)} FROM {rows} JOIN {name}_b USING (px, py) WHERE {where} GROUP BY px, py)",
        f"{name} AS MATERIALIZED (SELECT * FROM {name}_b JOIN {name}_e USING (px, py))"]


def _fit_by_elimination(name: str, rows: str, where: str, p, carry: str = "", having: str = "") -> list[str]:
    """The same tables for models whose order follows the number of rows (``ord``):
    Gaussian elimination, one step a table, of the equations cut to that order."""
    k = p.terms
    steps = " ".join(f"WHEN nfit >= {3 * x} THEN {x}" for x in sorted(p.orders, reverse=True))
    sums = [f"count(*) FILTER (WHERE {where}) AS nfit"]
    sums += [f"sum(x{i} * x{j}) FILTER (WHERE {where}) AS q{i}{j}" for i in range(k) for j in range(i, k)]
    sums += [f"sum(x{i} * {b}) FILTER (WHERE {where}) AS w_{b}_{i}" for b in p.bands for i in range(k)]
    a = [f"CASE WHEN ord > {j} THEN q{i}{j} + {p.ridge if i == j > 0 else 0.0!r}::DOUBLE ELSE {float(i == j)!r}::DOUBLE END AS a{i}{j}" for i in range(k) for j in range(i, k)]
    r = [f"CASE WHEN ord > {i} THEN w_{b}_{i} ELSE 0.0 END AS r_{b}_{i}" for b in p.bands for i in range(k)]
    out = [f"{name}_s AS MATERIALIZED (SELECT *, CASE {steps} ELSE {min(p.orders)} END AS ord FROM (SELECT px, py, {carry} {', '.join(sums)} FROM {rows} GROUP BY px, py {having}) q)",
           f"{name}_0 AS MATERIALIZED (SELECT px, py, {', '.join(a + r)} FROM {name}_s)"]
    for c in range(k - 1):
        less = [f"a{i}{j} - a{c}{i} * a{c}{j} / a{c}{c} AS a{i}{j}" for i in range(c + 1, k) for j in range(i, k)]
        less += [f"r_{b}_{i} - a{c}{i} * r_{b}_{c} / a{c}{c} AS r_{b}_{i}" for b in p.bands for i in range(c + 1, k)]
        out.append(f"{name}_{c + 1} AS MATERIALIZED (SELECT * REPLACE ({', '.join(less)}) FROM {name}_{c})")
    last = f"{name}_{k - 1}"
    for c in reversed(range(k)):
        back = [f"(r_{b}_{c}{''.join(f' - a{c}{j} * b_{b}_{j}' for j in range(c + 1, k))}) / a{c}{c} AS b_{b}_{c}" for b in p.bands]
        out.append(f"{name}_u{c} AS MATERIALIZED (SELECT *, {', '.join(back)} FROM {last})")
        last = f"{name}_u{c}"
    coefs = ", ".join(f"b_{b}_{i}" for b in p.bands for i in range(k))
    error = [f"sqrt(sum(pow({x} - ({' + '.join(f'b_{x}_{i} * x{i}' for i in range(k))}), 2)) / greatest(any_value(nfit) - any_value(ord), 1)) AS rmse_{x}" for x in p.bands]
    extra = "".join(f", {c.strip().split(' AS ')[-1]}" for c in carry.split(",") if c.strip())
    return out + [
        f"{name}_b AS MATERIALIZED (SELECT px, py, nfit, ord{extra}, {coefs} FROM {name}_s JOIN {last} USING (px, py))",
        f"{name}_e AS MATERIALIZED (SELECT px, py, {', '.join(error)} FROM {rows} JOIN {name}_b USING (px, py) WHERE {where} GROUP BY px, py)",
        f"{name} AS MATERIALIZED (SELECT * FROM {name}_b JOIN {name}_e USING (px, py))"]


def screened(p, source: str, out: str) -> list[str]:
    """Table ``out``: the rows of ``source`` that local robust fits leave (D9), all
    rounds written one after another; {out}_r has the residuals."""
    bands = [b for b, _ in p.screen]
    c, s = REGRESSORS[2], REGRESSORS[3]
    ctes = [f"{out}_0 AS MATERIALIZED (SELECT *, {c} AS c, {s} AS s{''.join(f', 1.0::DOUBLE AS w_{b}' for b in bands)} FROM {source})"]
    near = {"a": f"OVER (PARTITION BY px, py ORDER BY t ROWS BETWEEN {p.screen_rows - 1} PRECEDING AND CURRENT ROW)",
            "z": f"OVER (PARTITION BY px, py ORDER BY t ROWS BETWEEN CURRENT ROW AND {p.screen_rows - 1} FOLLOWING)"}
    # determinants of the three equations, the ridge on the harmonic
    for r in range(p.screen_rounds + 1):
        sums, off = [], []
        for b in bands:
            for side, over in near.items():
                t, w = f"{side}_{b}", f"w_{b}"
                for name, x in {"n": f"CAST({w} > 0 AS INTEGER)", "w": w, "c": f"{w} * c", "s": f"{w} * s", "cc": f"{w} * c * c", "cs": f"{w} * c * s",
                                "ss": f"{w} * s * s", "y": f"{w} * {b}", "yc": f"{w} * {b} * c", "ys": f"{w} * {b} * s"}.items():
                    sums.append(f"sum({x}) {over} AS {t}_{name}")
                m = [[f"{t}_w", f"{t}_c", f"{t}_s"], [f"{t}_c", f"({t}_cc + 0.01::DOUBLE)", f"{t}_cs"], [f"{t}_s", f"{t}_cs", f"({t}_ss + 0.01::DOUBLE)"]]
                v = [f"{t}_y", f"{t}_yc", f"{t}_ys"]
                top = [_det([[v[i] if j == k else m[i][j] for j in range(3)] for i in range(3)]) for k in range(3)]
                off.append(f"CASE WHEN {t}_n >= 6 THEN {b} - ({top[0]} + {top[1]} * c + {top[2]} * s) / {_det(m)} END AS o_{t}")
        ctes.append(f"{out}_w{r} AS MATERIALIZED (SELECT *, {', '.join(sums)} FROM {out}_{r})")
        ctes.append(f"{out}_o{r} AS MATERIALIZED (SELECT *, {', '.join(off)} FROM {out}_w{r})")
        least = ", ".join(f"CASE WHEN o_a_{b} IS NULL THEN o_z_{b} WHEN o_z_{b} IS NULL OR abs(o_a_{b}) <= abs(o_z_{b}) THEN o_a_{b} ELSE o_z_{b} END AS r_{b}" for b in bands)
        ctes.append(f"{out}_l{r} AS MATERIALIZED (SELECT px, py, t, c, s, {least} FROM {out}_o{r})")
        ctes.append(f"{out}_m{r} AS MATERIALIZED (SELECT px, py, {', '.join(f'median(abs(r_{b})) AS m_{b}' for b in bands)} FROM {out}_l{r} GROUP BY px, py)")
        weight = ", ".join(f"CASE WHEN r_{b} IS NULL OR m_{b} <= 0 THEN 1.0 WHEN abs(r_{b}) < 6 * m_{b} THEN pow(1 - pow(r_{b} / (6 * m_{b}), 2), 2) ELSE 0.0 END AS w_{b}" for b in bands)
        ctes.append(f"{out}_{r + 1} AS MATERIALIZED (SELECT k.*, l.c, l.s, {weight} FROM {source} k JOIN {out}_l{r} l USING (px, py, t) JOIN {out}_m{r} USING (px, py))")
    r = p.screen_rounds
    steps = ", ".join(f"abs({b} - lag({b}) OVER (PARTITION BY px, py ORDER BY t)) AS d_{b}" for b in bands)
    ctes.append(f"{out}_d AS MATERIALIZED (SELECT px, py, {', '.join(f'median(d_{b}) AS d_{b}' for b in bands)} FROM (SELECT px, py, {steps} FROM {source}) q GROUP BY px, py)")
    limit = {b: f"greatest(1.4826::DOUBLE * m_{b}, coalesce(d_{b}, 0))" for b in bands}
    bad = " OR ".join(f"coalesce({limit[b]} > 0 AND {float(side)!r} * r_{b} > {p.screen_factor!r} * {limit[b]}, FALSE)" for b, side in p.screen)
    ctes.append(f"{out}_r AS MATERIALIZED (SELECT px, py, t, {bad} AS cloudy FROM {out}_l{r} JOIN {out}_m{r} USING (px, py) LEFT JOIN {out}_d USING (px, py))")
    ctes.append(f"{out} AS MATERIALIZED (SELECT k.* FROM {source} k JOIN {out}_r USING (px, py, t) WHERE NOT cloudy)")
    return ctes


def stable_start(p, rows: str, out: str) -> list[str]:
    """Table ``out``: (px, py, s, ts), the first row of the first stable window of each
    pixel of ``rows`` (with x0..x3); every window is joined with its rows."""
    bands, span, k = p.detection_bands, p.min_years * YEAR, 4
    m = [[f"q{min(i, j)}{max(i, j)}" if i != j or i == 0 else f"(q{i}{i} + {p.ridge!r}::DOUBLE)" for j in range(k)] for i in range(k)]
    cof = [f"{'-' if (i + j) % 2 else ''}{_det([[x for c, x in enumerate(row) if c != j] for r, row in enumerate(m) if r != i])} AS c{i}{j}" for i in range(k) for j in range(i, k)]
    det = " + ".join(f"{m[0][j]} * c0{j}" for j in range(k))
    coef = [f"({' + '.join(f'c{min(i, j)}{max(i, j)} * w_{b}_{j}' for j in range(k))}) / det AS b_{b}_{i}" for b in bands for i in range(k)]
    sums = ["count(*) AS nfit"] + [f"sum(x{i} * x{j}) AS q{i}{j}" for i in range(k) for j in range(i, k)] + [f"sum(x{i} * {b}) AS w_{b}_{i}" for b in bands for i in range(k)]
    off = {b: f"({b} - ({' + '.join(f'b_{b}_{i} * x{i}' for i in range(k))}))" for b in bands}
    floor = {b: f"greatest(e_{b}, vario_{b})" if p.variogram_floor else f"e_{b}" for b in bands}
    mean = lambda f: " + ".join(f"CASE WHEN {floor[b]} > 0 THEN abs({f(b)}) / ({p.stable_sigma!r} * {floor[b]}) ELSE 0.0 END" for b in bands)
    tests = [mean(f) for f in (lambda b: f"slope_{b} * (end_t - ts) / {YEAR!r}", lambda b: f"first_{b}", lambda b: f"last_{b}")]
    vario = "".join(f", any_value(vario_{b}) AS vario_{b}" for b in bands) if p.variogram_floor else ""
    return [
        f"{out}_n AS MATERIALIZED (SELECT px, py, max(n) AS top, max(t) AS top_t FROM {rows} GROUP BY px, py)",
        f"{out}_c AS MATERIALIZED (SELECT px, py, n AS s, t AS ts FROM {rows} JOIN {out}_n USING (px, py) WHERE n + {p.min_obs - 1} <= top AND top_t - t >= {span!r})",
        f"{out}_w AS MATERIALIZED (SELECT c.s, c.ts, r.* FROM {out}_c c JOIN {rows} r USING (px, py) WHERE r.n >= c.s AND (r.n < c.s + {p.min_obs} OR r.t - c.ts < {span!r}))",
        f"{out}_s AS MATERIALIZED (SELECT px, py, s, {', '.join(sums)} FROM {out}_w GROUP BY px, py, s)",
        f"{out}_d AS MATERIALIZED (SELECT *, {', '.join(cof)}, {det} AS det FROM {out}_s)",
        f"{out}_b AS MATERIALIZED (SELECT px, py, s, nfit, {', '.join(coef)} FROM {out}_d)",
        f"""{out}_t AS MATERIALIZED (SELECT px, py, s, any_value(ts) AS ts, max(t) AS end_t{vario},
         {', '.join(f'sqrt(sum(pow({off[b]}, 2)) / greatest(any_value(nfit) - {k}, 1)) AS e_{b}, any_value(b_{b}_1) AS slope_{b}, arg_min({off[b]}, n) AS first_{b}, arg_max({off[b]}, n) AS last_{b}' for b in bands)}
         FROM {out}_w JOIN {out}_b USING (px, py, s) GROUP BY px, py, s)""",
        f"{out} AS MATERIALIZED (SELECT px, py, min(s) AS s, min(ts) AS ts FROM {out}_t WHERE {' AND '.join(f'({t}) <= {len(bands)}' for t in tests)} GROUP BY px, py)"]


def _flag(name: str, rows: str, model: str, p) -> list[str]:
    """``rows`` with ``flag``, and the row ``brk`` at which a run of p.peek flags begins."""
    def term(x):
        floor = f"greatest(rmse_{x}, vario_{x})" if p.variogram_floor else f"rmse_{x}"
        off = f"({x} - ({' + '.join(f'm.b_{x}_{i} * x{i}' for i in range(p.terms))}))"
        return f"CASE WHEN {floor} > 0 THEN pow({off} / ({floor}), 2) ELSE 0.0 END"

    ahead = f"OVER (PARTITION BY px, py ORDER BY n ROWS BETWEEN CURRENT ROW AND {p.peek - 1} FOLLOWING)"
    if p.stable:
        behind = f"OVER (PARTITION BY px, py ORDER BY n ROWS BETWEEN {p.peek - 1} PRECEDING AND CURRENT ROW)"
        return [
            f"""{name}_f AS MATERIALIZED (SELECT r.*, CASE WHEN (r.n > r.n_init OR r.n < 1) AND ({' + '.join(term(x) for x in p.detection_bands)}) > {p.threshold!r} THEN 1 ELSE 0 END AS flag
             FROM {rows} r JOIN {model} m USING (px, py))""",
            f"""{name}_r AS MATERIALIZED (SELECT *, CASE WHEN n >= 1 AND min(flag) {ahead} = 1 AND count(*) {ahead} = {p.peek} THEN n END AS begins,
             CASE WHEN n < 1 AND min(flag) {behind} = 1 AND count(*) {behind} = {p.peek} THEN n END AS ends FROM {name}_f)""",
            f"{name} AS MATERIALIZED (SELECT * EXCLUDE (begins, ends), min(begins) OVER (PARTITION BY px, py) AS brk, max(ends) OVER (PARTITION BY px, py) AS back FROM {name}_r)"]
    return [
        f"""{name}_f AS MATERIALIZED (SELECT r.*, CASE WHEN r.n > r.n_init AND ({' + '.join(term(x) for x in p.detection_bands)}) > {p.threshold!r} THEN 1 ELSE 0 END AS flag
         FROM {rows} r JOIN {model} m USING (px, py))""",
        f"{name}_r AS MATERIALIZED (SELECT *, CASE WHEN min(flag) {ahead} = 1 AND count(*) {ahead} = {p.peek} THEN n END AS begins FROM {name}_f)",
        f"{name} AS MATERIALIZED (SELECT * EXCLUDE (begins), min(begins) OVER (PARTITION BY px, py) AS brk FROM {name}_r)"]


def _coefs(p) -> str:
    """Coefficients; after a look-back the intercept is taken at the segment's first day."""
    moved = lambda b, i: f"b_{b}_0 + b_{b}_1 * (sday_n - t0) / {YEAR!r} AS b_{b}_0" if p.stable and i == 0 else f"b_{b}_{i}"
    return ", ".join(moved(b, i) for b in p.bands for i in range(p.terms))


def detector_ctes(p, source: str = "obs", rounds: int = 5) -> list[str]:
    """Tables ``segs`` (a row per segment), ``used`` (px, py, t) and ``unfinished``."""
    bands, span = ", ".join(p.bands), p.min_years * YEAR
    clear = " AND ".join([f"{b} IS NOT NULL AND {b} <> {p.fill}" for b in p.bands] + ([f"({p.qa} & 41) = 0"] if p.qa else []))
    out = [f"{'seen' if p.screen else 'clear'} AS MATERIALIZED (SELECT cx, cy, px, py, t, {bands} FROM {source} WHERE {clear})"]
    if p.screen:
        out += screened(p, "seen", "clear")
    start = f"SELECT c.*, row_number() OVER (PARTITION BY px, py ORDER BY t) AS n, min(t) OVER (PARTITION BY px, py) AS t0"
    if p.variogram_floor:
        out.append("steps AS (SELECT px, py, " + ", ".join(f"abs({b} - lag({b}) OVER (PARTITION BY px, py ORDER BY t)) AS {b}" for b in p.bands) + " FROM clear)")
        out.append("vario AS MATERIALIZED (SELECT px, py, " + ", ".join(f"coalesce(median({b}), 0.0) AS vario_{b}" for b in p.bands) + " FROM steps GROUP BY px, py)")
        out.append(f"a1 AS MATERIALIZED ({start}, vario.* EXCLUDE (px, py) FROM clear c JOIN vario USING (px, py))")
    else:
        out.append(f"a1 AS MATERIALIZED ({start} FROM clear c)")
    for r in range(1, rounds + 1):
        xs = ", ".join(f"{x} AS x{i}" for i, x in enumerate(REGRESSORS[:p.terms]))
        first = f"(n <= {p.min_obs} OR t - t0 < {span!r})"
        if p.stable:
            first = f"(n >= 1 AND {first})"
            out.append(f"v{r} AS MATERIALIZED (SELECT *, {', '.join(f'{x} AS x{i}' for i, x in enumerate(REGRESSORS[:4]))} FROM a{r})")
            out += stable_start(p, f"v{r}", f"st{r}")
            out.append(f"b{r} AS MATERIALIZED (SELECT a.* REPLACE (n - s + 1 AS n, ts AS t0) FROM a{r} a JOIN st{r} USING (px, py))")
        out.append(f"x{r} AS MATERIALIZED (SELECT *, {xs} FROM {'b' if p.stable else 'a'}{r})")
        out += _fit(f"i{r}", f"x{r}", first, p, "max(n) AS last_n,", f"HAVING count(*) FILTER (WHERE {first}) >= {p.min_obs} AND max(t) - min(t0) >= {span!r}")
        out.append(f"y{r} AS MATERIALIZED (SELECT x.*, m.nfit AS n_init, m.last_n FROM x{r} x JOIN i{r} m USING (px, py))")
        out += _flag(f"z{r}_0{'a' if p.stable else ''}", f"y{r}", f"i{r}", p)
        if p.stable:
            out.append(f"z{r}_0 AS MATERIALIZED (SELECT * EXCLUDE (back) FROM z{r}_0a WHERE back IS NULL OR n > back)")
        for k in range(1, p.refine + 1):
            out += _fit(f"r{r}_{k}", f"z{r}_{k - 1}", "(brk IS NULL OR n < brk) AND flag = 0", p)
            out += _flag(f"z{r}_{k}", f"(SELECT * EXCLUDE (flag, brk) FROM z{r}_0)" if p.stable else f"y{r}", f"r{r}_{k}", p)
        scored = f"z{r}_{p.refine}"
        out += _fit(f"f{r}", scored, "(brk IS NULL OR n < brk) AND flag = 0", p)
        peeked = ", ".join(f"median({b} - ({' + '.join(f'm.b_{b}_{i} * x{i}' for i in range(p.terms))})) AS mag_{b}" for b in p.bands)
        out += [
            f"p{r} AS MATERIALIZED (SELECT px, py, {peeked} FROM {scored} s JOIN f{r} m USING (px, py) WHERE s.n >= s.brk AND s.n < s.brk + {p.peek} GROUP BY px, py)",
            f"""h{r} AS MATERIALIZED (SELECT px, py, any_value(cx) AS cx, any_value(cy) AS cy, min(t) AS sday_n, max(t) FILTER (WHERE brk IS NULL OR n < brk) AS eday_n,
         any_value(t0) AS t0, min(t) FILTER (WHERE n = brk) AS brk_t, any_value(last_n) - max(n) FILTER (WHERE flag = 0) AS tail FROM {scored} GROUP BY px, py)""",
            f"""g{r} AS (SELECT cx, cy, px, py, {r} AS seg, sday_n, eday_n, coalesce(brk_t, eday_n) AS bday_n, brk_t, nfit AS nobs, {'ord' if p.orders else p.terms} AS curqa,
         CASE WHEN brk_t IS NOT NULL THEN 1.0 ELSE least(tail, {p.peek}) / {float(p.peek)!r} END AS chprob,
         {', '.join(f'CASE WHEN brk_t IS NOT NULL THEN mag_{b} ELSE 0.0 END AS mag_{b}, rmse_{b}' for b in p.bands)},
         {_coefs(p)}
         FROM h{r} JOIN f{r} USING (px, py) LEFT JOIN p{r} USING (px, py))""",
            f"""a{r + 1} AS MATERIALIZED (SELECT cx, cy, px, py, t, {bands}, n - brk + 1 AS n, min(t) FILTER (WHERE n = brk) OVER (PARTITION BY px, py) AS t0
         {''.join(f', vario_{b}' for b in p.bands) if p.variogram_floor else ''} FROM {scored} WHERE n >= brk)"""]
    scored = [f"z{r}_{p.refine}" for r in range(1, rounds + 1)]
    if p.stable:
        peeked = ", ".join(f"median({b} - ({' + '.join(f'm.b_{b}_{i} * x{i}' for i in range(p.terms))})) AS mag_{b}" for b in p.bands)
        out.append("early AS MATERIALIZED (SELECT * FROM z1_0a WHERE back IS NOT NULL)")
        out += _fit("f0", "early", "n <= back", p)
        out += [f"p0 AS MATERIALIZED (SELECT px, py, {peeked} FROM early s JOIN f0 m USING (px, py) WHERE s.n > s.back AND s.n <= s.back + {p.peek} GROUP BY px, py)",
                """h0 AS MATERIALIZED (SELECT px, py, any_value(cx) AS cx, any_value(cy) AS cy, min(t) AS sday_n, max(t) FILTER (WHERE n <= back) AS eday_n,
         any_value(t0) AS t0, min(t) FILTER (WHERE n > back) AS brk_t FROM early GROUP BY px, py)""",
                f"""g0 AS (SELECT cx, cy, px, py, 0 AS seg, sday_n, eday_n, brk_t AS bday_n, brk_t, nfit AS nobs, 14 AS curqa, 1.0 AS chprob,
         {', '.join(f'mag_{b}, rmse_{b}' for b in p.bands)}, {_coefs(p)} FROM h0 JOIN f0 USING (px, py) JOIN p0 USING (px, py))"""]
    out += ["segs AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM g{r}" for r in range(0 if p.stable else 1, rounds + 1)) + ")",
            "used AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT px, py, t FROM {z} WHERE (brk IS NULL OR n < brk) AND flag = 0" for z in scored) + ")",
            f"unfinished AS (SELECT count(*) AS n FROM a{rounds + 1} WHERE n = {p.min_obs})"]
    return out


# Put into a query's WHERE: an error instead of a short result.
FINISHED = "(SELECT CASE WHEN n > 0 THEN error('a pixel needs more rounds') ELSE TRUE END FROM unfinished)"
