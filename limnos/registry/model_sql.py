"""The multi-scale count models stated for the checking engine, all candidate models side by side.

Newton's method is a recursive query with a fixed number of rounds; its linear equations are solved by elimination. The
search over bandwidths is unrolled for ``LEVELS`` bandwidths, of which those below the ladder's smallest never run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

COVARIATES = ["TN", "TNsq", "Temp", "Tsq", "Tot_P", "TPsq"]
SIZE = len(COVARIATES) + 1
ROUNDS = 14
LEVELS = 9
SMALLEST = 2500
RIGHT = ["g", *[f"e{q}" for q in range(SIZE)]]

SITES = (
    "SELECT vec_id AS site, label::DOUBLE AS y, embedding[1] * 1e6 AS px, embedding[2] * 1e6 AS py, TN AS x1, TN * TN AS x2, Temp AS x3, "
    "Temp * Temp AS x4, Tot_P AS x5, Tot_P * Tot_P AS x6, {effort} AS off, md5(CAST(vec_id AS VARCHAR))[1:1] IN ('0', '1', '2', '3') AS held "
    "FROM (SELECT *, CAST(embedding[3] AS DOUBLE) AS TN, CAST(embedding[4] AS DOUBLE) AS Temp, CAST(embedding[5] AS DOUBLE) AS Tot_P FROM embeddings)"
)


def _solved(source: str, right: Sequence[str], kept: Sequence[str]) -> str:
    """Solutions {right}d{i} of the symmetric equations h{i}_{j} with right sides {right}_{i}, by elimination."""
    n, keep = SIZE, ", ".join(kept)
    for k in range(n - 1):
        cells = [f"h{i}_{j}" for i in range(k + 1) for j in range(i, n)] + [f"{r}_{i}" for r in right for i in range(k + 1)]
        cells += [f"h{i}_{j} - h{k}_{i} * h{k}_{j} / h{k}_{k} AS h{i}_{j}" for i in range(k + 1, n) for j in range(i, n)]
        cells += [f"{r}_{i} - h{k}_{i} / h{k}_{k} * {r}_{k} AS {r}_{i}" for r in right for i in range(k + 1, n)]
        source = f"(SELECT {keep}, {', '.join(cells)} FROM {source})"
    for i in range(n - 1, -1, -1):
        cells = [f"({r}_{i}{''.join(f' - h{i}_{j} * {r}d{j}' for j in range(i + 1, n))}) / h{i}_{i} AS {r}d{i}" for r in right]
        source = f"(SELECT *, {', '.join(cells)} FROM {source})"
    return source


def _sums(rows: str, at: str, more: str, right: Sequence[str]) -> str:
    """Curvature and gradient of each model at its coefficients; terms a model lacks stand apart from the others."""
    x = ["1", *[f"x{i}" for i in range(1, SIZE)]]
    eta = "off" + "".join(f" + b{i} * {x[i]}" for i in range(SIZE))
    pairs = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]
    b = ", ".join(f"b{i}" for i in range(SIZE))
    same = ", ".join(f"min({c}) AS {c}" for c in (more, *(f"b{i}" for i in range(SIZE))))  # one row of coefficients a model
    inner = (f"(SELECT model, {same}, {', '.join(f'sum(mu * {x[i]} * {x[j]}) AS s{i}_{j}' for i, j in pairs)}, "
             f"{', '.join(f'sum((y - mu) * {x[i]}) AS t{i}' for i in range(SIZE))} "
             f"FROM (SELECT model, {more}, {b}, y, {', '.join(x[1:])}, exp({eta}) AS mu FROM {at} JOIN {rows} USING (model)) GROUP BY model)")
    cells = [f"CASE WHEN k{i} AND k{j} THEN s{i}_{j} ELSE {int(i == j)} END AS h{i}_{j}" for i, j in pairs]
    cells += [f"CASE WHEN k{i} THEN t{i} ELSE 0 END AS g_{i}" for i in range(SIZE)]
    cells += [f"{int(q == i)} AS e{q}_{i}" for q in range(SIZE) for i in range(SIZE) if f"e{q}" in right]
    return f"(SELECT model, {more}, {b}, {', '.join(cells)} FROM {inner} JOIN m USING (model))"


def _newton(name: str, rows: str) -> list[str]:
    """CTEs ``name`` with the coefficients b0 to b6 of each model, and ``name``_error with their standard errors."""
    b, zero = [f"b{i}" for i in range(SIZE)], ", ".join(f"0.0e0 AS b{i}" for i in range(1, SIZE))
    level = f"SELECT model, 0 AS round, ln(greatest(sum(y), 0.5e0) / sum(exp(off))) AS b0, {zero} FROM {rows} GROUP BY model"
    better = _solved(_sums(rows, f"(SELECT * FROM {name}_path WHERE round < {ROUNDS})", "round", ["g"]), ["g"], ["model", "round", *b])
    errors = _solved(_sums(rows, f"(SELECT *, 0 AS round FROM {name})", "round", RIGHT), RIGHT, ["model", "round", *b])
    return [
        f"{name}_path AS ({level} UNION ALL SELECT model, round + 1, {', '.join(f'b{i} + gd{i}' for i in range(SIZE))} FROM {better})",
        f"{name} AS MATERIALIZED (SELECT model, {', '.join(b)} FROM {name}_path WHERE round = {ROUNDS})",
        f"{name}_error AS MATERIALIZED (SELECT model, {', '.join(f'sqrt(e{i}d{i}) AS se{i}' for i in range(SIZE))} FROM {errors})",
    ]


def _around(source: str, columns: tuple[str, ...]) -> str:
    """Weighted sums over the cells around each occupied one."""
    sums, total = ", ".join(f"weight * {c} AS {c}" for c in columns), ", ".join(f"sum({c}) AS {c}" for c in columns)
    spread = f"SELECT model, cx + dx AS cx, cy + dy AS cy, {sums} FROM {source}, o"
    return f"SELECT a.* FROM (SELECT model, cx, cy, {total} FROM ({spread}) GROUP BY model, cx, cy) a JOIN {source} USING (model, cx, cy)"


def _coarse(k: int) -> str:
    factor = 0.5 ** (LEVELS - 1 - k)
    return ", ".join(f"CAST(floor((base_{n} + 0.5e0) * {factor!r}) AS INTEGER) AS c{n}" for n in "xy")


def model_sql(sets: Mapping[str, Sequence[str]], result: str, more: str = "", effort: str = "0.0e0") -> str:
    """CTEs r (rows), lin (first linear parts), g (gain and decision by model and bandwidth), h (held-out cells), f (cells of the
    final fit with the terms s, of which wide, medium), fin and fin_error (last linear parts), p (rows with model, pred and cell), then the result. Models are
    numbered in the order of ``sets``; the result writes ``@model`` for a name."""
    models = ", ".join(f"({i}, true, " + ", ".join(str(c in chosen).lower() for c in COVARIATES) + ")" for i, chosen in enumerate(sets.values()))
    names = "CASE model " + " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(sets)) + " END"
    masks, x = ", ".join(f"k{i}" for i in range(SIZE)), ", ".join(f"x{i}" for i in range(1, SIZE))
    side = f"(widest * {0.5 ** (LEVELS - 1)!r} / 2)"
    steps = [
        "o AS MATERIALIZED (SELECT dx, dy, exp(-(dx * dx + dy * dy) / 8.0e0) AS weight FROM (SELECT CAST(unnest(range(-6, 7)) AS INTEGER) AS dx), "
        "(SELECT CAST(unnest(range(-6, 7)) AS INTEGER) AS dy) WHERE dx * dx + dy * dy <= 36)",
        f"m AS MATERIALIZED (SELECT * FROM (VALUES {models}) AS v(model, {masks}))",
        f"e AS MATERIALIZED ({SITES.format(effort=effort)})",
        "w AS MATERIALIZED (SELECT min(px) AS x0, min(py) AS y0, greatest(max(px) - min(px), max(py) - min(py)) / 2 AS widest FROM e)",
        f"r AS MATERIALIZED (SELECT site, y, {x}, off, held, CAST(floor((px - x0) / {side}) AS INTEGER) AS base_x, CAST(floor((py - y0) / {side}) AS INTEGER) AS base_y FROM e, w)",
        f"tr AS MATERIALIZED (SELECT model, y, off, {x} FROM r, m WHERE NOT held)",
        *_newton("lin", "tr"),
        f"em AS MATERIALIZED (SELECT model, site, y, held, base_x, base_y, exp(off + b0{''.join(f' + b{i} * x{i}' for i in range(1, SIZE))}) AS mu FROM r, lin)",
        "c0 AS MATERIALIZED (SELECT model, base_x, base_y, sum(CASE WHEN held THEN 0 ELSE y END) AS seen, sum(CASE WHEN held THEN 0 ELSE mu END) AS fitted, "
        "sum(CASE WHEN held THEN y ELSE 0 END) AS hseen, sum(CASE WHEN held THEN mu ELSE 0 END) AS hfitted, 0.0e0 AS s, 0 AS fails FROM em GROUP BY ALL)",
        "f0 AS MATERIALIZED (SELECT model, base_x, base_y, sum(y) AS seen, sum(mu) AS fitted, 0.0e0 AS s, 0.0e0 AS wide, 0.0e0 AS medium FROM em GROUP BY ALL)",
    ]
    for k in range(LEVELS):
        band = f"widest * {0.5 ** k!r}"
        step = "ln((a.seen + 1) / (a.fitted + 1))"
        steps += [
            f"p{k} AS MATERIALIZED (SELECT *, {_coarse(k)} FROM c{k})",
            f"q{k} AS MATERIALIZED (SELECT model, cx, cy, sum(seen) AS seen, sum(fitted) AS fitted FROM p{k} GROUP BY ALL)",
            f"a{k} AS MATERIALIZED ({_around(f'q{k}', ('seen', 'fitted'))})",
            f"j{k} AS MATERIALIZED (SELECT p.*, {step} AS step FROM p{k} p JOIN a{k} a USING (model, cx, cy))",
            f"g{k} AS MATERIALIZED (SELECT model, max(fails) < 2 AND ({band} >= {SMALLEST} OR {k} = 0) AS running, sum(hseen * step - hfitted * (exp(step) - 1)) AS gain "
            f"FROM j{k}, w GROUP BY model, widest)",
            f"c{k + 1} AS MATERIALIZED (SELECT model, base_x, base_y, seen, CASE WHEN running AND gain > 0 THEN fitted * exp(step) ELSE fitted END AS fitted, hseen, "
            f"CASE WHEN running AND gain > 0 THEN hfitted * exp(step) ELSE hfitted END AS hfitted, CASE WHEN running AND gain > 0 THEN s + step ELSE s END AS s, "
            f"CASE WHEN NOT running THEN fails WHEN gain > 0 THEN 0 ELSE fails + 1 END AS fails FROM j{k} JOIN g{k} USING (model))",
            f"fp{k} AS MATERIALIZED (SELECT *, {_coarse(k)} FROM f{k})",
            f"fq{k} AS MATERIALIZED (SELECT model, cx, cy, sum(seen) AS seen, sum(fitted) AS fitted FROM fp{k} GROUP BY ALL)",
            f"fa{k} AS MATERIALIZED ({_around(f'fq{k}', ('seen', 'fitted'))})",
            f"f{k + 1} AS MATERIALIZED (SELECT model, base_x, base_y, p.seen, CASE WHEN running AND gain > 0 THEN p.fitted * exp({step}) ELSE p.fitted END AS fitted, "
            f"CASE WHEN running AND gain > 0 THEN s + {step} ELSE s END AS s, "
            f"CASE WHEN running AND gain > 0 AND {band} >= 100000 THEN wide + {step} ELSE wide END AS wide, "
            f"CASE WHEN running AND gain > 0 AND {band} >= 10000 AND {band} < 100000 THEN medium + {step} ELSE medium END AS medium "
            f"FROM fp{k} p JOIN fa{k} a USING (model, cx, cy) JOIN g{k} USING (model), w)",
        ]
    gains = " UNION ALL ".join(f"SELECT model, {k} AS k, widest * {0.5 ** k!r} AS band, gain, running, running AND gain > 0 AS selected FROM g{k}, w" for k in range(LEVELS))
    steps += [
        f"g AS MATERIALIZED ({gains})",
        f"h AS MATERIALIZED (SELECT model, y, y - mu * exp(s) AS error FROM em JOIN c{LEVELS} USING (model, base_x, base_y) WHERE held)",
        f"f AS MATERIALIZED (SELECT * FROM f{LEVELS})",
        f"fr AS MATERIALIZED (SELECT model, site, y, off + s AS off, {x}, base_x, base_y FROM r JOIN f USING (base_x, base_y))",
        *_newton("fin", "fr"),
        f"narrow AS MATERIALIZED (SELECT coalesce(max(k) FILTER (selected), 0) AS last FROM g)",
        f"p AS MATERIALIZED (SELECT model, site, y, exp(off + b0{''.join(f' + b{i} * x{i}' for i in range(1, SIZE))}) AS pred, "
        f"CAST(floor((base_x + 0.5e0) * power(0.5e0, {LEVELS - 1} - last)) AS INTEGER) AS cx, CAST(floor((base_y + 0.5e0) * power(0.5e0, {LEVELS - 1} - last)) AS INTEGER) AS cy "
        "FROM fr JOIN fin USING (model), narrow)",
    ]
    return f"WITH RECURSIVE {', '.join(steps)}{', ' + more if more else ''} {result.replace('@model', names)}"


SPREAD = ("v AS MATERIALIZED (SELECT model, cx, cy, sum((y - pred) * (y - pred)) AS squared, count(*)::DOUBLE AS n FROM p GROUP BY ALL), "
          f"va AS MATERIALIZED ({_around('v', ('squared', 'n'))})")

SLOPES = "sl AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT model, {i} AS place, '{name}' AS var, b{i} AS coef, b{i} - 1.959963984540054e0 * se{i} AS low, b{i} + 1.959963984540054e0 * se{i} AS high "
    f"FROM fin JOIN fin_error USING (model) JOIN m USING (model) WHERE k{i}" for i, name in enumerate(["(Intercept)", *COVARIATES])) + ")"
COEFFICIENTS = "SELECT @model AS model, var, round(coef, 6) + 0.0e0 AS coef, round(low, 6) + 0.0e0 AS lower_95CI, round(high, 6) + 0.0e0 AS upper_95CI FROM sl"

R2 = "r2 AS MATERIALIZED (SELECT model, 1 - sum(error * error) / (var_pop(y) * count(*)) AS r2, sqrt(avg(error * error)) AS rmse, avg(abs(error)) AS mae FROM h GROUP BY model)"
SHORT = "replace(replace({}, 'Tot_P', 'TP'), 'Temp', 'T')"
LABEL = f"replace(regexp_replace(replace({SHORT}, 'sq', '(^2'), ';[A-Za-z]{{{{1,2}}}}[(]', '', 'g'), ';', ' + ')"
LAST = f"(SELECT greatest(max(k), 0) AS last FROM w, (SELECT unnest(range({LEVELS})) AS k) WHERE widest * power(0.5e0, k) >= {SMALLEST} OR k = 0)"
