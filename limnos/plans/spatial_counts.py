"""Multi-scale spatial Poisson models, all candidate models fitted side by side.

The log mean of a count is a linear part plus one spatial term per selected bandwidth. Bandwidths are
visited from wide to narrow. At each, the local ratio of observed to fitted counts around a cell (the
local maximum-likelihood level of a Poisson model with known exposure) is added to the log mean, if it
raises the likelihood of rows held out by a hash of their id. After a number of failures in a row a
model stops.

For a Poisson mean the sums of observed and fitted counts per cell are all that the spatial terms
depend on. Cells of a bandwidth are halved for the next, so they form a pyramid: the sums of a level
are those of the level below added up, and the terms of wider bandwidths are the same for all of a
cell. A level therefore works on its own occupied cells, with one number from each cell's parent; it
never touches finer ones, and no empty cell is built. Levels are summed from the rows a few at a time,
as far down as some model still gains.

The candidate model is one more grouping key: the search takes as many rounds as a single model does.
The linear parts of all models are fitted together too: a round of Newton's method is one aggregate
over the rows, in which each row adds to the gradient and curvature of every model.

Kernel, ladder, stopping rule and the standard deviation are choices of this package. They follow the
coarse-to-fine idea and give the same kinds of results; figures differ from other implementations.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos import fixed_values as fixed
from limnos.functions import text, values
from limnos.operators.aggregates import column_means
from limnos.operators.joins import lookup_join
from limnos.operators.lattice import SMALLEST_BAND, Ladder, bandwidth_ladder, smooth_cells, with_cells
from limnos.operators.reshape import scores_wide
from limnos.operators.sets import append
from limnos.session import cut_lineage

NULL_MODEL = "Null"
PRIOR_COUNT = 1.0
HOLDOUT_DIGITS = ["0", "1", "2", "3"]  # first digit of the hashed id: a quarter of the rows
WALD_95 = 1.959963984540054
STATS = ["R2", "RMSE", "MAE"]
MOST_ROUNDS = 100  # of a regression; one that needs more is an error
CLOSE = 1e-8  # standard errors, below which a step is the last
INTERCEPT = "(Intercept)"

Sets = Mapping[str, Sequence[str]]


@dataclass(frozen=True)
class ModelData:
    """Where the columns of a model are found."""

    id: str
    label: str
    x: str
    y: str
    log_effort: str | None = None


@dataclass
class LinearPart:
    """Intercept and slopes of one model, with standard errors where they are known."""

    intercept: float
    slopes: dict[str, float] = field(default_factory=dict)
    errors: dict[str, float] = field(default_factory=dict)

    def eta(self) -> Column:
        out = F.lit(self.intercept)
        for name, slope in self.slopes.items():
            out = out + F.lit(slope) * F.col(f"`{name}`")
        return out


@dataclass
class Selection:
    """What holdout validation found: per model the starting linear part, bandwidths and scores."""

    data: ModelData
    sets: Sets
    ladder: Ladder
    family: str
    linear: dict[str, LinearPart]
    bands: dict[str, list[float]]
    gains: dict[str, dict[float, float]]
    scores: DataFrame


@dataclass
class SpatialFit:
    """Result tables of the fitted models."""

    selection: Selection
    linear: dict[str, LinearPart]
    cells: DataFrame  # model, cx, cy, parts: one term for each visited bandwidth
    rows: DataFrame
    level: int  # of the ladder, to which the cells belong
    visited: list[float]


# ------------------------------------------------------------------ shared steps


def _prepare(df: DataFrame, data: ModelData, sets: Sets) -> DataFrame:
    """Narrow, complete model rows with their holdout flag."""
    names = sorted({c for chosen in sets.values() for c in chosen})
    effort = F.col(data.log_effort).cast("double") if data.log_effort else F.lit(0.0)
    rows = df.select(
        F.col(data.id), F.col(data.label).cast("double").alias("_y"), effort.alias("_effort"),
        F.col(data.x).cast("double").alias("_px"), F.col(data.y).cast("double").alias("_py"),
        *[F.col(c).cast("double").alias(c) for c in names],
    ).dropna()
    held = F.substring(F.md5(F.col(data.id).cast("string")), 1, 1).isin(*HOLDOUT_DIGITS)
    return rows.withColumn("_held", held)


def _in_cells(rows: DataFrame, ladder: Ladder, level: int) -> DataFrame:
    return with_cells(rows, "_px", "_py", ladder.origin, ladder.side(level))


def _levels_start(data: DataFrame, count: int) -> list[tuple[float, float]]:
    """(observed count, exposure) of each model."""
    sums = data.select("_y", F.posexplode("_offsets").alias("k", "offset")).groupBy("k").agg(F.sum("_y").alias("y"), F.sum(F.exp("offset")).alias("e"))
    found = {r["k"]: (r["y"], r["e"]) for r in sums.collect()}
    if len(found) < count:
        raise ValueError("no complete rows to fit")
    return [found[k] for k in range(count)]


def _newton_sums(data: DataFrame, names: Sequence[str], at: Mapping[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Log likelihood, gradient and curvature of each model at its coefficients, by one aggregate over the rows.

    A row is repeated for each model inside its task; what is shuffled is one row for each task and model. Coefficients
    come in as one constant array, so all rounds share their generated code.
    """
    models = F.array(*[F.struct(F.lit(k).alias("_k"), F.array(*[F.lit(float(v)) for v in b]).alias("_b")) for k, b in at.items()])
    x = [F.lit(1.0), *[F.col(f"`{n}`") for n in names]]
    eta = F.get("_offsets", F.col("_k"))
    for j, value in enumerate(x):
        eta = eta + F.get("_b", F.lit(j)) * value
    each = data.select("*", F.inline(models)).withColumn("_eta", eta).withColumn("_mu", F.exp("_eta"))
    mu, rest = F.col("_mu"), F.col("_y") - F.col("_mu")
    n = len(x)
    sums = each.groupBy("_k").agg(
        F.sum(F.col("_y") * F.col("_eta") - mu).alias("likelihood"), *[F.sum(rest * x[i]).alias(f"g{i}") for i in range(n)],
        *[F.sum(mu * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(n) for j in range(i, n)])
    out = {}
    for r in sums.collect():
        curvature = np.array([[r[f"h{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)])
        out[r["_k"]] = (r["likelihood"], np.array([r[f"g{i}"] for i in range(n)]), curvature)
    return out


def _inverse(curvature: np.ndarray) -> np.ndarray:
    """Of the curvature in units of its diagonal; terms that cannot be told apart share their effect."""
    scale = 1.0 / np.sqrt(np.maximum(np.diag(curvature), 1e-300))
    return np.linalg.pinv(curvature * np.outer(scale, scale), rcond=1e-12, hermitian=True) * np.outer(scale, scale)


def _fit_jointly(rows: DataFrame, sets: Sets, offsets: Column) -> dict[str, LinearPart]:
    """Poisson regressions on the log scale, all models in each round; ``offsets`` has one number for each of them.

    Newton's method from the level alone; a step that lowers the likelihood is halved. A model is done when its next step
    is below ``CLOSE`` standard errors. Without covariates the level is the result.
    """
    names = sorted({c for chosen in sets.values() for c in chosen})
    data = rows.select("_y", offsets.alias("_offsets"), *[f"`{c}`" for c in names])
    out: dict[str, LinearPart] = {}
    places: dict[int, list[int]] = {}
    at: dict[int, np.ndarray] = {}
    for k, ((model, chosen), (counted, exposed)) in enumerate(zip(sets.items(), _levels_start(data, len(sets)))):
        counted = max(counted, 0.5)
        level = math.log(counted / exposed)
        out[model] = LinearPart(level, {}, {INTERCEPT: 1.0 / math.sqrt(counted)})
        if chosen:
            places[k] = [0, *(1 + names.index(c) for c in chosen)]
            at[k] = np.array([level, *[0.0] * len(names)])
    best: dict[int, tuple[float, np.ndarray]] = {}
    models = list(sets)
    for _ in range(MOST_ROUNDS):
        if not at:
            return out
        for k, (likelihood, gradient, curvature) in _newton_sums(data, names, at).items():
            if k in best and not likelihood >= best[k][0] - 1e-9 * abs(best[k][0]):
                at[k] = (at[k] + best[k][1]) / 2
                continue
            best[k] = (likelihood, at[k])
            own = places[k]
            inverse = _inverse(curvature[np.ix_(own, own)])
            step, errors = inverse @ gradient[own], np.sqrt(np.diag(inverse))
            if (np.abs(step) <= CLOSE * errors).all():
                found = dict(zip([INTERCEPT, *sets[models[k]]], zip((at[k][own] + step).tolist(), errors.tolist())))
                level = found[INTERCEPT][0]
                out[models[k]] = LinearPart(level, {c: b for c, (b, _) in found.items() if c != INTERCEPT}, {c: e for c, (_, e) in found.items()})
                del at[k]
            else:
                at[k] = at[k].copy()
                at[k][own] += step
    raise RuntimeError(f"the regressions of {[models[k] for k in at]} have not converged in {MOST_ROUNDS} rounds")


def _same_offset(sets: Sets) -> Column:
    return F.array_repeat("_effort", len(sets))


def _means(linear: Mapping[str, LinearPart]) -> Column:
    """(model, mean of the linear part) of a row, for all models."""
    return F.array(*[F.struct(F.lit(name).alias("model"), F.exp(part.eta() + F.col("_effort")).alias("_mu")) for name, part in linear.items()])


class _Pyramid:
    """Sums of rows in cells, by model and level; a level is summed from the level below it.

    Levels are made in groups of ``GROUP``, each from the rows when the search first comes to it. ``sums`` are the sums
    to keep, over the columns of the rows and the mean of the model's linear part.
    """

    GROUP = 4

    def __init__(self, rows: DataFrame, ladder: Ladder, linear: Mapping[str, LinearPart], sums: Mapping[str, Column]) -> None:
        self.rows, self.ladder, self.linear, self.sums = rows, ladder, linear, sums
        self.known: dict[int, DataFrame] = {}

    def level(self, k: int) -> DataFrame:
        """model, cx, cy and the sums of the cells of one level."""
        if k not in self.known:
            if (k + 1) % self.GROUP == 0 or k == len(self.ladder.bandwidths) - 1:
                made = self.at(k)
            else:
                made = _in_parents(self.level(k + 1), 1).groupBy("model", "cx", "cy").agg(*[F.sum(n).alias(n) for n in self.sums])
            self.known[k] = cut_lineage(made)
        return self.known[k]

    def at(self, k: int) -> DataFrame:
        """The same, from the rows."""
        each = _in_cells(self.rows, self.ladder, k).select("cx", "cy", "_y", "_held", F.inline(_means(self.linear)))
        return each.groupBy("model", "cx", "cy").agg(*[F.sum(v).alias(n) for n, v in self.sums.items()])


def _in_parents(cells: DataFrame, levels: int, names: tuple[str, str] = ("cx", "cy")) -> DataFrame:
    """Cells with the cell that holds them so many levels up."""
    return cells.withColumns({names[0]: F.shiftright("cx", levels), names[1]: F.shiftright("cy", levels)})


def _with_terms(cells: DataFrame, above: DataFrame | None, levels: int) -> DataFrame:
    """Cells with the terms of wider bandwidths, which are those of their parents, in their fitted sums."""
    if above is None:
        return cells.withColumn("parts", F.array().cast("array<double>"))
    parents = above.select("model", F.col("cx").alias("px"), F.col("cy").alias("py"), "parts")
    joined = _in_parents(cells, levels, ("px", "py")).join(parents, ["model", "px", "py"]).drop("px", "py")
    times = F.exp(_spatial_sum())
    return joined.withColumns({c: F.col(c) * times for c in ("fitted", "held_fitted") if c in cells.columns})


def _smooth_models(cells: DataFrame, models: Sequence[str], shared: str, own: str, result: Callable[[Column, Column], Column], name: str) -> DataFrame:
    """Cells of all models with a result of two sums around them: of a column that all models share, and of each model's own.

    The models of a cell travel as columns of one row, so a cell meets its neighbours once, not once a model.
    """
    owns = [f"own{i}" for i in range(len(models))]
    wide = cells.groupBy("cx", "cy").agg(
        F.max(shared).alias("shared"), *[F.sum(F.when(F.col("model") == m, F.col(own)).otherwise(0.0)).alias(c) for m, c in zip(models, owns)])
    around = smooth_cells(wide, [], ["shared", *owns])
    results = F.map_from_arrays(F.array(*map(F.lit, models)), F.array(*[result(F.col("shared"), F.col(c)) for c in owns]))
    return cells.join(around.select("cx", "cy", results.alias("_results")), ["cx", "cy"]).withColumn(name, F.col("_results")[F.col("model")]).drop("_results")


def _local_step(cells: DataFrame, models: Sequence[str]) -> DataFrame:
    """Cells with the log ratio of observed to fitted counts around them."""
    prior = F.lit(PRIOR_COUNT)
    return _smooth_models(cells, models, "seen", "fitted", lambda seen, fitted: F.log((seen + prior) / (fitted + prior)), "step")


def _accept(cells: DataFrame, accepted: Sequence[str]) -> DataFrame:
    """model, cx, cy and the terms so far, with the step of the accepted models and zero for the others."""
    step = F.when(F.col("model").isin(*accepted), F.col("step")).otherwise(0.0) if accepted else F.lit(0.0)
    return cells.select("model", "cx", "cy", F.concat("parts", F.array(step)).alias("parts"))


def _attach_spatial(rows: DataFrame, cells: DataFrame, linear: Mapping[str, LinearPart], columns: Sequence[str] = ("parts",)) -> DataFrame:
    """Each row in its cell once per model, with its linear mean and the columns of its cell.

    The models of a cell travel together, so rows are shuffled before they are multiplied by models. Rows of a dense
    cell are one side of a plain inner join, which Spark splits.
    """
    per_cell = cells.groupBy("cx", "cy").agg(F.collect_list(F.struct("model", *columns)).alias("_models"))
    joined = rows.withColumn("_means", F.map_from_entries(_means(linear))).join(per_cell, ["cx", "cy"])
    return joined.select("*", F.inline("_models")).withColumn("_mu", F.col("_means")[F.col("model")]).drop("_means", "_models")


def _spatial_sum(parts: str = "parts") -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)


# ------------------------------------------------------------------ selection and fit


def select_scales(df: DataFrame, data: ModelData, sets: Sets, ladder: Ladder | None = None, family: str = "poisson",
                  patience: int = 2, scales: int | None = None, smallest: float = SMALLEST_BAND) -> Selection:
    """Choose bandwidths for every model by the likelihood of held-out rows.

    The ladder halves bandwidths down to ``smallest``; ``scales`` asks for a number of them instead.
    """
    if family not in ("poisson", "quasipoisson"):
        raise ValueError("counts are modelled as poisson (quasipoisson has the same fit)")
    ladder = ladder or bandwidth_ladder(df, data.x, data.y, scales, 0.5, smallest)
    if any(2 * narrow != wide for wide, narrow in zip(ladder.bandwidths, ladder.bandwidths[1:])):
        raise ValueError("each bandwidth must be half of the one before")
    rows = _prepare(df, data, sets).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        linear = _fit_jointly(rows.filter(~F.col("_held")), sets, _same_offset(sets))
        held, y, mu = F.col("_held"), F.col("_y"), F.col("_mu")
        pyramid = _Pyramid(rows, ladder, linear, {
            "seen": F.when(~held, y).otherwise(0.0), "fitted": F.when(~held, mu).otherwise(0.0),
            "held_seen": F.when(held, y).otherwise(0.0), "held_fitted": F.when(held, mu).otherwise(0.0)})
        bands: dict[str, list[float]] = {name: [] for name in sets}
        gains: dict[str, dict[float, float]] = {name: {} for name in sets}
        failures = dict.fromkeys(sets, 0)
        terms, level = None, 0
        for k, bandwidth in enumerate(ladder.bandwidths):
            running = [name for name in sets if failures[name] < patience]
            if not running:
                break
            stepped = cut_lineage(_local_step(_with_terms(pyramid.level(k), terms, 1), list(sets)))
            gain = F.sum(F.col("held_seen") * F.col("step") - F.col("held_fitted") * F.expm1("step"))
            found = {r["model"]: r["gain"] for r in stepped.groupBy("model").agg(gain.alias("gain")).collect()}
            accepted = [name for name in running if found.get(name, 0.0) > 0.0]
            for name in running:
                gains[name][bandwidth] = found.get(name, 0.0)
                failures[name] = 0 if name in accepted else failures[name] + 1
                if name in accepted:
                    bands[name].append(bandwidth)
            terms, level = _accept(stepped, accepted), k
        predicted = _attach_spatial(_in_cells(rows.filter("_held"), ladder, level), terms, linear)
        scores = cut_lineage(_holdout_scores(predicted))
    finally:
        rows.unpersist()
    return Selection(data, sets, ladder, family, linear, bands, gains, scores)


def _holdout_scores(predicted: DataFrame) -> DataFrame:
    """(model, stat, value) over held-out rows; the first statistic is R2."""
    error = F.col("_y") - F.col("_mu") * F.exp(_spatial_sum())
    measured = predicted.withColumn("error", error).groupBy("model").agg(
        (F.lit(1.0) - F.try_divide(F.sum(F.col("error") * F.col("error")), F.var_pop("_y") * F.count("_y"))).alias("R2"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("RMSE"),
        F.avg(F.abs("error")).alias("MAE"),
    )
    return measured.unpivot("model", STATS, "stat", "value")


def fit_selected(df: DataFrame, selection: Selection) -> SpatialFit:
    """Fit on all rows with the selected bandwidths, then refit the linear parts beside the spatial terms.

    Terms live in the cells of the narrowest bandwidth that any model uses (of the widest, if none uses any).
    """
    data, ladder, sets = selection.data, selection.ladder, selection.sets
    rows = cut_lineage(_prepare(df, data, sets))
    used = [k for k, b in enumerate(ladder.bandwidths) if any(b in chosen for chosen in selection.bands.values())]
    pyramid = _Pyramid(rows, ladder, selection.linear, {"seen": F.col("_y"), "fitted": F.col("_mu")})
    terms, above = None, 0
    for k in used:
        accepted = [name for name, chosen in selection.bands.items() if ladder.bandwidths[k] in chosen]
        terms, above = cut_lineage(_accept(_local_step(_with_terms(pyramid.level(k), terms, k - above), list(sets)), accepted)), k
    if terms is None:
        terms = _with_terms(pyramid.level(0), None, 0).select("model", "cx", "cy", "parts")
    # one join brings the spatial terms of all models to the rows; the regressions then only scan
    placed = cut_lineage(_in_cells(rows, ladder, above))
    totals = terms.groupBy("cx", "cy").agg(F.map_from_entries(F.collect_list(F.struct("model", _spatial_sum()))).alias("_terms"))
    names = sorted({c for chosen in sets.values() for c in chosen})
    offsets = F.array(*[F.col("_effort") + F.col("_terms")[name] for name in sets])
    beside = cut_lineage(placed.join(totals, ["cx", "cy"]).select("_y", *[f"`{c}`" for c in names], offsets.alias("_beside")))
    linear = _fit_jointly(beside, sets, F.col("_beside"))
    return SpatialFit(selection, linear, terms, placed, above, [ladder.bandwidths[k] for k in used])


def holdout_select(df: DataFrame, data: ModelData, covariates: Sequence[str] = (), **options) -> Selection:
    """Holdout validation of one model."""
    name = ";".join(covariates) or NULL_MODEL
    return select_scales(df, data, {name: list(covariates)}, **options)


def fit_coarse_to_fine(df: DataFrame, selection: Selection) -> SpatialFit:
    """Fit with the scales and the family of a selection."""
    return fit_selected(df, selection)


# ------------------------------------------------------------------ result tables


def fitted_cells(fit: SpatialFit) -> DataFrame:
    """(model, base_x, base_y, fitted): sums of the means before the linear parts were fitted again, in the ladder's narrowest cells."""
    selection, last = fit.selection, len(fit.selection.ladder.bandwidths) - 1
    sums = _Pyramid(fit.rows.drop("cx", "cy"), selection.ladder, selection.linear, {"fitted": F.col("_mu")}).at(last)
    cells = _with_terms(sums, fit.cells, last - fit.level)
    return cells.select("model", F.col("cx").alias("base_x"), F.col("cy").alias("base_y"), "fitted")


def predict_mean_sd(fit: SpatialFit) -> DataFrame:
    """(model, id, pred, pred_sd): mean, and the square root of the local mean squared error.

    The error is averaged with the kernel of the narrowest visited bandwidth (of the widest, without any). A cell's squared
    errors follow from its sums of y y, y mu and mu mu, which are partial aggregates of rows; a dense cell is in no task as
    a whole. The spread comes back to the rows with the spatial terms.
    """
    y, mu = F.col("_y"), F.col("_mu")
    sums = _Pyramid(fit.rows.drop("cx", "cy"), fit.selection.ladder, fit.linear, {"yy": y * y, "ym": y * mu, "mm": mu * mu, "n": F.lit(1.0)})
    times = F.exp(_spatial_sum())
    squared = F.greatest(F.col("yy") - F.lit(2.0) * times * F.col("ym") + times * times * F.col("mm"), F.lit(0.0))
    cells = cut_lineage(sums.at(fit.level).join(fit.cells, ["model", "cx", "cy"]).withColumn("squared", squared))
    known = _smooth_models(cells, list(fit.selection.sets), "n", "squared", lambda n, squared: F.sqrt(squared / n), "pred_sd").select(
        "model", "cx", "cy", "parts", "pred_sd")
    rows = _attach_spatial(fit.rows, known, fit.linear, ("parts", "pred_sd"))
    return rows.select("model", fit.selection.data.id, (F.col("_mu") * F.exp(_spatial_sum())).alias("pred"), "pred_sd")


def scale_component(fit: SpatialFit, low: float = 0.0, high: float | None = None, name: str = "component") -> DataFrame:
    """(model, id, component): the log-mean terms whose bandwidth lies in [low, high), summed per row."""
    chosen = [k for k, b in enumerate(fit.visited) if b >= low and (high is None or b < high)]
    total = sum((F.get("parts", F.lit(k)) for k in chosen), F.lit(0.0))
    rows = fit.rows.select(fit.selection.data.id, "cx", "cy")
    return rows.join(fit.cells.select("model", "cx", "cy", total.alias(name)), ["cx", "cy"]).select("model", fit.selection.data.id, name)


def scale_components_long(fit: SpatialFit, ranges: Mapping[str, tuple[float, float | None]] = fixed.SCALE_RANGES) -> DataFrame:
    """(model, id, scale, predSpat) for named ranges of bandwidths."""
    out = None
    for name, (low, high) in ranges.items():
        one = scale_component(fit, low, high, "predSpat").withColumn("scale", F.lit(name))
        out = one if out is None else append(out, one)
    return out


def coefficients(fit: SpatialFit) -> DataFrame:
    """(model, var, coef, lower_95CI, upper_95CI) by Wald limits, the level included."""
    rows = []
    for model, part in fit.linear.items():
        for var, coef in {INTERCEPT: part.intercept, **part.slopes}.items():
            half = WALD_95 * part.errors[var]
            rows.append((model, var, coef, coef - half, coef + half))
    return fit.rows.sparkSession.createDataFrame(
        rows, "model string, var string, coef double, lower_95CI double, upper_95CI double")


def selected_bands(fit: SpatialFit) -> DataFrame:
    """(model, band) of the selected bandwidths."""
    rows = [(m, float(b)) for m, chosen in fit.selection.bands.items() for b in chosen]
    return fit.rows.sparkSession.createDataFrame(rows, "model string, band double")


def scores_by_model(fit: SpatialFit) -> DataFrame:
    """One row per model, one column per statistic."""
    return scores_wide(fit.selection.scores, "model", "stat", "value", STATS)


def band_score_matrix(fit: SpatialFit) -> DataFrame:
    """(model, band, R2) over all candidate bandwidths, 0 where the model does not use one."""
    bands = F.array(*[F.lit(float(b)) for b in fit.selection.ladder.bandwidths])
    scored = fit.selection.scores.filter(F.col("stat") == STATS[0])
    every = scored.select("model", F.col("value"), F.explode(bands).alias("band"))
    used = selected_bands(fit).withColumn("used", F.lit(True))
    return every.join(used, ["model", "band"], "left").select(
        "model", "band", F.when(F.col("used"), F.col("value")).otherwise(0.0).alias("R2"))


def band_report(fit: SpatialFit) -> DataFrame:
    """Band matrix from the smallest bandwidth any model uses, with kilometre and model labels."""
    matrix = band_score_matrix(fit)
    used = [b for chosen in fit.selection.bands.values() for b in chosen]
    smallest = min(used) if used else math.inf
    return matrix.filter(F.col("band") >= smallest).select(
        model_label(F.col("model")).alias("modName"), values.kilometre_label(F.col("band")).alias("distance"), "band", "R2")


def model_label(model: Column) -> Column:
    """Readable model name: short variable names, squares marked, terms joined by ``+``."""
    return text.replace_many(text.recode_labels(model, fixed.SHORT_NAMES),
                             [(p, r.replace("$", r"\$")) for p, r in fixed.MODEL_LABEL_PATTERNS])


def candidate_sets(squares: Mapping[str, str] = fixed.MODEL_COVARIATES) -> dict[str, list[str]]:
    """Every mix of covariates, each absent, linear, or linear with its square; never empty."""
    sets: list[list[str]] = [[]]
    for base, square in squares.items():
        sets = [chosen + more for chosen in sets for more in ([], [base], [base, square])]
    return {";".join(chosen): chosen for chosen in sorted(filter(None, sets), key=len)}


def model_sweep(df: DataFrame, data: ModelData, sets: Sets | None = None, **options) -> SpatialFit:
    """Select and fit all candidate models and the null model together."""
    every = {NULL_MODEL: [], **(candidate_sets() if sets is None else sets)}
    return fit_selected(df, select_scales(df, data, every, **options))


def effect_table(fit: SpatialFit, means: DataFrame) -> DataFrame:
    """Slopes with significance, effect at the covariate mean, sign, short names and report order.

    ``means`` has (var, meanEff). A row for the null model keeps its place in the report.
    """
    slopes = coefficients(fit).filter(F.length("var") > 1).filter(F.col("var") != INTERCEPT)
    with_means = lookup_join(slopes, means, "var")
    names = list(fit.selection.sets)
    effects = with_means.select(
        text.recode_labels(F.col("model"), fixed.SHORT_NAMES).alias("mod"),
        values.case_map([(F.col("var") == old, new) for old, new in fixed.SHORT_NAMES], F.col("var")).alias("var"),
        "coef", values.same_sign(F.col("lower_95CI"), F.col("upper_95CI")).alias("isSig"), "meanEff",
        values.rescaled_effect(F.col("coef"), F.col("meanEff")).alias("coefResc"),
        values.is_negative(F.col("coef")).alias("isNeg"),
    )
    blank = fit.rows.sparkSession.createDataFrame(
        [(NULL_MODEL, "TN", None, 0, None, None, None)], effects.schema)
    short = [name for name in names]
    for old, new in fixed.SHORT_NAMES:
        short = [name.replace(old, new) for name in short]
    levels = list(fixed.EFFECT_LEVELS)
    labels = [(F.col("var") == k, v) for k, v in fixed.EFFECT_LEVELS.items()]
    return append(effects, blank).withColumns(
        {
            "mod_order": values.level_position(F.col("mod"), short),
            "var_order": values.level_position(F.col("var"), levels),
            "var": values.case_map(labels, F.col("var")),
        }
    )


def covariate_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return column_means(df, columns)
