"""Neighbourhoods, local means and the multi-scale count models."""

from __future__ import annotations

from pyspark.sql import functions as F

from limnos import fixed_values as fixed
from limnos.operators import lattice as L
from limnos.operators.aggregates import corr_matrix, residuals
from limnos.operators.columns import poly_features
from limnos.operators.joins import attach_predictions
from limnos.operators.sets import append
from limnos.plans import reporting as R
from limnos.plans import spatial_counts as M
from limnos.registry import model_sql as S
from limnos.registry.core import query, table

# ---------------------------------------------------------------- neighbourhoods

@query("neighbour_join", """WITH c AS (SELECT CAST(floor(l_suppkey / 4.0e0) AS INTEGER) AS cx, CAST(floor(l_quantity / 4.0e0) AS INTEGER) AS cy,
    count(*) AS n, sum(l_linenumber)::BIGINT AS total FROM lineitem GROUP BY ALL)
  SELECT a.cx, a.cy, b.cx AS nx, b.cy AS ny, sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy)::DOUBLE) * 4 AS distance, b.n, b.total
  FROM c a JOIN c b ON b.cx BETWEEN a.cx - 3 AND a.cx + 3 AND sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy)::DOUBLE) * 4 <= 12""")
def neighbour_join(spark, sf):
    """Cells of 4 within a distance of 12."""
    return L.neighbour_join(table(spark, sf, "lineitem"), "l_suppkey", "l_quantity", 12.0, 4.0, (0.0, 0.0), {"total": "l_linenumber"})


_LOCAL_MEAN = """WITH c AS (SELECT CAST(floor(l_suppkey / 5.0e0) AS INTEGER) AS cx, CAST(floor(l_quantity / 5.0e0) AS INTEGER) AS cy,
    count(*) AS n, sum(l_linenumber)::DOUBLE AS total FROM lineitem GROUP BY ALL),
  w AS (SELECT a.cx, a.cy, exp(-((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy)) / 8.0e0) AS w, b.n, b.total
    FROM c a JOIN c b ON b.cx BETWEEN a.cx - 6 AND a.cx + 6 AND (a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy) <= 36)
  SELECT cx, cy, round(sum(w * total) / sum(w * n), 9) AS local_mean FROM w GROUP BY cx, cy"""


@query("kernel_local_mean", _LOCAL_MEAN)
def kernel_local_mean(spark, sf):
    local = L.kernel_local_mean(table(spark, sf, "lineitem"), "l_suppkey", "l_quantity", "l_linenumber", 10.0, (0.0, 0.0))
    return local.withColumn("local_mean", F.round("local_mean", 9))


def _point_sums_sql(weight: str) -> str:
    return f"""WITH e AS (SELECT embedding[1] * 1e6 AS east, embedding[2] * 1e6 AS north, label FROM embeddings),
  d AS (SELECT a.east, a.north, (a.east - b.east) * (a.east - b.east) + (a.north - b.north) * (a.north - b.north) AS squared, b.label
    FROM (SELECT DISTINCT east, north FROM e) a JOIN e b ON b.east BETWEEN a.east - 60000 AND a.east + 60000)
  SELECT east, north, round(sum({weight}), 6) AS weight, round(sum({weight} * label), 6) AS total FROM d WHERE squared <= 3600000000 GROUP BY east, north"""


@query("sums_around_points", _point_sums_sql("1.0e0"))
def sums_around_points(spark, sf):
    """Sites and their richness within 60 km of each site, by exact distances."""
    found = L.sums_around_points(sites(spark, sf), "east", "north", 60_000.0, {"total": "rich"})
    return found.withColumns({c: F.round(c, 6) for c in ("weight", "total")})


@query("kernel_sums_at_points", _point_sums_sql("exp(-0.5e0 * squared / 400000000)"))
def kernel_sums_at_points(spark, sf):
    """The same weighted by a Gaussian kernel of 20 km, cut at 60 km."""
    found = L.sums_around_points(sites(spark, sf), "east", "north", 60_000.0, {"total": "rich"}, bandwidth=20_000.0)
    return found.withColumns({c: F.round(c, 6) for c in ("weight", "total")})


@query("bandwidth_ladder", "SELECT k, round((max(l_extendedprice) - min(l_extendedprice)) / 2 * power(0.5, k), 6) AS band FROM lineitem, "
                           "generate_series(0, 7) AS g(k) GROUP BY k")
def bandwidth_ladder(spark, sf):
    ladder = L.bandwidth_ladder(table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity", scales=8)
    rows = [(k, b) for k, b in enumerate(ladder.bandwidths)]
    return spark.createDataFrame(rows, "k bigint, b double").select("k", F.round("b", 6).alias("band"))


# ---------------------------------------------------------------- models

COVARIATES = ["TN", "Temp", "Tot_P"]
DATA = M.ModelData("site", "rich", "east", "north")
NULL_SET: dict[str, list[str]] = {M.NULL_MODEL: []}
SWEEP_SETS = NULL_SET | M.candidate_sets()


def sites(spark, sf):
    """Vectors as sites: two components as coordinates, three as covariates, the label as richness, one to seven visits."""
    columns = table(spark, sf, "embeddings").selectExpr(
        "vec_id AS site", "label AS rich", "embedding[0] * 1e6 AS east", "embedding[1] * 1e6 AS north",
        "CAST(embedding[2] AS DOUBLE) AS TN", "CAST(embedding[3] AS DOUBLE) AS Temp", "CAST(embedding[4] AS DOUBLE) AS Tot_P",
        "ln(CAST(1 + vec_id % 7 AS DOUBLE)) AS log_visits")
    return poly_features(columns, {"TN": "TNsq", "Temp": "Tsq", "Tot_P": "TPsq"})


_KEPT: dict[tuple[str, str, str], object] = {}


def _kept(spark, sf, name, build):
    """A fitted model that several reports of one application read; its tables lie in the shared folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def _null_selection(spark, sf):
    return _kept(spark, sf, "selection", lambda: M.holdout_select(sites(spark, sf), DATA))


def _null_fit(spark, sf):
    return _kept(spark, sf, "fit", lambda: M.fit_coarse_to_fine(sites(spark, sf), _null_selection(spark, sf)))


def _sweep(spark, sf):
    """All 26 candidate models and the null model, on the whole ladder."""
    return _kept(spark, sf, "sweep", lambda: M.model_sweep(sites(spark, sf), DATA))


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})  # no negative zero


def _null_sql(result, more=""):
    return S.model_sql(NULL_SET, result, more)


@query("holdout_select", _null_sql("SELECT @model AS model, round(band, 3) AS band, round(gain, 6) + 0.0e0 AS gain, selected FROM g WHERE running"))
def holdout_select(spark, sf):
    """Gain of held-out likelihood per visited bandwidth."""
    selection = _null_selection(spark, sf)
    rows = [(m, b, g, b in selection.bands[m]) for m, gains in selection.gains.items() for b, g in gains.items()]
    found = spark.createDataFrame(rows, "model string, band double, gain double, selected boolean")
    return _rounded(_rounded(found, "gain"), "band", digits=3)


@query("fit_coarse_to_fine", _null_sql(
    f"SELECT @model AS model, CAST(floor((base_x + 0.5e0) * power(0.5e0, {S.LEVELS - 1} - last)) AS BIGINT) AS base_x, "
    f"CAST(floor((base_y + 0.5e0) * power(0.5e0, {S.LEVELS - 1} - last)) AS BIGINT) AS base_y, round(sum(fitted), 6) AS fitted FROM f, {S.LAST} GROUP BY 1, 2, 3"))
def fit_coarse_to_fine(spark, sf):
    return _rounded(M.fitted_cells(_null_fit(spark, sf)), "fitted")


@query("predict_mean_sd", _null_sql("SELECT @model AS model, site, round(pred, 6) + 0.0e0 AS pred, round(sqrt(squared / n), 6) AS pred_sd FROM p JOIN va USING (model, cx, cy)", S.SPREAD))
def predict_mean_sd(spark, sf):
    return _rounded(M.predict_mean_sd(_null_fit(spark, sf)), "pred", "pred_sd")


@query("predict_all_models", S.model_sql(SWEEP_SETS, "SELECT @model AS model, site, round(pred, 6) + 0.0e0 AS pred, round(sqrt(squared / n), 6) AS pred_sd "
                                                     "FROM p JOIN va USING (model, cx, cy)", S.SPREAD))
def predict_all_models(spark, sf):
    return _rounded(M.predict_mean_sd(_sweep(spark, sf)), "pred", "pred_sd")


@query("scale_component", _null_sql("SELECT @model AS model, site, round(wide, 6) + 0.0e0 AS wide, round(s - wide, 6) + 0.0e0 AS narrow FROM r JOIN f USING (base_x, base_y)"))
def scale_component(spark, sf):
    """Terms of 100 km and wider beside all narrower ones."""
    fit = _null_fit(spark, sf)
    wide, narrow = M.scale_component(fit, 100000.0, None, "wide"), M.scale_component(fit, 0.0, 100000.0, "narrow")
    return _rounded(wide.join(narrow, ["model", "site"]), "wide", "narrow")


@query("scale_components_long", _null_sql(" UNION ALL ".join(
    f"SELECT @model AS model, site, '{scale}' AS scale, round({term}, 6) + 0.0e0 AS predSpat FROM r JOIN f USING (base_x, base_y)"
    for scale, term in (("large", "wide"), ("medium", "medium"), ("small", "s - wide - medium")))))
def scale_components_long(spark, sf):
    return _rounded(M.scale_components_long(_null_fit(spark, sf)), "predSpat")


@query("scores", _null_sql(" UNION ALL ".join(f"SELECT @model AS model, '{stat}' AS stat, round({column}, 6) AS value FROM r2" for stat, column in (("R2", "r2"), ("RMSE", "rmse"), ("MAE", "mae"))), S.R2))
def scores(spark, sf):
    return _rounded(_null_selection(spark, sf).scores, "value")


@query("residuals_by_observed", _null_sql("SELECT y AS rich, count(*) AS n, round(avg(y - pred), 6) AS mean_resid FROM p GROUP BY y"))
def residuals_by_observed(spark, sf):
    """Mean residual of the null model per observed richness, as its residual plots summarise."""
    predicted = M.predict_mean_sd(_null_fit(spark, sf)).select("site", "pred")
    joined = attach_predictions(sites(spark, sf).select("site", F.col("rich").cast("double")), predicted, "site")
    return residuals(joined, "rich", "pred").groupBy("rich").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("rawResid"), 6).alias("mean_resid"))


@query("coefficients", S.model_sql(SWEEP_SETS, S.COEFFICIENTS, S.SLOPES))
def coefficients(spark, sf):
    return _rounded(M.coefficients(_sweep(spark, sf)), "coef", "lower_95CI", "upper_95CI")


@query("offset_effort", S.model_sql({"TN;Temp;Tot_P": COVARIATES}, S.COEFFICIENTS, S.SLOPES, "ln(CAST(1 + vec_id % 7 AS DOUBLE))"))
def offset_effort(spark, sf):
    """A model of three covariates whose exposure is the number of visits."""
    df = sites(spark, sf)
    with_effort = M.ModelData("site", "rich", "east", "north", "log_visits")
    fit = M.fit_coarse_to_fine(df, M.holdout_select(df, with_effort, COVARIATES))
    return _rounded(M.coefficients(fit), "coef", "lower_95CI", "upper_95CI")


def _sets_sql() -> str:
    columns = {"TN": "embedding[3]", "Temp": "embedding[4]", "Tot_P": "embedding[5]"}
    base = "WITH t AS (SELECT label, " + ", ".join(
        f"CASE WHEN {c} > {cut} THEN {c} END AS {n}" for (n, c), cut in zip(columns.items(), (-0.1, -0.05, 0.0))) + " FROM embeddings), "
    base += "s AS (SELECT label, TN, TN * TN AS TNsq, Temp, Temp * Temp AS Tsq, Tot_P, Tot_P * Tot_P AS TPsq FROM t) "
    return base + " UNION ALL ".join(
        f"SELECT '{name}' AS model, count_if({' AND '.join(c + ' IS NOT NULL' for c in chosen)}) AS n_complete FROM s"
        for name, chosen in M.candidate_sets().items())


@query("candidate_sets", _sets_sql())
def candidate_sets(spark, sf):
    """Complete rows available to each of the candidate models."""
    gaps = sites(spark, sf).withColumns({n: F.when(F.col(n) > F.lit(cut), F.col(n))
                                         for n, cut in zip(COVARIATES, (-0.1, -0.05, 0.0))})
    gaps = poly_features(gaps, {"TN": "TNsq", "Temp": "Tsq", "Tot_P": "TPsq"})
    entries = [F.struct(F.lit(name).alias("model"),
                        F.forall(F.array(*chosen), lambda v: v.isNotNull()).alias("complete"))
               for name, chosen in M.candidate_sets().items()]
    return gaps.select(F.inline(F.array(*entries))).groupBy("model").agg(F.count_if("complete").alias("n_complete"))


_SCORED = "SELECT @model AS model, round(r2, 6) + 0.0e0 AS R2, round(rmse, 6) AS RMSE, round(mae, 6) AS MAE FROM r2"
_IN_LADDER = f"(band >= {S.SMALLEST} OR k = 0)"
_MATRIX = f"SELECT model, band, CASE WHEN selected THEN r2 ELSE 0 END AS r2 FROM g JOIN r2 USING (model) WHERE {_IN_LADDER}"


@query("model_sweep", S.model_sql(SWEEP_SETS, _SCORED, S.R2))
def model_sweep(spark, sf):
    """All 26 candidate models and the null model: scores."""
    return _rounded(M.scores_by_model(_sweep(spark, sf)), "R2", "RMSE", "MAE")


@query("band_score_matrix", S.model_sql(SWEEP_SETS, f"SELECT @model AS model, round(band, 3) AS band, round(r2, 6) + 0.0e0 AS R2 FROM ({_MATRIX})", S.R2))
def band_score_matrix(spark, sf):
    return _rounded(_rounded(M.band_score_matrix(_sweep(spark, sf)), "R2"), "band", digits=3)


@query("band_report", S.model_sql(SWEEP_SETS, f"SELECT {S.LABEL.format('@model')} AS modName, printf('%.1f', round(band / 1000.0e0, 1)) AS distance, "
                                              f"round(band, 3) AS band, round(r2, 6) + 0.0e0 AS R2 FROM ({_MATRIX}) WHERE band >= (SELECT min(band) FROM g WHERE selected)", S.R2))
def band_report(spark, sf):
    return _rounded(_rounded(M.band_report(_sweep(spark, sf)), "R2"), "band", digits=3)


@query("selected_bands", S.model_sql(SWEEP_SETS, "SELECT @model AS model, round(band, 3) AS band FROM g WHERE selected"))
def selected_bands(spark, sf):
    return _rounded(M.selected_bands(_sweep(spark, sf)), "band", digits=3)


_EFFECT_NAMES = list(fixed.EFFECT_LEVELS)
_POSITION = "CASE {} " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(_EFFECT_NAMES)) + " END"
_EFFECT_LABEL = "CASE {} " + " ".join(f"WHEN '{v}' THEN '{label}'" for v, label in fixed.EFFECT_LEVELS.items()) + " END"
_EFFECTS = (
    f"SELECT {S.SHORT.format('@model')} AS mod, {_EFFECT_LABEL.format(S.SHORT.format('var'))} AS var, round(coef, 6) + 0.0e0 AS coef, "
    "CAST(sign(low) = sign(high) AS INTEGER) AS isSig, round(mean, 6) + 0.0e0 AS meanEff, round(exp(coef * mean), 6) AS coefResc, CAST(coef < 0 AS INTEGER) AS isNeg, "
    f"model AS mod_order, {_POSITION.format(S.SHORT.format('var'))} AS var_order FROM sl JOIN means USING (var) "
    "UNION ALL SELECT 'Null', 'TN', NULL, 0, NULL, NULL, NULL, 0, 5"
)
_MEANS = "means AS (" + " UNION ALL ".join(f"SELECT '{c}' AS var, avg(x{i + 1}) AS mean FROM e" for i, c in enumerate(S.COVARIATES)) + ")"


@query("effect_table", S.model_sql(SWEEP_SETS, _EFFECTS, f"{S.SLOPES}, {_MEANS}"))
def effect_table(spark, sf):
    df = sites(spark, sf)
    means = M.covariate_means(df, [c for pair in fixed.MODEL_COVARIATES.items() for c in pair])
    return _rounded(M.effect_table(_sweep(spark, sf), means), "coef", "meanEff", "coefResc")


@query("run_model", S.model_sql({"TN;Temp": ["TN", "Temp"]}, S.COEFFICIENTS, S.SLOPES))
def run_model(spark, sf):
    """One model by itself: its coefficients."""
    df = sites(spark, sf)
    fit = M.fit_coarse_to_fine(df, M.holdout_select(df, DATA, ["TN", "Temp"]))
    return _rounded(M.coefficients(fit), "coef", "lower_95CI", "upper_95CI")


_REPORT_COLUMNS = {"rich": "y", "east": "px", "north": "py", "TN": "x1", "Temp": "x3", "Tot_P": "x5"}
_REPORT = " UNION ALL ".join(
    f"SELECT 'correlation' AS part, '{a}|{b}' AS item, round(corr({_REPORT_COLUMNS[a]}, {_REPORT_COLUMNS[b]}), 2) + 0.0e0 AS value FROM e"
    for i, a in enumerate(_REPORT_COLUMNS) for b in list(_REPORT_COLUMNS)[i + 1 :])
_REPORT += (" UNION ALL SELECT 'R2', @model, round(r2, 6) FROM r2 UNION ALL SELECT 'pearson_gof', 'Null', "
            "round(sum((y - pred) * (y - pred) / pred), 6) FROM p WHERE model = 0")


@query("model_report", S.model_sql(SWEEP_SETS, _REPORT, S.R2))
def model_report(spark, sf):
    """Correlations, scores of all models and goodness of fit of a report in one long table."""
    columns = list(_REPORT_COLUMNS)
    df = sites(spark, sf).drop("TNsq", "Tsq", "TPsq")
    both = tuple(corr_matrix(df, columns, use) for use in ("everything", "pairwise"))
    report = _kept(spark, sf, "report", lambda: R.model_report(df, DATA, fixed.MODEL_COVARIATES, both))
    pairs = report.correlations.select(F.lit("correlation").alias("part"), F.concat_ws("|", "a", "b").alias("item"), F.col("r").alias("value"))
    scored = report.scores.select(F.lit("R2").alias("part"), F.col("model").alias("item"), F.col("R2").alias("value"))
    fitted = report.goodness.select(F.lit("pearson_gof").alias("part"), F.lit("Null").alias("item"), F.col("pearson_gof").alias("value"))
    return _rounded(append(pairs, scored, fitted), "value")
