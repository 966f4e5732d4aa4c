"""The tables behind a model report, without the figures."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos import fixed_values as fixed
from limnos.operators.aggregates import corr_matrix, pearson_gof, residuals
from limnos.operators.columns import drop_missing, poly_features
from limnos.operators.joins import attach_predictions
from limnos.plans import spatial_counts as M


@dataclass
class ModelReport:
    """Result tables; each is a DataFrame."""

    correlations: DataFrame
    correlations_pairwise: DataFrame
    predictions: DataFrame
    scale_components: DataFrame
    scores: DataFrame
    bands: DataFrame
    coefficients: DataFrame
    effects: DataFrame
    goodness: DataFrame


SITE_MODEL = M.ModelData("samplingSiteId", "rich", "samplingSiteX", "samplingSiteY")


def correlation_tables(final: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(site and richness columns, missing makes a pair missing; all columns with chemistry, pairwise)."""
    few, full = fixed.CORRELATION_COLUMNS, fixed.CORRELATION_COLUMNS_FULL
    return (
        corr_matrix(final, list(few), "everything", labels=few),
        corr_matrix(final, list(full), "pairwise", labels=full),
    )


def complete_rows(df: DataFrame, squares: Mapping[str, str] = fixed.MODEL_COVARIATES) -> DataFrame:
    """Rows with all model covariates, and their squares."""
    return poly_features(drop_missing(df, list(squares)), squares)


def model_report(df: DataFrame, data: M.ModelData = SITE_MODEL, squares: Mapping[str, str] = fixed.MODEL_COVARIATES,
                 correlations: tuple[DataFrame, DataFrame] | None = None, **options) -> ModelReport:
    """Correlations on all rows; null model, sweep, effects and residuals on rows with all covariates."""
    plain, pairwise = correlations or correlation_tables(df)
    complete = complete_rows(df, squares)
    fit = M.model_sweep(complete, data, M.candidate_sets(squares), **options)
    predicted = M.predict_mean_sd(fit).filter(F.col("model") == M.NULL_MODEL).drop("model")
    with_residuals = residuals(attach_predictions(complete, predicted, data.id), data.label, "pred")
    every = [c for pair in squares.items() for c in pair]
    return ModelReport(
        correlations=plain,
        correlations_pairwise=pairwise,
        predictions=with_residuals,
        scale_components=M.scale_components_long(fit),
        scores=M.scores_by_model(fit),
        bands=M.band_report(fit),
        coefficients=M.coefficients(fit),
        effects=M.effect_table(fit, M.covariate_means(complete, every)),
        goodness=pearson_gof(with_residuals, "rawResid", "pred"),
    )
