"""Numeric, date, categorical and conditional column functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEDIAN_TOLERANCE = 1.5e-8


def finite_or_null(value: Column) -> Column:
    """Infinite and NaN values are NULL."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def null_nonfinite(df: DataFrame) -> DataFrame:
    """Infinite, NaN and empty-text cells become NULL on every double and string column."""
    cleaned = {}
    for name, kind in df.dtypes:
        if kind == "double":
            cleaned[name] = finite_or_null(F.col(f"`{name}`"))
        elif kind == "string":
            cleaned[name] = F.nullif(F.col(f"`{name}`"), F.lit(""))
    return df.withColumns(cleaned)


def round_median_toward_mean(median: Column, mean: Column) -> Column:
    """Keep whole medians; move a half toward the mean, downward when they agree."""
    whole = F.abs(median - F.rint(median)) < F.lit(MEDIAN_TOLERANCE)
    toward = F.when(mean > median, F.ceil(median)).otherwise(F.floor(median))
    return F.when(whole, median).otherwise(toward.cast("double"))


def label_rank(label: Column, ranks: Mapping[str, int]) -> Column:
    """Rank of a lower-cased label; an unlisted label is NULL."""
    by_rank: dict[int, list[str]] = {}
    for text, rank in ranks.items():
        by_rank.setdefault(rank, []).append(text)
    lowered = F.lower(label)
    branches = [(lowered.isin(*texts), rank) for rank, texts in by_rank.items()]
    return case_map(branches)


def case_map(branches: Sequence[tuple[Column, object]], default: Column | None = None) -> Column:
    """First branch whose condition holds."""
    (condition, value), *rest = branches
    out = F.when(condition, value if isinstance(value, Column) else F.lit(value))
    for condition, value in rest:
        out = out.when(condition, value if isinstance(value, Column) else F.lit(value))
    return out if default is None else out.otherwise(default)


def sum_nonnull(*values: Column) -> Column:
    """Row-wise sum of the values present; zero (nothing present) is NULL."""
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0)) for v in values])
    return F.nullif(total, F.lit(0))


def year_of(date: Column) -> Column:
    return F.year(date)


def date_parts(df: DataFrame, text: str, date: str = "samplingDateD", year: str = "samplingYr",
               month: str = "samplingM") -> DataFrame:
    """Date text (or timestamp) -> date, year and month columns; text that is no date gives NULL in all three."""
    return df.withColumn(date, F.col(text).try_cast("date")).withColumns(
        {year: F.year(F.col(date)), month: F.month(F.col(date))}
    )


def in_months(date: Column, months: Sequence[int]) -> Column:
    return F.month(date).isin(*months)


def rescaled_effect(coefficient: Column, mean: Column) -> Column:
    """Multiplicative effect of a covariate at its mean."""
    return F.exp(coefficient * mean)


def is_negative(coefficient: Column) -> Column:
    return (coefficient < 0).cast("int")


def same_sign(lower: Column, upper: Column) -> Column:
    """1 where both limits have the same sign."""
    return (F.signum(lower) == F.signum(upper)).cast("int")


def kilometre_label(metres: Column) -> Column:
    """Metres as kilometres with one decimal."""
    return F.format_string("%.1f", F.round(metres / F.lit(1000.0), 1))


def level_position(label: Column, levels: Sequence[str]) -> Column:
    """Place of a label in an explicit report order, from 0; an unlisted label is NULL."""
    return case_map([(label == level, place) for place, level in enumerate(levels)])


def inverse_transverse_mercator(
    easting: Column,
    northing: Column,
    central_meridian: float = 15.0,
    scale: float = 0.9996,
    false_easting: float = 500000.0,
    false_northing: float = 0.0,
    semi_major: float = 6378137.0,
    inverse_flattening: float = 298.257222101,
) -> tuple[Column, Column]:
    """Projected metres -> (longitude, latitude) in degrees by the Krüger series of order n^4.

    The default constants are those of EPSG 3006 (GRS 80 ellipsoid).
    """
    f = 1.0 / inverse_flattening
    n = f / (2.0 - f)
    rectifying = semi_major / (1.0 + n) * (1.0 + n**2 / 4.0 + n**4 / 64.0)
    delta = [
        n / 2.0 - 2.0 * n**2 / 3.0 + 37.0 * n**3 / 96.0 - n**4 / 360.0,
        n**2 / 48.0 + n**3 / 15.0 - 437.0 * n**4 / 1440.0,
        17.0 * n**3 / 480.0 - 37.0 * n**4 / 840.0,
        4397.0 * n**4 / 161280.0,
    ]
    e2 = f * (2.0 - f)
    series = [
        e2 + e2**2 + e2**3 + e2**4,
        -(7.0 * e2**2 + 17.0 * e2**3 + 30.0 * e2**4) / 6.0,
        (224.0 * e2**3 + 889.0 * e2**4) / 120.0,
        -(4279.0 * e2**4) / 1260.0,
    ]
    xi = (northing - F.lit(false_northing)) / F.lit(scale * rectifying)
    eta = (easting - F.lit(false_easting)) / F.lit(scale * rectifying)
    xi_p, eta_p = xi, eta
    for order, d in enumerate(delta, start=1):
        k = 2.0 * order
        xi_p = xi_p - F.lit(d) * F.sin(F.lit(k) * xi) * F.cosh(F.lit(k) * eta)
        eta_p = eta_p - F.lit(d) * F.cos(F.lit(k) * xi) * F.sinh(F.lit(k) * eta)
    conformal = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    sine = F.sin(conformal)
    square = sine * sine
    a, b, c, d = (F.lit(s) for s in series)
    latitude = conformal + sine * F.cos(conformal) * (a + b * square + c * square * square + d * square * square * square)
    longitude = F.lit(central_meridian) + F.degrees(F.atan(F.sinh(eta_p) / F.cos(xi_p)))
    return longitude, F.degrees(latitude)
