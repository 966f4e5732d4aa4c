"""Grouped and whole-table aggregates. All combine partially before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos import fixed_values as fixed
from limnos.operators.joins import join_nullsafe
from limnos.operators.reshape import transpose_stats


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def strict(aggregate: Column, source: Column) -> Column:
    """An aggregate that is NULL as soon as one source value is NULL."""
    return F.when(F.count(source) == F.count(F.lit(1)), aggregate)


def n_distinct(column: Column) -> Column:
    """Distinct values with NULL counted as one."""
    return F.count_distinct(column) + F.max(column.isNull().cast("int"))


def group_mean_strict(df: DataFrame, keys: Sequence[str], value: str, latest: str | None = None,
                      mean_name: str = "val", latest_name: str = "lastEditDate") -> DataFrame:
    """Mean value and latest date per group; one missing member makes the result missing."""
    v = F.col(value)
    measures = []
    if latest is not None:
        measures.append(strict(F.max(latest), F.col(latest)).alias(latest_name))
    measures.append(strict(F.avg(v), v).alias(mean_name))
    return df.groupBy(*_cols(keys)).agg(*measures)


def concat_distinct(df: DataFrame, keys: Sequence[str], column: str, sep: str = ";",
                    order: str | None = None, name: str | None = None) -> DataFrame:
    """Distinct present values of a group joined as text, sorted by value or by first appearance
    (smallest ``order``). Values are made distinct before the text is built."""
    name = name or column
    place = F.min(F.col(order if order else column)).alias("_place")
    distinct = df.groupBy(*_cols(keys), F.col(column).alias("_value")).agg(place)
    entries = F.array_sort(F.collect_list(F.when(F.col("_value").isNotNull(), F.struct("_place", "_value"))))
    return distinct.groupBy(*_cols(keys)).agg(
        F.array_join(F.transform(entries, lambda e: e["_value"].cast("string")), sep).alias(name)
    )


def covariate_summary(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str] = {},
    minima: Mapping[str, str] = {},
    maxima: Mapping[str, str] = {},
    medians: Mapping[str, str] = {},
    means: Mapping[str, str] = {},
    texts: Mapping[str, str] = {},
) -> DataFrame:
    """Sum / min / max / median / mean / joined text per group, missing ignored (output -> source).

    A sum over nothing is 0, everything else over nothing is NULL. Medians are for ordinal ranks:
    the state of ``median`` is a count per distinct rank, so it stays as small as the scale.
    Text is for vocabularies (reference systems, quality codes); a sorted distinct list is joined.
    """
    measures = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()]
    measures += [F.min(c).alias(n) for n, c in minima.items()]
    measures += [F.max(c).alias(n) for n, c in maxima.items()]
    measures += [F.median(c).alias(n) for n, c in medians.items()]
    measures += [F.avg(c).alias(n) for n, c in means.items()]
    measures += [
        F.nullif(F.array_join(F.array_sort(F.collect_set(c)), ";"), F.lit("")).alias(n) for n, c in texts.items()
    ]
    return df.groupBy(*_cols(keys)).agg(*measures)


def _values_long(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, column, value as text); negative zero is written as zero."""
    def text(name: str) -> Column:
        c = F.col(f"`{name}`")
        return ((c + F.lit(0.0)) if dict(df.dtypes)[name] == "double" else c).cast("string").alias(name)

    return df.select(*_cols(keys), *[text(c) for c in columns]).unpivot(
        list(keys), list(columns), "column", "value"
    )


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: distinct values (NULL counted) and missing values, as rows.

    Counts per (column, value) come first, so a frequent value is collapsed before the shuffle.
    """
    per_value = _values_long(df, columns or df.columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
    )


def varying_columns(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Largest number of distinct values any group has, per column."""
    per_value = _values_long(df, columns, keys).distinct()
    per_group = per_value.groupBy(*_cols(keys), "column").agg(F.count(F.lit(1)).alias("n"))
    return per_group.groupBy("column").agg(F.max("n").alias("max_distinct"))


def duplicate_groups(df: DataFrame, keys: Sequence[str], distinct: str | None = None) -> DataFrame:
    """Groups of more than one row, with their distinct units (NULL counted)."""
    if distinct is None:
        return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    per_unit = df.groupBy(*_cols(keys), F.col(distinct).alias("_unit")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_unit.groupBy(*_cols(keys))
        .agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_units"))
        .filter("n > 1")
    )


def duplicate_rate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Surplus rows of duplicated groups as a share of all rows."""
    per_group = df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias("n"))
    return per_group.agg(F.try_divide(F.sum(F.col("n") - 1), F.sum("n")).alias("duplicate_rate"))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*_cols(columns)).distinct()


def distinct_excess(df: DataFrame, columns: Sequence[str], extra: str) -> DataFrame:
    """How many more distinct rows there are with an extra column than without."""
    per_entry = df.select(*_cols(columns), F.col(extra)).distinct().groupBy(*_cols(columns)).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_entry.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_extra"))


def group_coverage(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """First date, last date and number of samples per group."""
    return df.groupBy(*_cols(keys)).agg(
        F.min(date).alias("date_first"), F.max(date).alias("date_last"), F.count(F.lit(1)).alias("n_samples")
    )


def out_of_season(df: DataFrame, keys: Sequence[str], date: str,
                  months: Sequence[int] = fixed.SEASON_CHECK_MONTHS) -> DataFrame:
    """Groups without any sample in season."""
    in_season = F.count_if(F.month(date).isin(*months))
    return df.groupBy(*_cols(keys)).agg(in_season.alias("n_season")).filter("n_season = 0")


def seasonal_weighted_mean(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    value: str,
    core: Sequence[int] = fixed.SUMMER_MONTHS,
    shoulder: Sequence[int] = fixed.SHOULDER_MONTHS,
    weights: tuple[float, float] = (fixed.SUMMER_WEIGHT, fixed.SHOULDER_WEIGHT),
    name: str = "val",
) -> DataFrame:
    """Weighted mean of the core-month mean and the shoulder-month mean; the one that exists if only
    one does, NULL if neither. Groups sampled only out of season stay, with NULL."""
    month = F.month(date)
    inner = F.avg(F.when(month.isin(*core), F.col(value)))
    outer = F.avg(F.when(month.isin(*shoulder), F.col(value)))
    blended = (F.lit(weights[0]) * inner + F.lit(weights[1]) * outer) / F.lit(sum(weights))
    return df.groupBy(*_cols(keys)).agg(F.coalesce(blended, inner, outer).alias(name))


def taxon_frequency(df: DataFrame, survey_keys: Sequence[str], taxon: str) -> DataFrame:
    """In how many surveys each taxon occurs."""
    return df.select(*_cols(survey_keys), F.col(taxon)).distinct().groupBy(taxon).agg(
        F.count(F.lit(1)).alias("n_surveys")
    )


def resurveyed(df: DataFrame, key: str, year: str) -> DataFrame:
    """Sites seen in more than one year."""
    return df.groupBy(key).agg(n_distinct(F.col(year)).cast("bigint").alias("n_years")).filter("n_years > 1")


def site_uniqueness(df: DataFrame, place: str, year: str, date: str, site: str) -> DataFrame:
    """Per coordinate text: rows, and distinct years, dates and site ids (NULL counted)."""
    return df.groupBy(place).agg(
        F.count(F.lit(1)).alias("n_rows"),
        n_distinct(F.col(year)).cast("bigint").alias("n_years"),
        n_distinct(F.col(date)).cast("bigint").alias("n_dates"),
        n_distinct(F.col(site)).cast("bigint").alias("n_ids"),
    )


def richness(df: DataFrame, survey_keys: Sequence[str], taxon: str, value: str,
             listed: DataFrame | None = None, name: str = "maxRich", listed_name: str = "murphyRich") -> DataFrame:
    """Taxa present per survey, and those on a reference list; surveys without any stay with 0.

    ``listed`` has one column of taxon names.
    """
    present = df.groupBy(*_cols(survey_keys), F.col(taxon)).agg(
        F.coalesce(F.max((F.col(value) > 0).cast("int")), F.lit(0)).alias("_present")
    )
    counts = [F.sum("_present").cast("bigint").alias(name)]
    if listed is not None:
        names = listed.select(F.col(listed.columns[0]).alias(taxon), F.lit(1).alias("_listed")).distinct()
        present = join_nullsafe(present, names, [taxon], "left")
        counts.append(F.sum(F.col("_present") * F.coalesce("_listed", F.lit(0))).cast("bigint").alias(listed_name))
    return present.groupBy(*_cols(survey_keys)).agg(*counts)


def freq_table(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, missing excluded."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Two-way counts with all values of ``b`` as columns, or the listed ones; missing excluded.

    ``unlisted_labels`` tells what a list leaves out.
    """
    complete = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return complete.groupBy(a).pivot(b, None if values is None else list(values)).agg(F.count(F.lit(1))).na.fill(0)


def column_means(df: DataFrame, columns: Sequence[str], name: str = "var", value: str = "meanEff") -> DataFrame:
    """Mean of each column as (name, mean) rows."""
    return transpose_stats(df.agg(*[F.avg(c).alias(c) for c in columns]), name, value)


def min_where(df: DataFrame, condition: Column, column: str, name: str) -> DataFrame:
    return df.filter(condition).agg(F.min(column).alias(name))


def max_of(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.max(column).alias(name))


def corr_matrix(df: DataFrame, columns: Sequence[str], use: str = "everything", digits: int | None = 2,
                labels: Mapping[str, str] | None = None) -> DataFrame:
    """Pearson correlations of the upper triangle as (a, b, r) rows.

    ``everything``: a missing value in either column makes the pair missing.
    ``pairwise``: rows complete in both columns are used. A constant column gives NULL.

    Each row yields its column pairs, which are reduced inside the task, so the shuffle carries one
    row per pair and task. The plan stays the same size for any number of columns.
    """
    if use not in ("everything", "pairwise"):
        raise ValueError(use)
    names = labels or {}
    cells = [F.col(f"`{c}`").cast("double") for c in columns]
    pairs = list(combinations(range(len(columns)), 2))
    entries = [F.struct(F.lit(k).alias("pair"), cells[i].alias("x"), cells[j].alias("y"))
               for k, (i, j) in enumerate(pairs)]
    long = df.select(F.inline(F.array(*entries)))
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    masked = long.withColumns({"x": F.when(both, F.col("x")), "y": F.when(both, F.col("y"))})
    r = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    if use == "everything":
        r = strict(r, F.col("x"))
    title = [names.get(c, c) for c in columns]
    left, right = (F.array(*[F.lit(title[p[side]]) for p in pairs]) for side in (0, 1))
    by_pair = masked.groupBy("pair").agg((r if digits is None else F.round(r, digits)).alias("r"))
    return by_pair.select(F.get(left, "pair").alias("a"), F.get(right, "pair").alias("b"), "r")


def residuals(df: DataFrame, observed: str, predicted: str, name: str = "rawResid") -> DataFrame:
    return df.withColumn(name, F.col(observed) - F.col(predicted))


def pearson_gof(df: DataFrame, residual: str, predicted: str) -> DataFrame:
    """Sum of squared residuals over predictions."""
    r, p = F.col(residual), F.col(predicted)
    return df.agg(F.sum(F.try_divide(r * r, p)).alias("pearson_gof"))


def histogram(df: DataFrame, column: str, low: float | None = None, high: float | None = None, bins: int = 30) -> DataFrame:
    """Rows per equal-width bin of [low, high]; the top edge belongs to the last bin.

    Bounds that are not given are the column's own least and greatest value. Rows below and above given
    bounds are counted in the bins -1 and ``bins``. Missing values have no bin.
    """
    c = F.col(column).cast("double")
    if low is None or high is None:
        own = df.agg(F.min(c), F.max(c)).first()
        low, high = own[0] if low is None else low, own[1] if high is None else high
        if low is None or high is None:  # no value at all
            low = high = 0.0
    width = (high - low) / bins
    inside = F.least(F.floor((c - F.lit(low)) / F.lit(width)).cast("int"), F.lit(bins - 1)) if width else F.lit(0)
    place = F.when(c < low, -1).when(c > high, bins).otherwise(inside)
    return df.filter(c.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
