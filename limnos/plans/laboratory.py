"""Laboratory samples -> one clean value per site, date and parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos import fixed_values as fixed
from limnos.functions.text import parse_censored, parse_decimal_comma
from limnos.operators.aggregates import (
    distinct_excess,
    distinct_rows,
    duplicate_groups,
    duplicate_rate,
    group_mean_strict,
)
from limnos.operators.columns import filter_in
from limnos.operators.joins import join_nullsafe_left, semi_join
from limnos.operators.nested import unnest_with_prefix
from limnos.operators.picks import later_occurrences, shallowest, sort_rows
from limnos.session import new_path
from limnos.sources.landed import restrict_to_stations, save_and_reload

OCCASION = ["samplingSiteId", "samplingDate", "propertyAbbrevName"]
DICTIONARY = ["propertyCode", "propertyAbbrevName", "propertyName", "unit"]


def flatten_laboratory(samples: DataFrame) -> DataFrame:
    """Samples -> observations -> values; samples without observations drop out."""
    observed = unnest_with_prefix(samples, "observations", "obs_", drop_copies=True)
    return unnest_with_prefix(observed, "observationValues", "val_", drop_copies=True)


def measured_values(flat: DataFrame, parameters: Sequence[str] = fixed.PARAMETER_NAMES) -> DataFrame:
    """Listed parameters with their value as a number; unreadable values are purged."""
    return (
        filter_in(flat, "propertyName", parameters)
        .withColumn("valueNew", parse_censored(F.col("value")))
        .filter(F.col("valueNew").isNotNull())
        .withColumn("editDate", F.col("lastEdit").try_cast("date"))
    )


def unit_factors(dictionary: DataFrame) -> DataFrame:
    """(propertyAbbrevName, unitC, unitAlt, convFact) of the dictionary as landed."""
    return dictionary.select(
        "propertyAbbrevName", "unitC", "unitAlt", parse_decimal_comma(F.col("convFactRaw")).alias("convFact")
    )


def harmonise_units(df: DataFrame, factors: DataFrame) -> DataFrame:
    """Value times factor in the target unit. A parameter-unit pair the dictionary lacks becomes NULL."""
    joined = join_nullsafe_left(df.withColumnRenamed("unit", "unitC"), factors, ["propertyAbbrevName", "unitC"])
    return (
        joined.withColumn("unitF", F.col("unitAlt"))
        .withColumn("valF", F.col("valueNew") * F.col("convFact"))
        .drop("valueNew", "unitC", "unitAlt", "convFact")
    )


def alk_acid_rule(df: DataFrame) -> DataFrame:
    """Negative-signed alkalinity/acidity is 0 and the parameter is recoded as alkalinity.

    The abbreviation is rewritten before the name is looked at, so ``propertyName`` keeps its text:
    the two sources of alkalinity stay apart in the depth mean and may tie afterwards.
    """
    is_mixed = F.col("propertyAbbrevName") == fixed.ALK_ACID
    return (
        df.withColumn("valF", F.when(is_mixed & F.col("value").contains("-"), F.lit(0.0)).otherwise(F.col("valF")))
        .withColumn("propertyCode", F.when(is_mixed, fixed.ALK_CODE).otherwise(F.col("propertyCode")))
        .withColumn("propertyAbbrevName", F.when(is_mixed, fixed.ALK_ABBREV).otherwise(F.col("propertyAbbrevName")))
        .withColumn("propertyName", F.when(is_mixed, fixed.ALK_NAME).otherwise(F.col("propertyName")))
    )


def mean_same_depth(df: DataFrame, keys: Sequence[str] = fixed.DEPTH_MEAN_KEYS) -> DataFrame:
    """Mean value and latest edit date of samples from the same depth."""
    return group_mean_strict(df, [k for k in keys if k in df.columns], "valF", "editDate")


def chemistry_clean(samples: DataFrame, stations: DataFrame, dictionary: DataFrame,
                    product_type: str | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """From nested samples to the shallowest value per site, date and parameter (long form).

    The depth means are saved in the shared folder: picking the shallowest reads them twice, and
    flattening and parsing the samples a second time would cost more than that.
    """
    kept = restrict_to_stations(samples, stations, product_type, years)
    values = measured_values(flatten_laboratory(kept))
    means = mean_same_depth(alk_acid_rule(harmonise_units(values, unit_factors(dictionary))))
    return shallowest(save_and_reload(means, new_path(means.sparkSession, "depth-means")), OCCASION)


def duplicate_unit_entries(flat: DataFrame) -> DataFrame:
    """Dictionary entries of every parameter that comes in more than one variant, in code order."""
    entries = distinct_rows(flat, DICTIONARY)
    repeated = later_occurrences(entries, ["propertyCode"], ["propertyAbbrevName", "propertyName", "unit"])
    return sort_rows(semi_join(entries, repeated.select("propertyCode").distinct(), ["propertyCode"]),
                     ["propertyCode"])


def unit_quality_report(flat: DataFrame, values: DataFrame, depth_means: DataFrame) -> DataFrame:
    """Unit variants, duplicated groups before unit conversion and duplicates left after, as rows."""
    station_keys = ["stationId", "samplingDate", "propertyAbbrevName", "minDepth", "maxDepth"]
    groups = duplicate_groups(values, station_keys, "unit")
    counted = groups.agg(F.count(F.lit(1)).alias("duplicate_groups"), F.count_if(F.col("n_units") > 1).alias("mixed_unit_groups"))
    measures = [  # both counts of the groups come from one pass
        distinct_excess(flat, DICTIONARY[:3], "unit").toDF("extra_units"),
        counted,
        duplicate_rate(depth_means, OCCASION).toDF("depth_duplicate_rate"),
    ]
    out = None
    for one in measures:
        entries = [F.struct(F.lit(name).alias("measure"), F.col(name).cast("double").alias("value")) for name in one.columns]
        rows = one.select(F.inline(F.array(*entries)))
        out = rows if out is None else out.unionByName(rows)
    return out
