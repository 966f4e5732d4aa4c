"""Site-year chemistry, richness, and the joined analysis table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos import fixed_values as fixed
from limnos.functions.text import squish, sentence_case, word
from limnos.operators.aggregates import richness, seasonal_weighted_mean
from limnos.operators.columns import filter_not_in
from limnos.operators.joins import full_join, join_nullsafe
from limnos.operators.reshape import cast_wide
from limnos.operators.sets import master_list

SITE_YEAR = ["samplingSiteId", "samplingYr"]


def coalesce_priority(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """First available of several columns; the sources are dropped."""
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in columns])).drop(*columns)


def seasonal_chemistry(chemistry: DataFrame, surveys: DataFrame,
                       dropped: Sequence[str] = fixed.DROPPED_CODES) -> DataFrame:
    """Seasonal mean per surveyed site, year and parameter.

    A site-year listed several times would repeat its samples evenly, which leaves every mean as it
    is, so a semi-join replaces the join and no rows are multiplied.
    """
    dated = (
        chemistry.filter(F.col("val").isNotNull())
        .withColumn("_date", F.col("samplingDate").try_cast("date"))
        .withColumn("samplingYr", F.year("_date"))
    )
    wanted = join_nullsafe(dated, surveys.select(*SITE_YEAR), SITE_YEAR, "left_semi")
    kept = filter_not_in(wanted, "propertyCode", dropped)
    return seasonal_weighted_mean(kept, [*SITE_YEAR, "propertyCode"], "_date", "val")


def site_year_chemistry(
    chemistry: DataFrame,
    surveys: DataFrame,
    codes: Sequence[str],
    dropped: Sequence[str] = fixed.DROPPED_CODES,
    sparse: Sequence[str] = fixed.SPARSE_CODES,
    nitrogen: Sequence[str] = fixed.TOTAL_NITROGEN_PRIORITY,
    total: str = "TN",
) -> DataFrame:
    """One row per site-year and one column per kept parameter, total nitrogen from the best method."""
    long = seasonal_chemistry(chemistry, surveys, dropped)
    columns = [c for c in codes if c not in set(sparse) and c not in set(dropped)]
    wide = cast_wide(long, SITE_YEAR, "propertyCode", "val", columns)
    sources = [c for c in nitrogen if c in columns]
    return coalesce_priority(wide, sources, total) if sources else wide


def two_word_name(name: Column) -> Column:
    """Species-level form of a listed name; missing when there is only one word."""
    return squish(sentence_case(word(name, 1, 2)))


def reference_taxa(reference: DataFrame) -> DataFrame:
    """Distinct species, synonyms and genera of the species; synonym genera are not part of it."""
    names = reference.select(
        two_word_name(F.col("Species")).alias("species"), two_word_name(F.col("Synonym")).alias("synonym")
    ).withColumn("genus", word(F.col("species"), 1))
    return master_list(names, ["species", "synonym", "genus"], "taxon")


def richness_join(surveys: DataFrame, taxa: DataFrame, reference: DataFrame, chemistry: DataFrame,
                  survey: str = "sampleId", taxon: str = "taxaClean", value: str = "value") -> DataFrame:
    """Surveys with total and listed richness, fully joined with site-year chemistry."""
    counts = richness(taxa, [survey], taxon, value, reference_taxa(reference))
    counted = join_nullsafe(surveys, counts, [survey], "left").na.fill(0, subset=["maxRich", "murphyRich"])
    return full_join(counted, chemistry, SITE_YEAR)
