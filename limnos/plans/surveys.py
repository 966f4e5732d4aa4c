"""Plant survey samples -> one row per survey, taxa in long or wide form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos import fixed_values as fixed
from limnos.functions import text, values
from limnos.operators.aggregates import covariate_summary, taxon_frequency
from limnos.operators.columns import neq_flag, onehot_flags, presence_flag, split_constant_columns, valid_sites
from limnos.operators.joins import join_nullsafe, lookup_join
from limnos.operators.nested import eav_to_columns, explode_outer, parse_kv
from limnos.operators.picks import highest_effort
from limnos.operators.reshape import cast_wide_fill
from limnos.session import in_parts, new_path
from limnos.sources.landed import save_and_reload

SURVEY = "sampleId"
MINIMA = ["waterDepth", "siteCoordStartX", "siteCoordStartY", "siteCoordEndX", "siteCoordEndY"]
METHODS = list(fixed.METHOD_FLAGS)


def index_cell(indices: str, label: str) -> Column:
    """Present values of one survey index, joined by ``|`` in list order; NULL without any."""
    entries = F.flatten(F.transform(F.col(indices), lambda part: part["indexList"]))
    chosen = F.filter(entries, lambda e: (e["indexShortName"] == label) & e["indexValue"].isNotNull())
    return F.nullif(F.array_join(F.transform(chosen, lambda e: e["indexValue"]), "|"), F.lit(""))


def index_inputs(indices: str) -> Column:
    """Present input texts of all survey indices, joined by ``|``."""
    entries = F.flatten(F.transform(F.col(indices), lambda part: part["indexList"]))
    texts = F.filter(F.transform(entries, lambda e: e["inputValuesText"]), lambda t: t.isNotNull())
    return F.nullif(F.array_join(texts, "|"), F.lit(""))


def prune_by_content(samples: DataFrame) -> DataFrame:
    """Drop attributes without any value or with a single one; nested columns and keys stay. Runs one job."""
    needed = {SURVEY, "samplingDate", *[n for n, kind in samples.dtypes if kind.startswith("array")]}
    varying, _ = split_constant_columns(samples.drop(*needed))
    return samples.select([F.col(f"`{n}`") for n in samples.columns if n in needed or n in varying.columns])


def survey_base(
    samples: DataFrame,
    sample_labels: Mapping[str, str] = fixed.SAMPLE_METADATA_NAMES,
    station_labels: Mapping[str, str] = {},
) -> DataFrame:
    """One row per sample: attributes, sample (and chosen station) metadata and the survey indices.

    Everything is read out of the row's own arrays, so the step needs no shuffle.
    """
    indexed = samples.withColumns(
        {
            "rich": text.extract_number(index_cell("sampleIndices", fixed.INDEX_RICHNESS)),
            "tmiRich": text.extract_number(index_cell("sampleIndices", fixed.INDEX_LISTED_RICHNESS)),
            "tmi": text.extract_number(index_cell("sampleIndices", fixed.INDEX_TROPHIC)),
            fixed.INDEX_INPUTS: index_inputs("sampleIndices"),
        }
    )
    parsed = parse_kv(
        indexed, fixed.INDEX_INPUTS, fixed.INDEX_PRODUCT_SUM, fixed.INDEX_WEIGHT_PREFIX,
        ("productSum", "weightFactorSum"),
    )
    labelled = eav_to_columns(parsed, "sampleMetadata", sample_labels)
    if station_labels:
        labelled = eav_to_columns(labelled, "stationMetadata", station_labels)
    return labelled.drop("sampleIndices", fixed.INDEX_INPUTS, "observations", "stationMetadata", "stdSamplingMethod")


def survey_observations(samples: DataFrame) -> DataFrame:
    """One row per recorded value with its metadata as columns; empty surveys keep one row."""
    slim = samples.select(SURVEY, "samplingDate", "observations")
    observed = explode_outer(slim, "observations", "obs_")
    valued = explode_outer(observed, "observationValues", "val_")
    columns = eav_to_columns(valued, "observationMetadata", fixed.OBSERVATION_METADATA_NAMES)
    keep = [SURVEY, "samplingDate", "propertyName", "qualityCode", "analysisDate", "value"]
    return columns.select(*keep, *fixed.OBSERVATION_METADATA_NAMES.values())


def survey_flatten(samples: DataFrame, prune: bool = False) -> tuple[DataFrame, DataFrame]:
    """(one row per survey, one row per recorded value)."""
    kept = prune_by_content(samples) if prune else samples
    return survey_base(kept), survey_observations(samples)


def clean_taxon_name(name: Column) -> Column:
    """Recorded name -> name used for counting: placeholder for excluded groups, genus for hybrids,
    no infraspecific parts, common names translated."""
    tidy = F.trim(text.sentence_case(name))
    screened = F.when(F.coalesce(tidy.isin(*fixed.EXCLUDED_TAXA), F.lit(True)), fixed.PLACEHOLDER_TAXON).otherwise(tidy)
    hybrid = text.detect(screened, *fixed.HYBRID_MARKS)
    genus = F.when(hybrid, text.word(screened, 1)).otherwise(screened)
    plain = F.trim(text.replace_many(genus, fixed.AGGREGATE_PATTERNS))
    for mark in fixed.INFRASPECIFIC_MARKS:
        plain = text.remove_from(plain, mark)
    return text.replace_many(plain, fixed.TAXON_PATTERNS)


def taxon_names(observations: DataFrame, name: str = "propertyName", out: str = "taxaClean") -> DataFrame:
    """Each recorded name with its clean one and its number of rows (``_rows``).

    Saved in the shared folder, so that Spark knows their size and sends few names to the rows: as a plan they would have the
    size of the observations, and all rows would be dealt by a handful of names.
    """
    counted = observations.groupBy(name).agg(F.count(F.lit(1)).alias("_rows"))
    return save_and_reload(counted.withColumn(out, clean_taxon_name(F.col(name))), new_path(observations.sparkSession, "taxon-names"))


def taxon_clean(observations: DataFrame, name: str = "propertyName", out: str = "taxaClean") -> DataFrame:
    """Clean each distinct name once and attach it; names are few, rows are many."""
    return lookup_join(observations, taxon_names(observations, name, out).drop("_rows"), name)


def taxon_table(observations: DataFrame, survey_keys: Sequence[str] = (SURVEY,),
                name: str = "propertyName") -> DataFrame:
    """Recorded name, its clean name and the number of surveys it occurs in."""
    counted = taxon_frequency(observations, survey_keys, name)
    return counted.withColumn("taxaClean", clean_taxon_name(F.col(name)))


def recode_observations(observations: DataFrame) -> DataFrame:
    """Numbers, 0/1 flags, sampling methods and substrate ranks from the recorded text."""
    v1 = values.label_rank(F.col("dominantInorgSubstrateV1"), fixed.SUBSTRATE_RANKS_V1)
    v3 = values.label_rank(F.col("dominantInorgSubstrateV3"), fixed.SUBSTRATE_RANKS_V3)
    coordinates = MINIMA[1:]
    numeric = observations.withColumns(
        {
            "value": text.to_number(F.col("value")),
            "waterDepth": text.parse_decimal_comma(F.col("waterDepth")),
            **{c: text.to_number(F.col(c)) for c in coordinates},
            "dominantOrgSubstrate": F.lower("dominantOrgSubstrate"),
            "dominantSubstrate": presence_flag(F.col("dominantSubstrate")),
            "analysisDate": neq_flag(F.col("analysisDate"), F.col("samplingDate")),
            "qualityCode": text.null_if(F.col("qualityCode"), "N/A"),
            "dominantInorgSubstrate": values.sum_nonnull(v1, v3),
        }
    )
    flagged = onehot_flags(numeric, "samplingMethod", fixed.METHOD_FLAGS)
    return flagged.drop("samplingMethod", "dominantInorgSubstrateV1", "dominantInorgSubstrateV3")


def _summary(df: DataFrame, keys: Sequence[str], suffixed: bool, sums: dict[str, str]) -> DataFrame:
    """Covariates per group, missing ignored; ``suffixed`` sources already end in Min and Max."""
    low = {f"{c}Min": f"{c}Min" if suffixed else c for c in MINIMA}
    high = {f"{c}Max": f"{c}Max" if suffixed else c for c in MINIMA}
    rank = "dominantInorgSubstrate"
    low["inorgSubstrateMin"] = "inorgSubstrateMin" if suffixed else rank
    high["inorgSubstrateMax"] = "inorgSubstrateMax" if suffixed else rank
    summary = covariate_summary(
        df, keys, sums={**sums, **{m: m for m in METHODS}}, minima=low, maxima=high,
        medians={"inorgSubstrateMed": "inorgSubstrateMed" if suffixed else rank},
        means={"inorgSubstrateMean": "inorgSubstrateMean" if suffixed else rank},
        texts={"siteCoordCRS": "siteCoordCRS"},
    )
    return summary.withColumn(
        "inorgSubstrateMed",
        values.round_median_toward_mean(F.col("inorgSubstrateMed"), F.col("inorgSubstrateMean")),
    )


def survey_taxa(observations: DataFrame) -> DataFrame:
    """Covariates and recorded amount per survey and clean taxon (long form). Runs one job, which saves and counts the names."""
    keys, names = [SURVEY, "taxaClean"], taxon_names(observations)
    rows = names.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    named = lookup_join(recode_observations(observations), names.drop("_rows"), "propertyName")
    return _summary(in_parts(named, keys, rows), keys, False, {"value": "value", "analysisDate": "analysisDate"})


def survey_covariates(taxa: DataFrame) -> DataFrame:
    """Covariates per survey: the median of medians and the mean of means over its taxa."""
    return _summary(taxa, [SURVEY], True, {"analysisDate": "analysisDate"}).drop("inorgSubstrateMean")


def present_taxa(taxa: DataFrame) -> DataFrame:
    """(survey, taxon, amount) without the placeholder."""
    return taxa.filter(F.col("taxaClean") != fixed.PLACEHOLDER_TAXON).select(SURVEY, "taxaClean", "value")


def community_wide(taxa: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per survey and one column per listed taxon, absences 0; surveys without taxa stay."""
    return cast_wide_fill(taxa, [SURVEY], "taxaClean", "value", names, 0, fixed.PLACEHOLDER_TAXON)


def fix_attributes(df: DataFrame) -> DataFrame:
    """Missing-value words, transparency depth, integer richness, dates and the coordinate key."""
    drainage = text.sentence_case(F.col("lakeDrainage"))
    fixed_up = df.withColumns(
        {
            "hydromorphImpact": text.null_if_contains(F.col("hydromorphImpact"), fixed.MISSING_TEXT),
            "lakeDrainage": F.when(~drainage.contains(fixed.MISSING_TEXT), drainage),
            "secchi": text.secchi_depth(F.col("secchi")),
            "rich": text.to_number(F.col("rich"), "int"),
            "tmiRich": text.to_number(F.col("tmiRich"), "int"),
            "tmi": text.to_number(F.col("tmi")),
            "siteIdUnique": text.concat_na(F.col("samplingSiteX"), F.col("samplingSiteY")),
        }
    )
    return values.date_parts(fixed_up, "samplingDate").drop("nationalStationId", "nationalSiteId")


def select_surveys(df: DataFrame) -> DataFrame:
    """Located sites, their earliest survey and of same-day surveys the one with most observations."""
    located = valid_sites(df, "samplingSiteX", "samplingSiteY", "samplingSiteId", fixed.MISLOCATED_SITES)
    return highest_effort(located, "samplingSiteId", "samplingDateD", "observationCount")


def community_surveys(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(selected surveys with covariates, their taxa in long form).

    Which surveys are selected depends on their own attributes only, so they are selected first, and only
    their metadata are parsed and their observations summarised. Both tables are read more than once and
    therefore saved in the shared folder, so the nested samples are not unpacked again.
    """
    spark = samples.sparkSession
    selected = select_surveys(values.date_parts(samples, "samplingDate")).select(*[F.col(f"`{n}`") for n in samples.columns])
    chosen = save_and_reload(fix_attributes(survey_base(selected)), new_path(spark, "chosen-surveys"))
    recorded = samples.select(SURVEY, "samplingDate", "observations")
    wanted = join_nullsafe(recorded, chosen.select(SURVEY), [SURVEY], "left_semi")
    taxa = save_and_reload(survey_taxa(survey_observations(wanted)), new_path(spark, "survey-taxa"))
    return join_nullsafe(chosen, survey_covariates(taxa), [SURVEY], "left"), present_taxa(taxa)


def community_table(samples: DataFrame, names: Sequence[str]) -> DataFrame:
    """The flat survey table: attributes and covariates, then one column per listed taxon."""
    chosen, kept = community_surveys(samples)
    columns = [n for n in names if n != fixed.PLACEHOLDER_TAXON]
    joined = join_nullsafe(chosen, community_wide(kept, columns), [SURVEY], "left").na.fill(0, subset=columns)
    return joined.drop(*fixed.SURVEY_COLUMNS_DROPPED_AT_END)
