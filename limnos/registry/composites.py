"""The composite plans over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from limnos import fixed_values as fixed
from limnos.operators.reshape import cast_wide
from limnos.plans import laboratory as P
from limnos.plans import site_years as Y
from limnos.plans import surveys as V
from limnos.registry.columns_and_text import CENSORED_SQL
from limnos.registry.core import CHEMISTRY, LAB_LONG_SQL, lab_samples, query, table
from limnos.registry.joins_and_sets import DICTIONARY_SQL, unit_dictionary
from limnos.registry.plants import ATTRIBUTES, PLANTS_SQL, TAXON_COLUMNS, plant_samples
from limnos.registry.summaries import SEASONAL_SQL

# ---------------------------------------------------------------- laboratory

_NAMES = ", ".join("'" + n + "'" for n in fixed.PARAMETER_NAMES)
_MEASURED_SQL = f"""{LAB_LONG_SQL}, d AS ({DICTIONARY_SQL}),
kept AS (SELECT * FROM lab_long WHERE productType = 'Chemistry' AND stationId IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 1000)),
num AS (SELECT * FROM (SELECT *, {CENSORED_SQL} AS num FROM kept WHERE propertyName IN ({_NAMES})) WHERE num IS NOT NULL),
u AS (SELECT num.*, d.unitAlt AS unitF, num.num * TRY_CAST(replace(d.convFactRaw, ',', '.') AS DOUBLE) AS valF FROM num LEFT JOIN d
  ON num.propertyAbbrevName = d.propertyAbbrevName AND num.unit IS NOT DISTINCT FROM d.unitC),
r AS (SELECT samplingSiteId, samplingDate, minDepth, maxDepth, stationId, CASE WHEN propertyAbbrevName = 'Alk/Acid' THEN 'Alk' ELSE propertyCode END AS propertyCode,
  CASE WHEN propertyAbbrevName = 'Alk/Acid' THEN 'Alk.' ELSE propertyAbbrevName END AS propertyAbbrevName, propertyName, unitF, CAST(lastEdit AS DATE) AS editDate,
  CASE WHEN propertyAbbrevName = 'Alk/Acid' AND value LIKE '%-%' THEN 0 ELSE valF END AS valF, value FROM u),
m AS (SELECT samplingSiteId, samplingDate, minDepth, maxDepth, stationId, propertyCode, propertyAbbrevName, propertyName, unitF,
  CASE WHEN count(editDate) = count(*) THEN max(editDate) END AS lastEditDate, CASE WHEN count(valF) = count(*) THEN avg(valF) END AS val
  FROM r GROUP BY ALL)"""


def _lab_inputs(spark, sf):
    samples = lab_samples(spark, sf)
    stations = table(spark, sf, "supplier").filter("s_acctbal > 1000").selectExpr("s_suppkey AS stationId")
    return samples, stations, unit_dictionary(spark, sf)


@query("chemistry_clean", f"""WITH {_MEASURED_SQL}, s AS (SELECT * FROM m QUALIFY rank() OVER (PARTITION BY samplingSiteId, samplingDate, propertyAbbrevName
  ORDER BY minDepth NULLS LAST, maxDepth NULLS LAST) = 1) SELECT * REPLACE (round(val, 6) AS val) FROM s""")
def chemistry_clean(spark, sf):
    samples, stations, dictionary = _lab_inputs(spark, sf)
    clean = P.chemistry_clean(samples, stations, dictionary, "Chemistry")
    return clean.withColumn("val", F.round("val", 6))


@query("alk_acid_rule", f"WITH {_MEASURED_SQL} SELECT propertyCode, propertyAbbrevName, propertyName, value, valF FROM r")
def alk_acid_rule(spark, sf):
    samples, stations, dictionary = _lab_inputs(spark, sf)
    kept = P.restrict_to_stations(samples, stations, "Chemistry")
    harmonised = P.harmonise_units(P.measured_values(P.flatten_laboratory(kept)), P.unit_factors(dictionary))
    return P.alk_acid_rule(harmonised).select("propertyCode", "propertyAbbrevName", "propertyName", "value", "valF")


@query("unit_quality_report", f"""WITH {_MEASURED_SQL},
  e AS (SELECT count(*) - count(DISTINCT (propertyCode, propertyAbbrevName, propertyName)) AS x FROM (SELECT DISTINCT propertyCode, propertyAbbrevName, propertyName, unit FROM lab_long)),
  g AS (SELECT count(*) AS n, count(DISTINCT unit) + max(CASE WHEN unit IS NULL THEN 1 ELSE 0 END) AS u FROM num
    GROUP BY stationId, samplingDate, propertyAbbrevName, minDepth, maxDepth HAVING count(*) > 1),
  o AS (SELECT count(*) AS n FROM m GROUP BY samplingSiteId, samplingDate, propertyAbbrevName)
  SELECT 'extra_units' AS measure, x::DOUBLE AS value FROM e UNION ALL SELECT 'duplicate_groups', count(*) FROM g
  UNION ALL SELECT 'mixed_unit_groups', count_if(u > 1) FROM g UNION ALL SELECT 'depth_duplicate_rate', sum(n - 1)::DOUBLE / sum(n)::DOUBLE FROM o""")
def unit_quality_report(spark, sf):
    samples, stations, dictionary = _lab_inputs(spark, sf)
    kept = P.restrict_to_stations(samples, stations, "Chemistry")
    values = P.measured_values(P.flatten_laboratory(kept))
    means = P.mean_same_depth(P.alk_acid_rule(P.harmonise_units(values, P.unit_factors(dictionary))))
    return P.unit_quality_report(P.flatten_laboratory(samples), values, means)


@query("duplicate_unit_entries", f"""WITH {LAB_LONG_SQL}, e AS (SELECT DISTINCT propertyCode, propertyAbbrevName, propertyName, unit FROM lab_long)
  SELECT * FROM e QUALIFY count(*) OVER (PARTITION BY propertyCode) > 1""")
def duplicate_unit_entries(spark, sf):
    return P.duplicate_unit_entries(P.flatten_laboratory(lab_samples(spark, sf)))


# ---------------------------------------------------------------- surveys

_ATTRIBUTES = ", ".join(ATTRIBUTES)


@query("survey_base", f"""WITH {PLANTS_SQL} SELECT {_ATTRIBUTES}, level_text AS waterLevel, drainage_text AS lakeDrainage, impact_text AS hydromorphImpact,
  secchi_text AS secchi, CASE WHEN indexed THEN rich_text END AS rich, CASE WHEN indexed THEN split_part(tmi_text, ' ', 1) END AS tmi,
  CASE WHEN indexed THEN regexp_extract(inputs_text, 'produkt=(.*);', 1) END AS productSum,
  CASE WHEN indexed THEN regexp_extract(inputs_text, 'viktfaktor=(.*)', 1) END AS weightFactorSum FROM plants""")
def survey_base(spark, sf):
    base = V.survey_base(plant_samples(spark, sf))
    return base.select(*ATTRIBUTES, "waterLevel", "lakeDrainage", "hydromorphImpact", "secchi", "rich", "tmi", "productSum", "weightFactorSum")


@query("survey_flatten", f"WITH {PLANTS_SQL} SELECT sampleId, propertyName, analysisDate, value, waterDepth, samplingMethod, siteCoordCRS, siteCoordStartX, "
                         "v1 AS dominantInorgSubstrateV1, v3 AS dominantInorgSubstrateV3 FROM obs")
def survey_flatten(spark, sf):
    _, observations = V.survey_flatten(plant_samples(spark, sf))
    return observations.select("sampleId", "propertyName", "analysisDate", "value", "waterDepth", "samplingMethod", "siteCoordCRS",
                               "siteCoordStartX", "dominantInorgSubstrateV1", "dominantInorgSubstrateV3")


@query("taxon_clean", f"WITH {PLANTS_SQL} SELECT propertyName, taxaClean, count(DISTINCT sampleId) AS n_surveys FROM coded GROUP BY 1, 2")
def taxon_clean(spark, sf):
    return V.taxon_table(V.survey_observations(plant_samples(spark, sf)))


_TAXON_FIELDS = ["sampleId", "taxaClean", "value", "analysisDate", "waterDepthMin", "waterDepthMax", "siteCoordStartXMin", "siteCoordCRS",
                 "inorgSubstrateMin", "inorgSubstrateMax", "inorgSubstrateMed", "inorgSubstrateMean", "sampleRake", "sampleSnorkel"]


@query("survey_taxa", f"WITH {PLANTS_SQL} SELECT {', '.join(_TAXON_FIELDS)} FROM taxa")
def survey_taxa(spark, sf):
    return V.survey_taxa(V.survey_observations(plant_samples(spark, sf))).select(*_TAXON_FIELDS).withColumn(
        "inorgSubstrateMin", F.col("inorgSubstrateMin").cast("double")).withColumn(
        "inorgSubstrateMax", F.col("inorgSubstrateMax").cast("double"))


_SURVEY_FIELDS = ["analysisDate", "waterDepthMin", "waterDepthMax", "siteCoordStartXMin", "siteCoordCRS", "inorgSubstrateMed", "sampleRake", "sampleSnorkel"]
_SECCHI_SQL = """CASE WHEN subProgramName = '1-URGENT' THEN TRY_CAST(secchi_text[2:] AS DOUBLE) * 1.1e0
  WHEN subProgramName = '2-HIGH' THEN (TRY_CAST(replace(split_part(secchi_text, '-', 1), ',', '.') AS DECIMAL(18,6)) + TRY_CAST(replace(split_part(secchi_text, '-', 2), ',', '.') AS DECIMAL(18,6)))::DOUBLE / 2
  ELSE TRY_CAST(replace(secchi_text, ',', '.') AS DOUBLE) END"""


@query("community_surveys", f"""WITH {PLANTS_SQL} SELECT {', '.join('p.' + a for a in ATTRIBUTES)}, {', '.join('c.' + f for f in _SURVEY_FIELDS)},
  {_SECCHI_SQL} AS secchi, CASE WHEN drainage_text LIKE '%saknas%' THEN NULL ELSE 'Måttlig sänkning' END AS lakeDrainage,
  CASE WHEN impact_text = 'Saknas' THEN NULL ELSE impact_text END AS hydromorphImpact, CASE WHEN indexed THEN CAST(rich_text::DOUBLE AS INTEGER) END AS rich,
  CASE WHEN indexed THEN split_part(tmi_text, ' ', 1)::DOUBLE END AS tmi, CAST(samplingDate AS DATE) AS samplingDateD,
  CAST(year(CAST(samplingDate AS DATE)) AS INTEGER) AS samplingYr, CAST(month(CAST(samplingDate AS DATE)) AS INTEGER) AS samplingM
  FROM chosen p JOIN covariates c USING (sampleId)""")
def community_surveys(spark, sf):
    chosen, _ = V.community_surveys(plant_samples(spark, sf))
    return chosen.select(*ATTRIBUTES, *_SURVEY_FIELDS, "secchi", "lakeDrainage", "hydromorphImpact", "rich", "tmi", "samplingDateD", "samplingYr", "samplingM")


_WIDE_SQL = ", ".join(f"coalesce(max(CASE WHEN taxaClean = '{t}' THEN value END), 0) AS \"{t}\"" for t in TAXON_COLUMNS)


@query("community_wide", f"WITH {PLANTS_SQL} SELECT sampleId, {_WIDE_SQL} FROM taxa GROUP BY sampleId")
def community_wide(spark, sf):
    taxa = V.survey_taxa(V.survey_observations(plant_samples(spark, sf)))
    return V.community_wide(taxa, TAXON_COLUMNS)


@query("community_table", f"""WITH {PLANTS_SQL}, w AS (SELECT sampleId, {_WIDE_SQL} FROM taxa GROUP BY sampleId)
  SELECT samplingSiteId, samplingDate, observationCount, {', '.join('"' + t + '"' for t in TAXON_COLUMNS)} FROM chosen JOIN w USING (sampleId)""")
def community_table(spark, sf):
    flat = V.community_table(plant_samples(spark, sf), TAXON_COLUMNS)
    return flat.select("samplingSiteId", "samplingDate", "observationCount", *[F.col(f"`{t}`") for t in TAXON_COLUMNS])


# ---------------------------------------------------------------- site-years

_CODES = ["1", "2", "3", "4", "5"]
_SITE_YEAR_SQL = f"""t0 AS ({CHEMISTRY.sql}), surveyed AS (SELECT site, yr FROM t0 WHERE status = 'F'),
  t AS (SELECT * FROM t0 WHERE val IS NOT NULL AND code <> '5' AND (site, yr) IN (SELECT site, yr FROM surveyed)),
  long AS ({SEASONAL_SQL.format(v='val')}),
  wide AS (SELECT site AS samplingSiteId, yr AS samplingYr, max(CASE WHEN code = '1' THEN val END) AS c1, max(CASE WHEN code = '2' THEN val END) AS c2,
    max(CASE WHEN code = '3' THEN val END) AS c3 FROM long GROUP BY ALL),
  chem AS (SELECT samplingSiteId, samplingYr, c1 AS "1", coalesce(c3, c2) AS TN FROM wide)"""


def _chemistry(spark, sf):
    return CHEMISTRY.df(spark, sf).selectExpr("site AS samplingSiteId", "CAST(day AS STRING) AS samplingDate", "code AS propertyCode", "val",
                                              "yr AS samplingYr", "status")


def _site_years(spark, sf):
    chemistry = _chemistry(spark, sf)
    surveys = chemistry.filter("status = 'F'").select("samplingSiteId", "samplingYr")
    return Y.site_year_chemistry(chemistry.drop("samplingYr", "status"), surveys, _CODES, dropped=["5"], sparse=["4"], nitrogen=["3", "2"])


@query("site_year_chemistry", f"WITH {_SITE_YEAR_SQL} SELECT * FROM chem")
def site_year_chemistry(spark, sf):
    return _site_years(spark, sf)


@query("coalesce_priority", f"WITH t AS ({CHEMISTRY.sql}), w AS (SELECT site, " + ", ".join(
    f"max(CASE WHEN code = '{c}' THEN val END) AS c{c}" for c in _CODES) + " FROM t GROUP BY site) SELECT site, c4 AS \"4\", c5 AS \"5\", coalesce(c3, c1, c2) AS best FROM w")
def coalesce_priority(spark, sf):
    wide = cast_wide(CHEMISTRY.df(spark, sf), ["site"], "code", "val", _CODES, several="greatest")
    return Y.coalesce_priority(wide, ["3", "1", "2"], "best")



@query("reference_taxa", """WITH p AS (SELECT upper(p_name[1:1]) || p_name[2:] AS s, CASE WHEN p_size > 25 THEN upper(p_brand[1:1]) || lower(p_brand[2:]) || ' ' || lower(p_type) END AS y FROM part)
  SELECT s AS taxon FROM p UNION SELECT y FROM p UNION SELECT split_part(s, ' ', 1) FROM p""")
def reference_taxa(spark, sf):
    part = table(spark, sf, "part").select(
        F.concat(F.initcap("p_name"), F.lit(" subsp. minor")).alias("Species"),
        F.when(F.col("p_size") > 25, F.concat_ws(" ", "p_brand", "p_type")).otherwise(F.col("p_brand")).alias("Synonym"))
    return Y.reference_taxa(part)


@query("richness_join", f"""WITH {PLANTS_SQL}, {_SITE_YEAR_SQL},
  n AS (SELECT sampleId, count(*) AS maxRich, count_if(taxaClean IN ('Carex', 'Isoëtes lacustris', 'Chara globularis', 'Chara', 'Isoëtes')) AS murphyRich
    FROM taxa WHERE taxaClean <> 'Biota' AND value > 0 GROUP BY sampleId),
  s AS (SELECT sampleId, samplingSiteId, CAST(year(CAST(samplingDate AS DATE)) AS INTEGER) AS samplingYr, coalesce(maxRich, 0) AS maxRich, coalesce(murphyRich, 0) AS murphyRich
    FROM chosen LEFT JOIN n USING (sampleId))
  SELECT sampleId, coalesce(s.samplingSiteId, c.samplingSiteId) AS samplingSiteId, coalesce(s.samplingYr, c.samplingYr) AS samplingYr, maxRich, murphyRich, "1", TN
  FROM s FULL JOIN chem c ON s.samplingSiteId = c.samplingSiteId AND s.samplingYr = c.samplingYr""")
def richness_join(spark, sf):
    samples = plant_samples(spark, sf)
    chosen, taxa = V.community_surveys(samples)
    # names taken from the recorded ones: 'Carex saamica', its genus, and two others with theirs
    reference = V.survey_observations(samples).select("propertyName").distinct().filter(
        F.col("propertyName").isin("carex x Lasiocarpa", "Isoëtes lacustris", "Chara globularis var. virgata")
    ).select(F.regexp_replace("propertyName", " x ", " ").alias("Species"), F.lit(None).cast("string").alias("Synonym"))
    surveys = chosen.select("sampleId", "samplingSiteId", "samplingYr")
    return Y.richness_join(surveys, taxa, reference, _site_years(spark, sf))
