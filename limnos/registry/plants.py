"""Orders in the role of plant survey samples, nested as landed, and the same rows stated as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from limnos import fixed_values as fixed
from limnos.registry.core import Role, landed_once
from limnos.session import spread

_K = "CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 8 AS INT)"
_DAY = "CAST(o_orderdate AS DATE)"

PLANTS = Role(
    "orders",
    {
        "sampleId": "o_orderkey",
        "samplingSiteId": "o_custkey",
        "samplingDate": f"CAST({_DAY} AS STRING)",
        "samplingSiteX": "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey * 100 AS STRING) END",
        "samplingSiteY": "CASE WHEN o_orderstatus <> 'F' AND o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey * 7 AS STRING) END",
        "observationCount": f"{_K} + 1",
        "county": "concat('C', CAST(o_custkey % 21 AS STRING))",
        "subProgramName": "o_orderpriority",
        # metadata texts
        "level_text": "CASE WHEN o_orderstatus = 'O' THEN 'Normal' END",
        "drainage_text": "CASE WHEN o_orderstatus = 'F' THEN 'Uppgift saknas' ELSE 'MÅTTLIG sänkning' END",
        "impact_text": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Saknas' ELSE 'Dämning' END",
        "secchi_text": f"CASE WHEN o_orderpriority = '1-URGENT' THEN concat('>', CAST({_K} AS STRING)) WHEN o_orderpriority = '2-HIGH' "
                       f"THEN concat(CAST({_K} AS STRING), ',5-', CAST({_K} + 1 AS STRING), ',25') "
                       f"WHEN o_orderpriority = '3-MEDIUM' THEN 'okänt' ELSE concat(CAST({_K} AS STRING), ',25') END",
        # indices
        "indexed": "(o_orderstatus <> 'P')",
        "rich_text": f"concat(CAST({_K} + 3 AS STRING), '.0')",
        "tmi_text": f"concat(CAST({_K} AS STRING), '.75 p')",
        "inputs_text": f"concat('Summa produkt=', CAST({_K} + 50 AS STRING), '.6;Summa viktfaktor=', CAST({_K} + 7 AS STRING), '.3')",
        # observations
        "bare": "(o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM')",
        "taxon_a": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Carex × saamica' WHEN o_orderpriority = '2-HIGH' THEN ' isoëtes LACUSTRIS' "
                   "WHEN o_orderpriority = '3-MEDIUM' THEN 'Inget fynd' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Nitella flexilis/opaca' "
                   "ELSE 'Ranunculus Batrachium agg.' END",
        "taxon_b": "CASE WHEN o_orderstatus = 'O' THEN 'Iris' WHEN o_orderstatus = 'F' THEN 'Sphagnum subg. Cuspidata' "
                   "ELSE 'Chara globularis var. virgata' END",
        "taxon_c": f"CASE WHEN {_K} < 2 THEN 'carex x Lasiocarpa' WHEN {_K} < 4 THEN 'Chara s.lat.' WHEN {_K} < 6 THEN 'Isoëtes lacustris' END",
        "depth_a": f"concat(CAST({_K} AS STRING), ',5')",
        "depth_b": f"CASE WHEN {_K} < 6 THEN concat(CAST({_K} + 1 AS STRING), ',75') ELSE 'djupt' END",
        "method_a": "CASE WHEN o_orderstatus = 'O' THEN 'Kratta' WHEN o_orderstatus = 'F' THEN 'SNORKLING' END",
        "grain_a": f"CASE WHEN {_K} < 3 THEN 'Ler ≤ 0,002 mm' WHEN {_K} < 5 THEN 'Block 200-630 mm' END",
        "grain_b": f"CASE WHEN {_K} >= 5 THEN 'Sten >63-200 mm' WHEN {_K} = 4 THEN 'okänd' END",
        "crs_a": "CASE WHEN o_orderstatus = 'O' THEN 'SWEREF99 TM' ELSE 'RT90' END",
        "start_x": "CAST(o_custkey * 10 AS STRING)",
        "analysed": f"CASE WHEN o_orderpriority = '2-HIGH' THEN CAST({_DAY} + 1 AS STRING) ELSE CAST({_DAY} AS STRING) END",
    },
    shared=[_K],
)

ATTRIBUTES = ["sampleId", "samplingSiteId", "samplingDate", "samplingSiteX", "samplingSiteY", "observationCount", "county", "subProgramName"]

_LABELS = {v: k for k, v in fixed.OBSERVATION_METADATA_NAMES.items()}
_SAMPLE_LABELS = {v: k for k, v in fixed.SAMPLE_METADATA_NAMES.items()}


def _entries(pairs: dict[str, str]) -> str:
    return "array(" + ", ".join(f"named_struct('label', '{k}', 'value', {v})" for k, v in pairs.items()) + ")"


def _observation(number: int, taxon: str, metadata: dict[str, str]) -> str:
    labelled = _entries({_LABELS[k]: v for k, v in metadata.items()})
    return (
        f"named_struct('observationId', sampleId * 3 + {number}, 'qualityCode', 'N/A', 'analysisDate', analysed, "
        f"'propertyName', {taxon}, 'observationMetadata', {labelled}, "
        f"'observationValues', array(named_struct('observationId', sampleId * 3 + {number}, 'value', '1')))"
    )


_A = _observation(0, "taxon_a", {"waterDepth": "depth_a", "samplingMethod": "method_a", "dominantInorgSubstrateV1": "grain_a",
                                 "siteCoordCRS": "crs_a", "siteCoordStartX": "start_x"})
_B = _observation(1, "taxon_b", {"waterDepth": "depth_b", "dominantInorgSubstrateV3": "grain_b"})
_C = _observation(2, "taxon_c", {"waterDepth": "depth_b", "dominantInorgSubstrateV1": "grain_a"})
_INDEX = (
    "named_struct('indexShortName', '{name}', 'indexValue', {value}, 'inputValuesText', {inputs})"
)
_INDEX_LIST = ", ".join([
    _INDEX.format(name=fixed.INDEX_RICHNESS, value="rich_text", inputs="CAST(NULL AS STRING)"),
    _INDEX.format(name=fixed.INDEX_LISTED_RICHNESS, value="rich_text", inputs="CAST(NULL AS STRING)"),
    _INDEX.format(name=fixed.INDEX_TROPHIC, value="tmi_text", inputs="inputs_text"),
])
_METADATA = _entries({_SAMPLE_LABELS["waterLevel"]: "level_text", _SAMPLE_LABELS["lakeDrainage"]: "drainage_text",
                      _SAMPLE_LABELS["hydromorphImpact"]: "impact_text", _SAMPLE_LABELS["secchi"]: "secchi_text"})


def plant_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested survey samples, each built from its own row."""
    parts = f"array(named_struct('indexQualityFlag', 'ok', 'indexList', array({_INDEX_LIST})))"
    full = f"array({_A}, {_B}, {_C})"
    return landed_once(spark, sf_dir, "plant-samples", lambda: spread(PLANTS.df(spark, sf_dir)).selectExpr(
        *ATTRIBUTES, f"{_METADATA} AS sampleMetadata", f"slice({parts}, 1, CASE WHEN indexed THEN 1 ELSE 0 END) AS sampleIndices",
        f"slice({full}, 1, CASE WHEN bare THEN 0 ELSE 3 END) AS observations", "CAST(NULL AS STRING) AS stationMetadata",
        "'n' AS nationalStationId", "'n' AS nationalSiteId",
    ))


# What each recorded name should become, written out by hand.
CLEAN_NAMES = {
    "Carex × saamica": "Carex", " isoëtes LACUSTRIS": "Isoëtes lacustris", "Inget fynd": "Biota", "Nitella flexilis/opaca": "Nitella",
    "Ranunculus Batrachium agg.": "Ranunculus", "Iris": "Iris pseudacorus", "Sphagnum subg. Cuspidata": "Sphagnum",
    "Chara globularis var. virgata": "Chara globularis", "carex x Lasiocarpa": "Carex", "Chara s.lat.": "Chara",
    "Isoëtes lacustris": "Isoëtes lacustris",
}
TAXON_COLUMNS = sorted(set(CLEAN_NAMES.values()) - {"Biota"})
_CLEAN_CASE = "CASE " + " ".join(f"WHEN propertyName = '{k}' THEN '{v}'" for k, v in CLEAN_NAMES.items()) + " ELSE 'Biota' END"

PLANTS_SQL = f"""
plants AS ({PLANTS.sql}),
obs AS (
  SELECT sampleId, samplingDate, taxon_a AS propertyName, analysed AS analysisDate, '1' AS value, depth_a AS waterDepth,
         method_a AS samplingMethod, crs_a AS siteCoordCRS, start_x AS siteCoordStartX, grain_a AS v1, NULL AS v3 FROM plants WHERE NOT bare
  UNION ALL SELECT sampleId, samplingDate, taxon_b, analysed, '1', depth_b, NULL, NULL, NULL, NULL, grain_b FROM plants WHERE NOT bare
  UNION ALL SELECT sampleId, samplingDate, taxon_c, analysed, '1', depth_b, NULL, NULL, NULL, grain_a, NULL FROM plants WHERE NOT bare
  UNION ALL SELECT sampleId, samplingDate, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM plants WHERE bare
),
coded AS (
  SELECT sampleId, propertyName, {_CLEAN_CASE} AS taxaClean, TRY_CAST(value AS DOUBLE) AS value,
    CASE WHEN analysisDate <> samplingDate THEN 1 WHEN analysisDate = samplingDate THEN 0 END AS late,
    TRY_CAST(replace(waterDepth, ',', '.') AS DOUBLE) AS depth, TRY_CAST(siteCoordStartX AS DOUBLE) AS start_x, siteCoordCRS,
    CASE WHEN v1 LIKE 'Ler%' THEN 1.0 WHEN v1 LIKE 'Block%' THEN 5.0 WHEN v3 LIKE 'Sten%' THEN 4.0 END::DOUBLE AS rank,
    CASE WHEN lower(samplingMethod) = 'kratta' THEN 1 ELSE 0 END AS rake, CASE WHEN lower(samplingMethod) = 'snorkling' THEN 1 ELSE 0 END AS snorkel
  FROM obs
),
by_taxon AS (
  SELECT sampleId, taxaClean, coalesce(sum(value), 0) AS value, coalesce(sum(late), 0)::BIGINT AS analysisDate, min(depth) AS waterDepthMin,
    max(depth) AS waterDepthMax, min(start_x) AS siteCoordStartXMin, nullif(coalesce(string_agg(DISTINCT siteCoordCRS, ';' ORDER BY siteCoordCRS), ''), '') AS siteCoordCRS,
    min(rank) AS inorgSubstrateMin, max(rank) AS inorgSubstrateMax, quantile_cont(rank, 0.5) AS med0, avg(rank) AS inorgSubstrateMean,
    sum(rake)::BIGINT AS sampleRake, sum(snorkel)::BIGINT AS sampleSnorkel FROM coded GROUP BY sampleId, taxaClean
),
taxa AS (
  SELECT *, CASE WHEN med0 = floor(med0) THEN med0 WHEN inorgSubstrateMean > med0 THEN ceil(med0) ELSE floor(med0) END AS inorgSubstrateMed FROM by_taxon
),
by_survey AS (
  SELECT sampleId, sum(analysisDate)::BIGINT AS analysisDate, min(waterDepthMin) AS waterDepthMin, max(waterDepthMax) AS waterDepthMax,
    min(siteCoordStartXMin) AS siteCoordStartXMin, nullif(coalesce(string_agg(DISTINCT siteCoordCRS, ';' ORDER BY siteCoordCRS), ''), '') AS siteCoordCRS,
    min(inorgSubstrateMin) AS inorgSubstrateMin, max(inorgSubstrateMax) AS inorgSubstrateMax, quantile_cont(inorgSubstrateMed, 0.5) AS med1,
    avg(inorgSubstrateMean) AS mean1, sum(sampleRake)::BIGINT AS sampleRake, sum(sampleSnorkel)::BIGINT AS sampleSnorkel FROM taxa GROUP BY sampleId
),
covariates AS (
  SELECT *, CASE WHEN med1 = floor(med1) THEN med1 WHEN mean1 > med1 THEN ceil(med1) ELSE floor(med1) END AS inorgSubstrateMed FROM by_survey
),
located AS (SELECT * FROM plants WHERE (samplingSiteX IS NOT NULL OR samplingSiteY IS NOT NULL) AND samplingSiteId <> 6679),
chosen AS (SELECT * FROM located QUALIFY rank() OVER (PARTITION BY samplingSiteId ORDER BY samplingDate, observationCount DESC) = 1)
"""
