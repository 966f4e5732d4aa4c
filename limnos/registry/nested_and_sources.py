"""Landed files, saved tables, nested arrays and label/value lists."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnos.operators import nested as N
from limnos.operators import reshape as R
from limnos.plans.laboratory import flatten_laboratory
from limnos.registry.core import LAB, LAB_LONG_SQL, SAMPLE_COLUMNS, TAXA, lab_rows, lab_samples, query, table
from limnos.session import new_path
from limnos.sources import landed

_COLUMNS = ", ".join(SAMPLE_COLUMNS)

# ---------------------------------------------------------------- sources and sinks


@query("scan_samples", f"WITH lab AS ({LAB.sql}) SELECT {_COLUMNS}, CASE WHEN empty THEN 0 WHEN warm THEN 2 ELSE 1 END AS n_obs FROM lab")
def scan_samples(spark, sf):
    """Land one JSON document per line, then scan the documents' arrays."""
    samples = lab_rows(spark, sf)
    path = new_path(spark, "documents")
    landed.sink_documents(samples, path)
    return landed.scan_samples(spark, path, samples.schema).select(*SAMPLE_COLUMNS, F.size("observations").alias("n_obs"))


@query("restrict_to_stations", f"""WITH lab AS ({LAB.sql}) SELECT sampleId, stationId, samplingDate FROM lab
  WHERE productType = 'Chemistry' AND year(CAST(samplingDate AS DATE)) BETWEEN 1996 AND 2000
  AND stationId IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 1000)""")
def restrict_to_stations(spark, sf):
    stations = table(spark, sf, "supplier").filter("s_acctbal > 1000").selectExpr("s_suppkey AS stationId")
    kept = landed.restrict_to_stations(lab_samples(spark, sf), stations, "Chemistry", (1996, 2000))
    return kept.select("sampleId", "stationId", "samplingDate")


@query("union_evolving", """SELECT c_custkey AS site, c_name AS name, c_acctbal AS val, NULL::VARCHAR AS note FROM customer
  UNION ALL SELECT s_suppkey, NULL, s_acctbal, s_name FROM supplier""")
def union_evolving(spark, sf):
    first = table(spark, sf, "customer").selectExpr("c_custkey AS site", "c_name AS name", "c_acctbal AS val")
    second = table(spark, sf, "supplier").selectExpr("s_acctbal AS val", "s_suppkey AS site", "s_name AS note")
    schema = T.StructType([T.StructField("site", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("val", T.DoubleType()), T.StructField("note", T.StringType())])
    return landed.union_evolving(first, second, schema=schema)


@query("scan_csv_typed", "SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price, "
                         "CAST(o_orderdate AS DATE) AS day FROM orders")
def scan_csv_typed(spark, sf):
    df = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price",
        "CAST(o_orderdate AS DATE) AS day")
    path = new_path(spark, "csv")
    landed.sink_csv(df, path)
    return landed.scan_csv_typed(spark, path, df.schema)


@query("scan_reference_list", f"WITH t AS ({TAXA.sql}) SELECT plain AS Species, nullif(trim(recorded), '') AS Synonym FROM t")
def scan_reference_list(spark, sf):
    path = new_path(spark, "list")
    landed.sink_csv(TAXA.df(spark, sf).select(F.col("plain").alias("Species"), F.trim("recorded").alias("Synonym")), path)
    return landed.scan_reference_list(spark, path)


@query("checkpoint", f"WITH lab AS ({LAB.sql}) SELECT sampleId, CASE WHEN empty THEN 0 WHEN warm THEN 2 ELSE 1 END AS n_obs, "
                          "CASE WHEN NOT empty THEN propertyCode END AS first_code FROM lab")
def checkpoint(spark, sf):
    saved = landed.save_and_reload(lab_rows(spark, sf), new_path(spark, "saved"))
    return saved.select("sampleId", F.size("observations").alias("n_obs"),
                        F.get("observations", F.lit(0))["propertyCode"].alias("first_code"))


@query("sink_csv", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def sink_csv(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    path = new_path(spark, "flat")
    landed.sink_csv(df, path)
    return landed.scan_csv_typed(spark, path, df.schema)


# ---------------------------------------------------------------- nested arrays


@query("explode_inner", f"WITH {LAB_LONG_SQL} SELECT sampleId, observationId, propertyCode FROM lab_long")
def explode_inner(spark, sf):
    samples = lab_samples(spark, sf).select("sampleId", "observations")
    return N.explode_inner(samples, "observations").select("sampleId", "observationId", "propertyCode")


@query("explode_outer", f"WITH {LAB_LONG_SQL} SELECT sampleId, observationId, propertyCode FROM lab_long "
                        "UNION ALL SELECT sampleId, NULL, NULL FROM lab WHERE empty")
def explode_outer(spark, sf):
    samples = lab_samples(spark, sf).select("sampleId", "observations")
    return N.explode_outer(samples, "observations").select("sampleId", "observationId", "propertyCode")


@query("unnest_with_prefix", f"WITH {LAB_LONG_SQL} SELECT sampleId, sampleId AS obs_sampleId, observationId, propertyName, "
                             "observationId AS val_observationId, propertyName AS name, value, unit FROM lab_long")
def unnest_with_prefix(spark, sf):
    observed = N.unnest_with_prefix(lab_samples(spark, sf).select("sampleId", "observations"), "observations", "obs_")
    valued = N.unnest_with_prefix(observed, "observationValues", "val_")
    return valued.select("sampleId", "obs_sampleId", "observationId", "propertyName", "val_observationId", "name", "value", "unit")


@query("columns_equal", f"WITH {LAB_LONG_SQL} SELECT count_if(observationId IS DISTINCT FROM observationId) AS n_unequal FROM lab_long")
def columns_equal(spark, sf):
    observed = N.unnest_with_prefix(lab_samples(spark, sf), "observations", "obs_")
    valued = N.unnest_with_prefix(observed, "observationValues", "val_")
    return N.unequal_rows(valued, "observationId", "val_observationId")


@query("columns_unequal", "SELECT count_if(l_linenumber IS DISTINCT FROM CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END) AS n_unequal FROM lineitem")
def columns_unequal(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr("l_linenumber", "CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INT) END AS other")
    return N.unequal_rows(df, "l_linenumber", "other")


@query("nested_sizes", f"WITH lab AS ({LAB.sql}) SELECT sampleId, CASE WHEN empty THEN 0 WHEN warm THEN 2 ELSE 1 END AS observations_n FROM lab")
def nested_sizes(spark, sf):
    return N.nested_sizes(lab_samples(spark, sf), ["observations"]).select("sampleId", "observations_n")


@query("without_elements", f"WITH lab AS ({LAB.sql}) SELECT {_COLUMNS} FROM lab WHERE empty")
def without_elements(spark, sf):
    return N.without_elements(lab_samples(spark, sf), "observations").select(*SAMPLE_COLUMNS)


@query("eav_to_columns", f"WITH {LAB_LONG_SQL} SELECT observationId, minDepth AS depth, productType AS method, NULL::VARCHAR AS absent FROM lab_long")
def eav_to_columns(spark, sf):
    observed = N.explode_inner(lab_samples(spark, sf).select("observations"), "observations")
    labels = {"Djup": "depth", "Metod": "method", "Saknad": "absent"}
    columns = N.eav_to_columns(observed.select("observationId", "observationMetadata"), "observationMetadata", labels)
    return columns.withColumn("depth", F.col("depth").cast("double"))


@query("eav_pivot", f"WITH {LAB_LONG_SQL} SELECT observationId, max(minDepth) AS Djup, max(productType) AS Metod FROM lab_long GROUP BY 1")
def eav_pivot(spark, sf):
    observed = N.explode_inner(lab_samples(spark, sf).select("observations"), "observations")
    entries = N.explode_inner(observed.select("observationId", "observationMetadata"), "observationMetadata")
    wide = N.eav_pivot(entries, ["observationId"], "label", "value", ["Djup", "Metod"], several="greatest")
    return wide.withColumn("Djup", F.col("Djup").cast("double"))


@query("parse_kv", """SELECT event_id, regexp_extract(props, '[0-9]+') || '.5' AS productSum, CAST(event_id AS VARCHAR) AS weightFactorSum FROM events""")
def parse_kv(spark, sf):
    from limnos import fixed_values as fixed

    source = table(spark, sf, "events").select("event_id", F.concat(
        F.lit("Summa produkt="), F.regexp_extract("props", "[0-9]+", 0), F.lit(".5 ;Summa viktfaktor="),
        F.col("event_id").cast("string")).alias("compTMI"))
    return N.parse_kv(source, "compTMI", fixed.INDEX_PRODUCT_SUM, fixed.INDEX_WEIGHT_PREFIX,
                      ("productSum", "weightFactorSum")).drop("compTMI")


@query("drop_nested", f"WITH lab AS ({LAB.sql}) SELECT {_COLUMNS} FROM lab")
def drop_nested(spark, sf):
    return N.drop_nested(lab_samples(spark, sf))


# ---------------------------------------------------------------- reshape


@query("melt", """SELECT l_orderkey, l_linenumber, m, v FROM (
    SELECT l_orderkey, l_linenumber, 'l_quantity' AS m, l_quantity AS v FROM lineitem UNION ALL
    SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem UNION ALL
    SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem)""")
def melt(spark, sf):
    return R.melt(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax", "l_discount"], "m", "v", "double")


@query("relabel_melted", f"WITH lab AS ({LAB.sql}) SELECT sampleId, 'value' AS name, value AS v, "
                         "CASE WHEN value IS NOT NULL THEN 'text' ELSE propertyCode END AS propertyCode FROM lab "
                         "UNION ALL SELECT sampleId, 'unit', unit, propertyCode FROM lab")
def relabel_melted(spark, sf):
    long = R.melt(LAB.df(spark, sf), ["sampleId", "propertyCode"], ["value", "unit"], "name", "v")
    return R.relabel_melted(long, "propertyCode", "name", "v", "value", "text")


_FLAGS = ["A", "N", "R"]


@query("cast_wide", "SELECT l_suppkey, l_linenumber, " + ", ".join(
    f"max(CASE WHEN l_returnflag = '{v}' THEN l_quantity END) AS {v}" for v in _FLAGS) + " FROM lineitem GROUP BY ALL")
def cast_wide(spark, sf):
    return R.cast_wide(table(spark, sf, "lineitem"), ["l_suppkey", "l_linenumber"], "l_returnflag", "l_quantity", _FLAGS, several="greatest")


@query("unlisted_labels", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag NOT IN ('A', 'R') GROUP BY 1")
def unlisted_labels(spark, sf):
    return R.unlisted_labels(table(spark, sf, "lineitem"), "l_returnflag", ["A", "R"])


@query("conflicting_cells", "SELECT l_suppkey, l_returnflag, min(l_quantity) AS least, max(l_quantity) AS greatest, count(l_quantity) AS n "
                            "FROM lineitem GROUP BY ALL HAVING min(l_quantity) < max(l_quantity)")
def conflicting_cells(spark, sf):
    return R.conflicting_cells(table(spark, sf, "lineitem"), ["l_suppkey"], "l_returnflag", "l_quantity")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
_PLACEHOLDER = "5-LOW"


@query("cast_wide_fill", "SELECT o_custkey, " + ", ".join(
    f"coalesce(max(CASE WHEN o_orderpriority = '{v}' THEN o_totalprice END), 0) AS \"{v}\"" for v in _PRIORITIES)
    + " FROM orders GROUP BY o_custkey")
def cast_wide_fill(spark, sf):
    return R.cast_wide_fill(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", "o_totalprice",
                            [*_PRIORITIES, _PLACEHOLDER], 0, placeholder=_PLACEHOLDER, several="greatest")


_WIDE_TEXT = "SELECT o_custkey, " + ", ".join(
    f"string_agg(CASE WHEN o_orderpriority = '{v}' THEN CAST(o_orderkey AS VARCHAR) END, '|' ORDER BY CAST(o_orderkey AS VARCHAR)) AS \"{v}\""
    for v in [*_PRIORITIES, _PLACEHOLDER]) + " FROM orders GROUP BY o_custkey"


def _wide_text(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    return R.cast_wide_concat(orders, ["o_custkey"], "o_orderpriority", "o_orderkey", [*_PRIORITIES, _PLACEHOLDER])


@query("cast_wide_concat", _WIDE_TEXT)
def cast_wide_concat(spark, sf):
    return _wide_text(spark, sf)


@query("multi_valued_cells", f"WITH w AS ({_WIDE_TEXT}) " + " UNION ALL ".join(
    f"SELECT '{v}' AS \"column\", count_if(contains(\"{v}\", '|')) AS n_multi FROM w" for v in [*_PRIORITIES, _PLACEHOLDER]))
def multi_valued_cells(spark, sf):
    return R.multi_valued_counts(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey", [*_PRIORITIES, _PLACEHOLDER])


@query("pivot_with", "SELECT l_suppkey, " + ", ".join(
    f"count(DISTINCT CASE WHEN l_returnflag = '{v}' THEN l_shipdate END) AS {v}" for v in _FLAGS) + " FROM lineitem GROUP BY 1")
def pivot_with(spark, sf):
    wide = R.pivot_with(table(spark, sf, "lineitem"), ["l_suppkey"], "l_returnflag", F.count_distinct("l_shipdate"), _FLAGS)
    return wide.na.fill(0)


@query("scores_wide", "SELECT l_returnflag AS model, " + ", ".join(
    f"max(CASE WHEN l_linenumber = {k} THEN l_quantity END) AS \"{k}\"" for k in range(1, 8)) + " FROM lineitem GROUP BY 1")
def scores_wide(spark, sf):
    df = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "model")
    return R.scores_wide(df, "model", "l_linenumber", "l_quantity", list(range(1, 8)), several="greatest")


@query("transpose_stats", "SELECT 'hi' AS \"column\", max(l_quantity) AS value FROM lineitem UNION ALL "
                          "SELECT 'lo', min(l_quantity) FROM lineitem UNION ALL SELECT 'n', count(*)::DOUBLE FROM lineitem")
def transpose_stats(spark, sf):
    return R.transpose_stats(table(spark, sf, "lineitem").agg(
        F.max("l_quantity").alias("hi"), F.min("l_quantity").alias("lo"), F.count(F.lit(1)).alias("n")))
