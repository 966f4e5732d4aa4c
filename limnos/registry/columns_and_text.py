"""Projections, filters, flags, and the scalar text, number and date functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from limnos import fixed_values as fixed
from limnos.functions import text, values
from limnos.operators import columns as C
from limnos.operators.reshape import sort_columns
from limnos.plans.laboratory import flatten_laboratory
from limnos.registry.core import (
    CHEMISTRY, LAB, LAB_LONG_SQL, PROFILE, TAXA, Role, lab_samples, query, table,
)

# ---------------------------------------------------------------- projections and filters


@query("project", "SELECT l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem")
def project(spark, sf):
    return C.project(table(spark, sf, "lineitem"), between=("l_partkey", "l_shipdate"), first=["l_shipdate"],
                     drop=["l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_linestatus"])


@query("rename_map", "SELECT c_custkey AS site, c_name AS site_name, c_nationkey, c_acctbal AS val, c_mktsegment FROM customer")
def rename_map(spark, sf):
    return C.rename_map(table(spark, sf, "customer"), {"c_custkey": "site", "c_name": "site_name", "c_acctbal": "val"})


@query("drop_all_null_columns",
       f"WITH t AS ({PROFILE.sql}) SELECT flag, supp, qty, price, disc, tax, line, same, half FROM t")
def drop_all_null_columns(spark, sf):
    return C.drop_all_null_columns(PROFILE.df(spark, sf))


@query("split_constant_columns",
       f"WITH t AS ({PROFILE.sql}) SELECT flag, supp, qty, price, disc, tax, line, half FROM t")
def split_constant_columns(spark, sf):
    return C.split_constant_columns(PROFILE.df(spark, sf))[0]


@query("constant_columns", f"WITH t AS ({PROFILE.sql}) SELECT nothing, same FROM t")
def constant_columns(spark, sf):
    return C.split_constant_columns(PROFILE.df(spark, sf))[1]


@query("drop_sparse_columns",
       f"WITH t AS ({PROFILE.sql}) SELECT flag, supp, price, disc, tax, line, same FROM t")
def drop_sparse_columns(spark, sf):
    return C.drop_sparse_columns(PROFILE.df(spark, sf), 0.25, keys=["flag", "supp"])


@query("select_where", f"WITH t AS ({PROFILE.sql}) SELECT flag, supp, price, tax, line, same FROM t")
def select_where(spark, sf):
    return C.select_where(PROFILE.df(spark, sf), lambda rows, present, same: rows == present)


@query("apply_columns",
       f"WITH t AS ({PROFILE.sql}) SELECT flag, supp, qty * 2 AS qty, price * 2 AS price, disc * 2 AS disc, "
       "tax * 2 AS tax, line * 2 AS line, nothing * 2 AS nothing, same * 2 AS same, half * 2 AS half FROM t")
def apply_columns(spark, sf):
    return C.apply_columns(PROFILE.df(spark, sf), lambda c: c * 2, kinds=["double"])


_NAMES = ", ".join("'" + n + "'" for n in fixed.PARAMETER_NAMES)


@query("filter_in", f"WITH {LAB_LONG_SQL} SELECT sampleId, propertyName, value FROM lab_long "
                    f"WHERE propertyName IN ({_NAMES})")
def filter_in(spark, sf):
    flat = flatten_laboratory(lab_samples(spark, sf))
    return C.filter_in(flat, "propertyName", fixed.PARAMETER_NAMES).select("sampleId", "propertyName", "value")


@query("filter_not_in", f"WITH t AS ({TAXA.sql}) SELECT part_id, recorded FROM t "
                        "WHERE recorded IS NULL OR recorded NOT IN ('Inget fynd', 'iris')")
def filter_not_in(spark, sf):
    return C.filter_not_in(TAXA.df(spark, sf), "recorded", ["Inget fynd", "iris"]).select("part_id", "recorded")


@query("drop_missing", f"WITH t AS ({PROFILE.sql}) SELECT supp, qty, disc, price FROM t "
                       "WHERE qty IS NOT NULL AND disc IS NOT NULL")
def drop_missing(spark, sf):
    return C.drop_missing(PROFILE.df(spark, sf), ["qty", "disc", "absent"]).select("supp", "qty", "disc", "price")


@query("filter_pattern", f"WITH lab AS ({LAB.sql}) SELECT sampleId, value FROM lab "
                         "WHERE propertyAbbrevName = 'Alk/Acid' AND value LIKE '%-%'")
def filter_pattern(spark, sf):
    return C.filter_pattern(LAB.df(spark, sf), "propertyAbbrevName", "Alk/Acid", "value", "-").select("sampleId", "value")


_PLACES = """SELECT c_custkey AS site, CASE WHEN c_mktsegment = 'BUILDING' OR c_nationkey = 3 THEN NULL ELSE c_custkey END AS x,
  CASE WHEN c_nationkey IN (3, 4) THEN NULL ELSE c_nationkey END AS y FROM customer"""


def _places(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS site", "CASE WHEN c_mktsegment = 'BUILDING' OR c_nationkey = 3 THEN NULL ELSE c_custkey END AS x",
        "CASE WHEN c_nationkey IN (3, 4) THEN NULL ELSE c_nationkey END AS y")


@query("valid_sites", f"WITH t AS ({_PLACES}) SELECT * FROM t WHERE (x IS NOT NULL OR y IS NOT NULL) AND site <> 79")
def valid_sites(spark, sf):
    return C.valid_sites(_places(spark, sf), "x", "y", "site", [79])


@query("concat_na", f"WITH t AS ({_PLACES}) SELECT site, coalesce(CAST(x AS VARCHAR), 'NA') || "
                    "coalesce(CAST(y AS VARCHAR), 'NA') AS site_key FROM t")
def concat_na(spark, sf):
    return _places(spark, sf).select("site", text.concat_na(F.col("x"), F.col("y")).alias("site_key"))


@query("filter_any_nonzero", "SELECT l_orderkey, l_discount, l_tax FROM lineitem WHERE l_discount <> 0 OR l_tax <> 0")
def filter_any_nonzero(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_discount", "l_tax")
    return C.filter_any_nonzero(df, ["l_orderkey"])


@query("filter_unequal", f"WITH lab AS ({LAB.sql}) SELECT sampleId, minDepth, maxDepth FROM lab WHERE minDepth <> maxDepth")
def filter_unequal(spark, sf):
    return C.filter_unequal(LAB.df(spark, sf), "minDepth", "maxDepth").select("sampleId", "minDepth", "maxDepth")


@query("onehot_flags", """SELECT c_custkey, c_mktsegment,
  CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 1 ELSE 0 END AS built,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS machine FROM customer""")
def onehot_flags(spark, sf):
    return C.onehot_flags(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment",
                          {"built": ["building", "furniture"], "machine": ["machinery"]})


@query("dummy_code", f"WITH t AS ({CHEMISTRY.sql}) SELECT sample_id, " + ", ".join(
    f"CASE WHEN yr = {y} THEN 1 ELSE 0 END AS yr_{y}" for y in range(1996, 2002)) + " FROM t")
def dummy_code(spark, sf):
    df = CHEMISTRY.df(spark, sf).select("sample_id", "yr")
    return C.dummy_code(df, "yr", list(range(1995, 2002))).drop("yr")


@query("complete_flag", f"WITH t AS ({PROFILE.sql}) SELECT supp, qty, disc, CASE WHEN qty IS NOT NULL AND disc IS NOT NULL "
                        "THEN 1 ELSE 0 END AS inFilt FROM t")
def complete_flag(spark, sf):
    return C.complete_flag(PROFILE.df(spark, sf).select("supp", "qty", "disc"), ["qty", "disc"])


@query("binarize", f"WITH t AS ({PROFILE.sql}) SELECT supp, CAST(tax > 0 AS DOUBLE) AS tax, CAST(disc > 0 AS DOUBLE) AS disc FROM t")
def binarize(spark, sf):
    return C.binarize(PROFILE.df(spark, sf).select("supp", "tax", "disc"), ["tax", "disc"])


@query("presence_flag", f"WITH t AS ({PROFILE.sql}) SELECT supp, CASE WHEN qty IS NULL THEN 0 ELSE 1 END AS has_qty FROM t")
def presence_flag(spark, sf):
    return PROFILE.df(spark, sf).select("supp", C.presence_flag(F.col("qty")).alias("has_qty"))


@query("neq_flag", f"WITH lab AS ({LAB.sql}) SELECT sampleId, CASE WHEN minDepth <> maxDepth THEN 1 WHEN minDepth = maxDepth "
                   "THEN 0 END AS differs FROM lab")
def neq_flag(spark, sf):
    return LAB.df(spark, sf).select("sampleId", C.neq_flag(F.col("minDepth"), F.col("maxDepth")).alias("differs"))


@query("poly_features", "SELECT l_orderkey, l_quantity, l_quantity * l_quantity AS qty_sq FROM lineitem")
def poly_features(spark, sf):
    return C.poly_features(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity"), {"l_quantity": "qty_sq"})


@query("feature_matrix", """SELECT vec_id, CAST(label AS DOUBLE) AS y, CAST(embedding[1] AS DOUBLE) AS x_coord,
  CAST(embedding[2] AS DOUBLE) AS y_coord, CAST(embedding[3] AS DOUBLE) AS e3, CAST(embedding[4] AS DOUBLE) AS e4 FROM embeddings""")
def feature_matrix(spark, sf):
    df = table(spark, sf, "embeddings").selectExpr("vec_id", "label", "embedding[0] AS x", "embedding[1] AS yy",
                                                   "embedding[2] AS e3", "embedding[3] AS e4")
    return C.feature_matrix(df, "vec_id", ["e3", "e4"], "label", ("x", "yy")).drop("features")


@query("column_sets", "SELECT o_custkey AS c_custkey, o_orderkey FROM orders")
def column_sets(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    shared, new = C.column_sets(orders, table(spark, sf, "customer"))
    return orders.select(*shared, new[0])


@query("sort_columns", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def sort_columns_query(spark, sf):
    return sort_columns(table(spark, sf, "nation"), ["n_regionkey"])


# ---------------------------------------------------------------- number parsing

_NUM = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


def _parse(expr: str) -> str:
    """The checking engine's reading of a decimal-comma number."""
    return f"(CASE WHEN regexp_matches(replace({expr}, ',', '.'), {_NUM}) THEN TRY_CAST(replace({expr}, ',', '.') AS DOUBLE) END)"


_FIRST = r"regexp_extract(value, '\(?[0-9,.]+\)?')"
CENSORED_SQL = (
    f"coalesce({_parse('value')}, CASE WHEN value LIKE '%<%' THEN {_parse(_FIRST)} * 0.5e0 ELSE {_parse(_FIRST)} * 1.1e0 END)"
)


@query("parse_decimal_comma", f"WITH lab AS ({LAB.sql}) SELECT sampleId, value, {_parse('value')} AS num FROM lab")
def parse_decimal_comma(spark, sf):
    return LAB.df(spark, sf).select("sampleId", "value", text.parse_decimal_comma(F.col("value")).alias("num"))


@query("parse_failures", f"WITH lab AS ({LAB.sql}), p AS (SELECT sampleId, value, {_parse('value')} AS num FROM lab) "
                         "SELECT sampleId, value FROM p WHERE num IS NULL AND value IS NOT NULL")
def parse_failures(spark, sf):
    parsed = LAB.df(spark, sf).withColumn("num", text.parse_decimal_comma(F.col("value")))
    return C.parse_failures(parsed, "value", "num").select("sampleId", "value")


@query("parse_censored", f"WITH lab AS ({LAB.sql}) SELECT sampleId, value, {CENSORED_SQL} AS num FROM lab")
def parse_censored(spark, sf):
    return LAB.df(spark, sf).select("sampleId", "value", text.parse_censored(F.col("value")).alias("num"))


_DEPTHS = Role("lineitem", {
    "item": "l_orderkey * 10 + l_linenumber",
    "depth": "CASE WHEN l_linenumber = 1 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), ',25-', "
             "CAST(CAST(l_quantity AS INT) + 1 AS STRING), ',5') "
             "WHEN l_linenumber = 2 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), ' -', "
             "CAST(CAST(l_quantity AS INT) + 1 AS STRING), ',25') "
             "WHEN l_linenumber = 3 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), ',7 meter') "
             "WHEN l_linenumber = 4 THEN concat('>', CAST(CAST(l_quantity AS INT) AS STRING), ',5') "
             "WHEN l_linenumber = 5 THEN concat('≥', CAST(CAST(l_quantity AS INT) AS STRING)) "
             "WHEN l_linenumber = 6 THEN 'till botten' "
             "ELSE concat(' ', CAST(CAST(l_quantity AS INT) AS STRING), ',5 ') END",
})
_MID = (
    "CASE WHEN depth LIKE '%-%' THEN (TRY_CAST(replace(trim(split_part(depth, '-', 1)), ',', '.') AS DECIMAL(18,6)) + "
    "TRY_CAST(replace(trim(split_part(depth, '-', 2)), ',', '.') AS DECIMAL(18,6)))::DOUBLE / 2 "
    "WHEN depth LIKE '%meter' THEN TRY_CAST(replace(trim(replace(depth, 'meter', '')), ',', '.') AS DOUBLE) "
    "ELSE TRY_CAST(replace(trim(depth), ',', '.') AS DOUBLE) END"
)
_OVER = (
    "CASE WHEN depth LIKE '>%' OR depth LIKE '≥%' THEN TRY_CAST(replace(depth[2:], ',', '.') AS DOUBLE) * 1.1e0 "
    "ELSE TRY_CAST(replace(trim(depth), ',', '.') AS DOUBLE) END"
)


@query("parse_range_midpoint", f"WITH t AS ({_DEPTHS.sql}) SELECT item, depth, {_MID} AS metres FROM t")
def parse_range_midpoint(spark, sf):
    return _DEPTHS.df(spark, sf).select("item", "depth", text.parse_range_midpoint(F.col("depth")).alias("metres"))


@query("parse_over_limit", f"WITH t AS ({_DEPTHS.sql}) SELECT item, depth, {_OVER} AS metres FROM t")
def parse_over_limit(spark, sf):
    return _DEPTHS.df(spark, sf).select("item", "depth", text.parse_over_limit(F.col("depth")).alias("metres"))


@query("secchi_depth", f"WITH t AS ({_DEPTHS.sql}) SELECT item, depth, coalesce({_OVER}, {_MID}) AS metres FROM t")
def secchi_depth(spark, sf):
    return _DEPTHS.df(spark, sf).select("item", "depth", text.secchi_depth(F.col("depth")).alias("metres"))


@query("to_number", "SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, "
                    "CASE WHEN event_type = 'click' THEN NULL ELSE TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) END AS d FROM events")
def to_number(spark, sf):
    number = F.regexp_extract("props", "[0-9]+", 0)
    tagged = F.when(F.col("event_type") == "click", F.concat(number, F.lit("d"))).otherwise(number)
    return table(spark, sf, "events").select("event_id", text.to_number(number, "int").alias("k"),
                                             text.to_number(tagged).alias("d"))


@query("extract_number", r"SELECT event_id, nullif(regexp_extract(props, '\d+\.*\d*'), '') AS k, "
                         r"nullif(regexp_extract(event_type, '\d+\.*\d*'), '') AS none FROM events")
def extract_number(spark, sf):
    return table(spark, sf, "events").select("event_id", text.extract_number(F.col("props")).alias("k"),
                                             text.extract_number(F.col("event_type")).alias("none"))


@query("extract_group", "SELECT event_id, regexp_extract(props, '\"k\": (\\d+)', 1) AS k, "
                        "CASE WHEN event_type LIKE 's%' THEN event_type[2:] END AS tail FROM events")
def extract_group(spark, sf):
    return table(spark, sf, "events").select("event_id", text.extract_group(F.col("props"), '"k": (\\d+)').alias("k"),
                                             text.extract_group(F.col("event_type"), "^s(.*)$").alias("tail"))


@query("replace_first", "SELECT p_partkey, regexp_replace(p_name, '[lr]', '_') AS masked FROM part")
def replace_first(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.replace_first(F.col("p_name"), "[lr]", "_").alias("masked"))


# ---------------------------------------------------------------- text


@query("detect", f"WITH t AS ({TAXA.sql}) SELECT part_id, (contains(recorded, ' x ') OR contains(recorded, '/')) AS hybrid FROM t")
def detect(spark, sf):
    return TAXA.df(spark, sf).select("part_id", text.detect(F.col("recorded"), " x ", "/").alias("hybrid"))


_SENTENCE = (
    r"CASE WHEN recorded IS NOT NULL THEN array_to_string(list_transform(string_split(regexp_replace(recorded, "
    r"'(\.\s+)([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)), "
    r"lambda s: regexp_extract(s, '^\s*') || upper(ltrim(s)[1:1]) || lower(ltrim(s)[2:])), '') END"
)


@query("sentence_case", f"WITH t AS ({TAXA.sql}) SELECT part_id, {_SENTENCE} AS cased FROM t")
def sentence_case(spark, sf):
    return TAXA.df(spark, sf).select("part_id", text.sentence_case(F.col("recorded")).alias("cased"))


@query("squish", f"WITH t AS ({TAXA.sql}) SELECT part_id, trim(regexp_replace(recorded, '\\s+', ' ', 'g')) AS squished, "
                 "lower(trim(recorded)) AS low FROM t")
def squish(spark, sf):
    return TAXA.df(spark, sf).select("part_id", text.squish(F.col("recorded")).alias("squished"),
                                     F.lower(F.trim("recorded")).alias("low"))


@query("word", f"WITH t AS ({TAXA.sql}), w AS (SELECT part_id, string_split(recorded, ' ') AS w FROM t) "
               "SELECT part_id, CASE WHEN len(w) >= 1 THEN w[1] END AS first_word, "
               "CASE WHEN len(w) >= 2 THEN w[1] || ' ' || w[2] END AS two_words, "
               "CASE WHEN len(w) >= 4 THEN w[3] || ' ' || w[4] END AS later_words FROM w")
def word(spark, sf):
    c = F.col("recorded")
    return TAXA.df(spark, sf).select("part_id", text.word(c, 1).alias("first_word"), text.word(c, 1, 2).alias("two_words"),
                                     text.word(c, 3, 4).alias("later_words"))


@query("replace_many", f"WITH t AS ({TAXA.sql}) SELECT part_id, regexp_replace(regexp_replace(regexp_replace(recorded, "
                       "'s. lat.', '', 'g'), 'agg.', '', 'g'), 'iris$', 'Iris pseudacorus', 'g') AS renamed FROM t")
def replace_many(spark, sf):
    pairs = [("s. lat.", ""), ("agg.", ""), ("iris$", "Iris pseudacorus")]
    return TAXA.df(spark, sf).select("part_id", text.replace_many(F.col("recorded"), pairs).alias("renamed"))


@query("remove_from", f"WITH t AS ({TAXA.sql}) SELECT part_id, trim(regexp_replace(recorded, '(var\\.).*', '')) AS kept FROM t")
def remove_from(spark, sf):
    return TAXA.df(spark, sf).select("part_id", text.remove_from(F.col("recorded"), r"var\.").alias("kept"))


@query("recode_labels", "SELECT p_partkey, replace(replace(p_type, 'ECONOMY', 'E'), 'STANDARD', 'STD') AS label FROM part")
def recode_labels(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", text.recode_labels(F.col("p_type"), [("ECONOMY", "E"), ("STANDARD", "STD")]).alias("label"))


@query("null_if", f"WITH t AS ({TAXA.sql}) SELECT part_id, CASE WHEN recorded = 'Inget fynd' THEN NULL ELSE recorded END AS known, "
                  "CASE WHEN lower(recorded) LIKE '%agg%' THEN NULL ELSE recorded END AS single FROM t")
def null_if(spark, sf):
    c = F.col("recorded")
    return TAXA.df(spark, sf).select("part_id", text.null_if(c, "Inget fynd").alias("known"),
                                     text.null_if_contains(c, "agg").alias("single"))


@query("string_length_filter", "SELECT p_partkey, p_brand FROM part WHERE length(p_brand) > 7")
def string_length_filter(spark, sf):
    return table(spark, sf, "part").filter(F.length("p_brand") > 7).select("p_partkey", "p_brand")


@query("text_shapes", f"WITH lab AS ({LAB.sql}) SELECT regexp_replace(value, '[0-9]', '', 'g') AS shape, count(*) AS n "
                      "FROM lab GROUP BY 1")
def text_shapes(spark, sf):
    return LAB.df(spark, sf).groupBy(text.text_shape(F.col("value")).alias("shape")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- values, dates, categories


@query("null_nonfinite", """SELECT l_orderkey, CASE WHEN l_tax = 0 OR l_discount = 0.0 THEN NULL ELSE l_quantity END AS v,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS s FROM lineitem""")
def null_nonfinite(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_tax") == 0, F.lit(float("inf"))).when(F.col("l_discount") == 0, F.lit(float("nan")))
        .otherwise(F.col("l_quantity")).alias("v"),
        F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_returnflag")).alias("s"),
    )
    return values.null_nonfinite(df)


@query("round_median_toward_mean", """WITH g AS (SELECT l_suppkey, l_returnflag, quantile_cont(l_linenumber, 0.5) AS med,
    sum(l_linenumber)::DOUBLE / count(*) AS mean FROM lineitem GROUP BY ALL)
  SELECT l_suppkey, l_returnflag, CASE WHEN med = floor(med) THEN med WHEN mean > med THEN ceil(med) ELSE floor(med) END AS med FROM g""")
def round_median_toward_mean(spark, sf):
    grouped = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        F.median("l_linenumber").alias("m"), F.avg("l_linenumber").alias("mean"))
    return grouped.select("l_suppkey", "l_returnflag",
                          values.round_median_toward_mean(F.col("m"), F.col("mean")).alias("med"))


@query("date_parts", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(year(o_orderdate) AS INTEGER) AS yr,
  CAST(month(o_orderdate) AS INTEGER) AS m, month(o_orderdate) IN (6, 7, 8) AS summer FROM orders""")
def date_parts(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("t"))
    parts = values.date_parts(df, "t", "d", "yr", "m")
    return parts.withColumn("summer", values.in_months(F.col("d"), fixed.SUMMER_MONTHS)).drop("t")


@query("ordinal_recode", """SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 3
  WHEN 'ECONOMY' THEN 1 END AS rank FROM part""")
def ordinal_recode(spark, sf):
    ranks = {"small": 1, "economy": 1, "medium": 2, "large": 3}
    return table(spark, sf, "part").select("p_partkey", values.label_rank(F.col("p_type"), ranks).alias("rank"))


@query("case_map", """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid'
  ELSE 'low' END AS level FROM orders""")
def case_map(spark, sf):
    p = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", values.case_map([(p > 400000, "high"), (p > 100000, "mid")], F.lit("low")).alias("level"))


@query("row_sum_nonnull", f"WITH t AS ({PROFILE.sql}) SELECT supp, nullif(coalesce(qty, 0) + coalesce(half, 0), 0) AS total FROM t")
def row_sum_nonnull(spark, sf):
    return PROFILE.df(spark, sf).select("supp", values.sum_nonnull(F.col("qty"), F.col("half")).alias("total"))


@query("rowwise_expressions", f"WITH t AS ({PROFILE.sql}) SELECT supp, greatest(qty, line, tax) AS top, "
                              "(CASE WHEN qty > 25 THEN 1 ELSE 0 END + CASE WHEN tax > 0.04 THEN 1 ELSE 0 END) AS n FROM t")
def rowwise_expressions(spark, sf):
    over = [F.when(F.col("qty") > 25, 1).otherwise(0), F.when(F.col("tax") > 0.04, 1).otherwise(0)]
    return PROFILE.df(spark, sf).select("supp", F.greatest("qty", "line", "tax").alias("top"), (over[0] + over[1]).alias("n"))


@query("rescaled_effect", "SELECT c_custkey, round(exp((c_acctbal / 10000 - 0.3) * 1.5), 9) AS effect, "
                          "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS isNeg FROM customer")
def rescaled_effect(spark, sf):
    coefficient = F.col("c_acctbal") / F.lit(10000) - F.lit(0.3)
    return table(spark, sf, "customer").select(
        "c_custkey", F.round(values.rescaled_effect(coefficient, F.lit(1.5)), 9).alias("effect"),
        values.is_negative(F.col("c_acctbal")).alias("isNeg"))


@query("ci_significant", """SELECT l_orderkey, l_linenumber, CASE WHEN sign(l_quantity - 20) = sign(l_quantity - 10) THEN 1 ELSE 0 END
  AS isSig FROM lineitem""")
def ci_significant(spark, sf):
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", values.same_sign(q - 20, q - 10).alias("isSig"))


@query("scale_and_bucket_label", "SELECT DISTINCT printf('%.1f', l_orderkey * 500 / 1000.0e0) AS km FROM lineitem")
def scale_and_bucket_label(spark, sf):
    metres = F.col("l_orderkey").cast("double") * 500
    return table(spark, sf, "lineitem").select(values.kilometre_label(metres).alias("km")).distinct()


@query("order_levels", """SELECT p_type, count(*) AS n, CASE p_type WHEN 'SMALL' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LARGE' THEN 2 END
  AS place FROM part GROUP BY p_type""")
def order_levels(spark, sf):
    levels = ["SMALL", "MEDIUM", "LARGE"]
    counted = table(spark, sf, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("place", values.level_position(F.col("p_type"), levels))


def _projection_sql() -> str:
    f = 1.0 / 298.257222101
    n = f / (2 - f)
    a_roof = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    d = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
         17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280]
    e2 = f * (2 - f)
    s = [e2 + e2**2 + e2**3 + e2**4, -(7 * e2**2 + 17 * e2**3 + 30 * e2**4) / 6, (224 * e2**3 + 889 * e2**4) / 120,
         -(4279 * e2**4) / 1260]
    xi = "xi" + "".join(f" - ({c!r}) * sin({2 * k} * xi) * cosh({2 * k} * eta)" for k, c in enumerate(d, 1))
    eta = "eta" + "".join(f" - ({c!r}) * cos({2 * k} * xi) * sinh({2 * k} * eta)" for k, c in enumerate(d, 1))
    lat = "phi + sin(phi) * cos(phi) * (" + " + ".join(f"({c!r}) * power(sin(phi), {2 * k})" for k, c in enumerate(s)) + ")"
    return f"""WITH a AS (SELECT c_custkey, (c_acctbal * 10 + 6500000) / {0.9996 * a_roof!r} AS xi,
      (c_nationkey * 20000 + 300000 - 500000) / {0.9996 * a_roof!r} AS eta FROM customer),
    b AS (SELECT c_custkey, {xi} AS xi, {eta} AS eta FROM a),
    c AS (SELECT c_custkey, xi, eta, asin(sin(xi) / cosh(eta)) AS phi FROM b)
    SELECT c_custkey, round(15.0e0 + degrees(atan(sinh(eta) / cos(xi))), 8) AS lon, round(degrees({lat}), 8) AS lat FROM c"""


@query("project_points", _projection_sql())
def project_points(spark, sf):
    easting = F.col("c_nationkey") * F.lit(20000.0) + F.lit(300000.0)
    lon, lat = values.inverse_transverse_mercator(easting, F.col("c_acctbal") * F.lit(10.0) + F.lit(6500000.0))
    return table(spark, sf, "customer").select("c_custkey", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))
