"""Joins, picks, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from limnos.operators import joins as J
from limnos.operators import picks as K
from limnos.operators import sets as S
from limnos.operators.aggregates import distinct_rows
from limnos.plans.laboratory import harmonise_units, measured_values, unit_factors, flatten_laboratory
from limnos.registry.columns_and_text import CENSORED_SQL
from limnos.registry.core import CHEMISTRY, LAB, LAB_LONG_SQL, TAXA, lab_samples, landed_once, query, table

# ---------------------------------------------------------------- joins

# The unit dictionary, derived from the parameter-unit pairs that occur; one parameter is left out.
DICTIONARY_SQL = """SELECT DISTINCT propertyAbbrevName, unit AS unitC,
  CASE WHEN propertyAbbrevName = 'Alk/Acid' THEN 'mekv/l' WHEN propertyAbbrevName = 'Tot-P' THEN 'µg/l' ELSE unit END AS unitAlt,
  CASE WHEN unit = 'mg/l' THEN '1000' WHEN unit = '°C' THEN '0,001' ELSE '1' END AS convFactRaw
  FROM lab_long WHERE propertyAbbrevName <> 'Färg'"""


def unit_dictionary(spark, sf):
    """The same dictionary from the flat columns, landed, so that Spark knows that it is small and sends it to the rows.

    As a plan it would have the size of its source, and all rows would be dealt by a handful of units.
    """
    lab = LAB.df(spark, sf).filter("NOT empty")
    warm = lab.filter("warm").selectExpr("'Temp' AS propertyAbbrevName", "'°C' AS unit")
    pairs = distinct_rows(lab.select("propertyAbbrevName", "unit").union(warm), ["propertyAbbrevName", "unit"])
    abbrev, unit = F.col("propertyAbbrevName"), F.col("unit")
    return landed_once(spark, sf, "unit-dictionary", lambda: pairs.filter(abbrev != "Färg").select(
        abbrev, unit.alias("unitC"),
        F.when(abbrev == "Alk/Acid", "mekv/l").when(abbrev == "Tot-P", "µg/l").otherwise(unit).alias("unitAlt"),
        F.when(unit == "mg/l", "1000").when(unit == "°C", "0,001").otherwise("1").alias("convFactRaw"),
    ))


@query("join_nullsafe_left", f"WITH {LAB_LONG_SQL}, d AS ({DICTIONARY_SQL}) SELECT observationId, l.unit, d.unitAlt, d.convFactRaw "
                             "FROM lab_long l LEFT JOIN d ON l.propertyAbbrevName = d.propertyAbbrevName "
                             "AND l.unit IS NOT DISTINCT FROM d.unitC")
def join_nullsafe_left(spark, sf):
    flat = flatten_laboratory(lab_samples(spark, sf)).select("observationId", "propertyAbbrevName", "unit")
    joined = J.join_nullsafe_left(flat.withColumnRenamed("unit", "unitC"), unit_dictionary(spark, sf), ["propertyAbbrevName", "unitC"])
    return joined.select("observationId", F.col("unitC").alias("unit"), "unitAlt", "convFactRaw")


@query("harmonise_units", f"""WITH {LAB_LONG_SQL}, d AS ({DICTIONARY_SQL}),
  v AS (SELECT *, {CENSORED_SQL} AS num FROM lab_long WHERE propertyName <> 'Övrigt')
  SELECT observationId, d.unitAlt AS unitF, num * TRY_CAST(replace(d.convFactRaw, ',', '.') AS DOUBLE) AS valF
  FROM v LEFT JOIN d ON v.propertyAbbrevName = d.propertyAbbrevName AND v.unit IS NOT DISTINCT FROM d.unitC
  WHERE num IS NOT NULL""")
def harmonise(spark, sf):
    flat = flatten_laboratory(lab_samples(spark, sf))
    return harmonise_units(measured_values(flat), unit_factors(unit_dictionary(spark, sf))).select("observationId", "unitF", "valF")


_SURVEYED = "SELECT o_custkey AS site, CAST(year(o_orderdate) AS INTEGER) AS yr, o_totalprice AS v FROM orders WHERE o_orderstatus = 'F'"
_MEASURED = "SELECT o_custkey AS site, CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderkey FROM orders WHERE o_orderstatus <> 'F'"


def _surveyed(spark, sf):
    return table(spark, sf, "orders").filter("o_orderstatus = 'F'").selectExpr("o_custkey AS site", "year(o_orderdate) AS yr", "o_totalprice AS v")


def _measured(spark, sf):
    return table(spark, sf, "orders").filter("o_orderstatus <> 'F'").selectExpr("o_custkey AS site", "year(o_orderdate) AS yr", "o_orderkey")


@query("natural_left_join", f"WITH a AS ({_SURVEYED}), b AS ({_MEASURED}) SELECT a.*, b.o_orderkey FROM a LEFT JOIN b ON a.site = b.site AND a.yr = b.yr")
def natural_left_join(spark, sf):
    return J.natural_left_join(_surveyed(spark, sf), _measured(spark, sf))


@query("natural_inner_join", f"WITH a AS ({_SURVEYED}), b AS ({_MEASURED}) SELECT a.*, b.o_orderkey FROM a JOIN b ON a.site = b.site AND a.yr = b.yr")
def natural_inner_join(spark, sf):
    return J.natural_left_join(_surveyed(spark, sf), _measured(spark, sf), matched_only=True)


@query("lookup_join", "SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey")
def lookup_join(spark, sf):
    names = table(spark, sf, "nation").filter("n_regionkey <> 2").selectExpr("n_nationkey AS c_nationkey", "n_name")
    return J.lookup_join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), names, "c_nationkey")


_FULL_A = "SELECT o_custkey AS site, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS yr, count(*) AS n_a FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL"
_FULL_B = "SELECT o_custkey AS site, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS yr, count(*) AS n_b FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL"


@query("full_join", f"WITH a AS ({_FULL_A}), b AS ({_FULL_B}) SELECT coalesce(a.site, b.site) AS site, coalesce(a.yr, b.yr) AS yr, n_a, n_b "
                    "FROM a FULL JOIN b ON a.site = b.site AND a.yr IS NOT DISTINCT FROM b.yr")
def full_join(spark, sf):
    def side(condition, name):
        rows = table(spark, sf, "orders").filter(condition).selectExpr(
            "o_custkey AS site", "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE year(o_orderdate) END AS yr")
        return rows.groupBy("site", "yr").agg(F.count(F.lit(1)).alias(name))

    return J.full_join(side("o_orderstatus = 'F'", "n_a"), side("o_orderstatus <> 'F'", "n_b"), ["site", "yr"])


@query("semi_join", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_join(spark, sf):
    keys = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").selectExpr("c_custkey AS o_custkey")
    return J.semi_join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), keys, ["o_custkey"])


@query("unmatched_keys", f"WITH t AS ({CHEMISTRY.sql}), a AS (SELECT DISTINCT site, yr FROM t WHERE status = 'F'), "
                         "b AS (SELECT site, yr, val FROM t WHERE status <> 'F') "
                         "SELECT DISTINCT a.site, a.yr FROM a LEFT JOIN b ON a.site = b.site AND a.yr = b.yr WHERE b.val IS NULL")
def unmatched_keys(spark, sf):
    t = CHEMISTRY.df(spark, sf)
    return J.unmatched_keys(t.filter("status = 'F'"), t.filter("status <> 'F'"), ["site", "yr"], "val")


@query("attach_predictions", "SELECT o_orderkey, o_totalprice, m.pred FROM orders LEFT JOIN (SELECT c_custkey, c_acctbal AS pred "
                             "FROM customer WHERE c_acctbal > 0) m ON o_custkey = c_custkey")
def attach_predictions(spark, sf):
    predicted = table(spark, sf, "customer").filter("c_acctbal > 0").selectExpr("c_custkey AS o_custkey", "c_acctbal AS pred")
    return J.attach_predictions(table(spark, sf, "orders"), predicted, "o_custkey").select("o_orderkey", "o_totalprice", "pred")


# ---------------------------------------------------------------- picks and order


@query("later_occurrences", """WITH d AS (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem)
  SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_linestatus, l_linenumber, l_suppkey) > 1""")
def later_occurrences(spark, sf):
    d = distinct_rows(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"])
    return K.later_occurrences(d, ["l_returnflag"], ["l_linestatus", "l_linenumber", "l_suppkey"])


@query("shallowest", f"""WITH lab AS ({LAB.sql}) SELECT sampleId, stationId, propertyCode, minDepth, maxDepth FROM lab
  QUALIFY rank() OVER (PARTITION BY stationId, propertyCode ORDER BY minDepth NULLS LAST, maxDepth NULLS LAST) = 1""")
def shallowest(spark, sf):
    samples = LAB.df(spark, sf).select("sampleId", "stationId", "propertyCode", "minDepth", "maxDepth")
    return K.shallowest(samples, ["stationId", "propertyCode"])


@query("pick_min", """SELECT l_orderkey, l_returnflag, l_quantity, l_discount, l_partkey FROM lineitem
  QUALIFY rank() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_quantity, l_discount) = 1""")
def pick_min(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity", "l_discount", "l_partkey")
    return K.pick_min(items, ["l_orderkey", "l_returnflag"], ["l_quantity", "l_discount"])


@query("first_survey", "SELECT user_id, CAST(ts AS DATE) AS day, event_id FROM events QUALIFY rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) = 1")
def first_survey(spark, sf):
    return K.first_survey(table(spark, sf, "events").selectExpr("user_id", "CAST(ts AS DATE) AS day", "event_id"), "user_id", "day")


@query("highest_effort", """WITH t AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(floor(value / 10) AS INTEGER) AS effort, event_id FROM events)
  SELECT * FROM t QUALIFY rank() OVER (PARTITION BY user_id ORDER BY day, effort DESC) = 1""")
def highest_effort(spark, sf):
    surveys = table(spark, sf, "events").selectExpr("user_id", "CAST(ts AS DATE) AS day", "CAST(floor(value / 10) AS INT) AS effort", "event_id")
    return K.highest_effort(surveys, "user_id", "day", "effort")


@query("sort_rows", "SELECT p_brand, p_partkey, p_name FROM part ORDER BY p_brand, p_partkey, p_name")
def sort_rows(spark, sf):
    return K.sort_rows(table(spark, sf, "part").select("p_brand", "p_partkey", "p_name"), ["p_brand"])


# ---------------------------------------------------------------- sets


@query("append", "SELECT c_custkey AS id, c_acctbal AS val, c_mktsegment AS seg FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier")
def append(spark, sf):
    a = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_acctbal AS val", "c_mktsegment AS seg")
    return S.append(a, table(spark, sf, "supplier").selectExpr("s_acctbal AS val", "s_suppkey AS id"))


@query("master_list", f"WITH t AS ({TAXA.sql}) SELECT plain AS value FROM t UNION SELECT recorded FROM t UNION SELECT split_part(plain, ' ', 1) FROM t")
def master_list(spark, sf):
    t = TAXA.df(spark, sf).withColumn("genus", F.split("plain", " ")[0])
    return S.master_list(t, ["plain", "recorded", "genus"])


@query("intersect_values", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def intersect_values(spark, sf):
    a = table(spark, sf, "customer").selectExpr("c_nationkey AS k")
    return S.intersect_values(a, table(spark, sf, "supplier").selectExpr("s_nationkey AS k"))


@query("except_values", "SELECT c_custkey AS k FROM customer EXCEPT SELECT s_suppkey FROM supplier")
def except_values(spark, sf):
    a = table(spark, sf, "customer").selectExpr("c_custkey AS k")
    return S.except_values(a, table(spark, sf, "supplier").selectExpr("s_suppkey AS k"))
