"""Grouped and whole-table aggregates, quantiles and correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from limnos.operators import aggregates as A
from limnos.operators import quantiles as Q
from limnos.registry.core import CHEMISTRY, LAB, MEASUREMENTS, PROFILE, PROFILE_NUMBERS, TAXA, query, table

# ---------------------------------------------------------------- grouped means and covariates


@query("group_mean_strict", f"""WITH t AS ({MEASUREMENTS.sql}) SELECT site, day, code,
  CASE WHEN count(cents) = count(*) THEN avg(cents) END AS val, max(edited) AS lastEditDate FROM t GROUP BY site, day, code""")
def group_mean_strict(spark, sf):
    return A.group_mean_strict(MEASUREMENTS.df(spark, sf), ["site", "day", "code"], "cents", "edited")


_SUMMARY = {"sums": {"total": "qty"}, "minima": {"lo": "qty"}, "maxima": {"hi": "qty"}, "medians": {"med": "line"},
            "means": {"mean": "line"}, "texts": {"flags": "flag"}}
_SUMMARY_SQL = """coalesce(sum(qty), 0) AS total, min(qty) AS lo, max(qty) AS hi, quantile_cont(line, 0.5) AS med,
  sum(line) / count(line) AS mean, nullif(coalesce(string_agg(DISTINCT flag, ';' ORDER BY flag), ''), '') AS flags"""


@query("survey_covariates", f"WITH t AS ({PROFILE.sql}) SELECT supp, disc, {_SUMMARY_SQL} FROM t GROUP BY supp, disc")
def survey_covariates(spark, sf):
    return A.covariate_summary(PROFILE.df(spark, sf), ["supp", "disc"], **_SUMMARY)


@query("survey_covariates_twice", f"""WITH t AS ({PROFILE.sql}), g AS (SELECT supp, flag, coalesce(sum(qty), 0) AS total, min(qty) AS lo,
    quantile_cont(line, 0.5) AS med FROM t GROUP BY supp, flag)
  SELECT supp, sum(total) AS total, min(lo) AS lo, quantile_cont(med, 0.5) AS med FROM g GROUP BY supp""")
def survey_covariates_twice(spark, sf):
    first = A.covariate_summary(PROFILE.df(spark, sf), ["supp", "flag"], sums={"total": "qty"}, minima={"lo": "qty"}, medians={"med": "line"})
    return A.covariate_summary(first, ["supp"], sums={"total": "total"}, minima={"lo": "lo"}, medians={"med": "med"})


@query("covariate_extent", """SELECT l_orderkey, min(l_partkey) AS startMin, max(l_partkey) AS startMax, min(l_suppkey) AS endMin,
  max(l_suppkey) AS endMax FROM lineitem GROUP BY l_orderkey""")
def covariate_extent(spark, sf):
    return A.covariate_summary(table(spark, sf, "lineitem"), ["l_orderkey"], minima={"startMin": "l_partkey", "endMin": "l_suppkey"},
                               maxima={"startMax": "l_partkey", "endMax": "l_suppkey"})


@query("concat_distinct", f"WITH t AS ({MEASUREMENTS.sql}) SELECT site, coalesce(string_agg(DISTINCT unit, ';' ORDER BY unit), '') AS unit FROM t GROUP BY site")
def concat_distinct(spark, sf):
    return A.concat_distinct(MEASUREMENTS.df(spark, sf), ["site"], "unit")


@query("concat_first_seen", f"""WITH t AS ({MEASUREMENTS.sql}), f AS (SELECT site, code, min(event_id) AS e FROM t GROUP BY ALL)
  SELECT site, string_agg(code, ';' ORDER BY e) AS codes FROM f GROUP BY site""")
def concat_first_seen(spark, sf):
    return A.concat_distinct(MEASUREMENTS.df(spark, sf), ["site"], "code", order="event_id", name="codes")


# ---------------------------------------------------------------- profiles and duplicates

_ALL = ["flag", "supp", *PROFILE_NUMBERS]


@query("profile_columns", f"WITH t AS ({PROFILE.sql}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct, "
    f"count(*) - count({c}) AS n_null FROM t" for c in _ALL))
def profile_columns(spark, sf):
    return A.profile_columns(PROFILE.df(spark, sf))


@query("varying_columns", f"WITH t AS ({PROFILE.sql}), g AS (SELECT supp, " + ", ".join(
    f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}" for c in PROFILE_NUMBERS) + " FROM t GROUP BY supp) "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", max({c}) AS max_distinct FROM g" for c in PROFILE_NUMBERS))
def varying_columns(spark, sf):
    return A.varying_columns(PROFILE.df(spark, sf), ["supp"], PROFILE_NUMBERS)


@query("duplicate_groups", f"""WITH t AS ({MEASUREMENTS.sql}) SELECT site, day, code, count(*) AS n,
  count(DISTINCT unit) + max(CASE WHEN unit IS NULL THEN 1 ELSE 0 END) AS n_units FROM t GROUP BY site, day, code HAVING count(*) > 1""")
def duplicate_groups(spark, sf):
    return A.duplicate_groups(MEASUREMENTS.df(spark, sf), ["site", "day", "code"], "unit")


@query("duplicate_rate", f"WITH t AS ({MEASUREMENTS.sql}), g AS (SELECT count(*) AS n FROM t GROUP BY site, day, code) "
                         "SELECT sum(n - 1)::DOUBLE / sum(n)::DOUBLE AS duplicate_rate FROM g")
def duplicate_rate(spark, sf):
    return A.duplicate_rate(MEASUREMENTS.df(spark, sf), ["site", "day", "code"])


@query("distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(spark, sf):
    return A.distinct_rows(table(spark, sf, "part"), ["p_brand", "p_type"])


@query("distinct_excess", """SELECT (SELECT count(*) FROM (SELECT DISTINCT p_brand, p_type FROM part))
  - (SELECT count(*) FROM (SELECT DISTINCT p_brand FROM part)) AS n_extra""")
def distinct_excess(spark, sf):
    return A.distinct_excess(table(spark, sf, "part"), ["p_brand"], "p_type")


# ---------------------------------------------------------------- dates and seasons

_SITE_CODE = ["site", "yr", "code"]


@query("group_coverage", f"WITH t AS ({CHEMISTRY.sql}) SELECT site, yr, code, min(day) AS date_first, max(day) AS date_last, "
                         "count(*) AS n_samples FROM t GROUP BY site, yr, code")
def group_coverage(spark, sf):
    return A.group_coverage(CHEMISTRY.df(spark, sf), _SITE_CODE, "day")


@query("out_of_season", f"WITH t AS ({CHEMISTRY.sql}) SELECT site, yr, code, 0::BIGINT AS n_season FROM t GROUP BY site, yr, code "
                        "HAVING count_if(month(day) BETWEEN 6 AND 9) = 0")
def out_of_season(spark, sf):
    return A.out_of_season(CHEMISTRY.df(spark, sf), _SITE_CODE, "day")


SEASONAL_SQL = """SELECT site, yr, code, CASE
    WHEN count_if(month(day) IN (6, 7, 8)) > 0 AND count_if(month(day) IN (5, 9)) > 0 THEN
      (3 * avg(CASE WHEN month(day) IN (6, 7, 8) THEN {v} END) + 2 * avg(CASE WHEN month(day) IN (5, 9) THEN {v} END)) / 5
    WHEN count_if(month(day) IN (6, 7, 8)) > 0 THEN avg(CASE WHEN month(day) IN (6, 7, 8) THEN {v} END)
    WHEN count_if(month(day) IN (5, 9)) > 0 THEN avg(CASE WHEN month(day) IN (5, 9) THEN {v} END) END AS val
  FROM t GROUP BY site, yr, code"""


@query("seasonal_weighted_mean", f"WITH t AS ({CHEMISTRY.sql}) {SEASONAL_SQL.format(v='full_val')}")
def seasonal_weighted_mean(spark, sf):
    return A.seasonal_weighted_mean(CHEMISTRY.df(spark, sf), _SITE_CODE, "day", "full_val")


# ---------------------------------------------------------------- taxa and surveys


@query("taxon_frequency", f"WITH t AS ({TAXA.sql}) SELECT plain, count(*) AS n_surveys FROM (SELECT DISTINCT brand, size, plain FROM t) GROUP BY plain")
def taxon_frequency(spark, sf):
    return A.taxon_frequency(TAXA.df(spark, sf), ["brand", "size"], "plain")


@query("resurveyed", f"WITH t AS ({CHEMISTRY.sql}) SELECT site, count(DISTINCT yr) AS n_years FROM t GROUP BY site HAVING count(DISTINCT yr) > 1")
def resurveyed(spark, sf):
    return A.resurveyed(CHEMISTRY.df(spark, sf), "site", "yr")


@query("site_uniqueness", f"WITH lab AS ({LAB.sql}), t AS (SELECT coalesce(CAST(minDepth AS VARCHAR), 'NA') || coalesce(CAST(maxDepth AS VARCHAR), 'NA') "
                          "AS place, CAST(year(CAST(samplingDate AS DATE)) AS INTEGER) AS yr, samplingDate, stationId FROM lab) "
                          "SELECT place, count(*) AS n_rows, count(DISTINCT yr) AS n_years, count(DISTINCT samplingDate) AS n_dates, "
                          "count(DISTINCT stationId) AS n_ids FROM t GROUP BY place")
def site_uniqueness(spark, sf):
    from limnos.functions.text import concat_na

    t = LAB.df(spark, sf).select(concat_na(F.col("minDepth"), F.col("maxDepth")).alias("place"),
                                 F.year(F.to_date("samplingDate")).alias("yr"), "samplingDate", "stationId")
    return A.site_uniqueness(t, "place", "yr", "samplingDate", "stationId")


@query("richness", """WITH r AS (SELECT l_suppkey, p_name, max(CASE WHEN l_discount > 0.02 THEN 1 ELSE 0 END) AS present
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
  SELECT l_suppkey, sum(present)::BIGINT AS maxRich,
    sum(CASE WHEN p_name IN (SELECT p_name FROM part WHERE p_brand = 'Brand#7' AND p_size > 20) THEN present ELSE 0 END)::BIGINT AS murphyRich
  FROM r GROUP BY l_suppkey""")
def richness(spark, sf):
    part = table(spark, sf, "part")
    records = table(spark, sf, "lineitem").join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    listed = part.filter("p_brand = 'Brand#7' AND p_size > 20").select("p_name")
    amount = records.withColumn("amount", F.when(F.col("l_discount") > 0.02, 1).otherwise(0))
    return A.richness(amount, ["l_suppkey"], "p_name", "amount", listed)


@query("freq_table", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1")
def freq_table(spark, sf):
    return A.freq_table(table(spark, sf, "orders"), "o_orderpriority")


@query("crosstab", "SELECT o_orderpriority, count_if(o_orderstatus = 'F') AS F, count_if(o_orderstatus = 'O') AS O, "
                   "count_if(o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def crosstab(spark, sf):
    return A.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("column_means", "SELECT 'l_quantity' AS var, avg(l_quantity) AS meanEff FROM lineitem UNION ALL "
                       "SELECT 'l_linenumber', avg(l_linenumber) FROM lineitem")
def column_means(spark, sf):
    return A.column_means(table(spark, sf, "lineitem"), ["l_quantity", "l_linenumber"])


@query("min_where", "SELECT min(l_extendedprice) AS lowest FROM lineitem WHERE l_discount <> 0 OR l_tax <> 0")
def min_where(spark, sf):
    return A.min_where(table(spark, sf, "lineitem"), (F.col("l_discount") != 0) | (F.col("l_tax") != 0), "l_extendedprice", "lowest")


@query("max_of", "SELECT max(l_extendedprice) AS highest FROM lineitem")
def max_of(spark, sf):
    return A.max_of(table(spark, sf, "lineitem"), "l_extendedprice", "highest")


# ---------------------------------------------------------------- correlations, residuals, quantiles


def _corr_sql(use: str) -> str:
    parts = []
    for a, b in combinations(PROFILE_NUMBERS, 2):
        whole = f"count({a}) = count(*) AND count({b}) = count(*)" if use == "everything" else "TRUE"
        both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        parts.append(
            f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN {whole} AND stddev_pop({a}) FILTER ({both}) > 0 "
            f"AND stddev_pop({b}) FILTER ({both}) > 0 THEN round(corr({a}, {b}), 6) END AS r FROM t"
        )
    return f"WITH t AS ({PROFILE.sql}) " + " UNION ALL ".join(parts)


@query("corr_matrix", _corr_sql("everything"))
def corr_everything(spark, sf):
    return A.corr_matrix(PROFILE.df(spark, sf), PROFILE_NUMBERS, "everything", 6)


@query("corr_matrix_pairwise", _corr_sql("pairwise"))
def corr_pairwise(spark, sf):
    return A.corr_matrix(PROFILE.df(spark, sf), PROFILE_NUMBERS, "pairwise", 6)


@query("residuals", "SELECT l_orderkey, l_quantity - l_linenumber AS rawResid FROM lineitem")
def residuals(spark, sf):
    return A.residuals(table(spark, sf, "lineitem"), "l_quantity", "l_linenumber").select("l_orderkey", "rawResid")


@query("pearson_gof", "SELECT round(sum((l_quantity - l_linenumber) * (l_quantity - l_linenumber) / l_linenumber), 3) AS pearson_gof FROM lineitem")
def pearson_gof(spark, sf):
    r = A.residuals(table(spark, sf, "lineitem"), "l_quantity", "l_linenumber")
    return A.pearson_gof(r, "rawResid", "l_linenumber").select(F.round("pearson_gof", 3).alias("pearson_gof"))


@query("histogram", "SELECT CAST(least(floor((l_quantity - 0) / 5.0), 9) AS INTEGER) AS bin, count(*) AS n FROM lineitem "
                    "WHERE l_quantity BETWEEN 0 AND 50 GROUP BY 1")
def histogram(spark, sf):
    return A.histogram(table(spark, sf, "lineitem"), "l_quantity", 0, 50, 10)


_PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@query("histogram_outside", "SELECT CASE WHEN l_quantity < 10 THEN -1 WHEN l_quantity > 30 THEN 8 "
                            "ELSE CAST(least(floor((l_quantity - 10) / 2.5), 7) AS INTEGER) END AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def histogram_outside(spark, sf):
    return A.histogram(table(spark, sf, "lineitem"), "l_quantity", 10, 30, 8)


@query("qq_pairs", " UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS prob, round(quantile_cont(l_extendedprice, {p}), 6) AS l_extendedprice, quantile_cont(l_quantity, {p}) AS l_quantity FROM lineitem"
    for p in _PROBS))
def qq_pairs(spark, sf):
    pairs = Q.qq_pairs(table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity", _PROBS)
    return pairs.withColumn("l_extendedprice", F.round("l_extendedprice", 6))


@query("bivariate_class", """WITH t AS (SELECT o_orderkey, round(o_totalprice * 100) AS x, CASE WHEN o_orderstatus <> 'P' THEN o_custkey::DOUBLE END AS y FROM orders),
  c AS (SELECT * FROM t WHERE y IS NOT NULL),
  q AS (SELECT quantile_cont(x, 1/3.0::DOUBLE) AS x1, quantile_cont(x, 2/3.0::DOUBLE) AS x2, quantile_cont(y, 1/3.0::DOUBLE) AS y1, quantile_cont(y, 2/3.0::DOUBLE) AS y2 FROM c)
  SELECT o_orderkey, (1 + (x > x1)::INT + (x > x2)::INT)::VARCHAR || '-' || (1 + (y > y1)::INT + (y > y2)::INT)::VARCHAR AS bi_class FROM c, q""")
def bivariate_class(spark, sf):
    t = table(spark, sf, "orders").selectExpr("o_orderkey", "round(o_totalprice * 100) AS x",
                                              "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS DOUBLE) END AS y")
    return Q.bivariate_class(t, "x", "y").select("o_orderkey", "bi_class")
