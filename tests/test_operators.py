"""Operators on hand-made rows, one test per rule that is easy to get wrong."""

from datetime import date
from types import SimpleNamespace

import random

import pytest
from pyspark.sql import functions as F

from limnos.functions import values as V
from limnos.operators import aggregates as A
from limnos.operators import columns as C
from limnos.operators import joins as J
from limnos.operators import nested as N
from limnos.operators import picks as K
from limnos.operators import quantiles as Q
from limnos.operators import reshape as R
from limnos.operators import sets as S
from limnos.plans.laboratory import alk_acid_rule
from limnos.session import shared_folder
from limnos.sources import landed as L


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_missing_units_match_missing_units(spark):
    left = spark.createDataFrame([("pH", None), ("TP", "mg"), ("X", "u")], "p string, unit string")
    units = spark.createDataFrame([("pH", None, "-"), ("TP", "mg", "ug")], "p string, unit string, alt string")
    assert rows(J.join_nullsafe_left(left, units, ["p", "unit"])) == [("TP", "mg", "ug"), ("X", "u", None), ("pH", None, "-")]


def test_full_join_matches_null_keys_and_keeps_both_sides(spark):
    a = spark.createDataFrame([(1, None, "a"), (2, 2, "b"), (2, 2, "c")], "k int, y int, l string")
    b = spark.createDataFrame([(1, None, "x"), (3, 3, "y"), (2, 2, "z")], "k int, y int, r string")
    assert rows(J.full_join(a, b, ["k", "y"])) == [(1, None, "a", "x"), (2, 2, "b", "z"), (2, 2, "c", "z"), (3, 3, None, "y")]


def test_unmatched_keys_count_partners_without_value(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(1, 1.0), (2, None)], "k int, v double")
    assert rows(J.unmatched_keys(a, b, ["k"], "v")) == [(2,), (3,)]
    assert rows(J.unmatched_keys(a, b, ["k"])) == [(3,)]


def test_strict_mean(spark):
    df = spark.createDataFrame([("a", 1.0, date(2020, 1, 1)), ("a", 3.0, date(2021, 1, 1)), ("b", None, date(2020, 1, 1)), ("b", 1.0, None)],
                               "k string, v double, d date")
    assert rows(A.group_mean_strict(df, ["k"], "v", "d")) == [("a", date(2021, 1, 1), 2.0), ("b", None, None)]


def test_distinct_counts_include_missing(spark):
    df = spark.createDataFrame([("x", 1.0), (None, -0.0), ("x", 0.0)], "s string, d double")
    assert rows(A.profile_columns(df)) == [("d", 2, 0), ("s", 2, 1)]
    assert rows(A.varying_columns(df.withColumn("k", F.lit(1)), ["k"], ["s", "d"])) == [("d", 2), ("s", 2)]
    assert rows(A.duplicate_groups(df.withColumn("k", F.lit(1)), ["k"], "s")) == [(1, 3, 2)]


def test_sums_over_nothing_are_zero(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "k int, v double")
    got = A.covariate_summary(df, ["k"], {"s": "v"}, {"lo": "v"}, {"hi": "v"}, {"med": "v"}, {"mean": "v"})
    assert rows(got) == [(1, 0.0, None, None, None, None), (2, 3.0, 3.0, 3.0, 3.0, 3.0)]


def test_alk_acid_rule_is_sequential(spark):
    df = spark.createDataFrame([("Alk_Acid", "Alk/Acid", "Alkalinitet/Acid.", "-0,03", 5.0), ("Alk_Acid", "Alk/Acid", "Alkalinitet/Acid.", None, 2.0),
                                ("pH", "pH", "pH", "-1", 7.0)],
                               "propertyCode string, propertyAbbrevName string, propertyName string, value string, valF double")
    assert rows(alk_acid_rule(df)) == [("Alk", "Alk.", "Alkalinitet/Acid.", "-0,03", 0.0), ("Alk", "Alk.", "Alkalinitet/Acid.", None, 2.0),
                                       ("pH", "pH", "pH", "-1", 7.0)]


def test_picks_keep_ties_and_sort_missing_last(spark):
    df = spark.createDataFrame([("s", None, 0.0, 1), ("s", 0.5, 2.0, 2), ("s", 0.5, 1.0, 3), ("s", 0.5, 1.0, 4), ("t", None, None, 5), ("t", None, 1.0, 6),
                                (None, 1.0, 1.0, 7)], "k string, minDepth double, maxDepth double, id int")
    assert sorted(r["id"] for r in K.shallowest(df, ["k"]).collect()) == [3, 4, 6, 7]


def test_first_survey_and_effort(spark):
    d = [date(2010, 1, 1), date(2012, 1, 1)]
    df = spark.createDataFrame([(1, d[0], 3, "a"), (1, d[0], 5, "b"), (1, d[0], 5, "c"), (1, d[1], 9, "d"), (2, None, 1, "e"), (2, d[1], None, "f")],
                               "site int, day date, n int, id string")
    assert sorted(r["id"] for r in K.first_survey(df, "site", "day").collect()) == ["a", "b", "c", "f"]
    assert sorted(r["id"] for r in K.highest_effort(df, "site", "day", "n").collect()) == ["b", "c", "f"]


def test_one_group_with_a_third_of_all_rows(spark):
    """A large group is reduced and split like any other and loses no row."""
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "CAST(id % 2 AS DOUBLE) AS d", "id")
    got = K.pick_min(df, ["k"], ["d"])
    assert got.filter("k = -1").count() == 5000
    assert got.count() == 25000


def test_later_occurrences(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", None), ("b", "z")], "k string, u string")
    assert rows(K.later_occurrences(df, ["k"], ["u"])) == [("a", "y"), ("a", None)] or rows(
        K.later_occurrences(df, ["k"], ["u"])) == [("a", None), ("a", "y")]


def test_filters_and_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert rows(C.filter_not_in(df, "c", ["a"])) == [("b",), (None,)]
    assert rows(C.filter_in(df, "c", ["a"])) == [("a",)]
    flags = C.onehot_flags(spark.createDataFrame([("Kratta",), (None,), ("räfsa",)], "m string"), "m", {"rake": ["kratta", "räfsa"]})
    assert sorted(r["rake"] for r in flags.collect()) == [0, 1, 1]


def test_one_missing_coordinate_is_enough(spark):
    df = spark.createDataFrame([(1, "5", None), (2, None, None), (6679, "1", "1"), (None, "1", "1")], "s int, x string, y string")
    assert [r["s"] for r in C.valid_sites(df, "x", "y", "s", [6679]).collect()] == [1]


def test_column_contents(spark):
    df = spark.createDataFrame([(1, None, 7, None, [1]), (2, None, 7, 3, [1]), (3, None, 7, 3, [1])],
                               "id int, nothing int, same int, gap int, nest array<int>")
    varying, constant = C.split_constant_columns(df)
    assert varying.columns == ["id", "gap"] and constant.columns == ["nothing", "same", "nest"]
    assert C.drop_all_null_columns(df).columns == ["id", "same", "gap", "nest"]
    assert C.drop_sparse_columns(df, 0.25).columns == ["id", "same", "nest"]
    assert C.drop_sparse_columns(df, 0.25, keys=["gap"]).columns == ["id", "same", "gap", "nest"]


def test_column_sets_project_and_renames(spark):
    a = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int")
    assert C.column_sets(a, a.select("z", "x")) == (["x", "z"], ["y"])
    assert C.project(a, between=("y", "z"), first=["z"]).columns == ["z", "y"]
    assert C.rename_map(a, {"x": "k", "absent": "n"}).columns == ["k", "y", "z"]
    assert R.sort_columns(a.select("z", "y", "x"), ["y"]).columns == ["y", "x", "z"]


NESTED = "id int, items array<struct<id: int, label: string, value: string>>"


def nested(spark):
    return spark.createDataFrame([(1, [(1, "a", "x"), (1, "b", "y")]), (2, []), (3, None)], NESTED)


def test_explode_inner_and_outer(spark):
    assert rows(N.explode_inner(nested(spark), "items")) == [(1, 1, "a", "x"), (1, 1, "b", "y")]
    assert len(rows(N.explode_outer(nested(spark), "items"))) == 4
    flat = N.unnest_with_prefix(nested(spark), "items", "item_")
    assert flat.columns == ["id", "item_id", "label", "value"] and N.columns_equal(flat, "id", "item_id")
    assert not N.columns_equal(flat, "label", "value")
    assert N.unnest_with_prefix(nested(spark), "items", "item_", drop_copies=True).columns == ["id", "label", "value"]


def test_sizes_and_label_lists(spark):
    assert rows(N.nested_sizes(nested(spark), ["items"]).select("id", "items_n")) == [(1, 2), (2, 0), (3, 0)]
    assert sorted(r["id"] for r in N.without_elements(nested(spark), "items").collect()) == [2, 3]
    assert rows(N.eav_to_columns(nested(spark), "items", {"a": "first", "c": "absent"})) == [(1, "x", None), (2, None, None), (3, None, None)]
    assert N.drop_nested(nested(spark)).columns == ["id"]


def test_wide_and_long_are_inverse(spark):
    wide = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0)], "k int, a double, b double")
    long = R.melt(wide, ["k"], ["a", "b"], "name", "v", "double")
    assert rows(R.cast_wide(long, ["k"], "name", "v", ["a", "b"])) == rows(wide)


def test_placeholder_only_group_survives_the_wide_step(spark):
    long = spark.createDataFrame([(1, "Carex", 2.0), (2, "Biota", 1.0)], "s int, t string, v double")
    wide = R.cast_wide_fill(long, ["s"], "t", "v", ["Carex", "Biota", "Chara"], 0, "Biota")
    assert wide.columns == ["s", "Carex", "Chara"] and rows(wide) == [(1, 2.0, 0.0), (2, 0.0, 0.0)]


def test_joined_cells(spark):
    long = spark.createDataFrame([(1, "a", "y"), (1, "a", "x"), (1, "b", None), (2, "b", "z")], "k int, n string, v string")
    wide = R.cast_wide_concat(long, ["k"], "n", "v", ["a", "b"])
    assert rows(wide) == [(1, "x|y", None), (2, None, "z")]
    assert rows(R.multi_valued_cells(wide, ["a", "b"])) == [("a", 1), ("b", 0)]
    assert rows(R.multi_valued_counts(long, ["k"], "n", "v", ["a", "b", "c"])) == [("a", 1), ("b", 0), ("c", 0)]
    one = spark.createDataFrame([(1, "a", "x|y")], "k int, n string, v string")
    assert rows(R.multi_valued_counts(one, ["k"], "n", "v", ["a"])) == [("a", 0)]  # a value that holds the mark is one


def test_concat_distinct_orders(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "b", 3), (2, None, 4)], "k int, v string, pos int")
    assert rows(A.concat_distinct(df, ["k"], "v")) == [(1, "a;b"), (2, "")]
    assert rows(A.concat_distinct(df, ["k"], "v", order="pos")) == [(1, "b;a"), (2, "")]


def test_seasonal_mean_branches(spark):
    def day(month):
        return date(2020, month, 1)

    df = spark.createDataFrame([("both", day(7), 10.0), ("both", day(5), 0.0), ("summer", day(6), 4.0), ("shoulder", day(9), 6.0), ("winter", day(1), 9.0)],
                               "k string, d date, v double")
    assert rows(A.seasonal_weighted_mean(df, ["k"], "d", "v")) == [("both", 6.0), ("shoulder", 6.0), ("summer", 4.0), ("winter", None)]
    assert rows(A.out_of_season(df, ["k"], "d")) == [("both", 0)][:0] + [("winter", 0)]


def test_richness_counts_listed_taxa_and_keeps_empty_surveys(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (1, "b", 1.0), (2, "c", 0.0)], "s int, t string, v double")
    listed = spark.createDataFrame([("a",), ("a",), ("c",)], "t string")
    assert rows(A.richness(df, ["s"], "t", "v", listed)) == [(1, 2, 1), (2, 0, 0)]


def test_correlation_modes(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, None), (2.0, 4.0, 5.0, 1.0), (3.0, 7.0, 5.0, 3.0)], "a double, b double, c double, d double")
    everything = {(r["a"], r["b"]): r["r"] for r in A.corr_matrix(df, list("abcd"), "everything", None).collect()}
    pairwise = {(r["a"], r["b"]): r["r"] for r in A.corr_matrix(df, list("abcd"), "pairwise", None).collect()}
    assert everything[("a", "b")] == pytest.approx(0.993399, abs=1e-6) and everything[("a", "d")] is None
    assert pairwise[("a", "d")] == pytest.approx(1.0) and pairwise[("a", "c")] is None
    assert len(everything) == 6


def test_quantiles_by_narrowing_equal_an_exact_aggregate(spark):
    df = spark.range(20000).selectExpr("CASE WHEN id % 3 = 0 THEN 5.0D ELSE CAST(pmod(xxhash64(id), 100000) AS DOUBLE) END AS v")
    probs = [0.0, 0.01, 1 / 3, 0.5, 2 / 3, 0.99, 1.0]
    exact = df.selectExpr(f"percentile(v, array({', '.join(f'{p!r}D' for p in probs)})) AS q").first()["q"]
    assert Q.exact_quantiles(df, "v", probs, remainder=200) == pytest.approx(exact)
    assert Q.exact_quantiles(df, "v", probs) == pytest.approx(exact)
    assert Q.exact_quantiles(df.filter("v < 0"), "v", [0.5]) == [None]


def test_bivariate_classes_are_right_closed(spark):
    df = spark.createDataFrame([(float(i), float(7 - i)) for i in range(1, 7)] + [(None, 1.0)], "x double, y double")
    got = {r["x"]: r["bi_class"] for r in Q.bivariate_class(df, "x", "y").collect()}
    assert got == {1.0: "1-3", 2.0: "1-3", 3.0: "2-2", 4.0: "2-2", 5.0: "3-1", 6.0: "3-1"}


def test_master_list_and_set_operations(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert rows(S.master_list(df, ["x", "y"])) == [("a",), ("b",), (None,)]
    assert rows(S.intersect_values(df.select("x"), df.select("x"))) == [("a",)]
    assert rows(S.append(df, df.select("y"))) == sorted([("a", "b"), ("a", None), (None, "b"), (None, None)], key=str)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (11.0,)], "v double")
    assert sorted(A.histogram(df, "v", 0, 10, 10).collect()) == [(0, 1), (1, 1), (9, 1), (10, 1)]
    assert sorted(A.histogram(df, "v", 1, 10, 9).collect()) == [(-1, 1), (0, 1), (8, 1), (9, 1)]
    assert sorted(A.histogram(df, "v", bins=11).collect()) == [(0, 1), (1, 1), (10, 2)]
    assert A.histogram(df.filter("v < 0"), "v").count() == 0


def test_wide_tables_lose_nothing(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "zz", 9.0), (2, "a", 2.0), (2, "a", 2.0)], "k int, label string, v double")
    assert sorted(R.cast_wide(df, ["k"], "label", "v").collect(), key=str) == [(1, 1.0, 9.0), (2, 2.0, None)]
    assert sorted(R.cast_wide_fill(df, ["k"], "label", "v").collect()) == [(1, 1.0, 9.0), (2, 2.0, 0.0)]
    assert [tuple(r) for r in R.unlisted_labels(df, "label", ["a"]).collect()] == [("zz", 1)]
    twice = df.union(spark.createDataFrame([(2, "a", 7.0)], df.schema))
    assert [tuple(r) for r in R.conflicting_cells(twice, ["k"], "label", "v").collect()] == [(2, "a", 2.0, 7.0, 3)]
    with pytest.raises(Exception, match="different values"):
        R.cast_wide(twice, ["k"], "label", "v").collect()


@pytest.mark.parametrize("split", ["7", "40", "1000000"])
def test_quoted_line_breaks_are_read_in_splits(spark, tmp_path, split):
    """Files of all kinds of texts, cut anywhere, against the reader that takes each file as a whole."""
    rng = random.Random(int(split))
    marks = ["a", "bc", "é中", ",", '""', "\n", "\r\n", "\n\n", " ", "NA", "1"]
    for file in range(3):
        body = "".join(f'{k},"{"".join(rng.choices(marks, k=rng.randrange(9)))}",{rng.choice(["1.5", "", "NA", "x"])}{rng.choice([chr(10), chr(13) + chr(10), chr(10) * 2])}' for k in range(file * 40))
        (tmp_path / f"{file}.csv").write_bytes(("k,t,v\n" + body).encode())
    (tmp_path / "empty.csv").write_text("")
    schema = "k int, t string, v double"
    whole = spark.read.csv(str(tmp_path), schema=schema, header=True, nullValue="NA", emptyValue="", enforceSchema=True, quote='"', escape='"', multiLine=True)
    want = rows(whole.withColumn("t", F.nullif("t", F.lit(""))))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = L.scan_csv_typed(spark, str(tmp_path), schema)
        assert rows(got) == want and len(want) > 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_texts_survive_a_csv_round_trip(spark, tmp_path):
    texts = [(1, 'a "quoted" word, and comma', 1.5), (2, "two\nlines", None), (3, None, 2.0), (4, "back\\slash\\", 0.0), (5, '"', 1.0)]
    df = spark.createDataFrame(texts, "k int, t string, v double")
    L.sink_csv(df, str(tmp_path / "out"))
    assert sorted(map(tuple, L.scan_csv_typed(spark, str(tmp_path / "out"), df.schema).collect())) == texts
    (tmp_path / "in.csv").write_text('k,t,v\n1,"a ""quoted"" word, and comma",1.5\n2,"",\n3,NA,NA\n')
    assert sorted(map(tuple, L.scan_csv_typed(spark, str(tmp_path / "in.csv"), df.schema).collect())) == [texts[0], (2, None, None), (3, None, None)]


def test_dates_that_cannot_be_read_are_missing(spark):
    df = spark.createDataFrame([("2020-05-06",), ("ok\u00e4nt",), (None,), ("2020-13-01",)], "d string")
    assert [tuple(r)[1:] for r in V.date_parts(df, "d").collect()] == [(date(2020, 5, 6), 2020, 5)] + [(None, None, None)] * 3


def test_a_cluster_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda name, default=None: default)
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="x")))
