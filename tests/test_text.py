"""Number and name texts."""

import pytest
from pyspark.sql import functions as F

from limnos.functions import text, values
from limnos.plans.site_years import two_word_name
from limnos.plans.surveys import clean_taxon_name


def apply(spark, function, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


def test_decimal_comma_and_failures(spark):
    got = apply(spark, text.parse_decimal_comma, ["1,25", "-0,03", " 2 ", "1e3", "abc", "1.5d", "<1", "", None, "1,2,3"])
    assert got == [1.25, -0.03, 2.0, 1000.0, None, None, None, None, None, None]


def test_censored_has_two_branches_and_keeps_the_bracket_case(spark):
    got = apply(spark, text.parse_censored, ["1,25", "<0,5", ">100", "(<0,5)", "0,1-0,2", "-0,03", "abc", None])
    assert got[:2] == [1.25, 0.25]
    assert got[2] == pytest.approx(110.0)
    assert got[3] is None
    assert got[4] == pytest.approx(0.11)
    assert got[5] == -0.03
    assert got[6:] == [None, None]


def test_secchi_ranges_are_exact(spark):
    ranges = {"2,36-2,76": 2.56, "1,8-4,5": 3.15, "1,1-1,4": 1.25, "1,1-1,3": 1.2, "1-1,6": 1.3, "1,8-2,1": 1.95,
              "1 -1,25": 1.125, "1,7 meter": 1.7, "1,6-2,5": 2.05, "2,63-3,8": 3.215}
    assert apply(spark, text.secchi_depth, list(ranges)) == list(ranges.values())
    got = apply(spark, text.secchi_depth, [">4", "≥3,5", "till botten", None, " 2,5 ", ">4-5"])
    assert got[0] == pytest.approx(4.4) and got[1] == pytest.approx(3.85)
    assert got[2:] == [None, None, 2.5, None]


def test_sentence_case_keeps_capitals_after_a_full_stop(spark):
    got = apply(spark, text.sentence_case, ["Sphagnum subgen. Acutifolia sect. Acutifolia", "trådalg", "CAREX Rostrata", " iris ", None,
                                            "Stigonema ocellatum var. globosum"])
    assert got == ["Sphagnum subgen. Acutifolia sect. Acutifolia", "Trådalg", "Carex rostrata", " Iris ", None,
                   "Stigonema ocellatum var. globosum"]


def test_word_counts_single_spaces(spark):
    assert apply(spark, lambda c: text.word(c, 1, 2), ["a b c", "a", "a  b", None]) == ["a b", None, "a ", None]
    assert apply(spark, two_word_name, ["Acorus  calamus", "acorus CALAMUS var", "Acorus", None]) == ["Acorus", "Acorus calamus", None, None]


def test_taxon_names(spark):
    names = {
        "Carex × saamica": "Carex", "A x b": "A", "Nitella flexilis/opaca": "Nitella", "Chara s.lat.": "Chara", "Chara s. lat.": "Chara",
        "Ranunculus Batrachium agg.": "Ranunculus", "X y var. z": "X y", "X y subsp. z": "X y", "Iris": "Iris pseudacorus",
        "Sphagnum subg. Cuspidata": "Sphagnum", "Sphagnum subgen. Acutifolia sect. Acutifolia": "Sphagnum", "Inget fynd": "Biota",
        " isoetes lacustris ": "Isoetes lacustris", None: "Biota", "trådalg": "Biota", "trådstarr": "Carex lasiocarpa",
        "Knoppslinga": "Myriophyllum sibiricum", "möja": "Ranunculus", "Stigonema ocellatum var. globosum": "Biota",
        "Riccia fluitans": "Riccia fluitans", "Riccia": "Riccia fluitans", "Deschampsia cespitosa": "Deschampsia",
        "Chara aggx": "Chara",  # the dot of the pattern is any character
    }
    assert apply(spark, clean_taxon_name, list(names)) == list(names.values())


def test_extract_replace_and_missing_text(spark):
    assert apply(spark, text.extract_number, ["12.0 arter", "TMI 7", "x", None]) == ["12.0", "7", None, None]
    assert apply(spark, lambda c: text.replace_first(c, "a", "_"), ["banana", "x", None]) == ["b_nana", "x", None]
    assert apply(spark, lambda c: text.null_if(c, "N/A"), ["N/A", "ok", None]) == [None, "ok", None]
    assert apply(spark, lambda c: text.null_if_contains(c, "saknas"), ["Uppgift SAKNAS", "ok", None]) == [None, "ok", None]
    assert apply(spark, lambda c: text.to_number(c, "int"), ["12.7", "x", "3"]) == [12, None, 3]
    assert apply(spark, text.text_shape, ["<1,5", "12"]) == ["<,", ""]


def test_median_rounding(spark):
    df = spark.createDataFrame([(2.5, 2.7), (2.5, 2.5), (2.5, 2.1), (3.0, 9.0), (None, 1.0)], "m double, a double")
    got = [r[0] for r in df.select(values.round_median_toward_mean(F.col("m"), F.col("a"))).collect()]
    assert got == [3.0, 2.0, 2.0, 3.0, None]


def test_nonfinite_cells(spark):
    df = spark.createDataFrame([(float("inf"), ""), (float("-inf"), "a"), (float("nan"), None), (1.0, "b")], "d double, s string")
    assert [tuple(r) for r in values.null_nonfinite(df).collect()] == [(None, None), (None, "a"), (None, None), (1.0, "b")]


def test_substrate_ranks_and_row_sum(spark):
    from limnos import fixed_values as fixed

    v3 = apply(spark, lambda c: values.label_rank(c, fixed.SUBSTRATE_RANKS_V3), ["Sten >63-200 mm", "ler-silt ≤0,063 mm", "okänd", None])
    assert v3 == [4, 1, None, None]
    df = spark.createDataFrame([(1, None), (None, None), (2, 3)], "a int, b int")
    assert [r[0] for r in df.select(values.sum_nonnull(F.col("a"), F.col("b"))).collect()] == [1, None, 5]


def test_projection_of_a_known_point(spark):
    lon, lat = values.inverse_transverse_mercator(F.lit(674032.357), F.lit(6580821.991))
    row = spark.range(1).select(lon.alias("lon"), lat.alias("lat")).first()
    assert row["lon"] == pytest.approx(18.0592, abs=1e-4) and row["lat"] == pytest.approx(59.3302, abs=1e-4)
