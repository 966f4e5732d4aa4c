"""Lattice smoothing against brute force, and the count models on a surface that is known."""

import math
import time

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from limnos.operators import lattice as L
from limnos.operators import nearby
from limnos.plans import spatial_counts as M


def brute_local_mean(points, bandwidth):
    side = bandwidth / 2
    cells = {}
    for x, y, v in points:
        key = (math.floor(x / side), math.floor(y / side))
        n, total = cells.get(key, (0, 0.0))
        cells[key] = (n + 1, total + v)
    out = {}
    for a in cells:
        weighted = [(math.exp(-((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2) / 8), n, t) for b, (n, t) in cells.items()
                    if (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= 36]
        out[a] = sum(w * t for w, _, t in weighted) / sum(w * n for w, n, _ in weighted)
    return out


def test_local_mean_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    points = [(float(x), float(y), float(v)) for x, y, v in zip(rng.uniform(0, 100, 200), rng.uniform(0, 100, 200), rng.poisson(5, 200))]
    points += [(50.0, 50.0, 9.0)] * 100  # a third of all points in one place
    got = L.kernel_local_mean(spark.createDataFrame(points, "x double, y double, v double"), "x", "y", "v", 12.0, (0.0, 0.0))
    want = brute_local_mean(points, 12.0)
    found = {(r["cx"], r["cy"]): r["local_mean"] for r in got.collect()}
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k]) for k in want)


def test_neighbour_cells_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    points = [(float(x), float(y)) for x, y in rng.uniform(-30, 30, (150, 2))]
    got = L.neighbour_join(spark.createDataFrame(points, "x double, y double"), "x", "y", 7.0, 2.0, (-30.0, -30.0))
    cells = {(math.floor((x + 30) / 2), math.floor((y + 30) / 2)) for x, y in points}
    want = {(a, b) for a in cells for b in cells if math.dist(a, b) * 2 <= 7.0}
    assert {((r["cx"], r["cy"]), (r["nx"], r["ny"])) for r in got.collect()} == want


@pytest.mark.parametrize("bandwidth", [None, 4.0])
def test_sums_at_points_equal_brute_force(spark, bandwidth):
    """Copies of places, a dense cell of many blocks, missing values and rows without a place."""
    rng = np.random.default_rng(4)
    points = [(float(x), float(y), float(v)) for x, y, v in zip(rng.uniform(-40, 40, 250), rng.uniform(-40, 40, 250), rng.poisson(5, 250))]
    points += [(float(x), float(y), 1.0) for x, y in rng.uniform(10, 12, (150, 2))] + points[:40] + [(0.5, 0.5, None)] * 3
    df = spark.createDataFrame([*points, (None, 1.0, 2.0), (1.0, None, 2.0)], "x double, y double, v double")
    got = L.sums_around_points(df, "x", "y", 7.0, {"total": "v"}, bandwidth, points_per_block=20).collect()
    assert {(r.x, r.y) for r in got} == {(x, y) for x, y, _ in points} and len(got) == len({(x, y) for x, y, _ in points})
    for r in got:
        near = [((r.x - x) ** 2 + (r.y - y) ** 2, v or 0.0) for x, y, v in points if (r.x - x) ** 2 + (r.y - y) ** 2 <= 49]
        weights = [1.0 if bandwidth is None else math.exp(-0.5 * d / bandwidth**2) for d, _ in near]
        assert r.weight == pytest.approx(sum(weights), rel=1e-9)
        assert r.total == pytest.approx(sum(w * v for w, (_, v) in zip(weights, near)), rel=1e-9)


def near_sums(bandwidth, sources=30_000, targets=200):
    """(found, wanted) sums of a crowded tile, where whole cells are added by their sums."""
    rng = np.random.default_rng(5)
    sx, sy = rng.uniform(-60, 120, (2, sources))
    tx, ty = rng.uniform(0, 60, (2, targets))
    amounts = np.array([np.ones(sources), rng.integers(0, 9, sources).astype(float)])
    assert nearby._grid(sources, 60.0, bandwidth)[1]
    squared = (sx - tx[:, None]) ** 2 + (sy - ty[:, None]) ** 2
    weights = (squared <= 3600) * (1.0 if bandwidth is None else np.exp(-0.5 * squared / bandwidth**2))
    return nearby.sums_nearby(tx, ty, sx, sy, amounts, (0, 0), 60.0, bandwidth), amounts @ weights.T


def test_counts_around_points_add_whole_cells(monkeypatch):
    """Cells inside the circle are added as sums; few pairs of points are met."""
    met = []
    repeat = np.repeat
    monkeypatch.setattr(nearby.np, "repeat", lambda who, count: met.append(count.sum()) or repeat(who, count))
    found, wanted = near_sums(None)
    assert (found == wanted).all()
    assert sum(met) / 2 < 0.4 * wanted[0].sum()


@pytest.mark.parametrize("bandwidth", [20.0, 35.0])
def test_kernel_sums_from_moments_are_exact(bandwidth):
    found, wanted = near_sums(bandwidth)
    assert np.allclose(found, wanted, rtol=1e-12, atol=0)


def test_kernel_sums_take_one_core():
    """Moments are added on the task's own core; threads of a matrix library would take those of other tasks."""
    near_sums(20.0, targets=2)  # loads what is loaded once
    began, used = time.perf_counter(), time.process_time()
    near_sums(20.0, targets=2)
    assert time.process_time() - used < 1.5 * (time.perf_counter() - began)


def test_kernel_sums_of_few_points_need_no_moments(monkeypatch):
    monkeypatch.setattr(nearby, "_whole_cells", None)
    at = np.random.default_rng(6).uniform(-60, 120, (2, 9000))
    own = ((at >= 0) & (at < 60)).all(0)
    found = nearby.sums_nearby(*at[:, own], *at, np.ones((1, 9000)), (0, 0), 60.0, 20.0)
    squared = ((at[:, own, None] - at[:, None]) ** 2).sum(0)
    assert np.allclose(found[0], ((squared <= 3600) * np.exp(-0.5 * squared / 400)).sum(1), rtol=1e-12, atol=0)


@pytest.fixture(scope="module")
def surface(spark):
    """Counts over 200 km with a wide wave and a covariate whose effect is known."""
    rng = np.random.default_rng(3)
    n = 3000
    x, y = rng.uniform(0, 200_000, n), rng.uniform(0, 200_000, n)
    t = rng.normal(0, 1, n)
    spatial = 0.9 * np.sin(x / 30_000) + 0.5 * np.cos(y / 25_000)
    counts = rng.poisson(np.exp(1.5 + 0.3 * t + spatial))
    rows = [(int(i), float(a), float(b), float(c), int(k), float(s)) for i, (a, b, c, k, s) in enumerate(zip(x, y, t, counts, spatial))]
    return spark.createDataFrame(rows, "site int, east double, north double, t double, rich int, truth double").cache()


@pytest.fixture(scope="module")
def fitted(surface):
    data = M.ModelData("site", "rich", "east", "north")
    return M.model_sweep(surface, data, {"t": ["t"]}, scales=5)


def test_joint_fit_equals_single_regressions(spark):
    """All models at once, each with its own offset, against one regression a model."""
    rng = np.random.default_rng(7)
    n = 800
    a, b, e = rng.normal(0, 1, n), rng.normal(5, 2, n), rng.uniform(-1, 1, n)
    y = rng.poisson(np.exp(0.2 + 0.4 * a - 0.1 * b + e))
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(y, e, 2 * e, a, b, b * b)], "_y double, e double, e2 double, a double, b double, b2 double")
    sets = {"Null": [], "a": ["a"], "all": ["a", "b", "b2"]}
    found = M._fit_jointly(df, sets, F.array("e", "e2", "e"))
    for name, offset in (("a", "e2"), ("all", "e")):
        assembled = VectorAssembler(inputCols=sets[name], outputCol="x").transform(df)
        one = GeneralizedLinearRegression(family="poisson", link="log", labelCol="_y", featuresCol="x", offsetCol=offset, maxIter=100, tol=1e-12).fit(assembled)
        assert [found[name].slopes[c] for c in sets[name]] == pytest.approx(list(one.coefficients), abs=1e-8)
        assert found[name].intercept == pytest.approx(one.intercept, abs=1e-8)
        errors = one.summary.coefficientStandardErrors
        assert [found[name].errors[c] for c in [*sets[name], M.INTERCEPT]] == pytest.approx(list(errors), rel=1e-6)
    assert found["Null"].intercept == pytest.approx(math.log(y.sum() / np.exp(e).sum()))


def test_terms_that_cannot_be_told_apart_share_their_effect(spark):
    rows = [(float(k % 5), 0.0, float(k % 3), 2.0 * (k % 3)) for k in range(60)]
    df = spark.createDataFrame(rows, "_y double, e double, a double, twice double")
    found = M._fit_jointly(df, {"a": ["a"], "both": ["a", "twice"]}, F.array("e", "e"))
    assert found["both"].slopes["a"] + 2 * found["both"].slopes["twice"] == pytest.approx(found["a"].slopes["a"], abs=1e-8)


def test_no_rows_are_an_error(spark):
    with pytest.raises(ValueError, match="no complete rows"):
        M._fit_jointly(spark.createDataFrame([], "_y double, e double"), {"Null": []}, F.array("e"))


@pytest.mark.parametrize("extent", [1.0, 9_000.0, 3_000_000.0])
def test_ladder_reaches_its_smallest_bandwidth_on_any_extent(spark, extent):
    df = spark.createDataFrame([(0.0, 5.0), (extent, 6.0)], "x double, y double")
    bands = L.bandwidth_ladder(df, "x", "y").bandwidths
    assert bands[0] == extent / 2 and all(2 * b == a for a, b in zip(bands, bands[1:]))
    assert len(bands) == 1 if extent / 2 < 5_000 else 2_500 <= bands[-1] < 5_000


def test_a_pyramid_adds_up_and_a_dense_cell_has_the_right_spread(spark):
    """A third of all rows in one cell; sums of every level, and squared errors from sums, against the rows."""
    rng = np.random.default_rng(11)
    n = 900
    x, y = rng.uniform(0, 100_000, n), rng.uniform(0, 100_000, n)
    x[: n // 3], y[: n // 3] = 50_500.0, 50_500.0
    counts = rng.poisson(4 + 3 * np.sin(x / 9_000))
    rows = [(int(i), float(a), float(b), int(k)) for i, (a, b, k) in enumerate(zip(x, y, counts))]
    df = spark.createDataFrame(rows, "site int, east double, north double, rich int")
    fit = M.fit_coarse_to_fine(df, M.holdout_select(df, M.ModelData("site", "rich", "east", "north"), smallest=1_000.0))
    got = {r.site: r for r in M.predict_mean_sd(fit).collect()}
    side, (x0, y0) = fit.selection.ladder.side(fit.level), fit.selection.ladder.origin
    cells = {}
    for i, a, b, k in rows:
        squared, m = cells.get(key := (math.floor((a - x0) / side), math.floor((b - y0) / side)), (0.0, 0))
        cells[key] = (squared + (k - got[i].pred) ** 2, m + 1)
    for i, a, b, _ in rows[:: n // 40]:
        cx, cy = math.floor((a - x0) / side), math.floor((b - y0) / side)
        near = [(math.exp(-((cx - u) ** 2 + (cy - v) ** 2) / 8), *cells[u, v]) for u, v in cells if (cx - u) ** 2 + (cy - v) ** 2 <= 36]
        assert got[i].pred_sd == pytest.approx(math.sqrt(sum(w * s for w, s, _ in near) / sum(w * m for w, _, m in near)), rel=1e-6)
    assert sum(r.fitted for r in M.fitted_cells(fit).collect()) > 0
    pyramid = M._Pyramid(fit.rows, fit.selection.ladder, fit.linear, {"seen": F.col("_y")})
    assert {pyramid.level(k).agg(F.sum("seen")).first()[0] for k in range(len(fit.selection.ladder.bandwidths))} == {float(counts.sum())}


def test_known_surface_is_recovered(surface, fitted):
    slopes = {(r["model"], r["var"]): r for r in M.coefficients(fitted).collect()}
    slope = slopes[("t", "t")]
    assert slope["coef"] == pytest.approx(0.3, abs=0.05) and slope["lower_95CI"] < slope["coef"] < slope["upper_95CI"]
    scores = {r["model"]: r["R2"] for r in M.scores_by_model(fitted).collect()}
    assert scores["t"] > 0.5 and scores["t"] > scores["Null"] > 0.3
    part = M.scale_component(fitted).filter("model = 't'").join(surface, "site")
    assert part.agg(F.corr("component", "truth")).first()[0] > 0.9


def test_scale_ranges_add_up(fitted):
    cut = fitted.visited[len(fitted.visited) // 2]
    whole = M.scale_component(fitted)
    wide, narrow = M.scale_component(fitted, cut, None, "wide"), M.scale_component(fitted, 0.0, cut, "narrow")
    both = whole.join(wide, ["model", "site"]).join(narrow, ["model", "site"])
    assert both.count() == 6000
    assert both.filter(F.abs(F.col("component") - F.col("wide") - F.col("narrow")) > 1e-9).isEmpty()


def test_predictions_have_the_right_level(surface, fitted):
    predicted = M.predict_mean_sd(fitted).join(surface, "site")
    for row in predicted.groupBy("model").agg(F.sum("pred").alias("p"), F.sum("rich").alias("r"), F.min("pred_sd").alias("s"), F.count("*").alias("n")).collect():
        assert row["p"] == pytest.approx(row["r"], rel=1e-3) and row["s"] > 0 and row["n"] == 3000


def test_band_matrix_and_effects(surface, fitted):
    matrix = M.band_score_matrix(fitted)
    assert matrix.count() == 2 * 5
    used = {(r["model"], r["band"]) for r in M.selected_bands(fitted).collect()}
    assert all((r["R2"] != 0) == ((r["model"], r["band"]) in used) for r in matrix.collect())
    effects = M.effect_table(fitted, M.covariate_means(surface, ["t"]).withColumn("var", F.lit("t"))).collect()
    assert {r["mod"] for r in effects} >= {"Null"}


def test_candidate_sets_need_the_base_of_a_square():
    sets = M.candidate_sets()
    assert len(sets) == 26 and len({frozenset(s) for s in sets.values()}) == 26
    assert all(base in s for s in sets.values() for base, square in (("TN", "TNsq"), ("Temp", "Tsq"), ("Tot_P", "TPsq")) if square in s)


def test_model_labels(spark):
    df = spark.createDataFrame([("Null",), ("TN;TNsq;Temp;Tsq",), ("Tot_P",), ("TN;Tot_P;TPsq",)], "m string")
    assert [r[0] for r in df.select(M.model_label(F.col("m"))).collect()] == ["Null", "TN^2 + T^2", "TP", "TN + TP^2"]


def test_family_is_checked(surface):
    with pytest.raises(ValueError):
        M.holdout_select(surface, M.ModelData("site", "rich", "east", "north"), family="gaussian")


def test_cells_meet_their_neighbours_once_for_all_models(spark, monkeypatch):
    smooth, met = M.smooth_cells, []
    monkeypatch.setattr(M, "smooth_cells", lambda cells, *rest: met.append(cells.count()) or smooth(cells, *rest))
    rows = [(i, i % 5, float(i % 8) * 100, float(i % 3) * 100, float(i % 4)) for i in range(96)]
    df = spark.createDataFrame(rows, "id int, y int, e double, n double, t double")
    found = M.select_scales(df, M.ModelData("id", "y", "e", "n"), {M.NULL_MODEL: [], "t": ["t"]}, scales=1)
    assert met == [10] and set(found.gains) == {M.NULL_MODEL, "t"}  # 5 by 2 occupied cells, whatever the number of models
