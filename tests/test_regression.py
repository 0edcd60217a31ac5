import math
import random
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import regression, stats, tables
from millrace.sources.generated import EXAMPLE_LEVEL, EXAMPLE_POLYNOMIAL, polynomial_series

TERMS = ["constant", "x", "z"]


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(3)
    rows = []
    for i in range(500):
        x, z = rng.random(), rng.random() * 2
        rows.append((i, 1.0, x, z, 3 + 2 * x - z + rng.gauss(0, 0.1), "abc"[i % 3]))
    return spark.createDataFrame(rows, "id bigint, constant double, x double, z double, y double, g string").cache()


@pytest.fixture(scope="module")
def arrays(points):
    rows = points.orderBy("id").collect()
    return np.array([[r.constant, r.x, r.z] for r in rows]), np.array([r.y for r in rows])


@pytest.fixture(scope="module")
def sums(points):
    return regression.moments(points, TERMS, "y")


def weights_of(fit):
    return np.array([fit.weights[t] for t in TERMS])


def test_sums(points, arrays, sums):
    x, y = arrays
    assert sums.xtx == pytest.approx(x.T @ x) and sums.xty == pytest.approx(x.T @ y)
    assert sums.yty == pytest.approx(y @ y) and sums.n == 500
    long = {(r.row_term, r.col_term): r.value for r in regression.gram_matrix(points, TERMS, "y").collect()}
    assert len(long) == 10 and long["x", "z"] == pytest.approx(x[:, 1] @ x[:, 2])


def test_closed_form(points, arrays, sums):
    x, y = arrays
    best = np.linalg.lstsq(x, y, rcond=None)[0]
    assert sums.solve() == pytest.approx(best)
    assert sums.rss(best) == pytest.approx(np.sum((y - x @ best) ** 2))
    _, weights = regression.fit_linear(points, ["x", "z"], "y")
    assert list(weights.values()) == pytest.approx(best)


def test_penalised_closed_form(arrays, sums):
    x, y = arrays
    assert sums.solve(l2=5.0) == pytest.approx(np.linalg.solve(x.T @ x + np.diag([0, 5.0, 5.0]), x.T @ y))


def test_gradient_matches_rows(points, arrays, sums):
    x, y = arrays
    w = np.array([1.0, -2.0, 0.5])
    want = -2 * x.T @ (y - x @ w)
    assert sums.gradient(w) == pytest.approx(want)
    rows = stats.gradient(points, "y", dict(zip(TERMS, w)), l2=3.0).collect()
    got = {r.term: r.partial for r in rows}
    want = want + 2 * 3.0 * np.array([0.0, -2.0, 0.5])
    assert [got[t] for t in TERMS] == pytest.approx(want)
    assert rows[0].magnitude == pytest.approx(np.linalg.norm(want))


def test_penalty_hand_check(spark):
    """With weight 10 and penalty 1 a feature's partial gains 20, the constant's stays."""
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (1.0, 3.0, 4.0)], "constant double, x double, y double")
    plain = {r.term: r.partial for r in stats.gradient(df, "y", {"constant": 1.0, "x": 10.0}).collect()}
    ridge = {r.term: r.partial for r in stats.gradient(df, "y", {"constant": 1.0, "x": 10.0}, l2=1.0).collect()}
    assert ridge["x"] - plain["x"] == 20.0 and ridge["constant"] == plain["constant"]
    assert plain["constant"] == 2 * ((21 - 5) + (31 - 4))


def test_fixed_descent(arrays, sums):
    x, y = arrays
    w = np.array([1.0, 0.0, 0.0])
    for _ in range(30):
        w = w + 1e-4 * 2 * x.T @ (y - x @ w)
    fit = regression.descend_fixed(sums, 1e-4, 0.0, 30, initial=[1.0, 0.0, 0.0])
    assert weights_of(fit) == pytest.approx(w) and (fit.converged, fit.steps) == (False, 30)
    fit = regression.descend_fixed(sums, 5e-4, 1e-6, 100_000)
    assert fit.converged and weights_of(fit) == pytest.approx(sums.solve(), abs=1e-6)


def test_wrong_number_of_initial_weights(sums):
    with pytest.raises(ValueError):
        regression.descend_fixed(sums, 1e-4, 0.0, 1, initial=[0.0])


def test_ridge_descent_reaches_the_closed_form(sums):
    fit = regression.descend_ridge(sums, 5e-4, l2=5.0, iterations=20_000)
    assert weights_of(fit) == pytest.approx(sums.solve(l2=5.0), abs=1e-6)


def adaptive_by_rows(x, y, step, threshold, max_steps, extrapolate):
    """The adaptive rule on rows instead of sums, with the whole history kept."""
    w, history, steps = np.zeros(x.shape[1]), [], 0
    error = lambda v: math.sqrt(np.mean((y - x @ v) ** 2))
    while True:
        new = w + step * 2 * x.T @ (y - x @ w)
        gain = error(w) - error(new)
        if gain < 0:
            step /= 10
        elif gain <= threshold or steps >= max_steps:
            return w, steps
        else:
            following = new
            if extrapolate and len(history) >= 3:
                ratio = np.abs(history[-2] - w) / np.abs(w - new) * 100
                if sum(math.floor(r + 0.5) - 100 for r in ratio) == 0:
                    following = w - (w - new) * 1e6
            history.append(following)
            w, steps = following, steps + 1


@pytest.mark.parametrize("extrapolate", [False, True])
@pytest.mark.parametrize("max_steps", [3, 10_000])
def test_adaptive_descent(arrays, sums, max_steps, extrapolate):
    x, y = arrays
    want, steps = adaptive_by_rows(x, y, 0.5, 1e-7, max_steps, extrapolate)
    fit = regression.descend_adaptive(sums, 0.5, 1e-7, max_steps, extrapolate=extrapolate)
    assert fit.steps == steps and weights_of(fit) == pytest.approx(want, rel=1e-6)


@pytest.fixture(scope="module")
def offset(spark):
    """1e6 + 3x, alternately 0.01 above and below; groups of different level."""
    df = spark.range(1000).select(F.lit(1.0).alias("constant"), (F.col("id") / 1000).alias("x"), F.col("id").alias("id"))
    noise = F.when(F.col("id") % 2 == 0, 0.01).otherwise(-0.01)
    return df.select("*", (F.lit(1e6) + F.col("x") * 3 + noise).alias("y"), (F.col("id") % 3).cast("string").alias("g"), F.lit("train").alias("part"))


def test_a_large_offset_costs_no_digits(offset):
    rows = offset.toPandas()
    truth = lambda r: np.linalg.lstsq(np.column_stack((np.ones(len(r)), r.x)), r.y - 1e6, rcond=None)[1][0]
    m = regression.moments(offset, ["constant", "x"], "y")
    assert m.rss(m.solve()) == pytest.approx(truth(rows), rel=1e-6)
    for r in regression.fit_groups(offset, ["constant", "x"], "y", ["g"]).collect():
        assert r.rss == pytest.approx(truth(rows[rows.g == r.g]), rel=1e-6)
    assert regression.fit_degrees(offset, "x", "y", 1, "part")[0].rss["train"] == pytest.approx(truth(rows), rel=1e-6)
    for r in regression.fit_polynomial_groups(offset, "x", "y", (1,), ["g"]).collect():
        assert r.rss == pytest.approx(truth(rows[rows.g == r.g]), rel=1e-6)


def test_descent_reads_the_rows_once(spark, offset):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("descent", "counted")
    fit = regression.descend_adaptive(regression.moments(offset, ["constant", "x"], "y"), 1e-3, 1e-9, initial=[1e6, 0.0])
    jobs = tracker.getJobIdsForGroup("descent")
    spark.sparkContext.setJobGroup("after", "")
    assert fit.converged and fit.steps > 20 and len(jobs) <= 2
    assert fit.weights["x"] == pytest.approx(3.0, abs=0.05)


def test_rows_with_missing_values_are_left_out(spark):
    good = [(1.0, float(i), 100.0 + 2 * i, "a") for i in range(10)]
    df = spark.createDataFrame([*good, *[(1.0, 50.0 + i, None, "a") for i in range(5)], (1.0, None, 3.0, "a")], "constant double, x double, y double, g string")
    m = regression.moments(df, ["constant", "x"], "y")
    assert (m.n, m.left_out) == (10, 6) and m.solve() == pytest.approx([100, 2])
    row = regression.fit_groups(df, ["constant", "x"], "y", ["g"]).first()
    assert (row.rows, row.constant, row.x) == (10, pytest.approx(100), pytest.approx(2))
    fit = regression.fit_degrees(df, "x", "y", 1, "g", fitted_on="a")[0]
    assert fit.power_coefficients() == pytest.approx([100, 2])
    row = regression.fit_polynomial_groups(df, "x", "y", (1,), ["g"]).first()
    assert row.rows == 10 and row.rss == pytest.approx(0, abs=1e-9)
    _, weights = regression.fit_linear(df, ["x"], "y")
    assert weights == pytest.approx({"constant": 100, "x": 2})
    assert {r.row_term + r.col_term: r.value for r in regression.gram_matrix(df, ["x"], "y").collect()}["xx"] == sum(i * i for i in range(10))


def test_predictions_beyond_the_range_follow_the_polynomial(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1, "train") for i in range(10)], "x double, y double, part string")
    fit = regression.fit_degrees(df, "x", "y", 1, "part")[0]
    points = spark.createDataFrame([(20.0,), (-5.0,), (None,), (float("nan"),)], "x double").coalesce(1)
    a, b, c, d = (r[0] for r in points.select(fit.column("x")).collect())
    assert a == pytest.approx(41) and b == pytest.approx(-9) and c is None and math.isnan(d)
    groups = regression.fit_polynomial_groups(df, "x", "y", (1, 3), ["part"])
    for r in groups.select(regression.polynomial_at(F.lit(20.0), 3).alias("v")).collect():
        assert r.v == pytest.approx(41)


def test_group_polynomials_of_high_degree(spark):
    rng = random.Random(3)
    rows = [(g, 1000 + 3 * x, math.sin(7 * x + g) + rng.gauss(0, 0.1)) for g in range(3) for x in [rng.random() * (g + 1) for _ in range(200)]]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    for r in regression.fit_polynomial_groups(df, "x", "y", (5, 15), ["g"]).collect():
        x, y = (np.array([row[k] for row in rows if row[0] == r.g]) for k in (1, 2))
        best = np.polynomial.Chebyshev.fit(x, y, r.degree)
        assert r.rss == pytest.approx(np.sum((y - best(x)) ** 2), rel=1e-7)


def test_errors_that_are_no_numbers_end(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (1.0, float("nan"), 2.0)], "constant double, x double, y double")
    m = regression.moments(df, ["constant", "x"], "y")
    with pytest.raises(ArithmeticError):
        regression.descend_adaptive(m, 0.1, 1e-6)
    with pytest.raises(ArithmeticError):
        regression.search_step(m, 1.0)


def test_contradictory_penalties_raise(points):
    with pytest.raises(ValueError):
        regression.fit_linear(points, ["x"], "y", reg=0.3, elastic_net=1.0, solver="normal")


def test_too_many_parts_raise(points):
    with pytest.raises(ValueError):
        regression.moments_of_parts(points, TERMS, "y", "id", most=10)


def test_sgd_is_the_library_algorithm(spark, points, sums):
    from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD

    labelled = points.select("y", "x", "z").coalesce(1).rdd.map(lambda r: LabeledPoint(r.y, [r.x, r.z])).cache()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for tol in (0.0, 0.001):
            model = LinearRegressionWithSGD.train(
                labelled, iterations=40, step=0.4, intercept=True, convergenceTol=tol, miniBatchFraction=1.0
            )
            fit = regression.fit_sgd(sums, 40, 0.4, convergence_tol=tol)
            assert weights_of(fit) == pytest.approx([model.intercept, *model.weights], rel=1e-9)


def test_step_search_leaves_diverged_fits(sums):
    fit, step = regression.search_step(sums, 1e6, iterations=400)
    assert step in (1.0, 0.1) and sums.rmse(weights_of(fit)) < 1.0


def test_model_comparison(points):
    parts = regression.moments_of_parts(points, TERMS, "y", "g")
    spark = points.sparkSession
    models = {"small": TERMS[:2], "all": TERMS}
    rows = regression.compare_models(spark, parts, models, [0.5], [10, 500], fitted_on="a", convergence_tol=0.0).collect()
    assert len(rows) == 2 * 2 * 3
    got = {(r.model, r.iterations, r.part): r.mse for r in rows}
    assert got["all", 500, "a"] < got["all", 10, "a"] < got["small", 10, "a"] * 10
    assert got["all", 500, "b"] < got["small", 500, "b"]


def test_group_fits(points, arrays):
    fits = {r.g: r for r in regression.fit_groups(points, TERMS, "y", ["g"]).collect()}
    x, y = arrays
    for i, g in enumerate("abc"):
        best, rss, *_ = np.linalg.lstsq(x[i::3], y[i::3], rcond=None)
        assert [fits[g][t] for t in TERMS] == pytest.approx(best)
        assert fits[g].rss == pytest.approx(rss[0]) and fits[g].rows == len(y[i::3])


def test_a_singular_group_gets_the_shortest_solution(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 6.0)], "n string, constant double, x double, y double")
    row = regression.fit_groups(df, ["constant", "x"], "y", ["n"]).first()
    assert row.constant + 2 * row.x == pytest.approx(6.0)


def test_degrees(spark):
    rng = random.Random(8)
    rows = [(i, 100 + 5 * x, math.sin(4 * x) + rng.gauss(0, 0.1), ("train", "validation", "test")[i % 3]) for i in range(900) for x in [rng.random()]]
    df = spark.createDataFrame(rows, "id int, x double, y double, part string")
    fits = regression.fit_degrees(df, "x", "y", 15, "part")
    train = [f.rss["train"] for f in fits]
    assert all(b <= a + 1e-9 for a, b in zip(train, train[1:]))
    xs = {p: np.array([r[1] for r in rows if r[3] == p]) for p in ("train", "test")}
    ys = {p: np.array([r[2] for r in rows if r[3] == p]) for p in ("train", "test")}
    for fit in (fits[0], fits[4], fits[14]):
        best = np.polynomial.Chebyshev.fit(xs["train"], ys["train"], fit.degree, domain=[fit.low, fit.high])
        assert fit.rss["train"] == pytest.approx(np.sum((ys["train"] - best(xs["train"])) ** 2), rel=1e-8)
        assert fit.rss["test"] == pytest.approx(np.sum((ys["test"] - best(xs["test"])) ** 2), rel=1e-6)
        scanned = stats.fit_errors(df.where("part = 'test'"), "y", fit.column("x")).first().rss
        assert scanned == pytest.approx(fit.rss["test"], rel=1e-6)
    best = regression.best_degree(fits)
    assert best.rss["validation"] == min(f.rss["validation"] for f in fits)
    line = fits[0].power_coefficients()
    assert line == pytest.approx(np.polynomial.Polynomial.fit(xs["train"], ys["train"], 1).convert().coef, rel=1e-8)


def test_polynomial_series_is_recovered(spark):
    df = polynomial_series(spark, 200, noise=0.0)
    assert df.columns == ["const", "x", "x2", "x3", "x4", "x5", "y"] and df.count() == 200
    fit = regression.fit_degrees(df.withColumn("part", F.lit("train")), "x", "y", 5, "part")[-1]
    want = [EXAMPLE_POLYNOMIAL[0] + EXAMPLE_LEVEL, *EXAMPLE_POLYNOMIAL[1:]]
    assert fit.power_coefficients() == pytest.approx(want, rel=1e-6)


def test_noise_only_raises_values(spark):
    exact = polynomial_series(spark, 200, noise=0.0).select("x", F.col("y").alias("e"))
    both = exact.join(polynomial_series(spark, 200, noise=0.1, seed=4), "x")
    share = both.select(((F.col("y") - F.col("e")) / (F.col("e") - EXAMPLE_LEVEL)).alias("s"))
    low, high = share.agg(F.min("s"), F.max("s")).first()
    assert -1e-9 <= low < 0.01 and 0.09 < high <= 0.1 + 1e-9


def test_predictions(points):
    df = regression.with_prediction(points, {"constant": 1.0, "x": 2.0})
    assert df.where("abs(predicted - (1 + 2 * x)) > 1e-12").count() == 0
    point = regression.predict_point(points.sparkSession, {"constant": 1.0, "x": 2.0, "z": -1.0}, {"x": 3.0, "z": 4.0})
    assert point.first().predicted == 3.0


def test_no_rows(points):
    with pytest.raises(ValueError):
        regression.moments(points.where("false"), TERMS, "y")


def test_splits_do_not_depend_on_partitions(points):
    weights = {"train": 0.45, "validation": 0.45, "test": 0.1}
    one = {r.id: r.split for r in tables.with_split(points.coalesce(1), "id", weights, 7).collect()}
    many = {r.id: r.split for r in tables.with_split(points.repartition(9), "id", weights, 7).collect()}
    assert one == many and set(one.values()) == set(weights)
    parts = tables.split_frames(points, "id", weights, 7)
    ids = [r.id for p in parts.values() for r in p.collect()]
    assert sorted(ids) == list(range(500))
    assert tables.with_split(points, "id", {"all": 1.0}).where("split <> 'all'").count() == 0


def test_penalised_path_equals_the_iterating_solver(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(400):
        a, b, c = rng.gauss(0, 1), rng.gauss(5, 3), rng.gauss(0, 0.01)
        rows.append((a, b, c, a + 0.3 * rng.gauss(0, 1), 7.0, 3 * a - 2 * b + 50 * c + rng.gauss(0, 2)))
    names = ["a", "b", "c", "d", "same", "y"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    sums = regression.moments(df, names[:-1], "y")
    for share in (0.0, 0.5, 1.0):
        penalties = [0.0, 0.05, 0.5, 3.0, 40.0]
        fits = regression.elastic_net_path(sums, penalties, share)
        assert all(f.converged for f in fits.values())
        for penalty in penalties:
            _, want = regression.fit_linear(df, names[:-1], "y", reg=penalty, elastic_net=share, max_iter=5000, solver="l-bfgs" if penalty else None)
            got = dict(fits[penalty].weights)
            if penalty:
                assert got.pop("same") == 0.0
                assert got == pytest.approx({k: v for k, v in want.items() if k != "same"}, rel=1e-4, abs=1e-4)
            # The exact conditions of the least value, which the other solver meets only nearly.
            spread = {n: math.sqrt(sums.centred[i, i] / (sums.n - 1)) for i, n in enumerate(names)}
            w = np.array([fits[penalty].weights[n] for n in names[:-1]])
            left = (sums.centred[:-1, -1] - sums.centred[:-1, :-1] @ w) / sums.n
            for i, n in enumerate(names[:-1]):
                if spread[n] < 1e-12:
                    continue
                slope, size = left[i] / spread[n] / spread["y"], penalty / spread["y"]
                held = w[i] * spread[n] / spread["y"]
                rest = slope - (1 - share) * size * held
                assert abs(rest) <= share * size + 1e-9 if held == 0 else rest == pytest.approx(math.copysign(share * size, held), abs=1e-9)


def test_penalised_path_reads_the_rows_once(spark):
    df = spark.range(100).selectExpr("cast(id as double) a", "cast(id % 7 as double) b", "cast(id * 2 + id % 3 as double) y")
    tracker, group = spark.sparkContext.statusTracker(), "one-pass"
    spark.sparkContext.setJobGroup(group, "")
    fits = regression.elastic_net_path(regression.moments(df, ["a", "b"], "y"), [k / 10 for k in range(30)])
    jobs = tracker.getJobIdsForGroup(group)
    spark.sparkContext._jsc.sc().clearJobGroup()
    assert len(fits) == 30 and len(jobs) <= 2  # AQE runs the shuffle of the one aggregation as a job of its own
