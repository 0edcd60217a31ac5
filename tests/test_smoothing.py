import math
import random
import subprocess
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.kernels import gaussian, inverse_distance
from millrace.operators import smoothing
from millrace.operators.series import with_position
from millrace.operators.smoothing import (
    Smoother,
    _batch_passes,
    _chains,
    rolling_geometric_mean,
    smooth,
    smooth_many,
    with_changes,
    with_derivatives,
)
from tests.conftest import column, frame_of


def by_hand(values, radius, power=1, kernel=inverse_distance, causal=False, kernel_each_pass=True):
    for done in range(power):
        k = kernel if done == 0 or kernel_each_pass else inverse_distance
        out = []
        for i in range(len(values)):
            near = range(max(0, i - radius), i + 1 if causal else min(len(values), i + radius + 1))
            weights = [k(i - j) for j in near]
            out.append(sum(w * values[j] for w, j in zip(weights, near)) / sum(weights))
        values = out
    return values


# Inputs, radius, causal, expected means.
KNOWN = [
    ([1, 1, 1], 1, False, [1.0, 1.0, 1.0]),
    ([1, 5, 9], 1, False, [2.3333333333333335, 5.0, 7.666666666666667]),
    ([1, 5, 9], 0, False, [1.0, 5.0, 9.0]),
    ([1], 1, True, [1.0]),
    ([1, 2, 3], 1, True, [1.0, 1.6666666666666667, 2.6666666666666665]),
]


@pytest.mark.parametrize("values, radius, causal, expected", KNOWN)
@pytest.mark.parametrize("arrays", [False, True])
def test_known_means(spark, values, radius, causal, expected, arrays):
    out = smooth_many(frame_of(spark, values), "v", {"s": Smoother(radius, causal=causal)}, ["k"], arrays=arrays)
    assert column(out, "s") == pytest.approx(expected, abs=1e-15)


def test_gaussian(spark):
    values = [10, 20, 60, 80, 100, 80, 60, 40]
    out = smooth(frame_of(spark, values), "v", 3, kernel=gaussian(3.0), causal=True, by=["k"])
    # Worked out once from the definition.
    expected = [
        10.0,
        15.82570206462315,
        38.86949740233817,
        63.43204483065232,
        85.78390235305626,
        86.56918218126098,
        72.7444974365063,
        53.72556424346458,
    ]
    assert column(out, "smoothed") == pytest.approx(expected, rel=1e-13)


def test_gaussian_weights():
    assert gaussian(10.0)(6) == math.exp(-3.6)
    assert inverse_distance(-3) == 0.25


def test_powers_are_repeated_passes(spark):
    once = frame_of(spark, [1, 5, 9, 2, 7])
    for _ in range(3):
        once = smooth(once, "v", 1, by=["k"]).drop("v").withColumnRenamed("smoothed", "v")
    cubed = smooth(frame_of(spark, [1, 5, 9, 2, 7]), "v", 1, power=3, by=["k"])
    assert column(cubed, "smoothed") == pytest.approx(column(once, "v"), rel=1e-14)


def test_zero_power_is_identity(spark):
    assert column(smooth(frame_of(spark, [3, 1, 2]), "v", 5, power=0, by=["k"]), "smoothed") == [3, 1, 2]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    lengths=st.lists(st.integers(1, 90), min_size=1, max_size=4),
    radius=st.integers(0, 9),
    power=st.integers(1, 3),
    causal=st.booleans(),
    each=st.booleans(),
    arrays=st.booleans(),
    bits=st.sampled_from([None, 5]),
)
def test_any_shape(spark, lengths, radius, power, causal, each, arrays, bits):
    rows = [(k, i, float((i * 7919 + k * 31) % 101)) for k, n in enumerate(lengths) for i in range(n)]
    df = spark.createDataFrame(rows, "k bigint, idx bigint, v double")
    smoother = Smoother(radius, power, gaussian(4.0), causal, each)
    out = smooth_many(df, "v", {"s": smoother}, ["k"], bits=bits, arrays=arrays)
    got = {}
    for r in out.orderBy("k", "idx").collect():
        got.setdefault(r.k, []).append(r.s)
    for k, n in enumerate(lengths):
        values = [v for key, _, v in rows if key == k]
        assert got[k] == pytest.approx(by_hand(values, radius, power, gaussian(4.0), causal, each), rel=1e-11)


def test_arrays_across_batches(spark):
    """Series longer than an Arrow batch are finished batch by batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        values = [float((i * 37) % 113) for i in range(700)]
        df = frame_of(spark, values).unionByName(frame_of(spark, values[:65], "b"))
        for causal in (False, True):
            out = smooth_many(df, "v", {"s": Smoother(6, 2, causal=causal)}, ["k"], arrays=True)
            assert column(out.where("k = 'a'"), "s") == pytest.approx(by_hand(values, 6, 2, causal=causal), rel=1e-12)
            assert column(out.where("k = 'b'"), "s") == pytest.approx(by_hand(values[:65], 6, 2, causal=causal), rel=1e-12)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("arrays", [False, True])
def test_several_smoothers_share_passes(spark, arrays):
    values = [float((i * 37) % 113) for i in range(60)]
    wanted = {"p3": Smoother(2, 3), "p1": Smoother(2, 1), "again": Smoother(2, 1), "p0": Smoother(2, 0), "wide": Smoother(5, 2, causal=True)}
    out = smooth_many(frame_of(spark, values), "v", wanted, ["k"], arrays=arrays)
    assert out.columns == ["k", "idx", "v", *wanted] or set(out.columns) == {"k", "idx", "v", *wanted}
    for name, s in wanted.items():
        assert column(out, name) == pytest.approx(by_hand(values, s.radius, s.power, causal=s.causal), rel=1e-12)


def test_a_constant_series_stays(spark):
    out = smooth(frame_of(spark, [4.0] * 50), "v", 9, power=3, by=["k"])
    assert column(out, "smoothed") == pytest.approx([4.0] * 50)


def test_invalid_shape():
    with pytest.raises(ValueError):
        Smoother(-1)


def test_derivatives(spark):
    out = with_derivatives(frame_of(spark, [1, 4, 9, 16, 25, 36]), "v", ["k"])
    assert column(out, "slope") == [0.0, 0.0, 4.0, 6.0, 8.0, 10.0]
    assert column(out, "curvature") == [0.0, 0.0, 2.0, 3.0, 2.0, 2.0]


def test_changes(spark):
    assert column(with_changes(frame_of(spark, [5, 7, 4]), "v", ["k"]), "change") == [0.0, 2.0, -3.0]


def test_geometric_means(spark):
    out = rolling_geometric_mean(frame_of(spark, [1, 8, 27, 64]), "v", 3, ["k"])
    assert column(out, "geometric_mean") == pytest.approx([6.0, 24.0])
    assert rolling_geometric_mean(frame_of(spark, [1, 8]), "v", 3, ["k"]).count() == 0


def test_task_functions_do_not_need_the_package():
    from pyspark import cloudpickle

    passes = _batch_passes(_chains({"s": Smoother(3, 2)}), ["s"], "v", 6, 6)
    load = "import pickle, sys; pickle.loads(sys.stdin.buffer.read()); assert not any(m.startswith('millrace') for m in sys.modules)"
    subprocess.run([sys.executable, "-c", load], input=cloudpickle.dumps(passes), cwd="/", env={}, check=True)


@pytest.mark.parametrize("causal", [False, True])
def test_kernels_see_the_side_of_a_neighbour(spark, causal):
    kernel = lambda o: 3.0 + o / 4
    values = [1.0, 4.0, 2.0, 8.0, 5.0, 7.0]
    frame = frame_of(spark, values)
    for arrays in (False, True):
        out = smoothing.smooth_many(frame, "v", {"s": smoothing.Smoother(2, 1, kernel, causal)}, ["k"], arrays=arrays)
        want = []
        for i in range(len(values)):
            near = [j for j in range(i - 2, i + 1 if causal else i + 3) if 0 <= j < len(values)]
            want.append(sum(kernel(j - i) * values[j] for j in near) / sum(kernel(j - i) for j in near))
        assert column(out, "s") == pytest.approx(want)


@pytest.mark.parametrize("arrays", [False, True])
@pytest.mark.parametrize("hole", [None, float("nan")])
def test_missing_values_have_one_rule(spark, arrays, hole):
    frame = spark.createDataFrame([("a", i, hole if i == 3 else float(i)) for i in range(8)], "k string, idx bigint, v double")
    got = column(smoothing.smooth_many(frame, "v", {"s": smoothing.Smoother(1)}, ["k"], arrays=arrays), "s")
    assert [x is None for x in got] == [i in (2, 3, 4) for i in range(8)]


def test_geometric_means_of_odd_windows(spark):
    values = [2.0, 8.0, 0.0, 4.0, -1.0, 1e300, 1e300, 1e300]
    got = column(smoothing.rolling_geometric_mean(frame_of(spark, values), "v", 2, ["k"]), "geometric_mean")
    assert got[:2] == pytest.approx([4.0, 0.0]) and got[2] == 0.0 and got[3] is None and got[4] is None
    assert got[5:] == pytest.approx([1e300, 1e300])


@pytest.mark.parametrize("mode", ["short", "cut"])
@pytest.mark.parametrize("power,causal,each", [(1, False, True), (3, False, True), (2, True, True), (2, False, False)])
def test_kernel_of_both_positions(spark, mode, power, causal, each, request):
    if mode == "cut":
        request.getfixturevalue("cut")
    rng = random.Random(power)
    series = {"a": [rng.uniform(0, 9) for _ in range(90)], "b": [rng.uniform(0, 9) for _ in range(7)], "c": [1.0]}
    kernel = lambda i, j: (1 + j % 4) / (abs(i - j) + 1 + i % 3)
    df = spark.createDataFrame([(k, t, v) for k, vs in series.items() for t, v in enumerate(vs)], "k string, t int, v double").repartition(4)
    out = smoothing.smooth_by_position(with_position(df, ["t"], ["k"]), "v", 5, kernel, power, causal, ["k"], kernel_each_pass=each)
    for k, values in series.items():
        for done in range(power):
            weigh = kernel if each or done == 0 else lambda i, j: 1 / (abs(i - j) + 1)
            near = [range(max(0, i - 5), min(len(values), i + 1 if causal else i + 6)) for i in range(len(values))]
            values = [sum(weigh(i, j) * values[j] for j in js) / sum(weigh(i, j) for j in js) for i, js in enumerate(near)]
        got = [r.smoothed for r in out.where(F.col("k") == k).orderBy("idx").collect()]
        assert got == pytest.approx(values, rel=1e-9)


def test_missing_values_under_a_kernel_of_positions(spark):
    values = [1.0, None, 3.0, 4.0, float("nan"), 6.0, 7.0, 8.0]
    df = spark.createDataFrame(list(enumerate(values)), "t int, v double")
    out = smoothing.smooth_by_position(with_position(df, ["t"]), "v", 1, lambda i, j: 1.0 + 0 * j).orderBy("idx").collect()
    assert [r.smoothed is None or math.isnan(r.smoothed) for r in out] == [True, True, True, True, True, True, False, False]
