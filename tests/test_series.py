import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import series
from millrace.operators.series import every_nth, group_sizes, over_series, pair_by_position, with_neighbour, with_position
from tests.conftest import column


@pytest.fixture(scope="module")
def ticks(spark):
    """Uneven groups: one holds more than half of the rows, one key is NULL."""
    rng = random.Random(1)
    keys = ["hot"] * 300 + ["a"] * 60 + ["b"] * 41 + ["c"] * 3 + [None] * 70
    rows = [(k, i, rng.random()) for i, k in enumerate(rng.sample(keys, len(keys)))]
    return spark.createDataFrame(rows, "k string, t bigint, v double").repartition(7).cache()


def expected_positions(ticks, by):
    rows = sorted(ticks.collect(), key=lambda r: r.t)
    seen, out = {}, {}
    for r in rows:
        key = r.k if by else ""
        out[r.t] = seen.get(key, 0)
        seen[key] = out[r.t] + 1
    return out


@pytest.mark.parametrize("by", [["k"], []])
@pytest.mark.parametrize("rows_per_task", [10, 1000])
def test_positions(ticks, by, rows_per_task):
    placed = with_position(ticks, ["t"], by, rows_per_task=rows_per_task)
    assert placed.columns == ["k", "t", "v", "idx"]
    assert {r.t: r.idx for r in placed.collect()} == expected_positions(ticks, by)
    assert placed.schema["idx"].dataType.simpleString() == "bigint"


def test_positions_without_a_broadcast(ticks, monkeypatch):
    monkeypatch.setattr(series, "BROADCAST_ROWS", 0)
    placed = with_position(ticks, ["t"], ["k"], rows_per_task=10)
    assert {r.t: r.idx for r in placed.collect()} == expected_positions(ticks, ["k"])


def test_only_short_series_are_known_as_short(ticks):
    short = with_position(ticks, ["t"], ["k"])
    assert short.schema["idx"].metadata == {series.LONGEST: 300}
    assert series.is_short(short.where("v > 0.5").select("idx"), "idx")
    assert not series.is_short(with_position(ticks, ["t"], ["k"], rows_per_task=10), "idx")


def test_group_sizes(spark, ticks):
    assert group_sizes(ticks, ["k"]) == (474, 5, 300)
    assert group_sizes(ticks, []) == (474, 1, 474)
    assert group_sizes(ticks.limit(0), ["k"]) == (0, 0, 0)


def test_positions_of_an_empty_frame(ticks):
    assert with_position(ticks.where("false"), ["t"], ["k"]).count() == 0


@pytest.mark.parametrize("by", [["k"], []])
def test_stretches_equal_plain_windows(ticks, by):
    placed = with_position(ticks, ["t"], by)

    def build(frame, window):
        near = window.rowsBetween(-7, 3)
        return frame.withColumns({"n": F.count("v").over(near), "low": F.min("v").over(near)})

    plain = over_series(placed, build, by, before=7, after=3)
    cut = over_series(placed, build, by, before=7, after=3, bits=3)
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))


@pytest.mark.parametrize("ahead", [True, False])
@pytest.mark.parametrize("bits", [2, 16, None])
def test_neighbours_of_thinned_rows(ticks, ahead, bits):
    placed = with_position(ticks, ["t"], ["k"])
    thin = placed.where((F.col("idx") % 37 == 0) | (F.col("idx") % 41 < 3))
    got = with_neighbour(thin, {"t": "other_t", "idx": "other"}, ["k"], ahead=ahead, bits=bits)
    rows = sorted(thin.collect(), key=lambda r: (str(r.k), r.idx), reverse=not ahead)
    want = {}
    for here, there in zip(rows, [*rows[1:], None]):
        same = there is not None and there.k == here.k
        want[here.t] = (there.t, there.idx) if same else (None, None)
    assert {r.t: (r.other_t, r.other) for r in got.collect()} == want


def test_every_nth(ticks):
    kept = every_nth(ticks, 100, ["t"])
    assert column(kept, "t") == [0, 100, 200, 300, 400]


def test_pairs(ticks):
    placed = with_position(ticks, ["t"], ["k"])
    left, right = placed.select("k", "idx", "v"), placed.select("k", "idx", F.col("v").alias("w"))
    both = pair_by_position(left, right, ["k"])
    assert both.count() == 474 and both.where("v = w").count() == 474


@pytest.mark.parametrize("bits", [None, 1, 2])
@pytest.mark.parametrize("ahead", [True, False])
def test_a_missing_value_of_the_neighbour_is_its_value(spark, bits, ahead):
    values = [10.0, None, 20.0, None, 40.0, 50.0, None, 60.0]
    frame = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, idx bigint, v double")
    out = series.with_neighbour(frame, {"v": "other"}, ["k"], ahead=ahead, bits=bits)
    want = [*values[1:], None] if ahead else [None, *values[:-1]]
    assert column(out, "other") == want


def test_stretches_of_stretches(spark, monkeypatch):
    monkeypatch.setattr(series, "ROWS_PER_TASK", 4)
    monkeypatch.setattr(series, "STRETCH_BITS", 1)
    frame = spark.createDataFrame([("a", t) for t in range(100)], "k string, t int")
    kept = series.with_position(frame, ["t"], ["k"]).where("idx % 17 = 3 or idx % 23 = 5")
    rows = sorted(r.idx for r in kept.collect())
    got = {r.idx: r.next for r in series.with_neighbour(kept, {"idx": "next"}, ["k"]).collect()}
    assert got == dict(zip(rows, [*rows[1:], None]))
