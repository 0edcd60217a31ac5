import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import signals
from millrace.operators.series import with_position
from millrace.operators.smoothing import Smoother, with_derivatives
from tests.conftest import column, frame_of
from tests.test_smoothing import by_hand


def slopes(values):
    return [0.0 if i <= 1 else (values[i] - values[i - 2]) / 2 for i in range(len(values))]


def trade(prices, d, c, d_level, c_level, fee):
    """A step-by-step trader: (trades, log of the final amount for one unit)."""
    held, log, trades = False, 0.0, 0
    for i in range(len(prices)):
        side = None
        if i == len(prices) - 1:
            side = "sell"
        elif d[i + 1] > d_level > d[i]:
            side = "sell"
        elif d[i + 1] < d_level < d[i]:
            side = "buy"
        elif c[i + 1] < c_level < c[i]:
            side = "sell"
        elif c[i + 1] > c_level > c[i]:
            side = "buy"
        if side == "buy" and not held:
            held, log, trades = True, log + math.log((1 - fee) / prices[i]), trades + 1
        elif side == "sell" and held:
            held, log, trades = False, log + math.log((1 - fee) * prices[i]), trades + 1
    return trades, log


@pytest.fixture(scope="module")
def prices():
    rng = random.Random(5)
    level, out = 100.0, []
    for _ in range(400):
        level *= math.exp(rng.gauss(0, 0.02))
        out.append(round(level, 2))
    return out


@pytest.mark.parametrize("mode", ["short", "cut"])
def test_returns_follow_a_step_by_step_trader(spark, prices, mode, request):
    if mode == "cut":
        request.getfixturevalue("cut")
    df = frame_of(spark, prices).drop("idx").withColumn("t", F.monotonically_increasing_id())
    df = spark.createDataFrame([("a", i, p) for i, p in enumerate(prices)], "k string, t bigint, v double")
    placed = with_position(df, ["t"], ["k"])
    marked = signals.with_trades(signals.with_price_signals(placed, "v", Smoother(3, 2), 0.1, -0.05, ["k"]), ["k"])
    row = signals.strategy_returns(marked, "v", by=["k"]).first()
    d = slopes(by_hand(prices, 3, 2))
    trades, log = trade(prices, d, slopes(d), 0.1, -0.05, signals.FEE)
    assert row.trades == trades > 10
    assert row.log_return == pytest.approx(log, rel=1e-9)


@pytest.mark.parametrize("mode", ["short", "cut"])
def test_sweep(spark, prices, mode, request):
    if mode == "cut":
        request.getfixturevalue("cut")
    df = spark.createDataFrame(list(enumerate(prices)), "t bigint, v double")
    swept = signals.strategy_sweep(with_position(df, ["t"]), "v", (1, 4), (1, 2), (0.0, 0.2), (0.0, 0.1, 0.3))
    rows = swept.collect()
    assert len(rows) == 24
    for r in rows:
        d = slopes(by_hand(prices, r.radius, r.power))
        trades, log = trade(prices, d, slopes(d), r.slope_level, r.curvature_level, signals.FEE)
        assert (r.trades, r.log_return) == (trades, pytest.approx(log, rel=1e-9))
    best = signals.best_of(swept, "log_return", 3).collect()
    assert [r.log_return for r in best] == sorted((r.log_return for r in rows), reverse=True)[:3]


def test_a_series_without_trades_keeps_its_amount(spark):
    df = spark.createDataFrame([("a", 0, 5.0), ("a", 1, 5.0)], "k string, t bigint, v double")
    marked = signals.with_trades(
        signals.with_price_signals(with_position(df, ["t"], ["k"]), "v", Smoother(1), by=["k"]), ["k"]
    )
    assert signals.strategy_returns(marked, "v", by=["k"]).collect() == [("a", 0, 0.0)]


@pytest.mark.parametrize("kind", ["double", "float", "int"])
def test_returns_at_prices_without_a_finite_logarithm(spark, kind):
    """Buying at 0 returns infinity, selling at 0 loses all, both or a negative price leave no number."""
    trades = {
        "bought at 0": [("buy", 0), ("sell", 5)],
        "sold at 0": [("buy", 5), ("sell", 0)],
        "both": [("buy", 0), ("sell", 0)],
        "bought below 0": [("buy", -5), ("sell", 5)],
        "sold below 0": [("buy", 5), ("sell", -5)],
        "no price": [("buy", None), ("sell", 5)],
        "usual": [("buy", 5), ("sell", 10)],
    }
    rows = [(k, signal, True, price) for k, sides in trades.items() for signal, price in sides]
    rows += [("usual", signal, False, 0) for signal in ("buy", "sell")]
    df = spark.createDataFrame(rows, "k string, signal string, traded boolean, v int").withColumn("v", F.col("v").cast(kind))
    got = {r.k: r for r in signals.strategy_returns(df, "v", by=["k"]).collect()}
    assert {k: r.trades for k, r in got.items()} == dict.fromkeys(trades, 2)
    returns = {k: r.log_return for k, r in got.items()}
    assert (returns["bought at 0"], returns["sold at 0"]) == (math.inf, -math.inf)
    assert all(math.isnan(returns[k]) for k in ("both", "bought below 0", "sold below 0"))
    kept = math.log(1 - signals.FEE)
    assert returns["no price"] == pytest.approx(kept + math.log(5))
    assert returns["usual"] == pytest.approx(2 * kept + math.log(2))


def test_turning_points_need_a_strict_change_of_sign(spark):
    rows = [("a", i, 10.0 * i, d) for i, d in enumerate([1.0, -1.0, 0.0, 1.0, -2.0, -3.0, 4.0])]
    df = spark.createDataFrame(rows, "k string, idx bigint, v double, d double")
    assert column(signals.turning_points(df, "d", ["k"]), "idx") == [0, 3, 5]
    moves = signals.turning_moves(df, "v", "d", 25.0, ["k"]).collect()
    assert [tuple(m) for m in moves] == [("a", 30.0, 0.0, 30.0, 0, 3, 3)]


def test_no_turning_point_in_an_empty_series(spark):
    df = spark.createDataFrame([], "k string, idx bigint, v double, d double")
    assert signals.turning_moves(df, "v", "d", 0.0, ["k"]).count() == 0


def test_regimes(spark):
    falling = signals.regimes(frame_of(spark, range(100, 0, -1)), "v", radii=(2, 4, 8), power=2, by=["k"])
    assert column(falling.where("idx > 20").select("idx", "regime").distinct(), "regime") == ["bear"] * 79
    rising = signals.regimes(frame_of(spark, range(100)), "v", radii=(2, 4, 8), power=2, by=["k"])
    assert rising.where("idx > 20 and regime <> 'bull'").count() == 0
    flat = signals.regimes(frame_of(spark, [1.0] * 30), "v", radii=(0, 0, 0), power=1, by=["k"])
    assert flat.where("regime <> 'none'").count() == 0


def test_breaks_between_runs(spark):
    kept = frame_of(spark, range(12)).where("idx in (1, 2, 5, 6, 7, 11)")
    got = signals.run_breaks(kept, "v", ["k"]).orderBy("end_idx").collect()
    assert [tuple(r)[1:] for r in got] == [(2, 2.0, 5, 5.0), (7, 7.0, 11, 11.0)]


def test_signals_without_lookahead_lag_by_one(spark, prices):
    sloped = with_derivatives(frame_of(spark, prices), "v", ["k"])
    ahead = column(signals.with_crossing_signals(sloped, by=["k"]), "signal")
    behind = column(signals.with_crossing_signals(sloped, by=["k"], lookahead=False), "signal")
    assert behind[1:-1] == ahead[:-2]
    assert behind[0] is None and behind[-1] == ahead[-1] == "sell"


@pytest.mark.parametrize("mode", ["short", "cut"])
def test_sweep_of_several_series_with_gaps(spark, prices, mode, request):
    """Equal values, short series and levels that nothing or everything crosses, each combination against a trader."""
    if mode == "cut":
        request.getfixturevalue("cut")
    series = {"a": prices[:150], "b": [100.0] * 40 + prices[150:210] + [100.0] * 40, "c": [5.0]}
    rows = [(k, i, v) for k, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, t bigint, v double")
    # No level at 0, around which rounding decides where a series is flat.
    slope_levels, curvature_levels = (1e9, 0.01, -0.5, 0.25, 0.25), (0.02, -1e9, 0.1)
    swept = signals.strategy_sweep(with_position(df, ["t"], ["k"]), "v", (2,), (1,), slope_levels, curvature_levels, by=["k"]).collect()
    assert len(swept) == 3 * 4 * 3
    for r in swept:
        values = series[r.k]
        d = slopes(by_hand(values, 2, 1))
        trades, log = trade(values, d, slopes(d), r.slope_level, r.curvature_level, signals.FEE)
        assert (r.trades, r.log_return) == (trades, pytest.approx(log, rel=1e-9, abs=1e-12))


def test_a_row_of_the_sweep_is_one_row_per_shape(spark, prices):
    """The plan makes rows for shapes only; cells of combinations appear once per series."""
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prices)], "t bigint, v double")
    grid = [k / 100 for k in range(51)]
    swept = signals.strategy_sweep(with_position(df, ["t"]), "v", (2,), (1,), [-g for g in grid], grid)
    assert swept.count() == 51 * 51
    plan = swept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 2 and "explode" not in plan
