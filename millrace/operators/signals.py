"""Turning points, regimes, crossing signals and the returns of trading on them."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from millrace.functions.kernels import Kernel, inverse_distance
from millrace.operators.series import LONGEST, home_stretch, over_series, stretch_bits, with_neighbour
from millrace.operators.smoothing import Smoother, slope, smooth_many

FEE = 0.002


def turning_points(df: DataFrame, derivative: str, by: Sequence[str] = (), idx: str = "idx") -> DataFrame:
    """Rows after which the derivative changes sign; an exact zero is no crossing."""

    def build(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return frame.withColumn("_next", F.lead(derivative).over(window))

    crossing = F.signum(F.col(derivative)) * F.signum(F.col("_next")) < 0
    return over_series(df, build, by, idx, after=1).where(crossing).drop("_next")


def turning_moves(
    df: DataFrame,
    value: str,
    derivative: str,
    min_move: float = 0.0,
    by: Sequence[str] = (),
    idx: str = "idx",
) -> DataFrame:
    """Moves between consecutive turning points of at least ``min_move`` in size."""
    points = turning_points(df, derivative, by, idx).select(*by, idx, value)
    moves = with_neighbour(points, {value: "to_value", idx: "to_idx"}, by, idx)
    move = F.col("to_value") - F.col(value)
    return moves.where(F.col("to_idx").isNotNull() & (F.abs(move) >= min_move)).select(
        *by,
        move.alias("move"),
        F.col(value).alias("from_value"),
        "to_value",
        F.col(idx).alias("from_idx"),
        "to_idx",
        (F.col("to_idx") - F.col(idx)).alias("length"),
    )


def regimes(
    df: DataFrame,
    value: str,
    radii: tuple[int, int, int] = (25, 50, 100),
    power: int = 4,
    by: Sequence[str] = (),
    idx: str = "idx",
    kernel: Kernel = inverse_distance,
) -> DataFrame:
    """Append ``fast``, ``middle`` and ``slow`` causal averages and the regime their order shows."""
    names = ("fast", "middle", "slow")
    smoothed = smooth_many(
        df, value, {n: Smoother(r, power, kernel, causal=True) for n, r in zip(names, radii)}, by, idx
    )
    falling = (F.col("fast") < F.col("middle")) & (F.col("middle") < F.col("slow"))
    rising = (F.col("fast") > F.col("middle")) & (F.col("middle") > F.col("slow"))
    return smoothed.withColumn("regime", F.when(falling, "bear").when(rising, "bull").otherwise("none"))


def run_breaks(df: DataFrame, value: str, by: Sequence[str] = (), idx: str = "idx") -> DataFrame:
    """For rows thinned to one regime: the two ends of every gap between runs of adjacent positions."""
    paired = with_neighbour(df.select(*by, idx, value), {idx: "next_idx", value: "next_value"}, by, idx)
    return paired.where(F.col("next_idx") != F.col(idx) + 1).select(
        *by, F.col(idx).alias("end_idx"), F.col(value).alias("end_value"), "next_idx", "next_value"
    )


def crossing_rule(
    earlier: tuple[Column, Column], later: tuple[Column, Column], slope_level: Column, curvature_level: Column
) -> Column:
    """The first matching rule decides: slope rising through its level sells, falling buys, then the same for
    the curvature with the directions exchanged."""
    (d, c), (d_later, c_later) = earlier, later
    return (
        F.when((d < slope_level) & (d_later > slope_level), "sell")
        .when((d > slope_level) & (d_later < slope_level), "buy")
        .when((c > curvature_level) & (c_later < curvature_level), "sell")
        .when((c < curvature_level) & (c_later > curvature_level), "buy")
    )


def with_crossing_signals(
    df: DataFrame,
    first: str = "slope",
    second: str = "curvature",
    slope_level: float = 0.0,
    curvature_level: float = 0.0,
    by: Sequence[str] = (),
    idx: str = "idx",
    lookahead: bool = True,
    output: str = "signal",
) -> DataFrame:
    """Append ``buy``, ``sell`` or NULL; the last row of a series always sells.

    The default compares each row with the **next** one, which a real trader cannot know.
    ``lookahead=False`` compares it with the previous one instead.
    """

    def build(frame: DataFrame, window: WindowSpec) -> DataFrame:
        here = (F.col(first), F.col(second))
        move = F.lead if lookahead else F.lag
        other = (move(first).over(window), move(second).over(window))
        earlier, later = (here, other) if lookahead else (other, here)
        rule = crossing_rule(earlier, later, F.lit(slope_level), F.lit(curvature_level))
        return frame.withColumn(output, F.when(F.lead(idx).over(window).isNull(), "sell").otherwise(rule))

    return over_series(df, build, by, idx, before=0 if lookahead else 1, after=1)


def with_price_signals(
    df: DataFrame,
    value: str,
    smoother: Smoother,
    slope_level: float = 0.0,
    curvature_level: float = 0.0,
    by: Sequence[str] = (),
    idx: str = "idx",
) -> DataFrame:
    """Signals from the derivatives of the smoothed series; the raw value stays for the trade prices."""
    smoothed = smooth_many(df, value, {"smoothed": smoother}, by, idx)

    def build(frame: DataFrame, window: WindowSpec) -> DataFrame:
        frame = frame.withColumn("slope", slope("smoothed", window, idx))
        frame = frame.withColumn("curvature", slope("slope", window, idx))
        later = (F.lead("slope").over(window), F.lead("curvature").over(window))
        here = (F.col("slope"), F.col("curvature"))
        rule = crossing_rule(here, later, F.lit(slope_level), F.lit(curvature_level))
        return frame.withColumn("signal", F.when(F.lead(idx).over(window).isNull(), "sell").otherwise(rule))

    return over_series(smoothed, build, by, idx, before=4, after=1)


def with_trades(
    df: DataFrame, by: Sequence[str] = (), idx: str = "idx", signal: str = "signal", output: str = "traded"
) -> DataFrame:
    """Keep the rows with a signal and mark those that change the position; it starts out of the market."""
    signalled = df.where(F.col(signal).isNotNull())
    previous = with_neighbour(signalled, {signal: "_previous"}, by, idx, ahead=False)
    changes = F.col(signal) != F.coalesce(F.col("_previous"), F.lit("sell"))
    return previous.withColumn(output, changes).drop("_previous")


def _log(x: Column) -> Column:
    """The logarithm of doubles: -infinity of 0 and NaN below, where Spark's own is NULL, which a sum leaves out."""
    return F.when(x > 0, F.log(x)).when(x == 0, F.lit(-math.inf)).when(x < 0, F.lit(math.nan))


def strategy_returns(
    trades: DataFrame, value: str, fee: float = FEE, by: Sequence[str] = (), signal: str = "signal", traded: str = "traded"
) -> DataFrame:
    """Trades and compounded log return per series: each side of a trade costs ``fee``.

    Buying at a price of 0 returns infinity, selling at 0 loses all (-infinity); a series that does both, or trades at a
    negative price, has the return NaN. Trades without a price count, but return nothing.
    """
    price = F.col(value).cast("double")
    # A power, unlike a division, does not fail at 0.
    bought = _log(F.when(price != 0, F.lit(1 - fee) / price).otherwise(F.pow(price, F.lit(-1.0))))
    sold = _log(F.lit(1 - fee) * price)
    gain = F.when(F.col(traded), F.when(F.col(signal) == "buy", bought).otherwise(sold)).otherwise(0.0)
    return trades.groupBy(*by).agg(
        F.count_if(F.col(traded)).alias("trades"), F.coalesce(F.sum(gain), F.lit(0.0)).alias("log_return")
    )


def strategy_sweep(
    df: DataFrame,
    value: str,
    radii: Sequence[int],
    powers: Sequence[int],
    slope_levels: Sequence[float],
    curvature_levels: Sequence[float],
    fee: float = FEE,
    by: Sequence[str] = (),
    idx: str = "idx",
) -> DataFrame:
    """Trades and log return of every parameter combination.

    Each (radius, power) is smoothed once, and both derivatives and their next values are put into the row, so no
    window is repeated per combination. A row stays one row per (radius, power), whatever the number of levels: the levels
    that it crosses are an interval of the sorted ones, so a task plays a stretch of the series for all levels at once and
    keeps a cell per combination of levels. What a stretch hands on (first and last signal, trades and gains between) is put
    together along the series.
    """
    shapes = {f"_s{i}": shape for i, shape in enumerate(itertools.product(radii, powers))}
    smoothed = smooth_many(
        df.select(*by, idx, value), value, {n: Smoother(r, p) for n, (r, p) in shapes.items()}, by, idx, arrays=True if len(shapes) > 2 else None
    )

    def build(frame: DataFrame, window: WindowSpec) -> DataFrame:
        # All shapes at once per step, so that their windows share one operator.
        frame = frame.withColumns({f"{name}d": slope(name, window, idx) for name in shapes})
        frame = frame.withColumns({f"{name}c": slope(f"{name}d", window, idx) for name in shapes})
        entries = [
            F.struct(
                F.lit(radius).alias("radius"),
                F.lit(power).alias("power"),
                F.col(f"{name}d").alias("d"),
                F.col(f"{name}c").alias("c"),
                F.lead(f"{name}d").over(window).alias("d_later"),
                F.lead(f"{name}c").over(window).alias("c_later"),
            )
            for name, (radius, power) in shapes.items()
        ]
        last = F.lead(idx).over(window).isNull()
        return frame.withColumns({"_last": last, "_shapes": F.array(*entries)})

    rows = over_series(smoothed, build, by, idx, before=4, after=1)
    rows = rows.select(*by, idx, F.col(value).cast("double").alias("_price"), "_last", F.inline("_shapes"))
    slopes, curves = (sorted({float(level) for level in levels}) for levels in (slope_levels, curvature_levels))
    bits = stretch_bits(0, 0)
    played = _played_stretches(rows, slopes, curves, fee, by, idx, bits)
    levels = F.array(*[F.struct(F.lit(s).alias("slope_level"), F.lit(c).alias("curvature_level")) for s in slopes for c in curves])
    cells = played.select(*by, "radius", "power", "_stretch", F.inline(F.arrays_zip(levels.alias("level"), *_CELL)))
    keys = [*by, "radius", "power", "level"]
    whole = F.struct("_stretch", *_CELL)
    longest = df.schema[idx].metadata.get(LONGEST)
    if longest is not None and longest <= 1 << bits:  # one stretch to a series
        found = cells.select(*keys, F.array(whole).alias("_cells"))
    else:
        found = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(whole)).alias("_cells"))

    def go_on(done: Column, cell: Column) -> Column:
        turns = (cell["first"] != done["last"]) & (cell["first"] != 0)
        return F.struct(
            F.when(cell["first"] == 0, done["last"]).otherwise(cell["last"]).alias("last"),
            (done["trades"] + turns.cast("bigint") + cell["trades"]).alias("trades"),
            (done["gain"] + F.when(turns, cell["first_gain"]).otherwise(0.0) + cell["gain"]).alias("gain"),
        )

    begin = F.struct(F.lit(SELL).alias("last"), F.lit(0).cast("bigint").alias("trades"), F.lit(0.0).alias("gain"))
    total = found.select(*keys, F.aggregate("_cells", begin, go_on).alias("_total"))
    return total.select(*by, "radius", "power", "level.*", F.col("_total.trades").alias("trades"), F.col("_total.gain").alias("log_return"))


BUY, SELL = 1, 2
_CELL = ("first", "first_gain", "trades", "gain", "last")


def _crossed(levels: np.ndarray, here: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The interval of sorted levels strictly between two values; empty if one is missing."""
    low, high = np.fmin(here, later), np.fmax(here, later)
    first, behind = np.searchsorted(levels, low, "right"), np.searchsorted(levels, high, "left")
    sound = (here < later) | (later < here)
    return np.where(sound, first, 0), np.where(sound, np.maximum(first, behind), 0)


def play_grid(table: Mapping[str, np.ndarray], slopes: Sequence[float], curves: Sequence[float], fee: float) -> dict[str, np.ndarray]:
    """Play rows in order for all combinations of levels: arrays [slope level, curvature level] of ``_CELL``.

    ``table``: price, last, d, d_later, c, c_later. The first signal of a cell has to wait for what went before it;
    trades and gains count from the second one on.
    """
    shape = len(slopes), len(curves)
    first, state, trades = np.zeros(shape, np.int32), np.zeros(shape, np.int32), np.zeros(shape, np.int64)
    first_gain, gain = np.zeros(shape), np.zeros(shape)
    top, bottom = _crossed(np.array(slopes), table["d"], table["d_later"])
    left, right = _crossed(np.array(curves), table["c"], table["c_later"])
    top, bottom = np.where(table["last"], 0, top), np.where(table["last"], len(slopes), bottom)
    by_slope = np.where(table["last"] | (table["d"] < table["d_later"]), SELL, BUY)
    by_curve = np.where(table["c"] > table["c_later"], SELL, BUY)
    with np.errstate(all="ignore"):
        prices = np.log(np.where(table["price"] > 0, table["price"], np.nan))
        worth = {BUY: np.nan_to_num(np.log(1 - fee) - prices), SELL: np.nan_to_num(np.log(1 - fee) + prices)}

    def signal(at: tuple[slice, slice], kind: int, worth: float) -> None:
        before = state[at]
        fresh = before == 0
        turned = (before != kind) & ~fresh
        trades[at] += turned
        gain[at] += worth * turned
        first[at][fresh], first_gain[at][fresh] = kind, worth
        state[at] = kind

    for k in np.flatnonzero((bottom > top) | (right > left)).tolist():
        a, b, kind = int(top[k]), int(bottom[k]), int(by_slope[k])
        if b > a:
            signal((slice(a, b), slice(None)), kind, worth[kind][k])
        if right[k] > left[k]:
            columns, kind = slice(int(left[k]), int(right[k])), int(by_curve[k])
            for rows in (slice(0, a), slice(b, None)):
                signal((rows, columns), kind, worth[kind][k])
    return dict(zip(_CELL, (first, first_gain, trades, gain, state)))


def _played_stretches(
    rows: DataFrame, slopes: Sequence[float], curves: Sequence[float], fee: float, by: Sequence[str], idx: str, bits: int
) -> DataFrame:
    """One row per (series, radius, power, stretch): arrays of the cells of all combinations of levels."""
    keys = [*by, "radius", "power", "_stretch"]
    names = ("d", "d_later", "c", "c_later")

    def play(table: pa.Table) -> pa.Table:
        table = table.sort_by(idx)
        arrays = {n: table.column(n).to_numpy() for n in names}
        arrays |= {"price": table.column("_price").to_numpy(), "last": table.column("_last").to_numpy()}
        cells = play_grid(arrays, slopes, curves, fee)
        return pa.table([*[table.column(k)[:1] for k in keys], *[pa.array([cells[c].ravel()]) for c in _CELL]], names=[*keys, *_CELL])

    placed = rows.select(*by, idx, "_price", "_last", "radius", "power", *names, home_stretch(idx, bits).alias("_stretch"))
    kinds = {"first": "int", "first_gain": "double", "trades": "bigint", "gain": "double", "last": "int"}
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in placed.select(*keys).schema.fields]
    return placed.groupBy(*keys).applyInArrow(play, ", ".join([*fields, *[f"{c} array<{kinds[c]}>" for c in _CELL]]))


def with_grid(df: DataFrame, axes: Mapping[str, Sequence], keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """Repeat each row for every combination of the given parameter values.

    ``keep`` takes a combination and says whether the row wants it; the others are never made into rows.
    """
    points = F.array(
        *[F.struct(*[F.lit(v).alias(name) for name, v in zip(axes, point)]) for point in itertools.product(*axes.values())]
    )
    return df.select("*", F.inline(points if keep is None else F.filter(points, keep)))


def best_of(df: DataFrame, score: str, n: int = 1000) -> DataFrame:
    """The ``n`` best results, best first."""
    others = [c for c in df.columns if c != score]
    return df.orderBy(F.col(score).desc(), *others).limit(n)
