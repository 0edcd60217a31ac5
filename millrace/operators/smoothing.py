"""Kernel smoothing, derivatives and rolling geometric means along series.

Neighbourhoods count rows, not time. At the ends of a series the neighbourhood is clipped and the weights are
renormalised. A neighbourhood that holds a missing value, NULL or NaN, has the mean NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.kernels import Kernel, inverse_distance
from millrace.functions.scalars import total
from millrace.operators.series import over_series

# Up to this many window offsets in all passes together the JVM is faster, above it numpy is.
COLUMN_OFFSETS = 32


@dataclass(frozen=True)
class Smoother:
    """``power`` passes of a weighted mean over ``radius`` rows to each side, or only backwards if causal.

    With ``kernel_each_pass=False`` the passes after the first fall back to the inverse-distance kernel.
    """

    radius: int
    power: int = 1
    kernel: Kernel = inverse_distance
    causal: bool = False
    kernel_each_pass: bool = True

    def __post_init__(self):
        if self.radius < 0 or self.power < 0:
            raise ValueError("radius and power must not be negative")

    @property
    def before(self) -> int:
        return self.radius * self.power

    @property
    def after(self) -> int:
        return 0 if self.causal else self.before

    @property
    def offsets(self) -> int:
        return self.power * self.radius * (1 if self.causal else 2)

    def weights(self) -> list[np.ndarray]:
        """Per pass, the weights of the offsets -radius..radius, or -radius..0 if causal."""
        later = self.kernel if self.kernel_each_pass else inverse_distance
        offsets = range(-self.radius, (0 if self.causal else self.radius) + 1)
        return [np.array([float(k(o)) for o in offsets]) for k in ([self.kernel] + [later] * (self.power - 1))[: self.power]]

    @property
    def chain(self) -> tuple:
        """Smoothers that differ in power only share their passes."""
        return self.radius, self.kernel, self.causal, self.kernel_each_pass

    def columns(self, frame: DataFrame, value: str, window: WindowSpec, names: Mapping[int, str]) -> DataFrame:
        """The passes as stacked window expressions over lagged values; ``names`` gives the output of a power."""
        frame = frame.withColumn("_pass", _present(F.col(value).cast("double")))
        row = F.row_number().over(window) - 1
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        frame = frame.withColumn("_left", F.least(row, F.lit(self.radius)))
        if not self.causal:
            frame = frame.withColumn("_right", F.least(F.count(F.lit(1)).over(whole) - 1 - row, F.lit(self.radius)))
        for done, weights in enumerate([None, *self.weights()]):
            if weights is not None:
                frame = frame.withColumn("_pass", self._mean(weights, window))
            if done in names:
                frame = frame.withColumn(names[done], F.col("_pass"))
        return frame.drop("_pass", "_left", "_right")

    def _mean(self, weights: np.ndarray, window: WindowSpec) -> Column:
        """``weights`` of offsets in ascending order; ``_left`` and ``_right`` count the neighbours that exist."""
        at = self.radius  # of the row itself
        parts = [F.col("_pass") * F.lit(float(weights[at]))]
        weight = _pick(np.cumsum(weights[at::-1]), "_left")
        for distance in range(1, self.radius + 1):
            parts.append(F.lag("_pass", distance, 0.0).over(window) * F.lit(float(weights[at - distance])))
            if not self.causal:
                parts.append(F.lead("_pass", distance, 0.0).over(window) * F.lit(float(weights[at + distance])))
        if not self.causal:
            weight = weight + _pick(np.cumsum(weights[at:]) - weights[at], "_right")
        return _present(total(parts) / weight)

    def arrays(self, values: np.ndarray, run: np.ndarray, powers: Sequence[int], places: np.ndarray) -> dict[int, np.ndarray]:
        """The passes over an array in which equal ``run`` numbers mark one series, after each of ``powers``.

        ``radius`` zeros between the series keep them apart, so a pass is one convolution.
        """
        at = np.arange(len(values)) + self.radius * (run - run[0])
        padded, present = np.zeros((2, at[-1] + 1 + self.radius))
        padded[at], present[at] = values, 1.0
        results = {0: values}
        for done, weights in enumerate(self.weights(), start=1):
            ahead = 0 if self.causal else self.radius
            taps = weights[::-1]  # a convolution runs backwards
            weighted = np.convolve(padded, taps)[ahead:][at]
            padded[at] = weighted / np.convolve(present, taps)[ahead:][at]
            results[done] = padded[at]
        return {power: results[power] for power in powers}


@dataclass(frozen=True)
class PositionSmoother(Smoother):
    """A smoother whose kernel gets both positions: ``kernel(of the row, of the neighbour)``, as arrays of whole numbers.

    Weights may thus change along the series. A pass adds up one shifted array per offset, each with weights of its own.
    """

    kernel: Callable[[np.ndarray, np.ndarray], np.ndarray] = field(default=None)  # type: ignore[assignment]

    def arrays(self, values: np.ndarray, run: np.ndarray, powers: Sequence[int], places: np.ndarray) -> dict[int, np.ndarray]:
        results = {0: values}
        n = len(values)
        for done in range(1, self.power + 1):
            given = self.kernel if done == 1 or self.kernel_each_pass else lambda i, j: 1.0 / (np.abs(i - j) + 1)
            weighted, weight = np.zeros((2, n))
            for offset in range(-self.radius, (0 if self.causal else self.radius) + 1):
                here = np.arange(max(0, -offset), max(0, min(n, n - offset)))
                here = here[run[here] == run[here + offset]]
                w = np.broadcast_to(np.asarray(given(places[here], places[here + offset]), float), here.shape)
                weighted[here] += w * results[done - 1][here + offset]
                weight[here] += w
            with np.errstate(all="ignore"):
                results[done] = weighted / weight
        return {power: results[power] for power in powers}


def _chains(smoothers: Mapping[str, Smoother]) -> list[tuple[Smoother, dict[int, list[str]]]]:
    """The strongest smoother of every chain, with the output columns of each power wanted from it."""
    strongest: dict[tuple, Smoother] = {}
    names: dict[tuple, dict[int, list[str]]] = {}
    for name, smoother in smoothers.items():
        key = smoother.chain
        if key not in strongest or strongest[key].power < smoother.power:
            strongest[key] = smoother
        names.setdefault(key, {}).setdefault(smoother.power, []).append(name)
    return [(strongest[key], names[key]) for key in strongest]


def _present(value: Column) -> Column:
    """NaN as NULL."""
    return F.when(~F.isnan(value), value)


def _pick(sums: Sequence[float], position: str) -> Column:
    return F.element_at(F.array(*[F.lit(float(s)) for s in sums]), (F.col(position) + 1).cast("int"))


def smooth_many(
    df: DataFrame,
    value: str,
    smoothers: Mapping[str, Smoother],
    by: Sequence[str] = (),
    idx: str = "idx",
    bits: int | None = None,
    arrays: bool | None = None,
) -> DataFrame:
    """Append one smoothed column per smoother, all from one shuffle.

    Small neighbourhoods become window expressions; large ones run as numpy passes over sorted Arrow batches.
    Both give the same values; ``arrays`` forces one of them.
    """
    before = max(s.before for s in smoothers.values())
    after = max(s.after for s in smoothers.values())
    chains = _chains(smoothers)
    if any(isinstance(s, PositionSmoother) for s in smoothers.values()):
        arrays = True
    if arrays is None:
        arrays = sum(s.offsets for s, _ in chains) > COLUMN_OFFSETS

    def in_columns(frame: DataFrame, window: WindowSpec) -> DataFrame:
        for smoother, names in chains:
            frame = smoother.columns(frame, value, window, {p: n[0] for p, n in names.items()})
            frame = frame.withColumns({n: F.col(ns[0]) for ns in names.values() for n in ns[1:]})
        return frame

    def in_arrays(frame: DataFrame, window: WindowSpec) -> DataFrame:
        # The window lays each series out in order within one partition, and marks where it starts.
        marked = frame.withColumn("_start", F.row_number().over(window) == 1)
        added = [T.StructField(output, T.DoubleType()) for output in smoothers]
        passes = _batch_passes(chains, list(smoothers), value, before, after, idx)
        return marked.mapInPandas(passes, T.StructType([*frame.schema.fields, *added]))

    return over_series(df, in_arrays if arrays else in_columns, by, idx, before, after, bits)


def _batch_passes(chains, outputs: list[str], value: str, before: int, after: int, idx: str = "idx"):
    """A mapInPandas function over rows sorted by series.

    It holds back the newest ``after`` rows and keeps the last ``before`` finished ones, so its memory does not
    depend on the length of a series.
    """
    enough = 4 * (before + after) + 1

    def finish(held: pd.DataFrame, start: int, stop: int) -> pd.DataFrame:
        run = np.cumsum(held["_start"].to_numpy(dtype=bool))
        values = held[value].to_numpy(dtype="float64")
        places = held[idx].to_numpy() if idx in held else np.arange(len(held))
        computed = {}
        for smoother, names in chains:
            for power, result in smoother.arrays(values, run, list(names), places).items():
                computed |= {name: result[start:stop] for name in names[power]}
        rows = held.iloc[start:stop].drop(columns="_start")
        return rows.assign(**{name: computed[name] for name in outputs})

    def run_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        rows, finished = 0, 0  # rows waiting; how many of them were already emitted and stay as context
        for batch in batches:
            waiting.append(batch)
            rows += len(batch)
            if rows - finished < enough:
                continue
            held = pd.concat(waiting, ignore_index=True)
            stop = rows - after
            yield finish(held, finished, stop)
            keep = max(0, stop - before)
            waiting = [held.iloc[keep:]]
            rows, finished = rows - keep, stop - keep
        if rows > finished:
            yield finish(pd.concat(waiting, ignore_index=True), finished, rows)

    return run_batches


def smooth(
    df: DataFrame,
    value: str,
    radius: int,
    power: int = 1,
    kernel: Kernel = inverse_distance,
    causal: bool = False,
    by: Sequence[str] = (),
    idx: str = "idx",
    output: str = "smoothed",
    kernel_each_pass: bool = True,
) -> DataFrame:
    smoother = Smoother(radius, power, kernel, causal, kernel_each_pass)
    return smooth_many(df, value, {output: smoother}, by, idx)


def smooth_by_position(
    df: DataFrame,
    value: str,
    radius: int,
    kernel: Callable[[np.ndarray, np.ndarray], np.ndarray],
    power: int = 1,
    causal: bool = False,
    by: Sequence[str] = (),
    idx: str = "idx",
    output: str = "smoothed",
    kernel_each_pass: bool = True,
) -> DataFrame:
    """``smooth`` with a kernel of both positions, see ``PositionSmoother``."""
    return smooth_many(df, value, {output: PositionSmoother(radius, power, kernel, causal, kernel_each_pass)}, by, idx)


def slope(value: str, window: WindowSpec, idx: str = "idx") -> Column:
    """Backward two-step difference, 0 for the first two positions. Looks 2 rows back."""
    return F.when(F.col(idx) <= 1, F.lit(0.0)).otherwise((F.col(value) - F.lag(value, 2).over(window)) / 2)


def with_derivatives(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    idx: str = "idx",
    first: str = "slope",
    second: str = "curvature",
) -> DataFrame:
    def build(frame: DataFrame, window: WindowSpec) -> DataFrame:
        frame = frame.withColumn(first, slope(value, window, idx))
        return frame.withColumn(second, slope(first, window, idx))

    return over_series(df, build, by, idx, before=4)


def with_changes(
    df: DataFrame, value: str, by: Sequence[str] = (), idx: str = "idx", output: str = "change"
) -> DataFrame:
    """Change from the previous row, 0 for the first."""

    def build(frame: DataFrame, window: WindowSpec) -> DataFrame:
        return frame.withColumn(output, F.coalesce(F.col(value) - F.lag(value).over(window), F.lit(0.0)))

    return over_series(df, build, by, idx, before=1)


def rolling_geometric_mean(
    df: DataFrame, value: str, size: int, by: Sequence[str] = (), idx: str = "idx", output: str = "geometric_mean"
) -> DataFrame:
    """Geometric mean of the last ``size`` values; rows without a full window are left out.

    A window that holds NULL, NaN or a negative value has none (NULL), one that holds 0 has the mean 0. Logarithms are
    averaged, so that long windows do not overflow.
    """

    def build(frame: DataFrame, window: WindowSpec) -> DataFrame:
        rows = window.rowsBetween(-(size - 1), 0)
        x = F.col(value).cast("double")
        usable = F.count_if((x >= 0) & ~F.isnan(x)).over(rows) == size
        zero = F.count_if(x == 0).over(rows) > 0
        mean = F.exp(F.avg(F.log(F.when(x > 0, x))).over(rows))
        return frame.withColumn(output, F.when(usable, F.when(zero, 0.0).otherwise(mean)))

    return over_series(df, build, by, idx, before=size - 1).where(F.col(idx) >= size - 1)
