"""Linear models fitted from sums that one distributed pass computes.

Squared-error fits need only the sums of products of the columns. ``moments`` gets them with a single
aggregation; every later step (closed form, gradient descent of any length, step searches, error of any
weights) works on a small matrix whose size depends on the number of columns and not on the number of rows.
Rows that lack a term or the target are left out of every sum, and counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import column, polynomial, weighted_sum
from millrace.operators.series import if_small, match_on
from millrace.session import stage

CONSTANT = "constant"
TARGET = "target"


# --- sums ------------------------------------------------------------------------------------------------------


def _complete(columns: Sequence[str]) -> Column:
    """Does the row have a value in every column? Rows that do not are left out of all sums alike."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _co_moments(terms: Sequence[str], target: str) -> list[Column]:
    """Means, and upper triangle of the covariances, of terms and target over complete rows; rows in and left out.

    Covariances are added up around the running means, so a large common offset costs no digits. The names are
    private ones, so that they cannot meet those of grouping columns.
    """
    columns = [*terms, target]
    whole = _complete(columns)
    kept = [F.when(whole, F.col(c).cast("double")) for c in columns]
    return [
        F.array(*[F.avg(c) for c in kept]).alias("_mean"),
        F.array(*[F.covar_pop(a, b) for i, a in enumerate(kept) for b in kept[i:]]).alias("_cov"),
        F.count_if(whole).alias("_n"),
        F.count_if(~whole).alias("_left_out"),
    ]


def gram_matrix(df: DataFrame, terms: Sequence[str], target: str) -> DataFrame:
    """The sums in long form: ``row_term, col_term, value``, the target included as a term."""
    columns = [*terms, target]
    df = df.where(_complete(columns))
    entries = [
        F.struct(F.lit(a).alias("row_term"), F.lit(b).alias("col_term"), F.sum(F.col(a) * F.col(b)).alias("value"))
        for i, a in enumerate(columns)
        for b in columns[i:]
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


@dataclass(frozen=True)
class Moments:
    """Means and sums of centred products of ``terms`` and a target over ``n`` complete rows.

    ``mean`` and ``centred`` have the target last. ``left_out`` rows had a NULL in a term or the target.
    """

    terms: tuple[str, ...]
    mean: np.ndarray
    centred: np.ndarray
    n: int
    left_out: int = 0

    @classmethod
    def from_row(cls, terms: Sequence[str], row) -> Moments:
        if row["_n"] == 0:
            raise ValueError("no rows to fit")
        centred = _full(np.array(row["_cov"]), len(terms) + 1) * row["_n"]
        return cls(tuple(terms), np.array(row["_mean"]), centred, row["_n"], row["_left_out"])

    @property
    def xtx(self) -> np.ndarray:
        return self.centred[:-1, :-1] + self.n * np.outer(self.mean[:-1], self.mean[:-1])

    @property
    def xty(self) -> np.ndarray:
        return self.centred[:-1, -1] + self.n * self.mean[:-1] * self.mean[-1]

    @property
    def yty(self) -> float:
        return float(self.centred[-1, -1] + self.n * self.mean[-1] ** 2)

    def subset(self, terms: Sequence[str]) -> Moments:
        at = [*[self.terms.index(t) for t in terms], -1]
        return replace(self, terms=tuple(terms), mean=self.mean[at], centred=self.centred[np.ix_(at, at)])

    def _miss(self, w: np.ndarray) -> float:
        """Mean of prediction minus target."""
        return float(self.mean[:-1] @ w - self.mean[-1])

    def gradient(self, w: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            slopes = self.centred[:-1, :-1] @ w - self.centred[:-1, -1]
            return 2 * (slopes + self.n * self.mean[:-1] * self._miss(w))

    def rss(self, w: np.ndarray) -> float:
        """Sum of squared errors: what the centred sums leave, and the mean error."""
        with np.errstate(all="ignore"):
            v = np.append(w, -1.0)
            return float(v @ self.centred @ v + self.n * self._miss(w) ** 2)

    def fall(self, slope: np.ndarray, step: float) -> float:
        """By how much an update against the gradient ``slope`` lowers the sum of squared errors, without a difference of two."""
        with np.errstate(all="ignore"):
            curve = slope @ self.centred[:-1, :-1] @ slope + self.n * (self.mean[:-1] @ slope) ** 2
            return float(step * (slope @ slope) - step**2 * curve)

    def rmse(self, w: np.ndarray) -> float:
        with np.errstate(all="ignore"):
            return float(np.sqrt(max(self.rss(w), 0.0) / self.n))

    def solve(self, l2: float = 0.0) -> np.ndarray:
        """Least squares; a penalty spares the constant term."""
        if CONSTANT in self.terms:  # then the other weights follow from the centred sums alone
            at = [i for i, t in enumerate(self.terms) if t != CONSTANT]
            w = np.zeros(len(self.terms))
            if at:
                w[at] = _solve((self.centred[np.ix_(at, at)] + l2 * np.eye(len(at)))[None], self.centred[at, -1][None])[0]
            w[self.terms.index(CONSTANT)] = self.mean[-1] - self.mean[at] @ w[at]
            return w
        return _solve(self.xtx[None] + l2 * np.eye(len(self.terms)), self.xty[None])[0]


def _full(upper: np.ndarray, d: int) -> np.ndarray:
    matrix = np.zeros((*upper.shape[:-1], d, d))
    rows, cols = np.triu_indices(d)
    matrix[..., rows, cols] = upper
    matrix[..., cols, rows] = upper
    return matrix


def _solve(xtx: np.ndarray, xty: np.ndarray) -> np.ndarray:
    """Solve many small systems after scaling each to a unit diagonal; singular ones get the shortest solution."""
    scale = np.sqrt(np.maximum(np.diagonal(xtx, axis1=-2, axis2=-1), np.finfo(float).tiny))
    scaled = xtx / scale[..., :, None] / scale[..., None, :]
    inverse = np.linalg.pinv(scaled, hermitian=True)
    return (inverse @ (xty / scale)[..., None])[..., 0] / scale


def moments(df: DataFrame, terms: Sequence[str], target: str) -> Moments:
    """One aggregation; only the sums reach the driver."""
    return Moments.from_row(terms, df.agg(*_co_moments(terms, target)).first())


def moments_of_parts(df: DataFrame, terms: Sequence[str], target: str, part: str, most: int = 1_000) -> dict[str, Moments]:
    """The sums of each part of a split, from one pass. ``part`` holds a handful of split names, at most ``most``."""
    rows = df.groupBy(part).agg(*_co_moments(terms, target)).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} parts; fit_groups fits any number of groups")
    return {row[part]: Moments.from_row(terms, row) for row in rows}


def fit_groups(
    df: DataFrame,
    terms: Sequence[str],
    target: str,
    by: Sequence[str],
    models: Mapping[int | str, Sequence[str]] | None = None,
    model_column: str = "model",
) -> DataFrame:
    """One least-squares fit per group, any number of groups: ``by..., rows, rss, term...``.

    Rows are reduced to sums before the shuffle, so a group of any size costs its tasks one row each. ``models``
    fits several subsets of the terms from the same sums, a row each, with NULL for the terms a model lacks.
    """
    terms = list(terms)
    chosen = {None: terms} if models is None else dict(models)
    sums = df.groupBy(*by).agg(*_co_moments(terms, target)).where("_n > 0")
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in df.select(*by).schema.fields]
    if models is not None:
        fields.append(f"{model_column} {'int' if isinstance(next(iter(chosen)), int) else 'string'}")
    schema = ", ".join([*fields, "rows bigint", "rss double", *[f"{t} double" for t in terms]])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            n = batch["_n"].to_numpy(dtype=float)
            means = np.stack(batch["_mean"].to_numpy())
            centred = _full(np.stack(batch["_cov"].to_numpy()), len(terms) + 1) * n[:, None, None]
            for name, wanted in chosen.items():
                free = [terms.index(t) for t in wanted if t != CONSTANT]
                found = {t: np.zeros(len(batch)) for t in wanted}
                with_constant = CONSTANT in wanted
                around = centred if with_constant else centred + n[:, None, None] * means[:, :, None] * means[:, None, :]
                v = np.full((len(batch), len(free) + 1), -1.0)
                if free:
                    v[:, :-1] = _solve(around[:, free][:, :, free], around[:, free, -1])
                    found |= dict(zip([terms[i] for i in free], v[:, :-1].T))
                if with_constant:
                    found[CONSTANT] = -(means[:, [*free, -1]] * v).sum(axis=1)
                rss = np.einsum("gi,gij,gj->g", v, around[:, [*free, -1]][:, :, [*free, -1]], v)
                out = batch[list(by)]
                if name is not None:
                    out = out.assign(**{model_column: name})
                out = out.assign(rows=batch["_n"], rss=rss)
                yield out.assign(**{t: found.get(t, np.nan) for t in terms})

    return sums.mapInPandas(solve, schema)


# --- fits ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    weights: dict[str, float]
    converged: bool
    steps: int

    def frame(self, spark: SparkSession) -> DataFrame:
        return coefficient_frame(spark, self.weights)


def coefficient_frame(spark: SparkSession, weights: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame([(t, float(w)) for t, w in weights.items()], "term string, coefficient double")


def _start(m: Moments, initial: Sequence[float] | None) -> np.ndarray:
    if initial is None:
        return np.zeros(len(m.terms))
    if len(initial) != len(m.terms):
        raise ValueError(f"{len(initial)} initial weights for {len(m.terms)} terms")
    return np.array(initial, dtype=float)


def _fit(m: Moments, w: np.ndarray, converged: bool, steps: int) -> Fit:
    return Fit(dict(zip(m.terms, map(float, w))), converged, steps)


def descend_fixed(
    m: Moments,
    step: float,
    tolerance: float,
    max_updates: int,
    initial: Sequence[float] | None = None,
) -> Fit:
    """Fixed-step descent until the gradient is shorter than ``tolerance``, at most ``max_updates`` updates."""
    w = _start(m, initial)
    for update in range(max_updates + 1):
        slope = m.gradient(w)
        if np.linalg.norm(slope) < tolerance:
            return _fit(m, w, True, update)
        if update < max_updates:
            w = w - step * slope
    return _fit(m, w, False, max_updates)


def descend_ridge(
    m: Moments, step: float, l2: float, iterations: int = 100, initial: Sequence[float] | None = None
) -> Fit:
    """A fixed number of descent steps with the penalty ``l2 * w**2`` on every term but the constant."""
    w = _start(m, initial)
    free = np.array([0.0 if t == CONSTANT else 1.0 for t in m.terms])
    for _ in range(iterations):
        w = w - step * (m.gradient(w) + 2 * l2 * free * w)
    return _fit(m, w, False, iterations)


def descend_adaptive(
    m: Moments,
    step: float,
    error_threshold: float,
    max_steps: int | None = None,
    initial: Sequence[float] | None = None,
    extrapolate: bool = False,
    leap: float = 1e6,
) -> Fit:
    """Descent that goes on while the error falls by more than ``error_threshold``.

    An update that raises the error, or makes it NaN, is dropped and the step divided by ten. With ``extrapolate``, weights whose
    moves keep the same length (to the percent) take one update ``leap`` times as long; it is never undone.
    """
    w, steps = _start(m, initial), 0
    visited: list[np.ndarray] = []
    while True:
        slope = m.gradient(w)
        updated = w - step * slope
        now = m.rss(w)
        fall = m.fall(slope, step)
        # The difference of the two roots, from the fall of the sum itself.
        gain = fall / (math.sqrt(m.n) * (math.sqrt(max(now, 0.0)) + math.sqrt(max(now - fall, 0.0)) or 1.0)) if now == now else math.nan
        if math.isnan(gain) or gain < 0:
            step = _shorter(step)
            continue
        if not gain > error_threshold:
            return _fit(m, w, True, steps)
        if max_steps is not None and steps >= max_steps:
            return _fit(m, w, False, steps)
        if extrapolate and len(visited) >= 3 and _steady(visited[-2], w, updated):
            updated = w + (updated - w) * leap
        visited = [*visited[-2:], updated]
        w, steps = updated, steps + 1


def _shorter(step: float) -> float:
    if step / 10 == 0.0:
        raise ArithmeticError("no step is short enough: the error is not a number")
    return step / 10


def _steady(before: np.ndarray, now: np.ndarray, then: np.ndarray) -> bool:
    """Do the last two moves agree in length, to a rounded percent, summed over the weights?"""
    with np.errstate(all="ignore"):
        percent = np.nan_to_num(np.abs(before - now) / np.abs(now - then) * 100, posinf=1e18)
    return np.sum(np.floor(percent + 0.5) - 100) == 0


def fit_sgd(
    m: Moments,
    iterations: int,
    step: float,
    convergence_tol: float = 0.001,
) -> Fit:
    """Full-batch descent with step ``step / sqrt(t)`` on the mean half squared error.

    Weights start at 0 and the constant at 1. It stops early once an update moves the weights by less than
    ``convergence_tol`` relative to their length; 0 runs all iterations.
    """
    w = np.array([1.0 if t == CONSTANT else 0.0 for t in m.terms])
    last = None
    with np.errstate(all="ignore"):
        for t in range(1, iterations + 1):
            w = w - step / math.sqrt(t) * (m.xtx @ w - m.xty) / m.n
            if last is not None and np.linalg.norm(last - w) < convergence_tol * max(np.linalg.norm(w), 1.0):
                return _fit(m, w, True, t)
            last = w
    return _fit(m, w, False, iterations)


def search_step(m: Moments, first_step: float, iterations: int = 100, convergence_tol: float = 0.001) -> tuple[Fit, float]:
    """Divide the step by ten while that lowers the error; a diverged fit never ends the search.

    Data whose error is NaN at every step raise an error. Returns the chosen fit and its step.
    """

    def attempt(step: float) -> tuple[Fit, float]:
        fit = fit_sgd(m, iterations, step, convergence_tol)
        with np.errstate(all="ignore"):
            return fit, m.rmse(np.array([fit.weights[t] for t in m.terms]))

    step = first_step
    fit, error = attempt(step)
    while True:
        next_fit, next_error = attempt(_shorter(step))
        if math.isnan(error):
            better = True
        elif math.isnan(next_error):
            better = False
        else:
            better = math.isinf(error) or math.isinf(next_error) or next_error < error
        if not better:
            return fit, step
        fit, error, step = next_fit, next_error, step / 10


def compare_models(
    spark: SparkSession,
    parts: Mapping[str, Moments],
    models: Mapping[str, Sequence[str]],
    steps: Sequence[float],
    iterations: Sequence[int],
    fitted_on: str = "train",
    convergence_tol: float = 0.001,
) -> DataFrame:
    """Error of every model, step and iteration count on every part, all from the sums of the parts."""
    rows = []
    for name, terms in models.items():
        small = {part: m.subset(terms) for part, m in parts.items()}
        for step in steps:
            for count in iterations:
                fit = fit_sgd(small[fitted_on], count, step, convergence_tol)
                w = np.array(list(fit.weights.values()))
                rows += [(name, step, count, part, m.rss(w) / m.n) for part, m in small.items()]
    return spark.createDataFrame(rows, "model string, step double, iterations int, part string, mse double")


def fit_linear(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    reg: float = 0.0,
    elastic_net: float = 0.0,
    intercept: bool = True,
    standardize: bool = True,
    max_iter: int = 100,
    solver: str | None = None,
):
    """A fitted ML model, and its coefficients as a dict.

    Without a penalty the normal equations are solved in one pass; ``solver`` forces another way. Rows with a NULL
    feature or label are left out.
    """
    if solver == "normal" and reg > 0 and elastic_net > 0:
        raise ValueError("the normal equations cannot hold an elastic net penalty")
    df = df.where(_complete([*features, label]))
    ready = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    if solver is None:
        solver = "normal" if elastic_net == 0.0 or reg == 0.0 else "auto"
    model = LinearRegression(
        featuresCol="features",
        labelCol=label,
        regParam=reg,
        elasticNetParam=0.0 if solver == "normal" else elastic_net,
        fitIntercept=intercept,
        standardization=standardize,
        maxIter=max_iter,
        solver=solver,
    ).fit(ready)
    weights = {CONSTANT: float(model.intercept)} if intercept else {}
    weights |= {f: float(c) for f, c in zip(features, model.coefficients.toArray())}
    return model, weights


def elastic_net_path(
    sums: Moments, penalties: Sequence[float], share: float = 0.5, tolerance: float = 1e-12, most_rounds: int = 10_000
) -> dict[float, Fit]:
    """Penalised least squares for a path of penalties, from sums that one pass gave: weights by penalty.

    ``share`` of a penalty is on absolute values, the rest on squares. Columns and target count in units of their sample
    deviation; the constant, always fitted, is spared. Weights are updated one after the other: each takes the soft threshold of
    what the others leave, which the sums of products tell without a look at the rows. The path goes from the largest penalty
    down, each fit beginning at the one before. Constant columns get the weight 0.
    """
    at = [i for i, t in enumerate(sums.terms) if t != CONSTANT]
    spread = np.sqrt(np.maximum(np.diagonal(sums.centred), 0) / max(1, sums.n - 1))
    scale, unit = spread[at], spread[-1]
    safe = np.where(scale > 0, scale, 1.0)
    products = sums.centred[np.ix_(at, at)] / sums.n / safe[:, None] / safe[None, :]
    toward = sums.centred[at, -1] / sums.n / safe / (unit or 1.0)
    weights, fits = np.zeros(len(at)), {}
    for penalty in sorted(penalties, reverse=True):
        size = penalty / unit if unit else 0.0
        moved, rounds = np.inf, 0
        left = toward - products @ weights
        while moved > tolerance and rounds < most_rounds:
            moved, rounds = 0.0, rounds + 1
            for j in range(len(at)):
                if not scale[j]:
                    continue
                pull = left[j] + products[j, j] * weights[j]
                new = np.sign(pull) * max(abs(pull) - share * size, 0.0) / (products[j, j] + (1 - share) * size)
                if new != weights[j]:
                    left -= products[:, j] * (new - weights[j])
                    moved = max(moved, abs(new - weights[j]))
                    weights[j] = new
        plain = weights * unit / safe
        told = {CONSTANT: float(sums.mean[-1] - sums.mean[at] @ plain)} | {sums.terms[i]: float(w) for i, w in zip(at, plain)}
        fits[penalty] = Fit(told, moved <= tolerance, rounds)
    return fits


def path_frame(spark: SparkSession, fits: Mapping[float, Fit]) -> DataFrame:
    rows = [(float(p), t, w) for p, fit in fits.items() for t, w in fit.weights.items()]
    return spark.createDataFrame(rows, "penalty double, term string, coefficient double")


def with_prediction(df: DataFrame, weights: Mapping[str, float], output: str = "predicted") -> DataFrame:
    """Append the weighted sum; a weight for ``constant`` needs no column of that name."""
    terms = dict(weights)
    if CONSTANT in terms and CONSTANT not in df.columns:
        value = F.lit(terms.pop(CONSTANT))
        value = value + weighted_sum(terms) if terms else value
    else:
        value = weighted_sum(terms)
    return df.withColumn(output, value)


def predict_point(spark: SparkSession, weights: Mapping[str, float], point: Mapping[str, float]) -> DataFrame:
    row = spark.createDataFrame([tuple(float(v) for v in point.values())], [*point])
    return with_prediction(row, weights)


# --- polynomials -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PolynomialFit:
    """Coefficients in Chebyshev polynomials of x mapped from ``[low, high]`` to [-1, 1]."""

    degree: int
    low: float
    high: float
    chebyshev: np.ndarray
    rss: dict[str, float]

    def column(self, x: str) -> Column:
        """The polynomial at any x, also beyond the range it was fitted on; NULL stays NULL."""
        return polynomial(_unit(F.col(x), F.lit(self.low), F.lit(self.high)), np.polynomial.chebyshev.cheb2poly(self.chebyshev))

    def power_coefficients(self) -> np.ndarray:
        """Coefficients of the plain powers of x; they lose digits at high degrees."""
        series = np.polynomial.Chebyshev(self.chebyshev, domain=[self.low, self.high])
        plain = series.convert(kind=np.polynomial.Polynomial).coef
        return np.pad(plain, (0, self.degree + 1 - len(plain)))


def _unit(x: Column, low: Column, high: Column) -> Column:
    """x mapped from [low, high] to [-1, 1]."""
    return (x * 2 - (low + high)) / F.when(high > low, high - low).otherwise(1.0)


def _with_chebyshev(df: DataFrame, unit: Column, most: int) -> DataFrame:
    """Append ``_t1`` to ``_t<most>``, the Chebyshev polynomials of a column in [-1, 1]; NULL stays NULL.

    T(m+n) = 2 T(m) T(n) - T(m-n) makes all of a doubling from those before it: a projection per doubling, and one
    multiplication and one subtraction a polynomial, inside generated code.
    """
    df = df.withColumn("_t1", unit)
    have = 1
    while have < most:
        more = range(1, min(have, most - have) + 1)
        df = df.withColumns({f"_t{have + k}": 2 * F.col(f"_t{have}") * F.col(f"_t{k}") - (F.lit(1.0) if k == have else F.col(f"_t{have - k}")) for k in more})
        have += len(more)
    return df


def _chebyshev_sums(max_degree: int) -> list[Column]:
    """Sums over ``_t1`` to ``_t<2 * max_degree>`` and ``_y`` that hold the equations of all degrees.

    A product of two Chebyshev polynomials is the mean of two others, so that ``2 * max_degree + 1`` sums hold the matrix.
    """
    y, n = F.col("_y"), F.count(F.lit(1))
    return [
        F.array(n.cast("double"), *[F.sum(f"_t{k}") for k in range(1, 2 * max_degree + 1)]).alias("_t"),
        F.array(F.sum(y), *[F.sum(y * F.col(f"_t{k}")) for k in range(1, max_degree + 1)]).alias("_ty"),
        F.sum(y * y).alias("_yy"),
        n.alias("_n"),
    ]


def _chebyshev_system(t: np.ndarray, size: int) -> np.ndarray:
    order = np.arange(size)
    return (t[..., order[:, None] + order] + t[..., np.abs(order[:, None] - order)]) / 2


def fit_degrees(
    df: DataFrame, x: str, y: str, max_degree: int, part: str, fitted_on: str = "train"
) -> list[PolynomialFit]:
    """Fit every degree 1..max_degree on one part and give its residual sum of squares on every part.

    Powers of x make sums that no double can hold apart at degree 15. Chebyshev polynomials do not. The target is
    measured from its mean, so that an offset costs no digits. Rows with a NULL in x or y are left out.
    """
    df = df.where(_complete([x, y])).select(part, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    low, high, middle = df.agg(F.min("_x"), F.max("_x"), F.avg("_y")).first()
    if low is None:
        raise ValueError("no rows to fit")
    unit = _unit(F.col("_x"), F.lit(low), F.lit(high))
    prepared = _with_chebyshev(df.select(part, "_x", (F.col("_y") - middle).alias("_y")), unit, 2 * max_degree)
    rows = prepared.groupBy(part).agg(*_chebyshev_sums(max_degree)).collect()  # one row per part of the split
    sums = {row[part]: (_chebyshev_system(np.array(row["_t"]), max_degree + 1), np.array(row["_ty"]), row["_yy"]) for row in rows}
    fits = []
    for degree in range(1, max_degree + 1):
        size = degree + 1
        matrix, ty, _ = sums[fitted_on]
        c = _solve(matrix[None, :size, :size], ty[None, :size])[0]
        rss = {name: float(yy - 2 * c @ ty[:size] + c @ matrix[:size, :size] @ c) for name, (matrix, ty, yy) in sums.items()}
        c = c.copy()
        c[0] += middle
        fits.append(PolynomialFit(degree, low, high, c, rss))
    return fits


def best_degree(fits: Sequence[PolynomialFit], judged_on: str = "validation") -> PolynomialFit:
    return min(fits, key=lambda f: f.rss[judged_on])


def degree_frame(spark: SparkSession, fits: Sequence[PolynomialFit]) -> DataFrame:
    rows = [(f.degree, part, value) for f in fits for part, value in f.rss.items()]
    return spark.createDataFrame(rows, "degree int, part string, rss double")


def fit_polynomial_groups(df: DataFrame, x: str, y: str, degrees: Sequence[int], by: Sequence[str]) -> DataFrame:
    """Polynomial fits of several degrees per group: ``by..., degree, rows, low, high, rss, power_0...``.

    Each group is fitted in Chebyshev polynomials over its own range, one row of sums per group and task; the powers
    are those of x mapped from [low, high] to [-1, 1], since powers of x itself lose all digits at high degrees.
    ``polynomial_at`` evaluates them. Groups are matched with their ranges by a join that is broadcast if there are few.
    """
    most = max(degrees)
    rows = df.where(_complete([x, y])).select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    ranges = rows.groupBy(*by).agg(F.min("_x").alias("_low"), F.max("_x").alias("_high"), F.avg("_y").alias("_middle"))
    placed = match_on(rows, if_small(stage(ranges)), by)
    unit = _unit(F.col("_x"), F.col("_low"), F.col("_high"))
    prepared = _with_chebyshev(placed.select(*by, "_x", "_low", "_high", "_middle", (F.col("_y") - F.col("_middle")).alias("_y")), unit, 2 * most)
    sums = prepared.groupBy(*by, "_low", "_high", "_middle").agg(*_chebyshev_sums(most))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in df.select(*by).schema.fields]
    powers = [f"power_{k}" for k in range(most + 1)]
    schema = ", ".join([*fields, "degree int", "rows bigint", "low double", "high double", "rss double", *[f"{p} double" for p in powers]])
    to_powers = np.zeros((most + 1, most + 1))
    for k in range(most + 1):
        to_powers[k, : k + 1] = np.polynomial.chebyshev.cheb2poly([0.0] * k + [1.0])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            matrix = _chebyshev_system(np.stack(batch["_t"].to_numpy()), most + 1)
            ty = np.stack(batch["_ty"].to_numpy())
            for degree in degrees:
                size = degree + 1
                c = _solve(matrix[:, :size, :size], ty[:, :size])
                rss = batch["_yy"].to_numpy() - 2 * (c * ty[:, :size]).sum(axis=1) + np.einsum("gi,gij,gj->g", c, matrix[:, :size, :size], c)
                p = np.full((len(batch), most + 1), np.nan)
                p[:, :size] = c @ to_powers[:size, :size]
                p[:, 0] += batch["_middle"].to_numpy()
                out = batch[list(by)].assign(degree=degree, rows=batch["_n"], low=batch["_low"], high=batch["_high"], rss=rss)
                yield out.assign(**dict(zip(powers, p.T)))

    return sums.mapInPandas(solve, schema)


def polynomial_at(x: Column | str, degree: int) -> Column:
    """The value at x of a row of ``fit_polynomial_groups`` (columns low, high, power_0...)."""
    t = _unit(column(x), F.col("low"), F.col("high"))
    return reduce(lambda value, k: value * t + F.coalesce(F.col(f"power_{k}"), F.lit(0.0)), reversed(range(degree)), F.coalesce(F.col(f"power_{degree}"), F.lit(0.0)))
