"""Time bars, summaries, error measures and gradients: each is one aggregation over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import column, total, weighted_sum
from millrace.operators.series import if_small, match_on
from millrace.session import stage


def time_bars(
    df: DataFrame, ts: str, value: Column | str, unit: str, by: Sequence[str] = (), bar: str = "bar", output: str = "mean"
) -> DataFrame:
    """Mean value per calendar ``unit``, with the number of ticks in it; empty bars are not filled."""
    start = F.date_trunc(unit, F.col(ts)).cast(df.schema[ts].dataType)
    return df.groupBy(*by, start.alias(bar)).agg(F.avg(column(value)).alias(output), F.count(F.lit(1)).alias("ticks"))


def rises_and_falls(df: DataFrame, bar: Column, change: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean positive and mean negative change per bar; NULL where there is none."""
    return df.groupBy(*by, bar.alias("bar")).agg(
        F.avg(F.when(F.col(change) > 0, F.col(change))).alias("mean_rise"),
        F.avg(F.when(F.col(change) < 0, F.col(change))).alias("mean_fall"),
    )


def span_in_days(df: DataFrame, ts: str) -> DataFrame:
    """Whole days that the minutes with ticks would fill.

    Minutes are first reduced to distinct ones, so no task sees more than its share of them.
    """
    minutes = df.select(F.date_trunc("minute", F.col(ts)).alias("minute")).distinct()
    n = F.count(F.lit(1))
    return minutes.agg(n.alias("minutes"), F.floor(F.floor(n / 60) / 24).alias("days"))


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column, from one pass."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).cast("double").alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def fit_errors(df: DataFrame, actual: str, predicted: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Residual sum of squares, mean squared error and its root."""
    square = F.pow(F.col(actual) - column(predicted), F.lit(2.0))
    return df.groupBy(*by).agg(
        F.sum(square).alias("rss"), F.avg(square).alias("mse"), F.sqrt(F.avg(square)).alias("rmse")
    )


def gradient(
    df: DataFrame, target: str, weights: Mapping[str, float], l2: float = 0.0, constant: str = "constant"
) -> DataFrame:
    """Partial derivatives of the squared error at ``weights``, plus the length of the gradient.

    A penalty ``l2 * w**2`` applies to every term except the constant.
    """
    error = F.col(target) - weighted_sum(weights)
    partials = [
        F.struct(
            F.lit(term).alias("term"),
            (-2 * F.sum(error * F.col(term)) + F.lit(0.0 if term == constant else 2 * l2 * w)).alias("partial"),
        )
        for term, w in weights.items()
    ]
    row = df.agg(F.array(*partials).alias("partials"))
    squares = total([F.pow(F.col("partials")[i]["partial"], F.lit(2.0)) for i in range(len(partials))])
    return row.select(F.sqrt(squares).alias("magnitude"), F.inline("partials"))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows, agreeing rows and their share."""
    same = F.col(actual) == F.col(predicted)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(same).alias("equal"),
        F.avg(same.cast("double")).alias("accuracy"),
    )


def minutes_since_open(df: DataFrame, text: str, pattern: str, day: str = "day", output: str = "minutes") -> DataFrame:
    """Whole minutes since the first tick of the same day, for text times that begin with ``yyyyMMdd``.

    The first ticks are one row per day, counted before they are broadcast, so that no day has to fit into one task.
    Text that is NULL or no time keeps its row, with NULL minutes.
    """
    timed = df.withColumns(
        {day: F.substring(text, 1, 8), "_millis": F.unix_millis(F.try_to_timestamp(F.col(text), F.lit(pattern)))}
    )
    opened = stage(timed.groupBy(day).agg(F.min("_millis").alias("_open")))
    minutes = F.floor((F.col("_millis") - F.col("_open")) / 60_000)
    return match_on(timed, if_small(opened), [day], "left").withColumn(output, minutes).drop("_millis", "_open")
