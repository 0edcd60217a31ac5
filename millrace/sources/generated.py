"""Tables from literal rows and generated series."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import column, polynomial

# Coefficients of the example polynomial, constant term first, and the level added to its values.
EXAMPLE_POLYNOMIAL = (
    1.0,
    -4524702943 / 22898836800,
    4799080868 / 4174267125,
    -1655323100983 / 64116743040000,
    175076509 / 929228160000,
    -114943399 / 256466972160000,
)
EXAMPLE_LEVEL = 1200.0


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


#: Hexadecimal digits of a hash that make a uniform number, whose 52 bits a double holds exactly.
_DIGITS = 13


def uniform(x: Column | str, seed: int = 0, stream: int = 0) -> Column:
    """A number in [0, 1) that depends on (seed, stream, x) alone, not on plan, partition or order; equal x, equal numbers.

    ``x`` is a whole number, or text. Streams of one seed are independent of each other.
    """
    key = F.concat(F.lit(f"{seed}:{stream}:"), column(x).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, _DIGITS), 16, 10).cast("double") / F.lit(float(16**_DIGITS))


def normal(x: Column | str, seed: int = 0, stream: int = 0) -> Column:
    """A standard normal number of (seed, stream, x), from two uniform ones."""
    radius = F.sqrt(-2 * F.log(1 - uniform(x, seed, 2 * stream)))
    return radius * F.cos(2 * math.pi * uniform(x, seed, 2 * stream + 1))


def whole_noise(x: Column | str, low: int, count: int, seed: int = 0, stream: int = 0) -> Column:
    """One of the whole numbers low .. low + count - 1."""
    return F.floor(uniform(x, seed, stream) * count) + low


def polynomial_columns(
    x: Column | str,
    coefficients: Sequence[float] = EXAMPLE_POLYNOMIAL,
    level: float = EXAMPLE_LEVEL,
    noise: float = 0.0,
    seed: int = 0,
) -> list[Column]:
    """``const, x, x2 .. xn, y`` where y is the polynomial, raised by up to the share ``noise`` of itself, plus ``level``.

    The noise of a row follows from its x and the seed, so any plan makes the same table.
    """
    key = column(x)
    x = key.cast("double")
    value = polynomial(x, coefficients)
    if noise:
        value = value * (1 + uniform(key, seed) * noise)
    powers = [F.pow(x, F.lit(float(p))).alias(f"x{p}") for p in range(2, len(coefficients))]
    return [F.lit(1.0).alias("const"), x.alias("x"), *powers, (value + level).alias("y")]


def polynomial_series(spark: SparkSession, rows: int = 200, noise: float = 0.1, seed: int = 0, **shape) -> DataFrame:
    """The example polynomial at x = 1 .. rows."""
    return spark.range(1, rows + 1).select(*polynomial_columns("id", noise=noise, seed=seed, **shape))


def sine_columns(x: Column | str, seed: int = 0, spread: int = 100) -> list[Column]:
    """``const, x, y``: a sine on a parabola with whole noise around 0, ``spread`` values wide."""
    key = column(x)
    x = key.cast("double")
    value = F.sin(x) + x * x / 100 + whole_noise(key, -spread // 2, spread, seed)
    return [F.lit(1.0).alias("const"), x.alias("x"), value.alias("y")]


def sine_series(spark: SparkSession, first: int = 10, last: int = 1000, seed: int = 0) -> DataFrame:
    return spark.range(first, last + 1).select(*sine_columns("id", seed))
