"""Column expressions for times, text, decimals and weighted sums. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

EXACT = "decimal(38,10)"


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis(ts: Column | str) -> Column:
    return F.unix_millis(column(ts).cast("timestamp"))


def epoch_bucket(ts: Column | str, seconds: int) -> Column:
    """Whole buckets of ``seconds`` since the epoch (60 gives minutes, 3600 hours)."""
    return F.floor(F.unix_seconds(column(ts).cast("timestamp")) / F.lit(seconds))


def parse_millis(text: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to epoch milliseconds; text that does not fit the pattern gives NULL."""
    return F.unix_millis(F.try_to_timestamp(column(text), F.lit(pattern)))


def starts_with_day(text: Column | str, day: str) -> Column:
    """Does a ``yyyyMMdd...`` text fall on ``day``?"""
    return column(text).startswith(day)


def on_days(ts: str, days: Sequence[str]) -> Column:
    """Is the time on one of the days, given as ``yyyyMMdd``? Neighbouring days become one range."""
    ranges: list[tuple[date, date]] = []
    for day in sorted({datetime.strptime(d, "%Y%m%d").date() for d in days}):
        if ranges and ranges[-1][1] == day:
            ranges[-1] = (ranges[-1][0], day + timedelta(days=1))
        else:
            ranges.append((day, day + timedelta(days=1)))
    tests = [(F.col(ts) >= F.lit(datetime(*a.timetuple()[:3]))) & (F.col(ts) < F.lit(datetime(*b.timetuple()[:3]))) for a, b in ranges]
    return reduce(lambda a, b: a | b, tests)


def tokens(line: Column | str, separator: str = " ") -> Column:
    """The parts between literal separators, without blanks and control characters around the line."""
    bare = F.regexp_replace(column(line), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return F.split(bare, "\\Q" + separator.replace("\\E", "\\E\\\\E\\Q") + "\\E")


def bracketed(items: Column | str, separator: str = ",") -> Column:
    """An array as ``[a,b,c]``."""
    return F.concat(F.lit("["), F.array_join(column(items).cast("array<string>"), separator), F.lit("]"))


def joined_row(columns: Sequence[Column | str], separator: str = "\t") -> Column:
    return F.concat_ws(separator, *[column(c).cast("string") for c in columns])


def total(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """The dot product of named columns with fixed weights."""
    return total([F.lit(float(w)) * F.col(c) for c, w in weights.items()])


def exact_weighted_sum(weights: Mapping[str, str]) -> Column:
    """The same in decimal arithmetic; weights come as text so that no digit is lost."""
    return total([F.lit(w).cast("decimal(18,6)") * F.col(c).cast("decimal(18,6)") for c, w in weights.items()]).cast(EXACT)


def polynomial(x: Column | str, coefficients: Sequence[float]) -> Column:
    """``c0 + c1*x + c2*x**2 + ...`` by nested multiplication."""
    x = column(x)
    return reduce(lambda acc, c: acc * x + F.lit(float(c)), reversed(coefficients[:-1]), F.lit(float(coefficients[-1])))


def apply_vectorised(function: Callable, returns: str, *columns: Column | str) -> Column:
    """A user function over pandas Series, for what no built-in expression covers."""
    return pandas_udf(function, returns)(*[column(c) for c in columns])
