"""The table of queries, and what their definitions share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the equivalent DuckDB statement if there is one."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load(spark: SparkSession, folder: str, table: str, *columns: str | Column) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df.select(*columns) if columns else df


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round computed columns, so that the order in which floats were added does not show."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def cents(column: str) -> Column:
    """Money with two decimals as a whole number, whose sums are exact."""
    return F.round(F.col(column) * 100).cast("bigint")
