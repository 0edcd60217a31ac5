"""Every registered query against its SQL; series queries also with all series cut into stretches."""

import math
import random

import duckdb
import pytest

import __spark_entry__ as entry
from check import compare, connect

FOLDER = "/root/testdata/sf0.001"
SERIES = sorted(
    name for name, build in entry.queries().items()
    if build.__module__.endswith("series")
) + ["every_nth", "row_index", "sort_two_keys", "hourly_up_down", "freq_sequences_grown"]


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, duck, sql) == ""


@pytest.mark.parametrize("name", SERIES)
def test_query_on_cut_series(spark, duck, cut, name):
    assert compare(entry.queries()[name](spark, FOLDER), duck, entry.oracle_sql()[name]) == ""


def test_log_returns_of_free_and_negative_prices(spark, tmp_path):
    """Users that trade at 0, at negative prices and at none, against the SQL: all kinds of returns come up."""
    rng = random.Random(3)
    prices = {1: lambda: 0.0 if rng.random() < 0.3 else rng.expovariate(0.02), 2: lambda: rng.gauss(40, 20), 3: lambda: rng.expovariate(0.02)}
    rows = [(20 * user + i, i, user, prices[1 + user % 3]()) for user in range(90) for i in range(20)]
    rows = [(*r[:3], None if r[2] % 4 == 0 and r[1] == 9 else r[3]) for r in rows]
    events = spark.createDataFrame(rows, "event_id bigint, t bigint, user_id bigint, value double")
    events.selectExpr("event_id", "CAST(timestamp_seconds(t) AS timestamp_ntz) AS ts", "user_id", "value").write.parquet(f"{tmp_path}/events.parquet")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    df = entry.queries()["strategy_log_return"](spark, str(tmp_path))
    returns = [r.log_return for r in df.collect()]
    assert {-math.inf, math.inf} <= set(returns)
    assert any(map(math.isnan, returns)) and sum(map(math.isfinite, returns)) > 40
    assert compare(df, connection, entry.oracle_sql()["strategy_log_return"]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["idx", "v", "fast", "middle", "slow", "regime"]
    assert df.count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
