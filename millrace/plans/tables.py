"""Projections, filters, scalar functions, splits, sorts, aggregates and error measures."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import scalars
from millrace.operators import series, stats, tables
from millrace.operators.regression import with_prediction
from millrace.operators.signals import with_grid
from millrace.operators.smoothing import with_changes
from millrace.plans.registry import cents, load, query, rounded
from millrace.plans.sources import CLOCK, SQL_CLOCK
from millrace.session import scratch_path


# --- projections and filters -----------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders")
def proj_columns(spark, folder):
    return load(spark, folder, "orders").select("o_orderkey", "o_totalprice")


@query("SELECT 1.0::DOUBLE AS constant, l_quantity, l_discount, l_extendedprice FROM lineitem")
def design_matrix(spark, folder):
    return tables.design_matrix(load(spark, folder, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice")


@query("SELECT p_partkey, p_retailprice, p_retailprice AS label FROM part")
def label_alias(spark, folder):
    return load(spark, folder, "part", "p_partkey", "p_retailprice").withColumn("label", F.col("p_retailprice"))


@query(
    """SELECT l_quantity AS power_1, pow(l_quantity, 2) AS power_2, pow(l_quantity, 3) AS power_3,
              l_extendedprice AS price FROM lineitem"""
)
def poly_with_target(spark, folder):
    powers = tables.with_powers(load(spark, folder, "lineitem"), "l_quantity", 3, lowest=1)
    names = [c for c in powers.columns if c.startswith("power_")]
    return powers.select(*names, F.col("l_extendedprice").alias("price"))


# The weekdays of the first three weeks of the month that the events cover.
TRADING_DAYS = [f"202401{d:02d}" for d in (2, 3, 4, 5, 8, 9, 10, 11, 12, 15, 16, 17, 18, 19)]


@query(
    f"""SELECT substr(date, 1, 8) AS day, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS value_cents
        FROM (SELECT {SQL_CLOCK} AS date, value FROM events)
        WHERE substr(date, 1, 8) IN ({", ".join(f"'{d}'" for d in TRADING_DAYS)}) GROUP BY 1"""
)
def filter_day_prefix(spark, folder):
    """Days by ranges of the time itself, which the scan can skip by."""
    ticks = load(spark, folder, "events", "ts", "value").where(scalars.on_days("ts", TRADING_DAYS))
    days = ticks.groupBy(F.date_format("ts", "yyyyMMdd").alias("day"))
    return days.agg(F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("value_cents"))


@query(
    f"""SELECT substr(date, 1, 8) AS day, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS value_cents
        FROM (SELECT {SQL_CLOCK} AS date, value FROM events)
        WHERE substr(date, 1, 8) IN ({", ".join(f"'{d}'" for d in TRADING_DAYS)}) GROUP BY 1"""
)
def filter_day_text(spark, folder):
    """The same from a file that holds the time as text, where prefixes reach the scan."""
    path = scratch_path(spark, "texts")
    load(spark, folder, "events", F.date_format("ts", CLOCK).alias("date"), "value").write.parquet(path)
    wanted = reduce(lambda a, b: a | b, [scalars.starts_with_day("date", day) for day in TRADING_DAYS])
    days = spark.read.parquet(path).where(wanted).groupBy(F.substring("date", 1, 8).alias("day"))
    return days.agg(F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("value_cents"))


@query("SELECT count(*) AS n FROM labels WHERE quality = toxic")
def count_equal(spark, folder):
    return load(spark, folder, "labels").agg(F.count_if(F.col("quality") == F.col("toxic")).alias("n"))


@query(
    """SELECT event_id, value, idx FROM (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx
       FROM events) WHERE idx % 100 = 0"""
)
def every_nth(spark, folder):
    ticks = load(spark, folder, "events", "event_id", "ts", "value")
    return series.every_nth(ticks, 100, ["ts", "event_id"]).select("event_id", "value", "idx")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx FROM orders")
def row_index(spark, folder):
    orders = load(spark, folder, "orders", "o_orderkey", "o_orderdate")
    return series.with_position(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "idx")


@query(
    """SELECT low, high, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS value_cents
       FROM events, (VALUES (0.0::DOUBLE), (10.0), (50.0)) AS a(low), (VALUES (100.0::DOUBLE), (200.0), (500.0)) AS b(high)
       WHERE value >= low AND value < high GROUP BY low, high"""
)
def grid_cross(spark, folder):
    axes = {"low": [0.0, 10.0, 50.0], "high": [100.0, 200.0, 500.0]}
    inside = with_grid(load(spark, folder, "events", "value"), axes, lambda p: (F.col("value") >= p["low"]) & (F.col("value") < p["high"]))
    return inside.groupBy("low", "high").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("value_cents")
    )


# --- sorts, limits, splits -------------------------------------------------------------------------------------


@query(
    """SELECT p_partkey, p_size, p_retailprice, row_number() OVER (ORDER BY p_size, p_retailprice, p_partkey) - 1 AS rank
       FROM part"""
)
def sort_two_keys(spark, folder):
    parts = load(spark, folder, "part", "p_partkey", "p_size", "p_retailprice")
    return series.with_position(parts, ["p_size", "p_retailprice", "p_partkey"], name="rank")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def first_n(spark, folder):
    return series.first_rows(load(spark, folder, "orders", "o_orderkey", "o_totalprice"), 10, ["o_totalprice", "o_orderkey"])


def split_sql(bounds: dict[str, int], seed: int) -> str:
    names = list(bounds)
    cases = " ".join(f"WHEN slot < {bounds[n]} THEN '{n}'" for n in names[:-1])
    return f"""SELECT split, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM (
        SELECT o_orderkey, CASE {cases} ELSE '{names[-1]}' END AS split FROM (
          SELECT o_orderkey, ('0x' || substr(md5(o_orderkey || '#{seed}'), 1, 8))::BIGINT % 10000 AS slot FROM orders))
        GROUP BY split"""


def _split_counts(spark, folder, weights, seed):
    marked = tables.with_split(load(spark, folder, "orders", "o_orderkey"), "o_orderkey", weights, seed)
    return marked.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query(split_sql({"train": 6000, "test": 10000}, 1234))
def split_two(spark, folder):
    return _split_counts(spark, folder, {"train": 0.6, "test": 0.4}, 1234)


@query(split_sql({"set_1": 2500, "set_2": 5000, "set_3": 7500, "set_4": 10000}, 0))
def split_quarters(spark, folder):
    return _split_counts(spark, folder, tables.QUARTERS, 0)


@query(split_sql({"train": 4500, "validation": 9000, "test": 10000}, 1))
def split_three(spark, folder):
    return _split_counts(spark, folder, tables.TRAIN_VALIDATE_TEST, 1)


# --- scalar functions ------------------------------------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_quantity * l_quantity AS rooms_squared, l_quantity * l_linenumber AS rooms_by_baths,
              round(ln(l_extendedprice), 9) AS log_area, l_discount + l_tax AS lat_plus_long FROM lineitem"""
)
def house_features(spark, folder):
    houses = tables.with_house_features(
        load(spark, folder, "lineitem"), "l_quantity", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"
    )
    columns = ["l_orderkey", "rooms_squared", "rooms_by_baths", "log_area", "lat_plus_long"]
    return rounded(houses.select(*columns), 9, "log_area")


@query(
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"pow(l_quantity, {p}) AS power_{p}" for p in range(6))
    + " FROM lineitem"
)
def poly_features(spark, folder):
    rows = load(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    return tables.with_powers(rows, "l_quantity", 5).drop("l_quantity")


@query(
    """SELECT p_partkey, abs(p_size - 25) AS distance, round(exp(-p_size / 10.0::DOUBLE), 9) AS decay,
              round(sqrt(p_retailprice), 9) AS root, round(p_retailprice)::BIGINT AS whole FROM part"""
)
def math_scalars(spark, folder):
    return load(spark, folder, "part").select(
        "p_partkey",
        F.abs(F.col("p_size") - 25).alias("distance"),
        F.round(F.exp(-F.col("p_size") / 10.0), 9).alias("decay"),
        F.round(F.sqrt("p_retailprice"), 9).alias("root"),
        F.round("p_retailprice").cast("bigint").alias("whole"),
    )


@query(
    """SELECT event_id, epoch_us(ts) // 1000 AS millis, epoch_us(ts) // 60000000 AS minute, epoch_us(ts) // 3600000000 AS hour
       FROM events"""
)
def epoch_buckets(spark, folder):
    return load(spark, folder, "events").select(
        "event_id",
        scalars.epoch_millis("ts").alias("millis"),
        scalars.epoch_bucket("ts", 60).alias("minute"),
        scalars.epoch_bucket("ts", 3600).alias("hour"),
    )


@query("SELECT event_id, epoch_ms(date_trunc('second', ts)) AS millis FROM events")
def parse_ts_ms(spark, folder):
    text = load(spark, folder, "events", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"))
    return text.select("event_id", scalars.parse_millis("text").alias("millis"))


@query(
    """SELECT event_id, day, (millis - min(millis) OVER (PARTITION BY day)) // 60000 AS minutes FROM (
         SELECT event_id, strftime(ts, '%Y%m%d') AS day, epoch_us(ts) // 1000 AS millis FROM events)"""
)
def minutes_since_open(spark, folder):
    text = load(spark, folder, "events", "event_id", F.date_format("ts", CLOCK).alias("text"))
    return stats.minutes_since_open(text, "text", CLOCK).select("event_id", "day", "minutes")


@query(
    """SELECT p_partkey, string_split(trim(p_name), ' ')[1] AS first_word, len(string_split(trim(p_name), ' ')) AS words,
              starts_with(p_brand, 'Brand#1') AS starts, try_cast(substr(p_brand, 7) AS DOUBLE) AS brand_number,
              try_cast(p_name AS BIGINT) AS no_number FROM part"""
)
def string_scalars(spark, folder):
    words = scalars.tokens("p_name")
    return load(spark, folder, "part").select(
        "p_partkey",
        words[0].alias("first_word"),
        F.size(words).cast("bigint").alias("words"),
        F.col("p_brand").startswith("Brand#1").alias("starts"),
        F.substring("p_brand", 7, 10).try_cast("double").alias("brand_number"),
        F.col("p_name").try_cast("bigint").alias("no_number"),
    )


@query(
    """SELECT p_partkey, '[' || replace(trim(p_name), ' ', ',') || ']' AS items,
              p_partkey || chr(9) || p_size AS joined FROM part"""
)
def format_itemset(spark, folder):
    return load(spark, folder, "part").select(
        "p_partkey",
        scalars.bracketed(scalars.tokens("p_name")).alias("items"),
        scalars.joined_row(["p_partkey", "p_size"]).alias("joined"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, (1.5::DECIMAL(18,6) * l_quantity::DECIMAL(18,6)
              + 0.25::DECIMAL(18,6) * l_discount::DECIMAL(18,6))::DECIMAL(38,10) AS score FROM lineitem"""
)
def decimal_dot(spark, folder):
    score = scalars.exact_weighted_sum({"l_quantity": "1.5", "l_discount": "0.25"})
    return load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", score.alias("score"))


@query(
    """SELECT l_orderkey, l_linenumber, 1.5::DOUBLE + (0.25::DOUBLE * l_quantity + 0.5::DOUBLE * l_discount) AS predicted
       FROM lineitem"""
)
def predict_dot(spark, folder):
    rows = load(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    predicted = with_prediction(rows, {"constant": 1.5, "l_quantity": 0.25, "l_discount": 0.5})
    return predicted.drop("l_quantity", "l_discount")


@query("SELECT p_partkey, round(pow(p_retailprice / 1000, 3), 9) AS cubed FROM part")
def apply_lambda(spark, folder):
    cubed = scalars.apply_vectorised(lambda s: (s / 1000) ** 3, "double", "p_retailprice")
    return load(spark, folder, "part", "p_partkey", "p_retailprice").select("p_partkey", F.round(cubed, 9).alias("cubed"))


@query("SELECT l_orderkey, l_linenumber, l_quantity AS v0, l_discount AS v1, l_tax AS v2 FROM lineitem")
def assemble_vector(spark, folder):
    vectors = tables.with_vectors(load(spark, folder, "lineitem"), {"features": ["l_quantity", "l_discount", "l_tax"]})
    values = vectors.select("l_orderkey", "l_linenumber", vector_to_array("features").alias("v"))
    return values.select("l_orderkey", "l_linenumber", *[F.col("v")[i].alias(f"v{i}") for i in range(3)])


# --- aggregates ------------------------------------------------------------------------------------------------


def bars_sql(unit: str) -> str:
    return f"""SELECT date_trunc('{unit}', ts) AS bar, avg(round(value * 100)::BIGINT) AS mean, count(*) AS ticks
               FROM events GROUP BY 1"""


@query(bars_sql("minute"))
def bars_minute(spark, folder):
    return stats.time_bars(load(spark, folder, "events"), "ts", cents("value"), "minute")


@query(bars_sql("hour"))
def bars_hour(spark, folder):
    return stats.time_bars(load(spark, folder, "events"), "ts", cents("value"), "hour")


@query(
    """SELECT date_trunc('hour', ts) AS bar, avg(CASE WHEN change > 0 THEN change END) AS mean_rise,
              avg(CASE WHEN change < 0 THEN change END) AS mean_fall FROM (
         SELECT ts, coalesce(c - lag(c) OVER (ORDER BY ts, event_id), 0) AS change FROM (
           SELECT ts, event_id, round(value * 100)::BIGINT AS c FROM events)) GROUP BY 1"""
)
def hourly_up_down(spark, folder):
    ticks = load(spark, folder, "events", "ts", "event_id", cents("value").alias("value"))
    changes = with_changes(series.with_position(ticks, ["ts", "event_id"]), "value")
    return stats.rises_and_falls(changes, F.date_trunc("hour", "ts").cast("timestamp_ntz"), "change")


@query(
    """SELECT count(*) AS minutes, count(*) // 60 // 24 AS days
       FROM (SELECT DISTINCT date_trunc('minute', ts) FROM events)"""
)
def span_days(spark, folder):
    return stats.span_in_days(load(spark, folder, "events"), "ts")


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
            min({c}) AS min, max({c}) AS max FROM lineitem"""
        for c in DESCRIBED
    )
)
def describe_features(spark, folder):
    return rounded(stats.summary(load(spark, folder, "lineitem"), DESCRIBED), 6, "mean", "stddev")


def _priced(spark, folder):
    """Prices in thousands with a fixed linear guess."""
    rows = load(spark, folder, "lineitem", (F.col("l_extendedprice") / 1000).alias("price"), "l_quantity", "l_discount")
    return with_prediction(rows, {"constant": 5.0, "l_quantity": 1.5})


PRICED = "(SELECT l_extendedprice / 1000 AS price, 5.0::DOUBLE + 1.5::DOUBLE * l_quantity AS predicted FROM lineitem)"


@query(f"SELECT round(sum(pow(price - predicted, 2)), 2) AS rss FROM {PRICED}")
def rss(spark, folder):
    return rounded(stats.fit_errors(_priced(spark, folder), "price", "predicted").select("rss"), 2, "rss")


@query(f"SELECT round(avg(pow(price - predicted, 2)), 6) AS mse FROM {PRICED}")
def mse(spark, folder):
    return rounded(stats.fit_errors(_priced(spark, folder), "price", "predicted").select("mse"), 6, "mse")


@query(f"SELECT round(sqrt(avg(pow(price - predicted, 2))), 6) AS rmse FROM {PRICED}")
def rmse(spark, folder):
    return rounded(stats.fit_errors(_priced(spark, folder), "price", "predicted").select("rmse"), 6, "rmse")


def gradient_sql(l2: float) -> str:
    return f"""WITH e AS (SELECT l_quantity AS x, l_discount AS d,
                   l_extendedprice / 1000 - (5.0::DOUBLE + 1.5::DOUBLE * l_quantity + 2.0::DOUBLE * l_discount) AS err FROM lineitem),
               p AS (SELECT -2 * sum(err) AS p0, -2 * sum(err * x) + {2 * l2 * 1.5} AS p1,
                   -2 * sum(err * d) + {2 * l2 * 2.0} AS p2 FROM e),
               m AS (SELECT *, round(sqrt(p0 * p0 + p1 * p1 + p2 * p2), 3) AS magnitude FROM p)
               SELECT 'constant' AS term, round(p0, 3) AS partial, magnitude FROM m
               UNION ALL SELECT 'l_quantity', round(p1, 3), magnitude FROM m
               UNION ALL SELECT 'l_discount', round(p2, 3), magnitude FROM m"""


def _gradient(spark, folder, l2):
    rows = load(spark, folder, "lineitem", "l_quantity", "l_discount", (F.col("l_extendedprice") / 1000).alias("price"))
    design = tables.design_matrix(rows, ["l_quantity", "l_discount"], "price")
    weights = {"constant": 5.0, "l_quantity": 1.5, "l_discount": 2.0}
    return rounded(stats.gradient(design, "price", weights, l2), 3, "partial", "magnitude")


@query(gradient_sql(0.0))
def gradient_once(spark, folder):
    return _gradient(spark, folder, 0.0)


@query(gradient_sql(100.0))
def ridge_gradient(spark, folder):
    return _gradient(spark, folder, 100.0)


@query("SELECT count(*) AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS total_cents FROM orders")
def sum_count(spark, folder):
    orders = load(spark, folder, "orders", "o_totalprice")
    return orders.agg(F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("total_cents"))


@query(
    """SELECT count(*) AS rows, count(*) FILTER (WHERE quality = toxic) AS equal,
              avg(CASE WHEN quality = toxic THEN 1.0::DOUBLE ELSE 0.0 END) AS accuracy FROM labels"""
)
def accuracy(spark, folder):
    return stats.accuracy(load(spark, folder, "labels"), "toxic", "quality")
