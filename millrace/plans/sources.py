"""Round trips through file formats: a table is written to the shared folder and read back by the operator."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.plans.registry import load, query, rounded
from millrace.session import scratch_path
from millrace.sources import files, generated

PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
CLOCK = "yyyyMMdd HHmmssSSS"
SQL_CLOCK = "strftime(ts, '%Y%m%d %H%M%S') || strftime(ts, '%g')"


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def src_csv_typed(spark, folder):
    path = files.write_csv(load(spark, folder, "part"), scratch_path(spark, "part"))
    return files.read_csv(spark, path, PART)


@query(f"SELECT {SQL_CLOCK} AS date, value AS label FROM events")
def src_csv_headerless(spark, folder):
    lines = load(spark, folder, "events", F.date_format("ts", CLOCK).alias("date"), "value")
    path = files.write_csv(lines, scratch_path(spark, "currency"), header=False)
    return files.read_currency_ticks(spark, path)


@query(
    """SELECT to_timestamp(epoch_s)::TIMESTAMP AS ts, value AS price FROM (
         SELECT epoch_us(ts) // 1000000 AS epoch_s, value FROM events ORDER BY 1, 2 LIMIT 300)"""
)
def src_ticks_head(spark, folder):
    """The first ticks are the feature; fewer than any table has, so that the limit shows."""
    return files.read_ticks(spark, _ticks_file(spark, folder), first=300)


@query("SELECT to_timestamp(epoch_us(ts) // 1000000)::TIMESTAMP AS ts, value AS price FROM events")
def src_ticks(spark, folder):
    return files.read_ticks(spark, _ticks_file(spark, folder))


def _ticks_file(spark, folder):
    lines = load(spark, folder, "events", F.unix_seconds(F.col("ts").cast("timestamp")), "value")
    return files.write_csv(lines, scratch_path(spark, "ticks"), header=False)


@query(
    """SELECT item, count(*) AS n FROM (SELECT unnest(string_split(trim(p_name), ' ')) AS item FROM part)
       GROUP BY item"""
)
def src_text_tokens(spark, folder):
    path = scratch_path(spark, "names")
    load(spark, folder, "part", F.concat(F.lit(" "), "p_name").alias("value")).write.text(path)
    items = files.read_tokens(spark, path).select(F.explode("items").alias("item"))
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT label::DOUBLE AS label, count(*) AS n, round(sum(embedding[1]::DOUBLE), 6) AS first_sum,
              round(sum(list_sum(embedding::DOUBLE[])), 6) AS total
       FROM embeddings GROUP BY label"""
)
def src_libsvm(spark, folder):
    path = files.write_libsvm(load(spark, folder, "embeddings"), scratch_path(spark, "vectors"), "label", "embedding")
    values = files.read_libsvm(spark, path, 64).select("label", vector_to_array("features").alias("v"))
    row_total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    sums = values.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v")[0]).alias("first_sum"), F.sum(row_total).alias("total")
    )
    return rounded(sums, 6, "first_sum", "total")


@query(
    """SELECT p_partkey AS key, p_name AS name,
              CASE p_size % 3 WHEN 1 THEN p_brand WHEN 2 THEN p_type || ', ' || p_brand END AS comment,
              CASE WHEN p_size % 3 = 2 THEN 'x' END AS blank
       FROM part"""
)
def src_csv_ragged(spark, folder):
    """Short rows, quoted fields with commas, empty last fields and blank lines in one file."""
    key = F.col("p_partkey").cast("string")
    kind = F.col("p_size") % 3
    short = F.concat_ws(",", key, "p_name")
    open_end = F.format_string('%s,"%s","%s",', key, "p_name", "p_brand")
    quoted = F.format_string('%s,%s,"%s, %s",x', key, "p_name", "p_type", "p_brand")
    line = F.when(kind == 0, short).when(kind == 1, open_end).otherwise(quoted)
    lines = F.when(F.col("p_size") % 5 == 0, F.array(line, F.lit(""))).otherwise(F.array(line))
    path = scratch_path(spark, "ragged")
    load(spark, folder, "part").select(F.explode(lines).alias("value")).write.text(path)
    return files.read_csv(spark, path, "key bigint, name string, comment string, blank string", header=False)


@query("SELECT p_brand, count(*) AS n, sum(p_partkey)::BIGINT AS key_sum FROM part GROUP BY p_brand")
def sink_csv_parts(spark, folder):
    parts = load(spark, folder, "part").repartition(4)
    path = files.write_csv(parts, scratch_path(spark, "columns"), ["p_partkey", "p_brand"])
    back = files.read_csv(spark, path, "p_partkey bigint, p_brand string")
    return back.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("key_sum"))


@query(
    """SELECT rank, urgent, count(*) AS orders FROM orders JOIN (VALUES ('1-URGENT', 1, true), ('2-HIGH', 2, true),
         ('3-MEDIUM', 3, false), ('4-NOT SPECIFIED', 4, false), ('5-LOW', 5, false)) AS p(priority, rank, urgent)
       ON o_orderpriority = priority GROUP BY rank, urgent"""
)
def src_literal_rows(spark, folder):
    rows = [
        ("1-URGENT", 1, True),
        ("2-HIGH", 2, True),
        ("3-MEDIUM", 3, False),
        ("4-NOT SPECIFIED", 4, False),
        ("5-LOW", 5, False),
    ]
    ranks = generated.literal_rows(spark, rows, "o_orderpriority string, rank int, urgent boolean")
    # Five literal rows: a broadcast of fixed size.
    ranked = load(spark, folder, "orders", "o_orderpriority").join(F.broadcast(ranks), "o_orderpriority")
    return ranked.groupBy("rank", "urgent").agg(F.count(F.lit(1)).alias("orders"))


@query(
    """SELECT 1.0::DOUBLE AS const, x, pow(x, 2) AS x2, pow(x, 3) AS x3, pow(x, 4) AS x4, pow(x, 5) AS x5,
              round(-(114943399.0::DOUBLE / 256466972160000) * pow(x, 5) + (175076509.0::DOUBLE / 929228160000) * pow(x, 4)
              - (1655323100983.0::DOUBLE / 64116743040000) * pow(x, 3) + (4799080868.0::DOUBLE / 4174267125) * pow(x, 2)
              - (4524702943.0::DOUBLE / 22898836800) * x + 1 + 1200, 6) AS y, count(*) AS rows
       FROM (SELECT l_quantity AS x FROM lineitem) GROUP BY x"""
)
def gen_poly_series(spark, folder):
    columns = generated.polynomial_columns("l_quantity")
    rows = load(spark, folder, "lineitem", "l_quantity").groupBy("l_quantity").agg(F.count(F.lit(1)).alias("rows"))
    return rounded(rows.select(*columns, "rows"), 6, "y")


def _sorted_ticks_file(spark, folder):
    """Ticks by their price, so that the order of the file is not that of time."""
    ticks = load(spark, folder, "events", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"), "value", "event_id")
    return files.write_csv(ticks.orderBy("value", "event_id").drop("event_id"), scratch_path(spark, "lines"), header=False)


FILE_ORDER = "SELECT row_number() OVER (ORDER BY value, event_id) - 1 AS line, to_timestamp(epoch_us(ts) // 1000000)::TIMESTAMP AS ts, value AS price FROM events"


@query(f"SELECT * FROM ({FILE_ORDER}) WHERE line < 300")
def src_ticks_first_lines(spark, folder):
    """The first lines of a file are the feature."""
    return files.read_tick_lines(spark, _sorted_ticks_file(spark, folder), first=300)


@query(FILE_ORDER)
def src_line_numbers(spark, folder):
    return files.read_tick_lines(spark, _sorted_ticks_file(spark, folder))


@query(
    """SELECT key, name, price, reason, lost, rejected FROM (
         SELECT CASE k WHEN 4 THEN p_partkey || ',"' || p_name || ',1' WHEN 1 THEN p_partkey || ',' || p_name
             WHEN 2 THEN p_partkey || ',"' || p_name || ', x",free' WHEN 3 THEN p_partkey || ',' || p_name || ',2.5,more' END AS rejected,
           p_partkey AS key, CASE k WHEN 4 THEN NULL WHEN 2 THEN p_name || ', x' ELSE p_name END AS name,
           CASE k WHEN 0 THEN 0.5::DOUBLE WHEN 3 THEN 2.5::DOUBLE END AS price,
           CASE k WHEN 1 THEN 'short' WHEN 2 THEN 'type' WHEN 3 THEN 'long' WHEN 4 THEN 'quotes' END AS reason,
           (CASE k WHEN 0 THEN 0 WHEN 4 THEN 2 ELSE 1 END)::INT AS lost
         FROM (SELECT *, p_size % 5 AS k FROM part))"""
)
def src_csv_rejects(spark, folder):
    """Good lines, short and long ones, a price that is no number, and quotes that are never closed."""
    key, kind = F.col("p_partkey").cast("string"), F.col("p_size") % 5
    line = (
        F.when(kind == 0, F.concat_ws(",", key, "p_name", F.lit("0.5")))
        .when(kind == 1, F.concat_ws(",", key, "p_name"))
        .when(kind == 2, F.format_string('%s,"%s, x",free', key, "p_name"))
        .when(kind == 3, F.concat_ws(",", key, "p_name", F.lit("2.5"), F.lit("more")))
        .otherwise(F.format_string('%s,"%s,1', key, "p_name"))
    )
    path = scratch_path(spark, "rejects")
    load(spark, folder, "part").select(line.alias("value")).write.text(path)
    return files.read_csv_rejects(spark, path, "key bigint, name string, price double")


def uniform_sql(x: str, seed: int, stream: int = 0) -> str:
    return f"(('0x' || substr(md5('{seed}:{stream}:' || {x}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


@query(
    f"""SELECT x::DOUBLE AS x, round((-(114943399.0::DOUBLE / 256466972160000) * pow(x, 5) + (175076509.0::DOUBLE / 929228160000) * pow(x, 4)
              - (1655323100983.0::DOUBLE / 64116743040000) * pow(x, 3) + (4799080868.0::DOUBLE / 4174267125) * pow(x, 2)
              - (4524702943.0::DOUBLE / 22898836800) * x + 1) * (1 + {uniform_sql('x', 5)} * 0.1::DOUBLE) + 1200, 6) AS y,
          round(sqrt(-2 * ln(1 - {uniform_sql('x', 5, 2)})) * cos(2 * pi() * {uniform_sql('x', 5, 3)}), 6) AS z, rows
        FROM (SELECT l_quantity::BIGINT * 8 + l_linenumber AS x, count(*) AS rows FROM lineitem GROUP BY 1)"""
)
def gen_noisy_series(spark, folder):
    """The polynomial with noise, and normal numbers, at the places that the lines give."""
    at = (F.col("l_quantity").cast("bigint") * 8 + F.col("l_linenumber")).alias("x")
    places = load(spark, folder, "lineitem", at).groupBy("x").agg(F.count(F.lit(1)).alias("rows"))
    columns = generated.polynomial_columns("x", noise=0.1, seed=5)
    return rounded(places.select(*columns, generated.normal("x", 5, 1).alias("z"), "rows").select("x", "y", "z", "rows"), 6, "y", "z")


@query(
    f"""SELECT 1.0::DOUBLE AS const, p_partkey::DOUBLE AS x,
          round(sin(p_partkey::DOUBLE) + p_partkey::DOUBLE * p_partkey / 100 + floor({uniform_sql('p_partkey', 9)} * 100) - 50, 6) AS y FROM part"""
)
def gen_sine_series(spark, folder):
    return rounded(load(spark, folder, "part", "p_partkey").select(*generated.sine_columns("p_partkey", seed=9)), 6, "y")
