"""Readers and writers for CSV, text and libsvm files, with declared schemas."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import tokens
from millrace.operators.series import LENGTH, LONGEST, ROWS_PER_TASK, first_rows, if_small
from millrace.session import stage, stage_table

# The column names and types of a house-sales file, in file order.
HOUSE_SALES = (
    "id string, date string, price double, bedrooms double, bathrooms double, sqft_living double, sqft_lot int, "
    "floors string, waterfront int, view int, condition int, grade int, sqft_above int, sqft_basement int, "
    "yr_built int, yr_renovated int, zipcode string, lat double, long double, sqft_living15 double, sqft_lot15 double"
)
TICKS = "epoch_seconds bigint, price double"
CURRENCY_TICKS = "date string, label double"


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True) -> DataFrame:
    """CSV with a declared schema. Short rows are filled with NULL, blank lines are dropped."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_house_sales(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, HOUSE_SALES)


def read_ticks(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """Header-less ``epoch_seconds,price`` lines; ``first`` keeps the earliest so many."""
    # Further columns of a line are not declared, so they are not parsed.
    df = read_csv(spark, path, TICKS, header=False)
    df = df if first is None else first_rows(df, first, ["epoch_seconds", "price"])
    return df.select(F.timestamp_seconds("epoch_seconds").cast("timestamp_ntz").alias("ts"), "price")


def read_tick_lines(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """The same lines in the order of the file: line, ts, price. ``first`` keeps the first so many lines, whatever their times."""
    df = with_line_numbers(read_csv(spark, path, TICKS, header=False), first=first)
    return df.select("line", F.timestamp_seconds("epoch_seconds").cast("timestamp_ntz").alias("ts"), "price")


def with_line_numbers(read: DataFrame, name: str = "line", first: int | None = None) -> DataFrame:
    """Append to rows just read from files their 0-based place: files in the order of their paths, rows as they stand in a file.

    Each task counts the rows of the splits that it reads. Counts and rows are written once, as another job might cut the files
    otherwise; a row's place is then its place in its split and the number of rows in all splits before. Neither depends on how
    files were cut. With ``first`` a split hands on its first so many rows only, but counts all.
    """
    rows = read.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema.fields]
    schema = T.StructType([*fields, T.StructField("_place", T.LongType()), T.StructField("_counts", T.BooleanType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place = None, 0

        def total(like: pa.RecordBatch) -> pa.RecordBatch:
            empty = [pa.nulls(1, column.type) for column in like.columns[:-2]]
            return pa.RecordBatch.from_arrays([*empty, pa.array([at[0]]), pa.array([at[1]]), pa.array([place]), pa.array([True])], schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            files = batch.column("_file").dictionary_encode().indices.to_numpy()
            blocks = batch.column("_block").to_numpy()
            cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                key = batch.column("_file")[int(a)].as_py(), int(blocks[a])
                if key != at:
                    if at is not None:
                        yield total(batch)
                    at, place = key, 0
                some = int(b - a) if first is None else max(0, min(int(b - a), first - place))
                if some:
                    part = batch.slice(int(a), some)
                    places = pa.array(np.arange(place, place + some))
                    yield pa.RecordBatch.from_arrays([*part.columns, places, pa.array(np.zeros(some, bool))], schema.names)
                place += int(b - a)
            like = batch
        if at is not None:
            yield total(like)

    staged = stage_table(rows.mapInArrow(number, schema))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each split.
    splits = stage(
        staged.where("_counts").select("_file", "_block", F.coalesce(F.sum("_place").over(before), F.lit(0)).alias("_before"), F.col("_place").alias("_rows"))
    )
    longest = splits.agg(F.sum("_rows")).first()[0] or 0
    longest = longest if first is None else min(longest, first)
    placed = staged.where(~F.col("_counts")).join(if_small(splits.drop("_rows")), ["_file", "_block"])
    metadata = {LONGEST if longest <= ROWS_PER_TASK else LENGTH: longest}
    placed = placed.withColumn(name, (F.col("_before") + F.col("_place")).alias(name, metadata=metadata))
    placed = placed if first is None else placed.where(F.col(name) < first)
    return placed.select(*read.columns, name)


def read_csv_rejects(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = False) -> DataFrame:
    """CSV with its bad records told apart: the declared columns, ``rejected`` (the line as it stands, NULL for good ones),
    ``reason`` and ``lost`` (fields that the line has and the row has not, or the other way around).

    Reasons, of which the first that holds is given: ``quotes`` (a quotation mark that is never closed; the field that it opens
    and all later ones are lost), ``short`` and ``long`` (too few and too many fields), ``type`` (a field is no value of its
    column). Fields are counted on the line, without separators inside quotes; lines hold no escaped quotation marks.
    """
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*kinds.fields, T.StructField("_line", T.StringType())])
    reader = spark.read.schema(whole).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
    rows = reader.option("columnPruning", False).csv(path)
    line, n = F.col("_line"), len(kinds.fields)
    bare = F.regexp_replace(line, '"[^"]*"', "")

    def separators(text: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))

    opened = separators(F.substring_index(bare, '"', 1))  # fields in front of a quotation mark that is never closed
    have = separators(bare) + 1
    texts = F.from_csv(line, F.lit(", ".join(f"_{k} string" for k in range(n))))
    wrong = [(texts[f"_{k}"].isNotNull() & F.col(f"`{f.name}`").isNull()).cast("int") for k, f in enumerate(kinds.fields)]
    unread = reduce(lambda a, b: a + b, wrong)
    broken = F.contains(bare, F.lit('"'))
    reason = F.when(line.isNull(), None).when(broken, "quotes").when(have < n, "short").when(have > n, "long").otherwise("type")
    lost = F.when(line.isNull(), 0).when(broken, n - F.least(opened, F.lit(n))).otherwise(F.abs(have - n) + unread)
    kept = [F.when(line.isNull() | ~broken | (F.lit(k) < opened), F.col(f"`{f.name}`")).alias(f.name) for k, f in enumerate(kinds.fields)]
    return rows.select(*kept, line.alias("rejected"), reason.alias("reason"), lost.cast("int").alias("lost"))


def read_currency_ticks(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CURRENCY_TICKS, header=False)


def read_tokens(spark: SparkSession, path: str, separator: str = " ") -> DataFrame:
    """One array of tokens per text line."""
    return spark.read.text(path).select(tokens("value", separator).alias("items"))


def read_libsvm(spark: SparkSession, path: str, size: int) -> DataFrame:
    """Sparse ``label index:value`` lines as label and feature vector; ``size`` spares a scan for it."""
    return spark.read.format("libsvm").option("numFeatures", size).load(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, header: bool = True, mode: str = "error") -> str:
    """A folder of CSV parts, each with its own header line."""
    out = df.select(*columns) if columns else df
    out.write.mode(mode).option("header", header).csv(path)
    return path


def write_libsvm(df: DataFrame, path: str, label: str, features: str, mode: str = "error") -> str:
    """Label and feature array (or vector) in libsvm lines."""
    is_array = isinstance(df.schema[features].dataType, T.ArrayType)
    vector = array_to_vector(F.col(features).cast("array<double>")) if is_array else F.col(features)
    rows = df.select(F.col(label).cast("double").alias("label"), vector.alias("features"))
    rows.write.mode(mode).format("libsvm").save(path)
    return path
