"""Mixing of sources to target weights: capped water-filling, then whole and fractional repetitions.

``targets`` gives every source its share of the words to take. Shares go by weight, but no source gives more than
``epochs`` times its size: sources above are clamped there, and the excess is dealt to the others by their weights, until
none is above. Each round is one aggregate over the table of sources.

``mix`` takes every document of a source as often as the whole part of target / size says. The rest is filled in the
seeded order of the documents' md5: documents before the mark are taken once more, the one on the mark in part. The mark is
found by prefix sums over buckets of that order, so no source has to fit into a task.

Defined results: NULL texts have size 0; the NULL source comes last and is a source like others; sources of size 0 take no
part and have target 0; repeated rows are documents of their own; ties in the order are broken by the id; no rows give no
rows; a budget that all caps together do not reach leaves every source at its cap. Extra columns stay inside ``doc``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, numbered, rows_of, stage, stage_table
from millrace.operators.series import with_position

#: Hexadecimal digits of the order's key that make a bucket: 4,096 buckets for each source.
BUCKET_DIGITS = 3


def word_count(text: str) -> Column:
    """Words between blanks of ASCII; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: list[int], share: float, epochs: float) -> DataFrame:
    """Add ``target`` to (source, source_size): ``weights`` repeat over the sources in order, NULL last."""
    order = sources.select("source", "source_size", F.col("source").isNull().alias("last"), F.coalesce("source", F.lit("")).alias("name"))
    placed = with_position(order, ["last", "name"])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("idx") % len(weights) + 1).cast("int")).cast("double")
    live = stage(placed.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(epochs))).alias("cap")))
    total = live.agg(F.sum("source_size")).first()[0] or 0
    budget, level = share * total, None
    while True:
        above = F.lit(False) if level is None else F.col("cap") <= F.col("weight") * F.lit(level)
        full = above | (F.col("cap") == 0)
        fixed, open_, clamped = live.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)), F.count_if(full)
        ).first()
        if not open_:
            level = float("inf")
            break
        new = (budget - fixed) / open_
        if level is not None and clamped == before:
            break
        level, before = new, clamped
    return live.select("source", "source_size", F.least("cap", F.when(F.col("cap") > 0, F.col("weight") * F.lit(level)).otherwise(0.0)).alias("target"))


def mix(docs: DataFrame, weights: list[int], share: float, epochs: float, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(row, id, source, size, source_size, target, taken): words to take of every row, repetitions counted."""
    return _mix_rows(rows_of(docs, text_col), weights, share, epochs, seed, id_col, source_col)


def _mix_rows(rows: DataFrame, weights: list[int], share: float, epochs: float, seed: int, id_col: str, source_col: str) -> DataFrame:
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"doc.{id_col}").cast("string"), F.lit(""))))
    sized = stage_table(rows.select("row", F.col(f"doc.{id_col}").alias("id"), F.col(f"doc.{source_col}").cast("string").alias("source"), word_count("text").alias("size"), F.xxhash64("text").alias("digest"), key.alias("key")))
    bucket = F.substring("key", 1, BUCKET_DIGITS)
    buckets = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("filled"))
    buckets = stage_table(buckets)
    goals = stage(targets(buckets.groupBy("source").agg(F.sum("filled").alias("source_size")), weights, share, epochs))
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    part = F.round(F.col("target") - whole * size).cast("bigint")
    goals = goals.select("source", "source_size", "target", whole.cast("bigint").alias("whole"), part.alias("part"))
    by = Window.partitionBy("source").orderBy("bucket")
    marks = buckets.withColumn("before", F.sum("filled").over(by) - F.col("filled"))
    marks = marks.join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    on_mark = (F.col("before") < F.col("part")) & (F.col("part") < F.col("before") + F.col("filled"))
    marks = stage_table(marks.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before", "filled", "source_size", "target", "whole", "part", on_mark.alias("mark")))
    # One row per source and bucket, by far fewer than documents; joined on both, so that no source is one group.
    joined = sized.withColumn("b0", bucket).join(marks, F.col("source").eqNullSafe(F.col("s")) & (F.col("b0") == F.col("b")))
    common = ["row", "id", "source", "size", "source_size", "target"]
    away = joined.where("not mark").select(*common, (F.col("size") * (F.col("whole") + (F.col("before") < F.col("part")).cast("int"))).alias("taken"))
    within = Window.partitionBy("source", "b").orderBy("key", "id", "digest", "row")
    before = F.col("before") + F.sum("size").over(within) - F.col("size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - before))
    near = joined.where("mark").select(*common, (F.col("size") * F.col("whole") + extra).alias("taken"))
    return away.union(near)


def mixed_documents(docs: DataFrame, weights: list[int], share: float, epochs: float, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows that the mix consists of: (doc, text) once for every repetition; the text of a fractional one is cut behind its last word taken.

    A document of no words is not taken. ``doc`` is the whole input row.
    """
    rows = numbered(docs, text_col)
    taken = _mix_rows(rows, weights, share, epochs, seed, id_col, source_col).select("row", "size", "taken").where("taken > 0")
    rows = rows.join(taken, "row")
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    again = rows.where(F.col("taken") >= F.col("size")).select("doc", "text", F.explode(F.array_repeat(F.lit(0), whole)).alias("n")).drop("n")
    pieces = F.split(F.col("text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # blanks and one word each
    cut = rows.where(rest > 0).select("doc", F.array_join(F.slice(pieces, 1, rest), "").alias("text"))
    return again.union(cut)
