"""What the operators on documents share: row numbers, batches of bounded size, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage, stage_table

#: Bytes of text that a task function holds as Python objects at once.
SLICE_BYTES = 2_000_000
WORD = r"[^\x20\x09-\x0D]+"


def rows_of(df: DataFrame, text: str) -> DataFrame:
    """Row number, whole row as a struct, text: extra columns of any name stay inside the struct.

    The numbers are made anew by every job, and follow how Spark cuts the files at that moment: they may go into one table,
    but must never be joined with those of another job. For that there is ``numbered``.
    """
    return df.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"), F.col(text).cast("string").alias("text"))


def numbered(df: DataFrame, text: str) -> DataFrame:
    """The same columns from a table written once, so that every job that reads it finds the same numbers."""
    rows = stage_table(rows_of(df, text).select("row", "doc"), "zstd")
    return rows.select("row", "doc", F.col(f"doc.`{text}`").cast("string").alias("text"))


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES, lengths: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of each part stay near ``size`` bytes; one text is never cut. ``lengths`` if the column does not tell them."""
    if lengths is None:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as bytes, NULL as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def crc_bucket(column: str, buckets: int) -> Column:
    """crc32 of the column as text, modulo ``buckets``; NULL counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def told_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, label) of ids that have one label, to learn from: every third id, by the checksum of its text, is kept for checking."""
    learn = labels.where(F.col(id_col).isNotNull()).where(crc_bucket(id_col, 3) != 1)
    each = learn.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"), F.max(label_col).alias("most"))
    return each.where("label = most").select("id", "label")


def partitions_for(df: DataFrame, rows: int, per_task: int) -> int:
    """Enough partitions for ``rows`` rows, at least as many as the session uses."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches over the edges a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        high = np.maximum(label[a], label[b])
        open_ = low != high
        if not open_.any():
            return label
        np.minimum.at(label, high[open_], low[open_])
        while True:
            nearer = label[label]
            if (nearer == label).all():
                break
            label = nearer
        a, b = a[open_], b[open_]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node that it reaches.

    Alternates two steps that hang neighbours under the smallest node around them until nothing changes. Each round is
    written to the shared folder. Minima are aggregated before the shuffle, so that a node with many edges is no hot group.
    """
    near = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = near.union(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        wide = both.join(lows, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lows = wide.groupBy("a").agg(F.min("b").alias("m"))
        tied = wide.join(lows, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        near = stage(tied.select("e.a", "e.b").where("a <> b").distinct())
        now = near.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return near.select(F.col("a").alias("node"), F.col("b").alias("root")).union(near.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


__all__ = ["SLICE_BYTES", "WORD", "components", "crc_bucket", "forest", "numbered", "partitions_for", "rows_of", "slices", "stage", "stage_table", "told_labels", "utf8"]
