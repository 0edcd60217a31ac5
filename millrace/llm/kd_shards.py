"""Shards of near equal bytes by a k-d tree over the metadata of documents.

The tree starts with all documents and splits a node that has more than one leaf to give along the dimension in which its
documents spread widest, at the weighted quantile that leaves each side bytes in proportion to its leaves; a node whose
bytes reach the target for one leaf is a leaf. All nodes of a level are split together: one aggregation finds the widest
dimension of each, a few more narrow down its cut, each by a histogram of bytes over equal bins between the bounds so far.
Only the histograms reach the driver, BINS numbers for each node.

A coordinate is a whole number of 62 bits: the value in the upper half, a hash of the row in the lower half. Many documents
of one value (a hot source) are thus cut anywhere, and no group has to stay in one shard. The lower half starts with the
checksum of the text, so equal texts mostly stay together.

Slots count up in each shard without gaps: documents are numbered within small buckets of a shard, and a bucket's offset is
the number of rows in the buckets before it.

Defined results: a NULL text has the size of the fixed part alone; a NULL in a dimension has the coordinate 0; repeated rows
have the same coordinates and may share a shard, which then is uneven by their size; fewer documents than shards leave
shards empty; no rows give no rows. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import partitions_for, rows_of, stage_table
from millrace.operators.series import match_on

#: Bins of a histogram, share of a leaf's bytes by which a cut may be off, rows of a slot bucket.
BINS, OFF, SLOT_ROWS = 2048, 0.0005, 100_000
HALF = 31


@dataclass
class Part:
    """A node of the tree on the current level: leaves below it, and once it is cut the dimension and the cut."""

    leaves: int
    dimension: int = 0
    cut: int = 0


def _coordinate(value: Column, row_hash: Column) -> Column:
    """31 bits of the value (scaled by the caller to 0..2^31-1) above 31 bits of the hash."""
    return F.shiftleft(F.coalesce(value, F.lit(0)).cast("bigint"), HALF).bitwiseOR(row_hash)


def _of(values: list[int]) -> Column:
    """The entry of a literal array that belongs to a row's part."""
    return F.get(F.array(*[F.lit(v).cast("bigint") for v in values]), F.col("part"))


def _find_cuts(rows: DataFrame, parts: list[Part], dims: int) -> None:
    """Give every part of more than one leaf its dimension and cut."""
    spans = rows.groupBy("part").agg(F.sum("size").alias("bytes"), *[f(F.get("at", F.lit(d))).alias(f"{k}{d}") for d in range(dims) for k, f in (("a", F.min), ("b", F.max))])
    facts = {r["part"]: r for r in spans.collect()}  # a row for each part of the level
    bounds: dict[int, tuple[int, int, int]] = {}
    goal, slack = {}, {}
    for k, part in enumerate(parts):
        if part.leaves < 2 or k not in facts:
            continue
        r = facts[k]
        part.dimension = max(range(dims), key=lambda d: (r[f"b{d}"] - r[f"a{d}"], -d))
        bounds[k] = (r[f"a{part.dimension}"], r[f"b{part.dimension}"] + 1, 0)
        goal[k] = r["bytes"] * (part.leaves // 2) / part.leaves
        slack[k] = OFF * r["bytes"] / part.leaves
    while bounds:
        widths = {k: max(1, -(-(b - a) // BINS)) for k, (a, b, _) in bounds.items()}
        at = F.get("at", _of([p.dimension for p in parts]).cast("int"))
        low, step = _of([bounds.get(k, (0,))[0] for k in range(len(parts))]), _of([widths.get(k, 1) for k in range(len(parts))])
        binned = rows.where(F.col("part").isin(list(bounds))).select("part", F.floor((at - low) / step).alias("bin"), "size")
        counts: dict[int, list] = {}
        for r in binned.where(F.col("bin").between(0, BINS - 1)).groupBy("part", "bin").agg(F.sum("size").alias("bytes")).collect():
            counts.setdefault(r["part"], []).append((r["bin"], r["bytes"]))
        for k in list(bounds):
            a, b, below = bounds.pop(k)
            cut, fit = a, abs(below - goal[k])  # the best cut so far is the lower bound
            inside = (a, min(b, a + widths[k]), below)
            for bin_, size in sorted(counts.get(k, [])):
                if below <= goal[k]:
                    inside = (a + bin_ * widths[k], min(b, a + (bin_ + 1) * widths[k]), below)
                below += size
                if abs(below - goal[k]) < fit:
                    cut, fit = a + (bin_ + 1) * widths[k], abs(below - goal[k])
                if below > goal[k]:
                    break
            parts[k].cut = cut
            if fit > slack[k] and widths[k] > 1:
                bounds[k] = inside


def grow(rows: DataFrame, dims: int, leaves: int) -> DataFrame:
    """Rows (at: array of coordinates, size, ...) with ``part``, the number of the leaf that they fall into.

    Rows are written to the shared folder once for every level, so that each pass has a short plan.
    """
    parts = [Part(leaves)]
    rows = stage_table(rows.withColumn("part", F.lit(0)))
    while any(p.leaves > 1 for p in parts):
        _find_cuts(rows, parts, dims)
        base, after = [], []
        for p in parts:
            base.append(len(after))
            after += [p] if p.leaves < 2 else [Part(p.leaves // 2), Part(p.leaves - p.leaves // 2)]
        above = F.get("at", _of([p.dimension for p in parts]).cast("int")) >= _of([p.cut if p.leaves > 1 else (1 << 63) - 1 for p in parts])
        rows = stage_table(rows.withColumn("part", (_of(base) + above.cast("int")).cast("int")))
        parts = after
    return rows


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", numbers: tuple[str, ...] = ("doc_id", "n_chars"), names: tuple[str, ...] = ("lang", "source"), fixed: int = 8) -> DataFrame:
    """(row, id, size, text_crc32, shard, slot); size is the text's UTF-8 bytes plus ``fixed``.

    ``numbers`` are dimensions by value, scaled to their range; ``names`` by checksum.
    """
    rows = rows_of(docs, text_col)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + fixed
    narrow = stage_table(
        rows.select(
            "row", F.col(f"doc.{id_col}").alias("id"), size.alias("size"), crc.alias("text_crc32"),
            *[F.col(f"doc.{c}").cast("double").alias(f"n{k}") for k, c in enumerate(numbers)],
            *[F.shiftright(F.crc32(F.col(f"doc.{c}").cast("string").cast("binary")), 1).alias(f"s{k}") for k, c in enumerate(names)],
        )
    )
    ranges = narrow.agg(F.count("*").alias("rows"), *[f(F.col(f"n{k}")).alias(f"{g}{k}") for k in range(len(numbers)) for g, f in (("a", F.min), ("b", F.max))]).first()
    # Row numbers follow the cuts of the files: they tell apart only rows that agree in id and checksum.
    twins = narrow.groupBy("id", "text_crc32").agg(F.count("*").alias("copies")).where("copies > 1")
    narrow = match_on(narrow, twins, ["id", "text_crc32"], "left").withColumn("twin", F.when(F.col("copies") > 1, F.col("row")).otherwise(0))
    lower = F.shiftright("text_crc32", 17)
    mixed = F.shiftleft(lower, 16).bitwiseOR(F.pmod(F.xxhash64("id", "text_crc32", "twin"), F.lit(1 << 16)))
    scaled = []
    for k in range(len(numbers)):
        a, b = ranges[f"a{k}"] or 0.0, ranges[f"b{k}"] or 0.0
        scaled.append(F.floor((F.col(f"n{k}") - a) * (((1 << HALF) - 1) / (b - a) if b > a else 0.0)))
    values = scaled + [F.col(f"s{k}") for k in range(len(names))]
    keyed = narrow.select("row", "twin", "id", "size", "text_crc32", F.array(*[_coordinate(v, mixed) for v in values]).alias("at"))
    placed = grow(keyed, len(values), shards).select("row", "twin", "id", "size", "text_crc32", F.col("part").alias("shard"))
    buckets = partitions_for(docs, ranges["rows"], SLOT_ROWS)
    bucketed = placed.withColumn("bucket", F.pmod(F.xxhash64("id", "text_crc32", "twin"), F.lit(buckets)).cast("int"))
    counts = bucketed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    offsets = counts.select("shard", "bucket", before.alias("offset"))
    own = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "twin")) - 1
    numbered = bucketed.withColumn("own", own).join(offsets, ["shard", "bucket"])
    return numbered.select("row", "id", "size", "text_crc32", "shard", (F.col("offset") + F.col("own")).cast("bigint").alias("slot"))
