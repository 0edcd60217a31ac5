"""Near copies by SimHash: fingerprints of word shingles, linked by vantage-point trees over Hamming distance.

``fingerprints`` gives every row the majority bits of the XXH64 values of its shingles. ``link`` finds all pairs of distinct
fingerprints that differ in few bits. A vantage-point tree, grown from a bounded sample, deals them to shards: at each node
a point goes to the inside if its distance to the vantage point is at most the cut, to the outside if it is above, and
*also* to the inside if it is above by at most the link distance. By the triangle inequality two linked points differ by no
more than that in their distance to the vantage point, so they meet in at least one shard. Inside a shard the same splitting
goes on until few points are left, which are compared. A shard returns a spanning forest of its links, not all pairs.
Beyond MOST_SHARDS shards the large ones are split again by trees of their own, level by level, in waves whose trees and
samples on the driver stay bounded; only points that no tree can part stay together.

Defined results: a NULL or wordless text has fingerprint 0 and is linked like any other; equal fingerprints are one node,
so copies cost one row; repeated rows each get a row; a component is named by its smallest id that is not NULL; no rows give
no rows. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, forest, numbered, slices, stage_table, utf8
from millrace.session import scratch_path

#: Fingerprints in a shard, sample rows per shard, the most shards that trees on the driver make at once, and how many times
#: SHARD a shard may grow by what overlaps before it is split again.
SHARD, PER_SHARD, MOST_SHARDS, OVERLAP = 16_384, 32, 4_096, 32
#: Points compared directly at the end of a tree, and rows of a comparison held at once.
FEW, BLOCK = 192, 1_024
SHINGLES_AT_ONCE = 65_536


def fingerprint(text: bytes, words: int) -> int:
    """The 64 majority bits of a text's shingles as an unsigned number."""
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    k = min(words, len(parts))
    starts = np.concatenate(([0], ends[: len(parts) - k])).tolist()
    stops = (ends[k - 1 :] - 1).tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        h = [digest(line[a:b], 42) for a, b in zip(starts[at : at + SHINGLES_AT_ONCE], stops[at : at + SHINGLES_AT_ONCE])]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(row, id, fp) for every row; fp is the fingerprint as a signed long."""
    return _prints(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")), words)


def _prints(rows: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fp = np.array([fingerprint(t, words) for t in utf8(part)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), pa.array(fp)], ["row", "id", "fp"])

    return rows.mapInArrow(run, "row bigint, id bigint, fp bigint")


def _distance(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to).astype(np.int16)


def _cut(points: np.ndarray, sample: np.ndarray, bits: int) -> tuple[np.uint64, int, float]:
    """A vantage point, a cut, and the share of points that either side keeps at most: of a few points the best one."""
    best = (np.uint64(0), 0, 2.0)
    for vantage in sample:
        counts = np.bincount(_distance(points, vantage), minlength=65 + bits)
        inside = np.cumsum(counts) / len(points)
        for cut in np.unique(np.searchsorted(inside, (0.3, 0.4, 0.5, 0.6))):
            worst = max(inside[min(cut + bits, 64)], 1 - inside[cut])
            total = inside[min(cut + bits, 64)] + 1 - inside[cut]
            if worst < 0.95 and total + worst < best[2]:
                best = (vantage, int(cut), float(total + worst))
    return best


def grow_tree(sample: np.ndarray, leaves: int, bits: int) -> list:
    """Nested [vantage, cut, inside, outside]; a leaf is its number. ``sample`` holds distinct unsigned fingerprints."""
    number = iter(range(1 << 40))

    def grow(points: np.ndarray, parts: int):
        if parts <= 1 or len(points) < 4:
            return next(number)
        vantage, cut, worth = _cut(points, points[:: max(1, len(points) // 8)][:8], bits)
        if worth >= 2.0:
            return next(number)
        d = _distance(points, vantage)
        inside, outside = points[d <= cut], points[d > cut]
        left = max(1, round(parts * len(inside) / len(points)))
        return [vantage, cut, grow(inside, left), grow(outside, max(1, parts - left))]

    return grow(sample, leaves)


def shards_of(tree, points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of a point, shard), several for a point near a boundary."""
    found: list[tuple[np.ndarray, int]] = []

    def down(node, at: np.ndarray) -> None:
        if not isinstance(node, list):
            found.append((at, node))
            return
        d = _distance(points[at], node[0])
        down(node[2], at[d <= node[1] + bits])
        down(node[3], at[d > node[1]])

    down(tree, np.arange(len(points)))
    return np.concatenate([a for a, _ in found]), np.concatenate([np.full(len(a), s) for a, s in found])


def linked(points: np.ndarray, bits: int) -> np.ndarray:
    """For distinct unsigned points: the smallest index that each reaches over links of at most ``bits`` bits."""
    label, edges, waiting = np.arange(len(points)), [], 0

    def fold() -> None:
        nonlocal label, waiting
        if edges:
            a, b = (np.concatenate(x) for x in zip(*edges))
            label = forest(len(points), np.concatenate((a, np.arange(len(points)))), np.concatenate((b, label)))
            edges.clear()
            waiting = 0

    todo = [np.arange(len(points))]
    while todo:
        at = todo.pop()
        mine = points[at]
        vantage, cut, worth = _cut(mine, mine[:: max(1, len(mine) // 4)][:4], bits) if len(at) > FEW else (None, 0, 2.0)
        if worth < 2.0:
            d = _distance(mine, vantage)
            todo += [at[d <= cut + bits], at[d > cut]]
            continue
        for k in range(0, len(at), BLOCK):
            near = np.bitwise_count(mine[k : k + BLOCK, None] ^ mine[None, k:]) <= bits
            a, b = np.nonzero(near)
            keep = a < b
            edges.append((at[k + a[keep]], at[k + b[keep]]))
            waiting += int(keep.sum())
            if waiting > 1_000_000:
                fold()
    fold()
    return label


def _waves(sizes: Iterator, shard: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (shard, fingerprints, leaves of its tree) with at most MOST_SHARDS leaves each."""
    wave, total = [], 0
    for at, size in sizes:
        leaves = min(MOST_SHARDS, max(2, -(-size // shard)))
        if wave and total + leaves > MOST_SHARDS:
            yield wave
            wave, total = [], 0
        wave.append((at, size, leaves))
        total += leaves
    if wave:
        yield wave


def _deal_again(dealt: DataFrame, wave: list[tuple[int, int, int]], bits: int, level: int, base: int) -> tuple[DataFrame, int]:
    """(shard, fp, whole) of the shards of a wave, dealt by a tree each, and the next free number; whole: no tree parts it."""
    spark = dealt.sparkSession
    mine = dealt.where(F.col("shard").between(wave[0][0], wave[-1][0])).where(F.col("shard").isin([at for at, _, _ in wave]))
    part = PER_SHARD * sum(leaves for _, _, leaves in wave) / sum(size for _, size, _ in wave)
    picked = mine.where(F.pmod(F.xxhash64("fp", F.lit(level)), F.lit(1 << 30)) < int(part * (1 << 30)) + 1).toPandas()
    samples = {at: np.sort(rows["fp"].to_numpy(np.int64).view(np.uint64)) for at, rows in picked.groupby("shard")}
    trees = {}
    for at, _, leaves in wave:
        tree = grow_tree(samples.get(at, np.empty(0, np.uint64)), leaves, bits)
        trees[at] = tree, base
        base += leaves
    sent = spark.sparkContext.broadcast(trees)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, fp = batch.column("shard").to_numpy(), batch.column("fp").to_numpy()
            for at in np.unique(shards):
                tree, first = sent.value[at]
                points = fp[shards == at]
                which, to = shards_of(tree, points.view(np.uint64), bits)
                yield pa.RecordBatch.from_arrays([pa.array(to + first), pa.array(points[which]), pa.array(np.full(len(to), not isinstance(tree, list)))], ["shard", "fp", "whole"])

    return mine.select("shard", "fp").mapInArrow(deal, "shard bigint, fp bigint, whole boolean"), base


def _split_large(dealt: DataFrame, bits: int, shard: int) -> list[DataFrame]:
    """Tables (shard, fp): shards of more than OVERLAP times ``shard`` points are split until none that a tree can part is left."""
    spark, done, level = dealt.sparkSession, [], 0
    dealt = stage_table(dealt.select("shard", "fp", F.lit(False).alias("whole")).sortWithinPartitions("shard"))
    while True:
        level += 1
        many = stage_table(dealt.where("not whole").groupBy("shard").count().where(F.col("count") > OVERLAP * shard))
        done.append(dealt.join(many, "shard", "left_anti").select("shard", "fp"))
        path, base = scratch_path(spark, "shards"), 0
        for wave in _waves(many.orderBy("shard").toLocalIterator(), shard):
            finer, base = _deal_again(dealt, wave, bits, level, base)
            finer.sortWithinPartitions("shard").write.mode("append").parquet(path)
        if not base:
            return done
        dealt = spark.read.schema("shard bigint, fp bigint, whole boolean").parquet(path)


def link(points: DataFrame, bits: int = 3, column: str = "fp", shard: int = SHARD) -> DataFrame:
    """(node, root) for the distinct fingerprints that have a link; roots name components."""
    spark = points.sparkSession
    distinct = points.select(F.col(column).alias("fp")).distinct()
    total = distinct.count()
    wanted = max(1, -(-total // shard))
    leaves = min(MOST_SHARDS, wanted)
    if leaves > 1:
        picked = distinct.orderBy(F.xxhash64("fp"), "fp").limit(PER_SHARD * leaves).toPandas()["fp"].to_numpy(np.int64)
        tree = grow_tree(picked.view(np.uint64), leaves, bits)
    else:
        tree = 0
    sent = spark.sparkContext.broadcast(tree)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            at, to = shards_of(sent.value, fp.view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int64)), pa.array(fp[at])], ["shard", "fp"])

    def search(table: pa.Table) -> pa.Table:
        fp = np.sort(table.column("fp").to_numpy())
        label = linked(fp.view(np.uint64), bits)
        apart = label != np.arange(len(fp))
        return pa.table({"a": fp[apart], "b": fp[label[apart]]})

    dealt = distinct.mapInArrow(deal, "shard bigint, fp bigint")
    tables = [dealt] if wanted == leaves else _split_large(dealt, bits, shard)
    forests = [t.groupBy("shard").applyInArrow(search, "a bigint, b bigint") for t in tables]
    return components(reduce(DataFrame.union, forests))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 3) -> DataFrame:
    """(row, id, fp, root, component_id) for every row: root names its component among fingerprints, component_id is the smallest id reachable over links of at most ``bits`` bits."""
    return _named(fingerprints(docs, id_col, text_col, words), bits)


def _named(prints: DataFrame, bits: int) -> DataFrame:
    prints = stage_table(prints)
    roots = link(prints, bits)
    first = prints.groupBy("fp").agg(F.min("id").alias("first"))
    named = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = stage_table(named)
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    names = stage_table(named.join(lowest, "root").select("fp", "root", "component_id"))
    return prints.join(names, "fp").select("row", "id", "fp", "root", "component_id")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 3) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the first row of the smallest id stays."""
    rows = numbered(docs, text_col)
    found = _named(_prints(rows.select("row", F.col(f"doc.{id_col}").cast("bigint").alias("id"), "text"), words), bits)
    least = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("who"))
    return rows.select("row", "doc").join(least.select(F.col("who.row").alias("row")), "row", "left_semi").select("doc.*")
