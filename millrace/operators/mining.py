"""Frequent itemsets, association rules and frequent sequences."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.series import BROADCAST_ROWS, home_stretch, if_small, match_on, with_position
from millrace.session import stage, stage_table


def least_count(rows: int, min_support: float) -> int:
    return max(1, math.ceil(rows * min_support))


#: Copies of a table of items that a join deals its rows to, if the table is too large to be broadcast.
SALTS = 16
#: A stretch of a group has 2^LEAST_BITS events at least, so that short groups are one index row.
LEAST_BITS = 10


def mine_baskets(
    baskets: DataFrame, items: str, min_support: float, min_confidence: float = 0.8, partitions: int | None = None, distinct: bool = False
):
    """A fitted FP-growth model over rows of item arrays; repeated items of a basket count once (``distinct``: there are none)."""
    rows = baskets.select((F.col(items) if distinct else F.array_distinct(items)).alias("items"))
    partitions = partitions or int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    learner = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    return learner.setNumPartitions(partitions).fit(rows)


def itemsets_of(model) -> DataFrame:
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def rules_of(model) -> DataFrame:
    """Rules with a single consequent: antecedent, consequent, confidence."""
    return model.associationRules.select(F.array_sort("antecedent").alias("antecedent"), "consequent", "confidence")


def mine_pairs(
    pairs: DataFrame, basket: Sequence[str], item: str, min_support: float, min_confidence: float = 0.8, partitions: int | None = None
):
    """FP-growth over (basket, item) rows.

    Items too rare for any frequent set stay out of the baskets: each remaining item is in at least ``min_support``
    of all baskets, which bounds how long a basket can get. All baskets count for the support, empty ones too.
    """
    pairs = stage_table(pairs.select(*basket, item).distinct())
    rows, baskets = pairs.groupBy(*basket).count().agg(F.sum("count"), F.count(F.lit(1))).first()
    least = least_count(baskets, min_support)
    frequent = pairs.groupBy(item).count().where(F.col("count") >= least).select(item, F.lit(True).alias("_frequent"))
    # At most rows / least items reach the least count, so the size of this side is known before it is broadcast.
    if (rows or 0) <= least * BROADCAST_ROWS:
        marked = pairs.join(F.broadcast(frequent), item, "left")
    else:
        # An item may be in a large part of all baskets: its rows are dealt to several copies of the table.
        salt = F.pmod(F.xxhash64(*basket), F.lit(SALTS)).cast("int").alias("_salt")
        copies = frequent.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        marked = pairs.select("*", salt).join(copies, [item, "_salt"], "left")
    kept = F.collect_list(F.when(F.col("_frequent"), F.col(item)))
    rows = spread_rows(marked, *basket).groupBy(*basket).agg(kept.alias("items"))
    return mine_baskets(rows, "items", min_support, min_confidence, partitions, distinct=True)


def spread_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition for work that is heavy per row, into a fixed number that is not merged for being small."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def frequent_sequences(df: DataFrame, sequence: str, min_support: float, max_length: int = 5) -> DataFrame:
    """PrefixSpan over rows of ``array<array<item>>``: sequence, freq."""
    span = PrefixSpan(minSupport=min_support, maxPatternLength=max_length, sequenceCol=sequence)
    return span.findFrequentSequentialPatterns(df.select(sequence))


def frequent_pairs(df: DataFrame, by: Sequence[str], order: Sequence[str], item: str, min_support: float) -> DataFrame:
    """Frequent sequences of one or two events: sequence (array of items), freq.

    A pattern of two occurs in a group exactly if the first occurrence of one item comes before the last of the other
    (or the same), so a group of any size is reduced to the first and last place of each of its items. Items that too few
    groups hold are left out before any pair is made.
    """
    at = F.struct(*order) if len(order) > 1 else F.col(order[0])
    edges = stage_table(df.groupBy(*by, F.col(item).alias("_item")).agg(F.min(at).alias("_first"), F.max(at).alias("_last")))
    least = least_count(edges.select(*by).distinct().count(), min_support)
    ones = stage(edges.groupBy("_item").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least))
    kept = edges.join(if_small(ones.select("_item")), "_item", "left_semi")
    lasts = kept.select(*by, F.col("_item").alias("_then"), F.col("_last").alias("_until"))
    met = match_on(kept.select(*by, "_item", "_first"), lasts, by).where(F.col("_first") < F.col("_until"))
    twos = met.groupBy("_item", "_then").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least)
    return ones.select(F.array("_item").alias("sequence"), "freq").unionByName(twos.select(F.array("_item", "_then").alias("sequence"), "freq"))


def sequences_of_sets(df: DataFrame, by: Sequence[str], at: str, item: str, output: str = "sequence") -> DataFrame:
    """One row per group: its item sets in the order of ``at``, each the distinct sorted items of one value of ``at``."""
    sets = df.select(*by, at, item).distinct().groupBy(*by, at).agg(F.array_sort(F.collect_list(item)).alias("_set"))
    steps = F.array_sort(F.collect_list(F.struct(at, "_set")))
    return spread_rows(sets, *by).groupBy(*by).agg(F.transform(steps, lambda s: s["_set"]).alias(output))


def grow_sequences(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    item: str,
    min_support: float,
    max_length: int = 5,
    bits: int | None = None,
) -> DataFrame:
    """Frequent sequences of single events of any length: sequence (array of items), freq."""
    steps = stage_table(with_position(df.select(*by, *order, item), order, by, "_idx").select(*by, "_idx", F.col(item).alias("_item")))
    groups, last = steps.agg(F.count_if(F.col("_idx") == 0), F.max("_idx")).first()
    least = least_count(groups, min_support)
    ones = stage(steps.select(*by, "_item").distinct().groupBy("_item").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least))
    kept = steps.join(if_small(ones.select("_item")), "_item", "left_semi").withColumn("_size", F.lit(1))
    return _grown(kept, ones, by, last or 0, least, max_length, bits)


def grow_set_sequences(
    df: DataFrame, by: Sequence[str], at: str, item: str, min_support: float, max_length: int = 5, bits: int | None = None
) -> DataFrame:
    """Frequent sequences of item sets: sequence (array of sorted arrays of items), freq. A group's items of one value of
    ``at`` are a set; ``max_length`` counts items.

    First come the frequent sets that lie within one set, item by item in ascending order. Each of them is then an event of its
    own, and sequences grow by such events as they do by single ones.
    """
    sets = stage_table(df.select(*by, F.col(at).alias("_at"), F.col(item).alias("_x")).distinct())
    times = with_position(sets.select(*by, "_at").distinct(), ["_at"], by, "_idx")
    groups, last = times.agg(F.count_if(F.col("_idx") == 0), F.max("_idx")).first()
    least = least_count(groups, min_support)
    steps = stage_table(match_on(sets, times, [*by, "_at"]).select(*by, "_idx", "_x"))
    ones = stage(steps.select(*by, "_x").distinct().groupBy("_x").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least))
    kept = stage_table(steps.join(if_small(ones.select("_x")), "_x", "left_semi"))
    within = kept.select(*by, "_idx", F.array("_x").alias("_item"), F.lit(1).alias("_size"))
    events, frequent = [within], [ones.select(F.array("_x").alias("_item"), "freq")]
    for size in range(2, max_length + 1):
        met = match_on(events[-1], kept, [*by, "_idx"]).where(F.col("_x") > F.element_at("_item", -1))
        more = met.select(*by, "_idx", F.concat("_item", F.array("_x")).alias("_item"), F.lit(size).alias("_size"))
        # A set can be frequent only if it is so without its first item, too.
        rest = frequent[-1].select(F.col("_item").alias("_rest"))
        more = stage_table(more.join(if_small(rest), F.slice("_item", 2, size - 1) == F.col("_rest"), "left_semi"))
        counted = more.select(*by, "_item").distinct().groupBy("_item").agg(F.count(F.lit(1)).alias("freq"))
        frequent.append(stage(counted.where(F.col("freq") >= least)))
        if frequent[-1].isEmpty():
            break
        events.append(stage_table(more.join(if_small(frequent[-1].select("_item")), "_item", "left_semi")))
    every = reduce(DataFrame.unionByName, frequent)
    return _grown(reduce(DataFrame.unionByName, events), every, by, last or 0, least, max_length, bits)


def _grown(steps: DataFrame, ones: DataFrame, by: Sequence[str], last: int, least: int, max_length: int, bits: int | None) -> DataFrame:
    """Frequent sequences of the events ``by, _idx, _item, _size``, whose frequent ones are given, without a group in one row.

    For each pattern a group keeps the position where its earliest occurrence ends. A longer pattern ends at the next
    occurrence of its last event. Groups are cut into stretches of about the square root of the longest one; an index row
    per stretch holds the positions of the events that the stretch has, and no others. What follows in the same stretch is
    read from that row; events that only come in a later one are found by a merge with the stretches that have them. A pattern
    is counted only if it is frequent without its first event.
    """
    bits = max(LEAST_BITS, math.ceil(math.log2(last + 2) / 2) + 1) if bits is None else bits
    placed = steps.withColumn("_stretch", home_stretch("_idx", bits))
    ends = placed.groupBy(*by, "_item", "_size").agg(F.min("_idx").alias("_end"))
    ends = ends.select(*by, F.array("_item").alias("_pattern"), "_end", F.col("_size").alias("_length"))
    levels = [ones.select(F.array("_item").alias("_pattern"), F.col("freq").alias("count"))]
    many = levels[0].count()
    longer = (last >> bits) > 0
    if max_length > 1 and many:
        index = stage_table(sparse_index(placed, by, longer))
    for count in range(2, max_length + 1):
        if not many:
            break
        met = match_on(ends.where(F.col("_length") < max_length).withColumn("_stretch", home_stretch("_end", bits)), index, [*by, "_stretch"])
        next_ = F.transform(
            "_items",
            lambda i: F.struct(i["_item"].alias("_item"), i["_size"].alias("_size"), F.array_min(F.filter(i["_at"], lambda x: x > F.col("_end"))).alias("_idx")),
        )
        here = met.withColumn("_found", F.filter(next_, lambda i: i["_idx"].isNotNull())).select(*by, "_pattern", "_length", "_stretch", "_more", "_found")
        grown = here.select(*by, "_pattern", "_length", F.inline("_found"))
        if longer:
            grown = grown.unionByName(_found_later(here.where("_more"), index, by))
        length = F.col("_length") + F.col("_size")
        grown = grown.where(length <= max_length)
        ends = grown.select(*by, F.concat("_pattern", F.array("_item")).alias("_pattern"), F.col("_idx").alias("_end"), length.alias("_length"))
        if count > 2:
            known = levels[-1].select(F.col("_pattern").alias("_tail"))
            known = F.broadcast(known) if many <= BROADCAST_ROWS else known
            ends = ends.join(known, F.slice("_pattern", 2, count - 1) == F.col("_tail"), "left_semi")
        ends = stage_table(ends)
        levels.append(stage(ends.groupBy("_pattern").count().where(F.col("count") >= least)))
        many = levels[-1].count()
        known = levels[-1].select("_pattern")
        ends = ends.join(F.broadcast(known) if many <= BROADCAST_ROWS else known, "_pattern", "left_semi")
    return reduce(DataFrame.unionByName, levels).select(F.col("_pattern").alias("sequence"), F.col("count").alias("freq"))


def sparse_index(steps: DataFrame, by: Sequence[str], longer: bool = True) -> DataFrame:
    """by, _stretch, _items, _more: a row per stretch with the sorted positions of each event that it has, and whether the
    group goes on behind it (``longer``: some groups have several stretches)."""
    own = steps.groupBy(*by, "_stretch", "_item", "_size").agg(F.array_sort(F.collect_list("_idx")).alias("_at"))
    rows = own.groupBy(*by, "_stretch").agg(F.collect_list(F.struct("_item", "_size", "_at")).alias("_items"))
    if not longer:
        return rows.withColumn("_more", F.lit(False))
    behind = Window.partitionBy(*by).orderBy("_stretch")
    return rows.withColumn("_more", F.lead("_stretch").over(behind).isNotNull())


def _found_later(here: DataFrame, index: DataFrame, by: Sequence[str]) -> DataFrame:
    """Events that a group has only in a later stretch than a pattern's end: their first position there.

    Patterns meet the events of their group whose last stretch is a later one; each such pair is a longer pattern. Its place
    is that of the nearest later stretch with the event, by a window over both in the order of stretches.
    """
    each = index.select(*by, "_stretch", F.inline("_items"))
    events = each.groupBy(*by, "_item", "_size").agg(F.max("_stretch").alias("_until"))
    pairs = match_on(here.select(*by, "_pattern", "_length", "_stretch", F.transform("_found", lambda i: i["_item"]).alias("_have")), events, by)
    pairs = pairs.where((F.col("_until") > F.col("_stretch")) & ~F.array_contains("_have", F.col("_item")))
    asks = pairs.select(*by, "_item", "_stretch", F.lit(None).cast("bigint").alias("_idx"), F.struct("_pattern", "_length", "_size").alias("_ask"))
    told = each.select(*by, "_item", "_stretch", F.col("_at")[0].alias("_idx"), F.lit(None).cast(asks.schema["_ask"].dataType).alias("_ask"))
    # Stretches descend, those that ask before those that tell: the last position told is that of the nearest later stretch.
    order = Window.partitionBy(*by, "_item").orderBy(F.desc("_stretch"), F.col("_ask").isNull().cast("int")).rowsBetween(Window.unboundedPreceding, 0)
    found = asks.unionByName(told).withColumn("_idx", F.last("_idx", ignorenulls=True).over(order)).where("_ask is not null")
    return found.select(*by, "_ask._pattern", "_ask._length", "_item", "_ask._size", "_idx")
