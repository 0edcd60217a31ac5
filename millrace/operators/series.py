"""Ordered series on a cluster: positions, windows over long series, neighbours of kept rows.

A series is a set of rows that share the ``by`` columns; without ``by`` the whole frame is one series.
No step here holds a whole series in one task, however long it is:

* ``with_position`` numbers the rows. Short series use one window sort; if a series exceeds
  ``rows_per_task`` rows the frame is range-partitioned and only partition sizes are added up.
* ``over_series`` cuts series into stretches of consecutive positions and copies the few rows that a
  bounded window needs from the adjacent stretches.
* ``with_neighbour`` finds the previous or next row of a thinned series, at any distance, from one
  summary row per stretch.

When ``with_position`` found all series short, the position column says so in its metadata. The other two then
use plain windows per series, which all share the one shuffle that numbered the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.session import stage_table

ROWS_PER_TASK = 1_000_000
ROWS_PER_RANGE = 8  # times ROWS_PER_TASK; a range is only sorted, which can spill
STRETCH_BITS = 16
BROADCAST_ROWS = 500_000
LONGEST = "longest_series"  # metadata of a position column: rows of the longest series, if all are short
LENGTH = "series_rows"  # the same if they are not
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def group_sizes(df: DataFrame, by: Sequence[str]) -> tuple[int, int, int]:
    """(rows, groups, rows of the largest group); only these numbers reach the driver."""
    if not by:
        n = df.count()
        return n, 1, n
    row = df.groupBy(*by).count().agg(F.sum("count"), F.count("count"), F.max("count")).first()
    return row[0] or 0, row[1], row[2] or 0


def match_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL matching NULL, keeping the left copy of the keys."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{key}" for key in keys])


def if_small(side: DataFrame) -> DataFrame:
    """Mark one side of a join for broadcast if it was counted to be small; it should be staged."""
    return F.broadcast(side) if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else side


def with_position(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "idx",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Append the 0-based position of each row in its series.

    ``order`` must be unique within a series, otherwise positions of equal rows are arbitrary.
    """
    rows_per_task = rows_per_task or ROWS_PER_TASK
    rows, groups, largest = group_sizes(df, by)
    if largest <= rows_per_task:
        window = Window.partitionBy(*by).orderBy(*order)
        position = (F.row_number().over(window) - 1).cast("bigint")
        return df.withColumn(name, position.alias(name, metadata={LONGEST: largest}))
    parts = math.ceil(rows / (ROWS_PER_RANGE * rows_per_task))
    parts = max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = _position_by_ranges(df, order, by, name, parts, groups)
    return placed.withColumn(name, F.col(name).alias(name, metadata={LENGTH: largest}))


def _position_by_ranges(
    df: DataFrame, order: Sequence[str], by: Sequence[str], name: str, parts: int, groups: int
) -> DataFrame:
    keys = [*by, *order]
    # Written once, because a second evaluation would sample other range bounds and move rows between partitions.
    ranged = stage_table(
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    ranged = ranged.withColumn("_part", F.shiftright("_id", _ROW_BITS)).withColumn(
        "_row", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition, so both the single-task window and the broadcast are bounded by `parts`.
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    placed = ranged.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + F.col("_row"))
    if by:
        # A group is matched partition by partition, so that a huge group stays spread over many tasks.
        heads = placed.groupBy("_part", *by).agg(F.min(name).alias("_head"))
        heads = heads.withColumn("_head", F.min("_head").over(Window.partitionBy(*by)))
        if groups + parts <= BROADCAST_ROWS:  # a group begins once and goes on in at most all partitions together
            heads = F.broadcast(heads)
        placed = match_on(placed, heads, ["_part", *by]).withColumn(name, F.col(name) - F.col("_head"))
    return placed.select(*df.columns, name)


def is_short(df: DataFrame, idx: str) -> bool:
    """Is every series known to fit into one task?"""
    longest = df.schema[idx].metadata.get(LONGEST)
    return longest is not None and longest <= ROWS_PER_TASK


def stretch_bits(before: int, after: int) -> int:
    """Stretches of ``2**bits`` rows, at least ten times as long as what they copy from their neighbours."""
    return max(STRETCH_BITS, math.ceil(math.log2(10 * (before + after) + 1)))


def home_stretch(idx: str, bits: int) -> Column:
    return F.shiftright(F.col(idx), bits)


def spread(df: DataFrame, idx: str, before: int, after: int, bits: int) -> DataFrame:
    """Append ``_stretch``, copying each row to every stretch whose windows reach it."""
    if before == after == 0:
        return df.withColumn("_stretch", home_stretch(idx, bits))
    first = F.shiftright(F.greatest(F.col(idx) - after, F.lit(0)), bits)
    last = F.shiftright(F.col(idx) + before, bits)
    return df.withColumn("_stretch", F.explode(F.sequence(first, last)))


def over_series(
    df: DataFrame,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    by: Sequence[str] = (),
    idx: str = "idx",
    before: int = 0,
    after: int = 0,
    bits: int | None = None,
) -> DataFrame:
    """Apply bounded window expressions along each series, whose positions must have no gaps.

    ``build(frame, window)`` may look ``before`` rows back and ``after`` rows ahead in total. One shuffle
    on (series, stretch) serves everything built in one call. ``bits`` forces the cut into stretches.
    """
    if bits is None and is_short(df, idx):
        return build(df, Window.partitionBy(*by).orderBy(idx))
    bits = stretch_bits(before, after) if bits is None else bits
    window = Window.partitionBy(*by, "_stretch").orderBy(idx)
    built = build(spread(df, idx, before, after, bits), window)
    return built.where(F.col("_stretch") == home_stretch(idx, bits)).drop("_stretch")


def with_neighbour(
    df: DataFrame,
    columns: dict[str, str],
    by: Sequence[str] = (),
    idx: str = "idx",
    ahead: bool = True,
    bits: int | None = None,
) -> DataFrame:
    """Append values of the next (or previous) present row of the series; positions may have gaps.

    ``columns`` maps source column to new column. Inside a stretch this is an ordinary lead or lag. The row at
    its edge takes the first (last) row of the nearest non-empty stretch, found among one row per stretch.
    """
    move, back = (F.lead, F.lag) if ahead else (F.lag, F.lead)
    if bits is None and is_short(df, idx):
        series = Window.partitionBy(*by).orderBy(idx)
        return df.withColumns({target: move(source).over(series) for source, target in columns.items()})
    bits = STRETCH_BITS if bits is None else bits
    rows = Window.partitionBy(*by, "_stretch").orderBy(idx)
    placed = df.withColumn("_stretch", home_stretch(idx, bits)).withColumns(
        {"_near": move(F.struct(*columns)).over(rows), "_edge": back(idx).over(rows).isNull()}
    )
    # The summary carries whole rows: with the same columns on both sides Spark runs the shuffle above only once.
    edges = placed.where("_edge").select(*by, "_stretch", F.struct(*df.columns).alias("_row"))
    summary = _next_stretch(edges, by, df.schema[idx].metadata.get(LENGTH), bits, ahead)
    joined = match_on(placed, summary, [*by, "_stretch"], "left")
    # A neighbour in the same stretch counts even if its values are NULL.
    found = {
        target: F.when(F.col("_near").isNotNull(), F.col("_near")[source]).otherwise(F.col("_far")[source])
        for source, target in columns.items()
    }
    return joined.select(*df.columns, *[value.alias(target) for target, value in found.items()])


def _next_stretch(edges: DataFrame, by: Sequence[str], longest: int | None, bits: int, ahead: bool) -> DataFrame:
    """Append ``_far``, the row of the next (previous) stretch, to one row per stretch.

    Where a series has too many stretches for one task, they are cut into stretches of stretches.
    """
    move = F.lead if ahead else F.lag
    if longest is None or longest >> bits <= ROWS_PER_TASK:
        stretches = Window.partitionBy(*by).orderBy("_stretch")
        return edges.select(*by, "_stretch", move("_row").over(stretches).alias("_far"))
    longest = longest >> bits
    metadata = {LENGTH: longest}
    marked = edges.withColumn("_at", F.col("_stretch").alias("_at", metadata=metadata)).withColumnRenamed("_stretch", "_low")
    found = with_neighbour(marked, {"_row": "_far"}, by, "_at", ahead, STRETCH_BITS)
    return found.select(*by, F.col("_low").alias("_stretch"), "_far")


def every_nth(df: DataFrame, n: int, order: Sequence[str], by: Sequence[str] = (), name: str = "idx") -> DataFrame:
    """Thin a series to the rows whose position is a multiple of ``n``."""
    return with_position(df, order, by, name).where(F.col(name) % n == 0)


def pair_by_position(left: DataFrame, right: DataFrame, by: Sequence[str] = (), idx: str = "idx") -> DataFrame:
    """Put two series side by side where their positions agree."""
    return match_on(left, right, [*by, idx])


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)
