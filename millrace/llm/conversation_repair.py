"""Repair of the structure of conversations by a checkpointed dynamic program.

A sound conversation has the role initials ``(s?(ua)+)?``: an optional system turn, then pairs of user and assistant turns, or
nothing at all. The cheapest edits that make it sound are looked for: keep a turn (0), give it the role that is due (2), delete
it (3; the only choice for blank turns and repeats), or insert an empty turn that is due (2). Truncated turns that stay add 1.

What is due follows from the state alone (nothing yet, behind the system turn, behind a user turn, behind an assistant turn),
so the least cost of finishing from each state is a vector of four numbers behind every turn. Conversations are cut into
blocks of about the square root of the longest one:

1. A block's turns become one byte each. The block's matrix says what it costs to get from each state before it to each state
   behind it.
2. The matrices of a conversation, one small row per block, give the vectors at the blocks' ends from the last to the first.
   Only these checkpoints are kept.
3. A block computes its own vectors again from its checkpoint and walks forward, always taking the edit whose letter (Delete,
   Insert, Keep, Rerole) comes first among those that lie on a cheapest way. It does so for each state that it may begin in.
4. From the states that the walks end in follows the one in which each block begins, and thus its edits.

So no step holds the turns of a conversation, only the final hash reads them one after the other, sorted by Spark.

Faults, of which a turn's first counts: blank (no character but blanks), duplicate (role and text seen earlier in the
conversation), truncated (the last character is none of ``.!?``). Turns are ordered by number (NULL first), role and text.

Defined results: NULL roles and texts are one blank; NULL conversations are one conversation; turns whose initial is none of
s, u and a can't be kept; repeated rows are duplicates of each other; no rows give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stage_table
from millrace.operators import series

#: Blanks, as in words; least turns of a block.
BLANKS, LEAST_BITS = " \t\n\x0b\f\r", 6
#: Kinds of turns by their initials, faults, and the bits of a turn's byte that tell them.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States: nothing yet, behind the system turn, behind a user turn, behind an assistant turn. The role that is due, the state after it.
DUE, NEXT = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
FINISH = (0, 4, 2, 0)  # what it costs to finish without further turns
#: More than any cost; the code that marks the first turn of its role and text, above all others.
FAR, FIRST = 1 << 40, 16


def kept_state(state: int, kind: int) -> int:
    """The state behind a turn that is kept, -1 if it can't be."""
    if kind == SYSTEM:
        return 1 if state == 0 else -1
    return NEXT[state] if kind == (ASSISTANT if state == 2 else USER) else -1


def before_turns(codes: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Costs from each state before a turn, for turns of many blocks at once: codes [block], costs behind them [block, state, ...]."""
    kind = codes & 3
    stays = np.array([0, FAR, FAR, 1])[codes >> 2].reshape(-1, *[1] * (behind.ndim - 2))  # what it costs besides not to delete
    out = behind + 3
    for s in range(4):
        out[:, s] = np.minimum(out[:, s], behind[:, NEXT[s]] + 2 + stays)
        for k in range(3):
            t = kept_state(s, k)
            if t >= 0:
                mine = kind == k
                out[mine, s] = np.minimum(out[mine, s], (behind[:, t] + stays)[mine])
    return inserted(out)


def inserted(costs: np.ndarray) -> np.ndarray:
    """The same with insertions before the turn."""
    for _ in range(2):  # a third insertion would come back to a state
        costs = np.minimum(costs, costs[:, NEXT] + 2)
    return costs


def matrices(blocks: list[bytes]) -> np.ndarray:
    """[block, state before, state behind]: least costs, behind the last turn without insertions."""
    size = max(map(len, blocks), default=0)
    codes = np.full((len(blocks), size), -1)
    for n, b in enumerate(blocks):
        codes[n, size - len(b) :] = np.frombuffer(b, np.uint8)  # ends side by side
    costs = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, FAR), (len(blocks), 4, 4)).copy()
    for at in range(size - 1, -1, -1):
        here = np.flatnonzero(codes[:, at] >= 0)
        costs[here] = before_turns(codes[here, at], costs[here])
    return np.minimum(costs, FAR)


def walk(codes: bytes, end: list[int], starts: list[int]) -> dict[int, tuple[int, str]]:
    """(state behind the block, edits) for each state before it; ``end``: costs behind the block, insertions included."""
    row = np.array([end])
    vectors = [end]
    for code in reversed(codes):
        row = before_turns(np.array([code]), row)
        vectors.append(row[0].tolist())
    vectors.reverse()
    out = {}
    for start in starts:
        at, state, edits = 0, start, []
        while at < len(codes):
            cost = vectors[at][state]
            behind, fault = vectors[at + 1], codes[at] >> 2
            if behind[state] + 3 == cost:
                edits.append("D")
                at += 1
                continue
            if vectors[at][NEXT[state]] + 2 == cost:
                edits.append("I")
                state = NEXT[state]
                continue
            kept = kept_state(state, codes[at] & 3)
            if kept >= 0 and behind[kept] + (fault == TRUNCATED) == cost:
                edits.append("K")
                state = kept
            else:
                edits.append("R")
                state = NEXT[state]
            at += 1
        out[start] = state, "".join(edits)
    return out


def closing(state: int) -> int:
    """How many turns must be inserted at the end."""
    return FINISH[state] // 2


def _placed(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, idx) written once."""
    blank = F.lit(" ")
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), blank).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), blank).alias("text"),
    )
    return stage_table(series.with_position(rows, ["turn", "role", "text"], ["conv"]), "zstd")


def _blocks(placed: DataFrame, bits: int) -> DataFrame:
    """(conv, block, codes: a byte for each turn in order)."""
    rest = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    fault = F.when(rest == "", BLANK).when(F.substring(rest, -1, 1).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    block = F.shiftright("idx", bits).alias("block")
    coded = placed.select("conv", block, "idx", (fault * 4 + kind).alias("code"))
    # A turn is a duplicate unless it is the first of its role and text: the firsts join their block like another column.
    firsts = placed.groupBy("conv", "role", F.sha2("text", 256).alias("digest")).agg(F.min("idx").alias("idx"))
    firsts = firsts.select("conv", block, "idx", F.lit(FIRST).alias("code"))
    listed = F.array_sort(F.collect_list(F.struct("idx", "code")))
    both = coded.unionByName(firsts).groupBy("conv", "block").agg(listed.alias("told"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = batch.column("told")
            sizes = told.value_lengths().to_numpy(zero_copy_only=False)
            flat = told.flatten()
            code = flat.field("code").to_numpy(zero_copy_only=False)
            is_first = np.append(code[1:], 0) == FIRST  # the mark follows its turn
            turn = code != FIRST
            repeat = turn & ~is_first & (code >> 2 != BLANK)
            code = np.where(repeat, DUPLICATE << 2 | code & 3, code)
            owner = np.repeat(np.arange(len(sizes)), sizes)[turn]
            code = code[turn].astype(np.uint8)
            cuts = np.searchsorted(owner, np.arange(len(sizes) + 1))
            codes = pa.array([code[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), codes], ["conv", "block", "codes"])

    kind = placed.schema["conv"].dataType.simpleString()
    return both.mapInArrow(run, f"conv {kind}, block bigint, codes binary")


def illegal_pairs(kinds: np.ndarray) -> int:
    """Neighbours that are none of su, ua, au."""
    pair = kinds[:-1] * 4 + kinds[1:]
    return int(np.count_nonzero(~np.isin(pair, (SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER))))


def _judged(blocks: DataFrame) -> DataFrame:
    """Blocks with their matrices, counts of faults, pairs that are not allowed, first and last kind."""
    names = ["conv", "block", "codes", "matrix", "facts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column("codes").to_pylist()
            kinds = [np.frombuffer(c, np.uint8) for c in codes]
            facts = [[*np.bincount(k >> 2, minlength=4)[1:].tolist(), illegal_pairs((k & 3).astype(int)), int(k[0] & 3), int(k[-1] & 3)] for k in kinds]
            matrix = pa.array(matrices(codes).reshape(len(codes), 16).tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), matrix, pa.array(facts, pa.list_(pa.int64()))], names)

    kind = blocks.schema["conv"].dataType.simpleString()
    return blocks.mapInArrow(run, f"conv {kind}, block bigint, codes binary, matrix array<bigint>, facts array<bigint>")


def _checkpoints(judged: DataFrame) -> DataFrame:
    """One row per conversation: facts (blank, duplicate, truncated, illegal, cost), and the costs at each block's end."""
    told = F.array_sort(F.collect_list(F.struct("block", "matrix", "facts"))).alias("told")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts, ends = [], []
            for blocks in batch.column("told").to_pylist():  # as many as the square root of the conversation's turns
                here = np.array([b["facts"] for b in blocks])
                edges = np.column_stack((here[:-1, 5], here[1:, 4])).reshape(-1, 2)
                broken = int(here[:, 3].sum()) + sum(illegal_pairs(e) for e in edges)
                vector = np.array(FINISH)
                vectors = []
                for b in reversed(blocks):
                    vectors.append({"block": b["block"], "end": vector.tolist()})
                    vector = (np.array(b["matrix"]).reshape(4, 4) + vector).min(1)
                facts.append([*here[:, :3].sum(0).tolist(), broken, int(vector[0])])
                ends.append(vectors)
            kind = pa.list_(pa.struct([("block", pa.int64()), ("end", pa.list_(pa.int64()))]))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(facts, pa.list_(pa.int64())), pa.array(ends, kind)], ["conv", "facts", "ends"])

    kind = judged.schema["conv"].dataType.simpleString()
    return judged.groupBy("conv").agg(told).mapInArrow(run, f"conv {kind}, facts array<bigint>, ends array<struct<block:bigint,end:array<bigint>>>")


def _walked(judged: DataFrame, ends: DataFrame) -> DataFrame:
    """(conv, block, ways: array of (start, stop, edits))."""
    each = ends.select("conv", F.explode("ends").alias("at")).select("conv", "at.block", "at.end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("edits", pa.string())]))
        for batch in batches:
            ways = []
            for block, codes, end in zip(*(batch.column(c).to_pylist() for c in ("block", "codes", "end"))):
                found = walk(codes, end, [0] if block == 0 else [0, 1, 2, 3])
                ways.append([{"start": a, "stop": b, "edits": e} for a, (b, e) in found.items()])
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), pa.array(ways, kind)], ["conv", "block", "ways"])

    kind = judged.schema["conv"].dataType.simpleString()
    joined = series.match_on(judged.select("conv", "block", "codes"), each, ["conv", "block"])
    return joined.mapInArrow(run, f"conv {kind}, block bigint, ways array<struct<start:int,stop:int,edits:string>>")


def _taken(walked: DataFrame) -> DataFrame:
    """(conv, block, start, edits): the way of each block that begins where the one before it ends."""
    stops = F.transform("ways", lambda w: F.struct(w.start.alias("start"), w.stop.alias("stop")))
    told = F.array_sort(F.collect_list(F.struct("block", stops.alias("ways")))).alias("told")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("block", pa.int64()), ("start", pa.int32()), ("last", pa.bool_())]))
        for batch in batches:
            starts = []
            for blocks in batch.column("told").to_pylist():
                state, here = 0, []
                for b in blocks:
                    here.append({"block": b["block"], "start": state, "last": b is blocks[-1]})
                    state = next(w["stop"] for w in b["ways"] if w["start"] == state)
                starts.append(here)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(starts, kind)], ["conv", "starts"])

    kind = walked.schema["conv"].dataType.simpleString()
    starts = walked.groupBy("conv").agg(told).mapInArrow(run, f"conv {kind}, starts array<struct<block:bigint,start:int,last:boolean>>")
    each = starts.select("conv", F.explode("starts").alias("at")).select("conv", "at.*")
    both = series.match_on(walked, each, ["conv", "block"])
    way = F.filter("ways", lambda w: w.start == F.col("start"))[0]
    close = F.when(~F.col("last"), 0).otherwise(F.element_at(F.array(*[F.lit(closing(s)) for s in range(4)]), way.stop + 1))
    return both.select("conv", "block", "start", F.concat(way.edits, F.repeat(F.lit("I"), close)).alias("edits"))


def _edits(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Placed turns, the edits of each block, facts of conversations, bits of a block's number of turns."""
    placed = _placed(turns, conv_col, turn_col, role_col, text_col)
    longest = (placed.agg(F.max("idx")).first()[0] or 0) + 1
    bits = max(LEAST_BITS, isqrt(longest).bit_length())
    judged = stage_table(_judged(_blocks(placed, bits)))
    checked = stage_table(_checkpoints(judged))
    return placed, stage_table(_taken(_walked(judged, checked))), checked.select("conv", "facts"), bits


def _played(placed: DataFrame, edits: DataFrame, bits: int, hashed: bool) -> DataFrame:
    """The repaired turns (conv, place, edit, role, text), or their hashes (conv, repaired_sha256): edits and turns of a
    conversation follow each other in one sorted partition, of which one block's edits are held."""
    kind = placed.schema["conv"].dataType.simpleString()
    none = F.lit(None).cast("string")
    rows = placed.select("conv", F.shiftright("idx", bits).alias("block"), "idx", "role", "text", none.alias("edits"), F.lit(0).alias("start"))
    marks = edits.select("conv", "block", F.lit(-1).cast("bigint").alias("idx"), none.alias("role"), none.alias("text"), "edits", F.col("start").cast("int").alias("start"))
    ordered = rows.unionByName(marks).repartition("conv").sortWithinPartitions("conv", "block", "idx")

    def turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, int, str, str, str]]:
        """(conv, place, edit, role, text) of the turns that stay, and of a conversation's head (place -1)."""
        conv, todo, at, state, place = None, "", 0, 0, 0

        def inserts() -> Iterator[tuple]:
            nonlocal at, state, place
            while at < len(todo) and todo[at] == "I":
                yield conv, place, "I", DUE[state], ""
                at, state, place = at + 1, NEXT[state], place + 1

        for batch in batches:
            for c, block, idx, role, text, now, start in zip(*(batch.column(k).to_pylist() for k in ("conv", "block", "idx", "role", "text", "edits", "start"))):
                if idx < 0:
                    yield from inserts()
                    if block == 0:
                        conv, place = c, 0
                        yield c, -1, "", "", ""
                    todo, at, state = now, 0, start
                    continue
                yield from inserts()
                edit = todo[at]
                at += 1
                if edit == "D":
                    continue
                if edit == "R":
                    role = DUE[state]
                state = 1 if role[:1] == "s" else NEXT[state]
                yield c, place, edit, role, text
                place += 1
        yield from inserts()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, found, digest = [], [], None
        for conv, place, _, role, text in turns_of(batches):
            if place < 0:
                if digest is not None:
                    found.append(digest.hexdigest())
                convs.append(conv)
                digest = hashlib.sha256()
            else:
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            if len(found) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(convs[: len(found)], arrow), pa.array(found)], ["conv", "repaired_sha256"])
                convs, found = convs[len(found) :], []
        if digest is not None:
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(convs, arrow), pa.array(found, pa.string())], ["conv", "repaired_sha256"])

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, size = [], 0
        kinds = [arrow, pa.int64(), pa.string(), pa.string(), pa.string()]
        names = ["conv", "place", "edit", "role", "text"]
        for turn in turns_of(batches):
            if turn[1] < 0:
                continue
            some.append(turn)
            size += len(turn[4]) + 100
            if size > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*some), kinds)], names)
                some, size = [], 0
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*some), kinds)], names)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(placed.schema["conv"].dataType)
    if hashed:
        return ordered.mapInArrow(digests, f"conv {kind}, repaired_sha256 string")
    return ordered.mapInArrow(repaired, f"conv {kind}, place bigint, edit string, role string, text string")


COLUMNS = {"conv_col": "conv_id", "turn_col": "turn", "role_col": "role", "text_col": "text"}


def repaired_turns(turns: DataFrame, **columns: str) -> DataFrame:
    """(conv, place, edit, role, text): the turns of all conversations after the cheapest edits, in order of place."""
    placed, edits, _, bits = _edits(turns, **COLUMNS | columns)
    return _played(placed, edits, bits, hashed=False)


def repair(turns: DataFrame, **columns: str) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    gaps: numbers missing between the least and largest turn; illegal: neighbours whose initials can't follow each other;
    audit: initials of the edits in order; the hash is that of the repaired ``role:text`` lines.
    """
    placed, edits, facts, bits = _edits(turns, **COLUMNS | columns)
    spans = placed.groupBy("conv").agg(F.min("turn").alias("least"), F.max("turn").alias("most"), F.count_distinct("turn").alias("many"))
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("many"), F.lit(0)).cast("bigint")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "edits"))), lambda e: e.edits), "")
    audits = edits.groupBy("conv").agg(audit.alias("audit"))
    joined = series.match_on(spans.select("conv", gaps.alias("gaps")), facts, ["conv"])
    joined = series.match_on(series.match_on(joined, audits, ["conv"]), _played(placed, edits, bits, hashed=True), ["conv"])
    counts = [F.col("facts")[k].alias(name) for k, name in enumerate(("blank", "duplicate", "truncated", "illegal", "cost"))]
    return joined.select("conv", "gaps", *counts, "audit", "repaired_sha256")
