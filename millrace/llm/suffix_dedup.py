"""Removal of byte strings that occur twice, by a distributed merge sort of suffixes that knows common prefixes.

Any string of ``length`` bytes holds ``length - GRAM + 1`` runs of GRAM bytes. The one with the least hash is its anchor:
equal strings have their anchor at the same place with the same bytes, so only suffixes that begin at anchors are sorted,
about one in seventy. The steps are:

1. Tasks find the anchors of their texts. Anchors whose hash occurs once in the corpus cannot be part of a repeat.
2. For every other anchor a task takes the suffix from the anchor on and the bytes before it, as far as the strings that
   have this anchor reach. It does so for a lot of whole texts at a time, sorts the suffixes, folds equal ones, and sends
   them as front-coded runs (the length of the prefix shared with the one before, then the rest) and the number of their
   places, dealt by their first GRAM bytes. The places themselves go along as one list per lot.
3. The receiving task merges its runs with a loser tree. Each run remembers how many bytes its head shares with the last
   one taken: if two heads differ in that number, the larger wins unseen; if not, comparison starts behind those bytes.
   The prefix shared with the one before falls out for every suffix.
4. Strings that reach k bytes to the left of their anchor are equal if their suffixes share ``length - k`` bytes and the
   parts before share k bytes, the latter read from the sorted reversed parts. Both are runs in sorted orders, so every
   string of every anchor is settled exactly by counting pairs of run numbers.
5. Verdicts (a record of a run, the strings of it that repeat) go back to the lot, which turns them into the places of its
   texts and joins those of a text: one row for each text that holds a repeat, however many strings make it up.

A string that many texts share is thus a record for each lot, not for each place. An anchor that occurs more than ``hot``
times amid different bytes is no longer one group: each of its strings becomes a suffix of its own, dealt by all its bytes.

Lots follow the order of row numbers, so that a task run again after a loss deals the same records.

Defined results: NULL is the empty text, from which nothing is removed; texts below ``length`` bytes can't repeat;
repeated rows are texts of their own and thus copies of each other; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import partitions_for, slices, stage_table, utf8

#: Bytes of an anchor; bytes hashed at once; anchors of one kind that still form one group; anchors sorted in one task.
GRAM, PIECE, HOT, PER_TASK = 48, 1 << 20, 50_000, 150_000
#: Records settled at once, in whole groups; anchors that a task sorts into runs at once.
SETTLE, RUN = 50_000, 100_000
_MASK = np.uint64((1 << 24) - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on; doubles the length hashed, as GRAM is 32 + 16."""
    with np.errstate(over="ignore"):
        h = (data.astype(np.uint64) + np.uint64(1)) * _MIX
        h ^= h >> np.uint64(29)
        step, width, short = _STEP, 1, None
        while width < 32:
            h = h[:-width] * step + h[width:]
            step, width = step * step, 2 * width
            if width == GRAM - 32:
                short = h
                apart = step
        h = h[: len(data) - GRAM + 1] * apart + short[32 : 32 + len(data) - GRAM + 1]
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
    return h


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """For each place the place of the least hash among the next ``width`` ones, the first of equals."""
    m = (h & ~_MASK) | np.arange(len(h), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    rest = width - have
    m = np.minimum(m[: len(m) - rest], m[rest:]) if rest else m
    return (m & _MASK).astype(np.int64)


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(index of the text, anchor's place, first and last start of a string that has this anchor, anchor's hash)."""
    pieces = [(k, at, t[at : at + PIECE + length - 1]) for k, t in enumerate(texts) for at in range(0, max(1, len(t) - length + 1), PIECE) if len(t) >= length]
    found = []
    group: list[tuple[int, int, bytes]] = []
    size = 0
    for n, piece in enumerate(pieces):
        group.append(piece)
        size += len(piece[2])
        if size >= PIECE or n + 1 == len(pieces):
            data = np.frombuffer(b"".join(p[2] for p in group), np.uint8)
            sizes = np.array([len(p[2]) for p in group])
            owner = np.repeat(np.arange(len(group)), sizes)
            begin = np.cumsum(sizes) - sizes
            h = gram_hashes(data)
            place = least_places(h, length - GRAM + 1)
            valid = owner[: len(place)] == owner[length - 1 : length - 1 + len(place)]
            change = np.concatenate(([True], (place[1:] != place[:-1]) | ~valid[:-1]))
            first = np.flatnonzero(valid & change)
            last = np.flatnonzero(valid & np.concatenate((change[1:] | ~valid[1:], [True])))
            mine = owner[first]
            shift = np.array([p[1] for p in group])[mine] - begin[mine]
            at = place[first]
            found.append((np.array([p[0] for p in group])[mine], at + shift, first + shift, last + shift, h[at]))
            group, size = [], 0
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found))


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known and not looked at."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7 >> 3)


def front_code(records: list[tuple[bytes, bytes, int, int, int]]) -> bytes:
    """Records (suffix, part before it, places, least and largest k) in the order of their suffixes, as one blob."""
    shared, before = [], b""
    for suffix, *_ in records:
        shared.append(common(before, suffix, 0))
        before = suffix
    rest = [r[0][k:] for r, k in zip(records, shared)]
    heads = np.array([shared, list(map(len, rest)), [len(r[1]) for r in records], *([r[k] for r in records] for k in (2, 3, 4))], "<i4")
    return np.int64(len(records)).tobytes() + heads.tobytes() + b"".join(rest) + b"".join(r[1] for r in records)


def decode(blob: bytes, run: int = 0) -> Iterator[tuple[int, bytes, bytes, tuple[int, int, int, int, int]]]:
    """(bytes shared with the suffix before, suffix, part before it, (run, number, places, least k, largest k)), in order."""
    n = int(np.frombuffer(blob, "<i8", 1)[0])
    heads = np.frombuffer(blob, "<i4", 6 * n, 8).reshape(6, n)
    shared, rest, part, *facts = heads.tolist()
    at = 8 + heads.nbytes
    left, suffix = at + sum(rest), b""
    for k, told in enumerate(zip(*facts)):
        suffix = suffix[: shared[k]] + blob[at : at + rest[k]]
        yield shared[k], suffix, blob[left : left + part[k]], (run, k, *told)
        at, left = at + rest[k], left + part[k]


def merge(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """The records of all runs in order; the first field becomes the bytes shared with the record before in the result."""
    k = 1 << max(0, len(runs) - 1).bit_length()
    heads: list = [next(r, None) for r in runs] + [None] * (k - len(runs))
    shared = [0 if h else -1 for h in heads]  # with the last record taken; -1: the run is at its end
    keys = [h[1] if h else b"" for h in heads]

    def beats(a: int, b: int) -> bool:
        """Whether the head of run a goes before that of run b; the loser then knows what it shares with the winner."""
        x, y = shared[a], shared[b]
        if x != y:
            return x > y
        if x < 0:
            return True
        both = common(keys[a], keys[b], x)
        if keys[a][both:] <= keys[b][both:]:
            shared[b] = both
            return True
        shared[a] = both
        return False

    losers = [0] * k
    players = list(range(k))
    at = k
    while len(players) > 1:  # the first round; node n has the children 2n and 2n + 1
        at //= 2
        winners = []
        for n in range(at):
            a, b = players[2 * n], players[2 * n + 1]
            first = beats(a, b)
            winners.append(a if first else b)
            losers[at + n] = b if first else a
        players = winners
    top = players[0]
    while shared[top] >= 0:
        yield (shared[top], *heads[top][1:])
        head = heads[top] = next(runs[top], None)
        if head:
            shared[top], keys[top] = head[0], head[1]
        else:
            shared[top] = -1
        node = (top + k) // 2
        while node:
            other = losers[node]
            if not beats(top, other):
                losers[node], top = top, other
            node //= 2


def settle(lcp: np.ndarray, before: list[bytes], many: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    """Which strings repeat: [record, k] for the string that begins k bytes before the anchor.

    ``lcp``: bytes shared with the record before; ``many``: places folded into a record; low and high: its least and
    largest k. Records are in the order of their suffixes.
    """
    n = len(lcp)
    back = [p[::-1] for p in before]
    order = sorted(range(n), key=back.__getitem__)
    shared = np.array([0] + [common(back[a], back[b], 0) for a, b in zip(order, order[1:])])
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    found = np.zeros((n, int(high.max()) + 1), bool)
    for k in range(int(low.min()), int(high.max()) + 1):
        own = np.flatnonzero((low <= k) & (k <= high))
        if not len(own):
            continue
        right = np.cumsum(lcp < length - k)[own]
        left = np.cumsum(shared < k)[rank[own]]
        pair = right * np.int64(n + 1) + left
        by = np.argsort(pair, kind="stable")
        edge = np.flatnonzero(np.concatenate(([True], np.diff(pair[by]) != 0)))
        total = np.add.reduceat(many[own][by], edge)
        found[own[by], k] = np.repeat(total > 1, np.diff(np.append(edge, len(by))))
    return found


def repeats(runs: list[bytes], length: int) -> Iterator[np.ndarray]:
    """Columns (run, record, first k, behind the last k) of strings that repeat, from the front-coded runs of one task."""

    def emit(records: list[tuple]) -> np.ndarray | None:
        lcp = np.array([r[0] for r in records], np.int64)
        lcp[0] = 0
        told = np.array([r[3] for r in records], np.int64)
        kept = np.flatnonzero((lcp >= GRAM) | (np.append(lcp[1:], 0) >= GRAM) | (told[:, 2] > 1))
        if not len(kept):
            return None
        told, lcp = told[kept], np.where(lcp[kept] >= GRAM, lcp[kept], 0)
        found = settle(lcp, [records[i][2] for i in kept], told[:, 2], told[:, 3], told[:, 4], length)
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        rec, near = np.nonzero(edge == 1)
        _, far = np.nonzero(edge == -1)
        return np.column_stack((told[rec, :2], near, far))

    group: list[tuple] = []
    for record in merge([decode(b, n) for n, b in enumerate(runs)]):
        if len(group) >= SETTLE and record[0] < GRAM:
            verdicts = emit(group)
            if verdicts is not None:
                yield verdicts
            group = []
        group.append(record)
    verdicts = emit(group) if group else None
    if verdicts is not None:
        yield verdicts


def joined(row: np.ndarray, first: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of bytes (row, first, behind the last) in order, those of a row that meet or overlap made one."""
    if not len(row):
        return row, first, behind
    order = np.lexsort((first, row))
    row, first, behind = row[order], first[order], behind[order]
    rank = np.cumsum(np.diff(row, prepend=row[:1]) != 0)
    width = int(behind.max(initial=0)) + 1
    reach = np.maximum.accumulate(rank * width + behind)  # rows lie apart by more than any place
    opens = np.concatenate(([True], rank[1:] * width + first[1:] > reach[:-1]))
    at = np.flatnonzero(opens)
    last = np.append(at[1:], len(row)) - 1
    return row[at], first[at], reach[last] - rank[last] * width


def _packed(docs: DataFrame, text_col: str) -> DataFrame:
    """(row, doc, packed): row number, the row without its text, the compressed text; written once, as several jobs join on the numbers."""
    others = [c for c in docs.columns if c != text_col]
    doc = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), doc.alias("doc"), F.col(text_col).cast("string").alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in slices(batch):
                packed = pa.array([squeeze(t) for t in utf8(part)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc"), packed], ["row", "doc", "packed"])

    table = stage_table(rows.mapInArrow(pack, f"row bigint, doc {rows.schema['doc'].dataType.simpleString()}, packed binary"))
    return table.where("row is not null")  # said here, an inner and a left join read the same exchange


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches with their texts, cut like all others by the bytes of text, which the heads of the frames tell."""
    unsqueeze = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        heads = pc.binary_slice(batch.column("packed"), 0, 18).to_pylist()
        for part in slices(batch, lengths=np.array([zstandard.frame_content_size(h) for h in heads], np.int64)):
            yield part, [unsqueeze(t) for t in part.column("packed").to_pylist()]


def _live_anchors(packed: DataFrame, length: int, hot: int) -> tuple[DataFrame, int]:
    """(row, spots) of anchors that occur more than once, and the number of tasks to sort them in.

    A spot is the anchor's place, a bit for hot anchors, and its distances to the first and last start of a string.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _unpacked(batches):
            text, place, first, last, h = anchors(texts, length)
            row = part.column("row").to_numpy()[text]
            spot = place << 17 | place - first << 8 | place - last
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(spot), pa.array(h.view(np.int64))], ["row", "spot", "hash"])

    found = stage_table(packed.select("row", "packed").mapInArrow(find, "row bigint, spot bigint, hash bigint"))
    live = stage_table(found.groupBy("hash").count().where("count > 1"))
    strings = F.col("count") * F.when(F.col("count") > hot, length - GRAM + 1).otherwise(1)
    total = live.agg(F.sum(strings)).first()[0] or 0
    marked = found.join(live, "hash").select("row", (F.col("spot") + F.when(F.col("count") > hot, 1 << 16).otherwise(0)).alias("spot"))
    return marked.groupBy("row").agg(F.sort_array(F.collect_list("spot")).alias("spots")), partitions_for(packed, total, PER_TASK)


def _members(lot: dict[int, list[list[int]]]) -> bytes:
    """The places of a lot: for each part and each record of its run in turn, the (row, place) pairs."""
    runs = list(lot.values())
    many = np.array([len(w) // 2 for r in runs for w in r], "<i8")
    heads = np.array([len(runs), len(many), *lot, *map(len, runs)], "<i8")
    return heads.tobytes() + many.tobytes() + np.fromiter((x for r in runs for w in r for x in w), "<i8", 2 * int(many.sum())).tobytes()


def _spans(members: bytes, verdicts: list[tuple[int, np.ndarray]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joined spans of a lot, from its places and the verdicts (record, first k, behind the last k) of each part."""
    at = np.frombuffer(members, "<i8")
    runs, records = at[:2].tolist()
    base = dict(zip(at[2 : 2 + runs].tolist(), (np.cumsum(at[2 + runs : 2 + 2 * runs]) - at[2 + runs : 2 + 2 * runs]).tolist()))
    many = at[2 + 2 * runs : 2 + 2 * runs + records]
    pairs = at[2 + 2 * runs + records :].reshape(-1, 2)
    begin = np.cumsum(many) - many
    told = np.concatenate([v + (base[part], 0, 0) for part, v in verdicts])
    n = many[told[:, 0]]
    spread = np.repeat(np.arange(len(told)), n)
    member = begin[told[spread, 0]] + np.arange(len(spread)) - np.repeat(np.cumsum(n) - n, n)
    row, place = pairs[member, 0], pairs[member, 1]
    return joined(row, place - told[spread, 2] + 1, place - told[spread, 1] + length)


def _repeated_spans(packed: DataFrame, spots: DataFrame, tasks: int, length: int) -> DataFrame:
    """(row, spans: array of first and behind-last byte, in order and apart), one row for each text that holds a repeat."""
    parts = 2 * tasks  # a few to a task evens out their sizes
    kinds = "part int, lot bigint, run binary, places binary"

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        dealt: dict[int, dict[tuple[bytes, bytes, int, int], list[int]]] = {}
        held, lot = 0, -1

        def flush() -> pa.RecordBatch:
            tasks, blobs, lists = list(dealt), [], {}
            for t in tasks:
                own = sorted(dealt.pop(t).items())
                blobs.append(squeeze(front_code([(s, p, len(w) // 2, low, high) for (s, p, low, high), w in own])))
                lists[t] = [w for _, w in own]
            n = len(tasks)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*tasks, lot % parts], pa.int32()),
                    pa.array([lot] * (n + 1), pa.int64()),
                    pa.array([*blobs, None], pa.binary()),
                    pa.array([*[None] * n, squeeze(_members(lists))], pa.binary()),
                ],
                ["part", "lot", "run", "places"],
            )

        for part, texts in _unpacked(batches):
            for row, text, spots in zip(part.column("row").to_pylist(), texts, part.column("spots").to_pylist()):
                lot = row if lot < 0 else lot  # a lot has the number of its first row
                for spot in spots:
                    place, high, low = spot >> 17, spot >> 8 & 255, spot & 255
                    if spot >> 16 & 1:
                        for at in range(place - high, place - low + 1):
                            suffix = text[at : at + length]
                            dealt.setdefault(crc32(suffix) % parts, {}).setdefault((suffix, b"", 0, 0), []).extend((row, at))
                        held += high - low
                    else:
                        suffix = text[place : place - low + length]
                        own = dealt.setdefault(crc32(suffix[:GRAM]) % parts, {})
                        own.setdefault((suffix, text[place - high : place], low, high), []).extend((row, place))
                held += len(spots)
                if held > RUN:
                    yield flush()
                    held, lot = 0, -1
        if lot >= 0:
            yield flush()

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, unsqueeze = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        mine: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            places = batch.filter(pc.is_valid(batch.column("places")))
            yield places
            for part, lot, run in zip(*(batch.column(c).to_pylist() for c in ("part", "lot", "run"))):
                if run is not None:
                    mine.setdefault(part, []).append((lot, run))
        for part in list(mine):
            lots, blobs = zip(*mine.pop(part))
            found = list(repeats([unsqueeze(b) for b in blobs], length))
            if not found:
                continue
            told = np.concatenate(found)
            told = told[np.argsort(told[:, 0], kind="stable")]
            which, at = np.unique(told[:, 0], return_index=True)
            out = [squeeze(v[:, 1:].astype("<i8").tobytes()) for v in np.split(told, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(out), pa.int32()), pa.array([lots[k] for k in which], pa.int64()), pa.array(out, pa.binary()), pa.nulls(len(out), pa.binary())],
                ["part", "lot", "run", "places"],
            )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unsqueeze = zstandard.ZstdDecompressor().decompress
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            for k in range(batch.num_rows):
                told = batch.column("told")[k].as_py()
                verdicts = [(v["part"], np.frombuffer(unsqueeze(v["run"]), "<i8").reshape(-1, 3)) for v in told]
                row, first, behind = _spans(unsqueeze(batch.column("places")[k].as_py()), verdicts, length)
                at = np.flatnonzero(np.diff(row, prepend=-1))
                pairs = pa.StructArray.from_arrays([pa.array(first), pa.array(behind)], ["a", "b"])
                lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(row)), pa.int32()), pairs)
                yield pa.RecordBatch.from_arrays([pa.array(row[at]), lists.cast(kind)], ["row", "spans"])

    # A merge join leaves rows in the order of their numbers, which makes lots the same whenever a task runs again.
    sent = packed.join(spots.hint("merge"), "row").select("row", "packed", "spots").mapInArrow(runs, kinds).repartition(tasks, "part")
    back = sent.mapInArrow(sort, kinds)
    told = F.collect_list(F.when(F.col("run").isNotNull(), F.struct("part", "run"))).alias("told")
    lots = back.groupBy("lot").agg(told, F.max("places").alias("places")).where(F.size("told") > 0)
    return lots.mapInArrow(spread, "row bigint, spans array<struct<a:bigint,b:bigint>>")


def _cut(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left of a text, bytes removed, maximal runs removed."""
    if not spans:
        return text, 0, 0
    ends = [0, *(s["b"] for s in spans)]
    starts = [*(s["a"] for s in spans), len(text)]
    left = b"".join(text[a:b] for a, b in zip(ends, starts))
    return left, len(text) - len(left), len(spans)


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = 200, hot: int = HOT, kept: str | None = "binary") -> DataFrame:
    """For every row of ``docs``: n_bytes, n_removed, n_spans, kept_sha256 and kept, and the other columns as ``doc``.

    Cuts may fall inside a character: ``kept`` is "binary", or "string" without what is left of such characters, or None
    for results without it.
    """
    if kept not in ("binary", "string", None):
        raise ValueError(f"kept can't be {kept}")
    if not GRAM <= length <= GRAM + 200:
        raise ValueError(f"length must be from {GRAM} to {GRAM + 200}")
    packed = _packed(docs, text_col)
    spots, tasks = _live_anchors(packed, length, hot)
    spans = _repeated_spans(packed, spots, tasks, length)
    joined = packed.join(spans.hint("shuffle_hash"), "row", "left")
    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * (kept is not None)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _unpacked(batches):
            done = [_cut(t, s) for t, s in zip(texts, part.column("spans").to_pylist())]
            columns = [
                part.column("doc"),
                pa.array(map(len, texts), pa.int64()),
                pa.array([d[1] for d in done], pa.int64()),
                pa.array([d[2] for d in done], pa.int64()),
                pa.array([hashlib.sha256(d[0]).hexdigest() for d in done], pa.string()),
            ]
            if kept == "binary":
                columns.append(pa.array([d[0] for d in done], pa.binary()))
            elif kept == "string":
                columns.append(pa.array([d[0].decode("utf-8", "ignore") for d in done], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    doc = packed.schema["doc"].dataType.simpleString()
    return joined.mapInArrow(cut, f"doc {doc}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (f", kept {kept}" if kept else ""))

