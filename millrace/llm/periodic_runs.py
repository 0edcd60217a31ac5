"""Runs of repeated words by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and at least ``max(least, 2 q)``
words, that no word next to it extends. Words are numbered per text, and texts are taken many at a time:

1. At the scale b = 2, 4, 8, ... the words are cut into aligned blocks of b. A run of period q in [2b, 4b) has a block among
   its first words whose copy lies q words on, so each block is looked for in the window of these distances behind it. The
   smallest scale takes all shorter periods too.
2. The sum of squared differences of a block and each stretch of its window is sum x^2 + sum y^2 - 2 sum xy; the products
   are a convolution, made by number-theoretic transforms modulo a prime. Numbers of words are cut into digits so small that
   every sum is less than the prime: the sums are exact, and zero means that all words agree. Blocks with a word that does not
   occur again in its window are left out beforehand.
3. Zeros of neighbouring blocks at one distance form chains. What lies before and behind a chain is less than a block, and is
   compared word by word. That gives each stretch of equal words q apart once, and thus the run.
4. A block of a run with a short period matches at every multiple of it. Such distances are skipped where block and copy lie in
   one known run, as they would lead to the same stretch. Of stretches found with several periods the least period stays.

Memory follows the slice of texts, whose transforms are made in pieces of bounded size; a very long text is a slice.

Defined results: NULL, empty and blank texts have no words and no runs; repeated rows have equal runs; no rows give no rows.
The other columns stay inside ``doc``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices, utf8

#: A prime with roots of unity of every order up to 2^23, and a generator; numbers transformed at once; words named at once.
PRIME, GENERATOR, AT_ONCE, NAMED = 998_244_353, 3, 1 << 17, 1 << 17
_P = np.uint64(PRIME)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_roots: dict[tuple[int, bool], np.ndarray] = {}


def roots(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half."""
    if (half, inverse) not in _roots:
        step = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
        step = pow(step, PRIME - 2, PRIME) if inverse else step
        powers = np.ones(half, np.uint64)
        have = 1
        while have < half:  # doubles the powers known
            powers[have : 2 * have] = powers[:have] * np.uint64(pow(step, have, PRIME)) % _P
            have *= 2
        _roots[half, inverse] = powers
    return _roots[half, inverse]


def transform(a: np.ndarray) -> np.ndarray:
    """The transform of each row, in place, in bit-reversed order; rows have a power of two of numbers below the prime."""
    half = a.shape[1] // 2
    while half:
        x = a.reshape(len(a), -1, 2, half)
        u, v = x[:, :, 0].copy(), x[:, :, 1]
        x[:, :, 0] = (u + v) % _P
        x[:, :, 1] = (u + _P - v) * roots(half, False) % _P
        half //= 2
    return a


def back(a: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``."""
    half, size = 1, a.shape[1]
    while half < size:
        x = a.reshape(len(a), -1, 2, half)
        u, v = x[:, :, 0].copy(), x[:, :, 1] * roots(half, True) % _P
        x[:, :, 0] = (u + v) % _P
        x[:, :, 1] = (u + _P - v) % _P
        half *= 2
    a *= np.uint64(pow(size, PRIME - 2, PRIME))
    a %= _P
    return a


def mismatches(names: np.ndarray, at: np.ndarray, b: int, low: int, high: int) -> np.ndarray:
    """[block, distance - low]: sum of squared differences of digits, zero if the b words from ``at`` on recur there.

    ``names`` must go on for ``high + b`` places behind every block's first.
    """
    digit = max(1, (29 - (b.bit_length() - 1)) // 2)  # b * (2^digit)^2 is less than the prime
    size = 4 * b
    total = np.zeros((len(at), high - low), np.int64)
    block_at, window_at = at[:, None] + np.arange(b), at[:, None] + low + np.arange(high - low + b - 1)
    blocks, windows = names[block_at], names[window_at]
    most = int(max(blocks.max(initial=0), windows.max(initial=0)))
    for shift in range(0, max(1, most.bit_length()), digit):
        x, y = (w >> shift & (1 << digit) - 1 for w in (blocks, windows))
        left, right = np.zeros((len(at), size), np.uint64), np.zeros((len(at), size), np.uint64)
        left[:, :b] = x[:, ::-1]
        right[:, : y.shape[1]] = y
        products = back(transform(left) * transform(right) % _P)[:, b - 1 : b - 1 + high - low].astype(np.int64)
        sums = np.cumsum(np.pad(y * y, ((0, 0), (1, 0))), axis=1)
        total += (x * x).sum(1)[:, None] + (sums[:, b:] - sums[:, :-b]) - 2 * products
    return total


def recurring(keys: np.ndarray, order: np.ndarray, low: int, high: int) -> np.ndarray:
    """Whether the word at each place occurs again at a distance from low to high - 1; keys: word and place as one number, sorted."""
    at = np.searchsorted(keys, keys + low)
    near = at < len(keys)
    near[near] = keys[at[near]] < keys[near] + high
    out = np.zeros(len(keys), bool)
    out[order] = near
    return out


def runs_of(names: np.ndarray, sizes: np.ndarray, least: int = 12) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, in this order; names of words of one text after the other."""
    n = len(names)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = (ends - sizes)[owner], ends[owner]
    longest = int(sizes.max(initial=0))
    if longest < least:
        return np.zeros((0, 4), np.int64)
    # A word of another text has another key, and lies farther than any window.
    word = owner * (int(names.max()) + 1) + names
    gap = 2 * n + 8 * longest + 64
    order = np.lexsort((np.arange(n), word))
    rank = np.cumsum(np.diff(word[order], prepend=word[order[:1]]) != 0)
    keys = rank * gap + order
    padded = np.concatenate((names, np.zeros(longest // 2 + 16, names.dtype)))
    covered = np.zeros(n, np.int64)  # behind the last word of the known run of short period that holds a word
    found: list[np.ndarray] = []
    waiting: list[np.ndarray] = []
    b = 2
    while b == 2 or 4 * b <= longest:
        low, high = (1, 8) if b == 2 else (2 * b, 4 * b)
        for runs in waiting:
            for s, e, q in runs[runs[:, 2] <= b].tolist():
                np.maximum(covered[s:e], e, out=covered[s:e])
        waiting = [runs[runs[:, 2] > b] for runs in waiting]
        alive = recurring(keys, order, low, high)
        at = np.arange(0, n - b + 1, b)
        at = at[alive[: len(at) * b].reshape(-1, b).all(1)]
        at = at[at + low + b <= end[at]]
        seeds = []
        step = max(1, AT_ONCE // (4 * b))
        for k in range(0, len(at), step):
            some = at[k : k + step]
            which, apart = np.nonzero(mismatches(padded, some, b, low, high) == 0)
            seeds.append(np.column_stack((apart + low, some[which])))
        seeds = np.concatenate(seeds) if seeds else np.zeros((0, 2), np.int64)
        stop = seeds.sum(1) + b
        seeds = seeds[(stop <= end[seeds[:, 1]]) & (stop > covered[seeds[:, 1]])]
        if len(seeds):
            runs = _extended(padded, seeds, begin, end, b, least)
            found.append(runs)
            waiting.append(runs)
        b *= 2
    if not found:
        return np.zeros((0, 4), np.int64)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)  # of one stretch the least period
    runs = runs[first]
    text = owner[runs[:, 0]]
    out = np.column_stack((text, runs[:, 0] - (ends - sizes)[text], runs[:, 1] - runs[:, 0], runs[:, 2]))
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _extended(names: np.ndarray, seeds: np.ndarray, begin: np.ndarray, end: np.ndarray, b: int, least: int) -> np.ndarray:
    """(start, behind the last, period) from matches (distance, place) of blocks: chains, and the words around them."""
    seeds = seeds[np.lexsort((seeds[:, 1], seeds[:, 0]))]
    apart = np.ones(len(seeds) + 1, bool)
    apart[1:-1] = (seeds[1:, 0] != seeds[:-1, 0]) | (seeds[1:, 1] != seeds[:-1, 1] + b)
    q, first, last = seeds[apart[:-1], 0], seeds[apart[:-1], 1], seeds[apart[1:], 1] + b
    out = []
    step = max(1, AT_ONCE // b)
    for k in range(0, len(q), step):
        p, s, e = q[k : k + step], first[k : k + step], last[k : k + step]
        places = s[:, None] - 1 - np.arange(b)
        same = (names[np.maximum(places, 0)] == names[np.maximum(places, 0) + p[:, None]]) & (places >= begin[s][:, None])
        start = s - np.where(same.all(1), b, same.argmin(1))
        places = e[:, None] + np.arange(b)
        inside = places + p[:, None] < end[s][:, None]
        same = inside & (names[np.where(inside, places, 0)] == names[np.where(inside, places + p[:, None], 0)])
        stop = e + np.where(same.all(1), b, same.argmin(1)) + p
        long = stop - start >= np.maximum(least, 2 * p)
        out.append(np.column_stack((start, stop, p))[long])
    return np.concatenate(out)


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last bytes of the words of a text."""
    edges = np.flatnonzero(np.diff(_SPACE[np.frombuffer(text, np.uint8)], prepend=True, append=True))
    return edges[::2], edges[1::2]


def name_words(text: bytes, first: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Numbers of the words in the order of their first occurrence."""
    name = defaultdict(count().__next__)
    some = (name[text[a:b]] for k in range(0, len(first), NAMED) for a, b in zip(first[k : k + NAMED].tolist(), behind[k : k + NAMED].tolist()))
    return np.fromiter(some, np.int64, len(first))


def collapsed(text: bytes, first: np.ndarray, behind: np.ndarray, runs: np.ndarray) -> bytes:
    """The words that no run (start, length, period) holds after its first period, joined by single blanks."""
    change = np.zeros(len(first) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    first, behind = first[kept], behind[kept]
    parts = (b" ".join([text[a:b] for a, b in zip(first[k : k + NAMED].tolist(), behind[k : k + NAMED].tolist())]) for k in range(0, len(first), NAMED))
    return b" ".join(parts)


def find_runs(docs: DataFrame, text_col: str = "text", least: int = 12) -> DataFrame:
    """For every row: the other columns as ``doc``, n_words, runs: array of (start, length, period) by start, then period, and
    collapsed: the text with a single period left of every run and single blanks between words."""
    if least < 12:
        raise ValueError("runs of fewer than 12 words need not hold a block of the smallest scale")
    others = [c for c in docs.columns if c != text_col]
    doc = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(doc.alias("doc"), F.col(text_col).cast("string").alias("text"))
    fields = ("start", "length", "period")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = utf8(part)
                bounds = [word_bounds(t) for t in texts]
                sizes = np.array([len(f) for f, _ in bounds], np.int64)
                names = np.concatenate([name_words(t, *b) for t, b in zip(texts, bounds)])
                found = runs_of(names, sizes, least)
                cuts = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
                left = [collapsed(t, *b, found[x:y, 1:]) for t, b, x, y in zip(texts, bounds, cuts, cuts[1:])]
                triples = pa.StructArray.from_arrays([pa.array(found[:, k + 1]) for k in range(3)], fields)
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), triples)
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(sizes), lists, pa.array(left, pa.binary()).cast(pa.string())], ["doc", "n_words", "runs", "collapsed"])

    kinds = ",".join(f"{f}:bigint" for f in fields)
    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, n_words bigint, runs array<struct<{kinds}>>, collapsed string")
