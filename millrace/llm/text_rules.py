"""Rule statistics of whole texts, counted over the bytes of many texts at once.

Words are runs of bytes other than ASCII blanks. A NULL or empty text has zeros. The exact counts are what the rules ask
for; ``shares`` turns them into numbers that do not grow with the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm.common import slices

#: Bytes of text counted at once.
AT_ONCE = 2_000_000
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_same", "n_upper", "n_digits",
    "n_stops", "n_marks", "n_other", "n_long", "n_bare", "n_marked", "n_marked_lines",
)
SHARES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeated", "distinct", "same", "upper", "digits", "stops", "marks", "other",
    "long", "bare", "line_words", "symbol_chars", "marked", "marked_lines",
)


def _table(characters: bytes) -> np.ndarray:
    hit = np.zeros(256, bool)
    hit[list(characters)] = True
    return hit


BLANK, SYMBOL, UPPER, DIGIT, STOP = _table(b" \t\n\r\x0b\x0c"), _table(b"#*$%&|<>"), _table(bytes(range(65, 91))), _table(b"0123456789"), _table(b".!?,;:")
LETTER = _table(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
MARK = ~(LETTER | BLANK | SYMBOL | DIGIT | STOP)
FOLLOW = _table(bytes(range(128, 192)))  # bytes inside a character


def _sums(flags: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int32 if len(flags) < 1 << 31 else np.int64)
    np.cumsum(flags, out=total[1:])
    return total[end].astype(np.int64) - total[begin]


def _earlier(owner: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether the same code occurred before with the same owner; owners ascend."""
    pair = owner * (np.int64(code.max(initial=0)) + 1) + code
    order = np.argsort(pair, kind="stable")
    out = np.zeros(len(pair), bool)
    out[order[1:]] = np.diff(pair[order]) == 0
    return out


def _repeat_words(owner: np.ndarray, code: np.ndarray, docs: int) -> np.ndarray:
    """Per text: words inside windows of three that occur twice or more in it."""
    if len(code) < 3:
        return np.zeros(docs, np.int64)
    size = np.int64(code.max()) + 1
    own = owner[2:] == owner[:-2]
    if int(size) ** 3 * docs < 1 << 62:
        window = ((owner[:-2] * size + code[:-2]) * size + code[1:-1]) * size + code[2:]
    else:
        pairs = np.unique(code[:-1] * size + code[1:], return_inverse=True)[1]
        triple = np.unique(pairs[:-1] * size + code[2:], return_inverse=True)[1]
        window = owner[:-2] * np.int64(triple.max() + 1) + triple
    order = np.argsort(window[own], kind="stable")
    at = np.flatnonzero(own)[order]
    same = np.diff(window[at]) == 0
    twice = np.zeros(len(code), bool)
    twice[at[1:]] |= same
    twice[at[:-1]] |= same
    inside = twice.copy()
    inside[1:] |= twice[:-1]
    inside[2:] |= twice[:-2]
    return np.bincount(owner[inside], minlength=docs)


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The COUNTS of each text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(t.as_buffer() for t in texts), np.uint8)
    end = np.cumsum(sizes)
    begin = end - sizes
    blank = BLANK[data]
    opens, closes = np.ones(len(data), bool), np.ones(len(data), bool)
    opens[1:], closes[:-1] = blank[:-1], blank[1:]
    some = sizes > 0
    opens[begin[some]] = closes[end[some] - 1] = True
    first, last = np.flatnonzero(opens & ~blank), np.flatnonzero(closes & ~blank)
    del opens, closes
    owner = np.searchsorted(end, first, side="right")  # the first text that ends behind the word's start
    ends = np.concatenate(([0], np.cumsum(last + 1 - first)))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(data[~blank])])
    code = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    del words, ends
    out = {"n_words": np.bincount(owner, minlength=n)}
    follow = FOLLOW[data]
    out["word_chars"] = _sums(~blank & ~follow, begin, end)
    for name, table in (("n_symbols", SYMBOL), ("n_upper", UPPER), ("n_digits", DIGIT), ("n_stops", STOP), ("n_marks", MARK)):
        out[name] = _sums(table[data], begin, end)
    out["n_other"] = _sums((data >= 192), begin, end)
    lines = pc.split_pattern(texts, "\n")
    many = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    line_doc = np.repeat(np.arange(n), many)
    line_code = lines.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    # A line has a word if a word starts in it: lines are told apart by the newlines before a place.
    line_of_word = np.searchsorted(np.flatnonzero(data == 10), first) + owner  # n-th line over all texts: each text adds one line to its newlines
    with_word = np.bincount(line_of_word, minlength=len(line_doc)).astype(bool)
    out["n_lines"] = np.bincount(line_doc[with_word], minlength=n)
    out["n_dup_lines"] = np.bincount(line_doc[with_word & _earlier(line_doc, line_code)], minlength=n)
    out["n_repeat_words"] = _repeat_words(owner, code, n)
    out["n_distinct"] = out["n_words"] - np.bincount(owner[_earlier(owner, code)], minlength=n)
    same = np.zeros(len(code), bool)
    same[1:] = (code[1:] == code[:-1]) & (owner[1:] == owner[:-1])
    out["n_same"] = np.bincount(owner[same], minlength=n)
    letters = _sums(LETTER[data] & ~follow, first, last + 1)
    out["n_long"] = np.bincount(owner[letters > 20], minlength=n)
    out["n_bare"] = np.bincount(owner[letters == 0], minlength=n)
    marked = _sums(SYMBOL[data], first, last + 1) > 0
    out["n_marked"] = np.bincount(owner[marked], minlength=n)
    out["n_marked_lines"] = np.bincount(line_doc[np.unique(line_of_word[marked])], minlength=n)
    return out


def shares(c: dict[str, np.ndarray]) -> np.ndarray:
    """[text, number of SHARES] as doubles."""
    words, chars, lines = (np.maximum(c[k], 1).astype(float) for k in ("n_words", "word_chars", "n_lines"))
    values = {
        "log_words": np.log1p(c["n_words"]), "word_length": c["word_chars"] / words, "symbols": c["n_symbols"] / words, "dup_lines": c["n_dup_lines"] / lines,
        "repeated": c["n_repeat_words"] / words, "distinct": c["n_distinct"] / words, "same": c["n_same"] / words, "upper": c["n_upper"] / chars,
        "digits": c["n_digits"] / chars, "stops": c["n_stops"] / words, "marks": c["n_marks"] / chars, "other": c["n_other"] / chars,
        "long": c["n_long"] / words, "bare": c["n_bare"] / words, "line_words": c["n_words"] / lines,
        "symbol_chars": c["n_symbols"] / chars, "marked": c["n_marked"] / words, "marked_lines": c["n_marked_lines"] / lines,
    }
    return np.stack([values[s].astype(float) for s in SHARES], axis=1)


KINDS = ", ".join(f"{c} bigint" for c in COUNTS) + ", shares array<double>"


def counted(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
    """Parts of a batch with a column text, and their columns of KINDS."""
    for part in slices(batch, size=AT_ONCE):
        c = counts(part.column("text"))
        x = shares(c)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
        yield part, [*[pa.array(c[k].astype(np.int64)) for k in COUNTS], flat]


def count_rows(texts: DataFrame) -> DataFrame:
    """(id, COUNTS, shares) for (id, text); the id goes through the counting, so that no join is needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, columns in counted(batch):
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], ["id", *COUNTS, "shares"])

    return texts.select("id", "text").mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, {KINDS}")
