"""SentencePiece encoding and decoding on the tokenizers library.

``parse_model`` reads the model's protobuf; ``build_tokenizer`` makes a tokenizer of the same results: the normaliser (its
character map, blanks folded if the model says so, the marker for blanks in front and in place of blanks), unigram scores or
the merges that a BPE model's scores stand for, and bytes for characters that are not in the vocabulary.

``encode`` sends the tokenizer to the tasks, which encode the distinct units of a batch in several threads. If no piece
reaches from one word into the next and texts are not rewritten, the units are the words between single blanks; else, and
for texts with runs of blanks or blanks at an end, they are whole texts. Each distinct unit is also encoded by the
sentencepiece library: ``parity`` tells whether all units of a text agree, ``round_trip`` whether its tokens decode to it.
Where they differ the library's tokens are returned; this is known of BPE models that give several pieces one score, as
they do for long runs of blanks, since ranked merges cannot prefer the leftmost of equals.

Defined results: NULL and empty texts have no tokens (and agree); repeated rows are encoded alike; strings that look like
control tokens are ordinary text; no rows give no rows. The other columns stay inside ``doc``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices

MARKER = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Bytes of text whose units are told apart together; units encoded in one call, bytes of them unless one is longer.
AT_ONCE, UNITS, UNIT_BYTES = 14_000_000, 8_192, 1_000_000


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, kind
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_blanks: bool = False
    unknown_text: str = " ⁇ "
    character_map: bytes = b""
    dummy_prefix: bool = True
    fold_blanks: bool = True
    escape_blanks: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    @property
    def by_words(self) -> bool:
        """Whether a text's tokens are those of its words one after the other."""
        crossing = any(MARKER in p.lstrip(MARKER) for p, _, k in self.pieces if k == NORMAL)
        return not (crossing or self.character_map or self.fold_blanks) and self.dummy_prefix and self.escape_blanks


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message; numbers come as int, all else as bytes."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def parse_model(data: bytes) -> Model:
    """The parts of a model file that encoding needs."""
    model = Model()
    for part, value in _fields(data):
        if part == 1:
            piece = dict(_fields(value))
            model.pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
        elif part == 2:
            spec = dict(_fields(value))
            model.kind = spec.get(3, UNIGRAM)
            model.byte_fallback, model.suffix_blanks = bool(spec.get(35, 0)), bool(spec.get(24, 0))
            model.unknown_text = spec.get(44, model.unknown_text.encode()).decode()
        elif part == 3:
            spec = dict(_fields(value))
            model.character_map = spec.get(2, b"")
            model.dummy_prefix, model.fold_blanks, model.escape_blanks = (bool(spec.get(k, 1)) for k in (3, 4, 5))
    if model.kind not in (UNIGRAM, BPE) or model.suffix_blanks or not model.escape_blanks:
        raise ValueError("only unigram and BPE models with the marker in front of words are supported")
    if any(k in (USER_DEFINED, UNUSED) for _, _, k in model.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    return model


def build_tokenizer(model: Model):
    from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

    if model.kind == UNIGRAM:
        # Control pieces keep their numbers, under names that no text has: a text that spells them must not become them.
        hidden = "\ufffe\uffff"
        scores = [(hidden + p if k in (CONTROL, UNKNOWN) else p, s) for p, s, k in model.pieces]
        tokenizer = Tokenizer(models.Unigram(scores, model.unknown, model.byte_fallback))
    else:
        ids = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        normal = {p for p, _, k in model.pieces if k == NORMAL}
        merges = [
            (-score, i, p[:cut], p[cut:])
            for i, (p, score, k) in enumerate(model.pieces)
            if k == NORMAL
            for cut in range(1, len(p))
            if p[:cut] in normal and p[cut:] in normal
        ]
        merges = [(a, b) for _, _, a, b in sorted(merges, key=lambda m: (m[0], ids[m[2]], ids[m[3]]))]
        unknown = model.pieces[model.unknown][0]
        tokenizer = Tokenizer(models.BPE(vocab=ids, merges=merges, unk_token=unknown, byte_fallback=model.byte_fallback, fuse_unk=True))
    steps = []
    if model.character_map:
        steps.append(normalizers.Precompiled(model.character_map))
    if model.fold_blanks:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER))
    steps.append(normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = normalizers.Sequence(steps)
    cuts = []
    if not any(MARKER in p.lstrip(MARKER) for p, _, k in model.pieces if k == NORMAL):
        cuts.append(f"(?<=[^{MARKER}])(?={MARKER})")
    if model.kind == UNIGRAM and model.byte_fallback:
        cuts.append("(?<=<)(?=0x[0-9A-F]{2}>)")  # a text that spells a byte piece is not that byte
    if cuts:
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex("|".join(cuts)), "isolated")
    return tokenizer


def piece_bytes(model: Model) -> list[bytes]:
    """What each token decodes to."""
    plain = {UNKNOWN: lambda p: model.unknown_text.encode(), CONTROL: lambda p: b"", BYTE: lambda p: bytes([int(p[3:5], 16)])}
    return [plain.get(k, lambda p: p.replace(MARKER, " ").encode())(p) for p, _, k in model.pieces]


def decode_ids(ids: list[int], table: list[bytes], dummy_prefix: bool = True) -> bytes:
    text = b"".join([table[i] for i in ids])
    return text[1:] if dummy_prefix and text[:1] == b" " else text


def _units(texts: pa.Array, by_words: bool) -> tuple[pa.Array, np.ndarray]:
    """All units of the texts in order, and how many each text has."""
    texts = texts.cast(pa.large_string())
    if by_words:
        whole = pc.fill_null(pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " "))), False)
        if not pc.any(whole).as_py():
            lists = pc.fill_null(pc.split_pattern(texts, " "), [])
            return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        cut = [[] if t is None else [t] if w else t.split(" ") for t, w in zip(texts.to_pylist(), whole.to_pylist())]
        return pa.array(chain.from_iterable(cut), pa.large_string()), np.array([len(c) for c in cut], np.int64)
    many = pc.is_valid(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    return texts.drop_null(), many


def _chunks(units: pa.Array) -> Iterator[list[str]]:
    """The units in lists of bounded number and size: what the library returns for a unit is far larger than the unit."""
    size = np.cumsum(pc.binary_length(units).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(units):
        stop = int(np.searchsorted(size, (size[start - 1] if start else 0) + UNIT_BYTES))
        stop = min(max(start + 1, stop), start + UNITS)
        yield units.slice(start, stop - start).to_pylist()
        start = stop


def encode_texts(texts: pa.Array, tokenizer, reference, table: list[bytes], by_words: bool, dummy_prefix: bool, threads: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(list of ids, parity, round trip) for each text."""
    units, many = _units(texts, by_words)
    coded = units.dictionary_encode()
    ids_of, sizes_of, same_of, back_of = [], [], [], []
    for some in _chunks(coded.dictionary):
        found = [e.ids for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        other = reference.encode(some, num_threads=threads)
        same = [a == b for a, b in zip(found, other)]
        found = [a if ok else b for ok, a, b in zip(same, found, other)]
        ids_of.append(np.fromiter(chain.from_iterable(found), np.int32))
        sizes_of.append(np.fromiter(map(len, found), np.int64, len(found)))
        same_of.append(np.array(same, bool))
        back_of.append(np.array([decode_ids(i, table, dummy_prefix) == u.encode() for i, u in zip(found, some)], bool))
    flat, sizes, same, back = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((ids_of, np.int32), (sizes_of, np.int64), (same_of, bool), (back_of, bool)))
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = sizes[code]
    starts = (np.cumsum(sizes) - sizes)[code]
    ids = flat[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    ends = np.concatenate(([0], np.cumsum(many)))
    tokens = np.concatenate(([0], np.cumsum(size)))[ends]
    wrong, lost = (np.concatenate(([0], np.cumsum(~ok[code])))[ends] for ok in (same, back))
    lists = pa.LargeListArray.from_arrays(pa.array(tokens), pa.array(ids)).cast(pa.list_(pa.int32()))
    return lists, np.diff(wrong) == 0, np.diff(lost) == 0


def encode(docs: DataFrame, model_path: str, text_col: str = "text", threads: int = 2) -> DataFrame:
    """For every row: the other columns as ``doc``, ids, n_tokens, parity, round_trip."""
    with open(model_path, "rb") as file:  # on the driver only: half a megabyte goes to the tasks
        data = file.read()
    model = parse_model(data)
    sent = docs.sparkSession.sparkContext.broadcast((data, build_tokenizer(model).to_str(), piece_bytes(model)))
    by_words, dummy_prefix = model.by_words, model.dummy_prefix
    others = [c for c in docs.columns if c != text_col]
    doc = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(doc.alias("doc"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        data, built, table = sent.value
        tokenizer, reference = Tokenizer.from_str(built), SentencePieceProcessor(model_proto=data)
        for batch in batches:
            for part in slices(batch, size=AT_ONCE):
                ids, parity, back = encode_texts(part.column("text"), tokenizer, reference, table, by_words, dummy_prefix, threads)
                count = pc.cast(pc.list_value_length(ids), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc"), ids, count, pa.array(parity), pa.array(back)], ["doc", "ids", "n_tokens", "parity", "round_trip"])

    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, ids array<int>, n_tokens bigint, parity boolean, round_trip boolean")


def decode(tokens: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """The other columns as ``doc`` and ``text``: the ids decoded, bytes that are no UTF-8 replaced; NULL stays NULL."""
    with open(model_path, "rb") as file:
        model = parse_model(file.read())
    sent = tokens.sparkSession.sparkContext.broadcast(piece_bytes(model))
    dummy_prefix = model.dummy_prefix
    others = [c for c in tokens.columns if c != ids_col]
    doc = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = tokens.select(doc.alias("doc"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if i is None else decode_ids(i, sent.value, dummy_prefix).decode("utf-8", "replace") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], ["doc", "text"])

    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, text string")
