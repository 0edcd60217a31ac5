import random
import struct

import pyarrow as pa
import pytest
import sentencepiece

from millrace.llm import queries, sentencepiece_codec as codec

FOLDER = "/root/testdata/sf0.001"
PATH = queries.SENTENCEPIECE_MODEL
ODD = ["", " ", "  two  blanks ", "a\nb\tc", "<s> </s> <unk> <0x41>", "漢字 \U0001f600 ünï", "x" * 3000, " lead", "tail ", "a" + " " * 40 + "b", "▁marker▁", "\x00\x01", "end.\n", "  　"]


def message(*fields):
    """A protobuf message from (number, value): text and bytes with a length, floats in four bytes, whole numbers."""
    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for k, v in fields:
        if isinstance(v, float):
            out += number(k << 3 | 5) + struct.pack("<f", v)
        elif isinstance(v, int):
            out += number(k << 3) + number(v)
        else:
            v = v.encode() if isinstance(v, str) else v
            out += number(k << 3 | 2) + number(len(v)) + v
    return out


def unigram(byte_fallback, **normal):
    rng = random.Random(4)
    pieces = {c: -rng.uniform(4, 8) for c in "abcdefgh▁"} | {"".join(rng.choices("abcdefgh", k=n)): -rng.uniform(3, 12) for n in (2, 2, 2, 3, 3, 4) for _ in range(12)}
    pieces |= {"▁" + p: s - 0.5 for p, s in list(pieces.items())[:40] if "▁" not in p}
    parts = [message((1, "<unk>"), (2, 0.0), (3, 2)), message((1, "<s>"), (2, 0.0), (3, 3))]
    if byte_fallback:
        parts += [message((1, f"<0x{b:02X}>"), (2, 0.0), (3, 6)) for b in range(256)]
    parts += [message((1, p), (2, s)) for p, s in pieces.items()]
    spec = message((3, 1), (35, int(byte_fallback)), (40, 0))
    rules = message((1, "identity"), (3, normal.get("dummy", 1)), (4, normal.get("fold", 1)), (5, 1))
    return b"".join(message((1, p)) for p in parts) + message((2, spec), (3, rules))


def encoded(data, texts):
    model = codec.parse_model(data)
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    lists, parity, back = codec.encode_texts(pa.array(texts, pa.string()), codec.build_tokenizer(model), reference, codec.piece_bytes(model), model.by_words, model.dummy_prefix, 2)
    return lists.to_pylist(), parity.tolist(), back.tolist(), reference, model


def test_bpe_model_equals_the_library():
    texts = [*ODD, None, "plain words here"]
    got, parity, back, reference, model = encoded(open(PATH, "rb").read(), texts)
    assert model.kind == codec.BPE and model.by_words and len(model.pieces) == 32_000
    assert got == [reference.encode(t) if t is not None else [] for t in texts]
    assert [t for t, ok in zip(texts, parity) if not ok] == ["a" + " " * 40 + "b"]  # equal scores
    assert all(b for t, b in zip(texts, back) if not t or "▁" not in t)
    for ids in got:
        assert codec.decode_ids(ids, codec.piece_bytes(model)).decode("utf-8", "replace") == reference.decode(ids)


@pytest.mark.parametrize("byte_fallback", [True, False])
@pytest.mark.parametrize("normal", [{}, {"fold": 0}, {"dummy": 0}, {"dummy": 0, "fold": 0}])
def test_unigram_model_equals_the_library(byte_fallback, normal):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefgh  z", k=rng.randint(0, 40))) for _ in range(200)] + ["漢字 ab", "a\nb", "<s>a"]
    got, parity, _, reference, model = encoded(unigram(byte_fallback, **normal), texts)
    assert model.kind == codec.UNIGRAM and model.byte_fallback == byte_fallback
    assert got == [reference.encode(t) for t in texts]
    assert all(parity)


def test_models_beyond_reach_raise():
    piece = message((1, message((1, "<unk>"), (2, 0.0), (3, 2))))
    with pytest.raises(ValueError):
        codec.parse_model(piece + message((2, message((3, 4)))))
    with pytest.raises(ValueError):
        codec.parse_model(piece + message((1, message((1, "x"), (3, 4)))) + message((2, message((3, 1)))))


def test_query_equals_the_library(spark):
    reference = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = queries.op9_sentencepiece(spark, FOLDER).collect()
    assert {r.doc_id: r.ids for r in got} == {i: reference.encode(t) for i, t in docs.items()}
    assert all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in got)
    tokens = codec.encode(spark.read.parquet(f"{FOLDER}/documents.parquet"), PATH)
    back = codec.decode(tokens.select("doc.doc_id", "ids"), PATH).collect()
    assert {r.doc.doc_id: r.text for r in back} == docs


def test_odd_rows(spark, odd, empty):
    reference = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = codec.encode(odd, PATH).collect()
    want = sorted(str(reference.encode(r.text) if r.text else []) for r in odd.collect())
    assert sorted(str(r.ids) for r in got) == want
    assert codec.encode(empty, PATH).count() == 0
