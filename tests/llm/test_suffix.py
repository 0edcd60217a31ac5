import hashlib
import random

import pyarrow as pa
import pytest
import zstandard

from millrace.llm import queries, suffix_dedup
from millrace.llm.common import SLICE_BYTES

FOLDER = "/root/testdata/sf0.001"


def brute(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    return sorted(((r.doc.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def wanted(frame, length):
    have = frame.collect()
    return sorted(((r.doc_id, *b) for r, b in zip(have, brute([(r.text or "").encode() for r in have], length))), key=str)


@pytest.mark.parametrize("length,hot", [(200, 50_000), (200, 1), (64, 50_000), (64, 3), (48, 50_000), (248, 50_000)])
def test_equals_brute_force(spark, corpus, length, hot):
    got = rows(suffix_dedup.remove_repeats(corpus, length=length, hot=hot))
    assert got == wanted(corpus, length)
    assert sum(r[2] for r in got) > 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = queries.op2_suffix_dedup(spark, FOLDER).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == wanted(docs, 200)


def test_edges_of_repeats_with_different_partners(spark, monkeypatch):
    """Strings just as long as needed, whose parts recur with different neighbours."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    rng = random.Random(9)
    blocks = ["".join(rng.choice("ab") for _ in range(n)) for n in (50, 70, 90, 110)]
    texts = ["".join(rng.choice(blocks) for _ in range(rng.randint(1, 9))) + rng.choice("xyz") for _ in range(80)] + ["ab" * 300, "q" * 900]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert rows(suffix_dedup.remove_repeats(frame, length=120)) == wanted(frame, 120)


def test_merge_gives_order_and_shared_prefixes():
    rng = random.Random(1)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 30))) for _ in range(7)]
    got = list(suffix_dedup.merge([suffix_dedup.decode(suffix_dedup.front_code([(s, b"", 1, 0, 0) for s in r])) for r in runs]))
    want = sorted(s for r in runs for s in r)
    assert [g[1] for g in got] == want
    assert [g[0] for g in got[1:]] == [suffix_dedup.common(a, b, 0) for a, b in zip(want, want[1:])]


def test_odd_rows(spark, odd, empty):
    assert rows(suffix_dedup.remove_repeats(odd)) == wanted(odd, 200)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_unpacked_texts_are_bounded_by_bytes():
    texts = [b"", b"short", *[bytes([65 + k % 26]) * 1_000_000 for k in range(30)], b"", b"x" * (2 * SLICE_BYTES), b"end"]
    batch = pa.RecordBatch.from_arrays([pa.array([zstandard.ZstdCompressor(level=1).compress(t) for t in texts], pa.binary())], ["packed"])
    parts = [got for _, got in suffix_dedup._unpacked(iter([batch, batch.slice(0, 0)]))]
    assert [t for got in parts for t in got] == texts
    assert all(sum(map(len, got)) <= SLICE_BYTES + max(map(len, got)) for got in parts)


def made(df):
    """Rows that the frame of spans holds, and those of its texts."""
    return df.count(), df.select("row").distinct().count()


@pytest.mark.parametrize("kind", ["passage", "line"])
def test_one_row_for_each_text_however_often_a_string_recurs(spark, kind):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    passage, line = " ".join(word() for _ in range(115)), "one line that recurs within its text\n"
    texts = [f"{word()} {passage if kind == 'passage' else line * 40} {word()}" for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(7)
    packed = suffix_dedup._packed(frame, "text")
    for hot in (10, 50_000):
        spots, tasks = suffix_dedup._live_anchors(packed, 200, hot)
        spans = suffix_dedup._repeated_spans(packed, spots, tasks, 200)
        assert made(spans) == (400, 400)
        assert spans.selectExpr("max(size(spans))").first()[0] == 1
        assert rows(suffix_dedup.remove_repeats(frame, hot=hot)) == wanted(frame, 200)


def test_spans_are_joined_by_text():
    import numpy as np

    got = suffix_dedup.joined(np.array([7, 3, 7, 3, 7]), np.array([50, 0, 0, 10, 20]), np.array([60, 10, 30, 12, 25]))
    assert [x.tolist() for x in got] == [[3, 7, 7], [0, 0, 50], [12, 30, 60]]
    assert [len(x) for x in suffix_dedup.joined(*[np.zeros(0, np.int64)] * 3)] == [0, 0, 0]
