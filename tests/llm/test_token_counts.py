import random

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from millrace.llm import queries, token_counts as g
from millrace.session import scratch_path

FOLDER = "/root/testdata/sf0.01"
MODEL, JSON = queries.SENTENCEPIECE_MODEL, "/opt/tokenizers/word_bpe_49k.json"


def shown(df):
    return sorted(((str(r.doc.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect()))


def wanted(docs, path=MODEL, limit=4096):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    if path.endswith(".model"):
        counts = [len(i) for i in SentencePieceProcessor(model_file=path).encode([t for _, t in rows])]
    else:
        counts = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for _, t in rows]
    return sorted((str(i), len(t.encode()), n, n > limit) for (i, t), n in zip(rows, counts))


def test_query_equals_the_library(spark):
    got = queries.op12_token_counts(spark, FOLDER).collect()
    want = wanted(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


@pytest.mark.parametrize("path", [MODEL, JSON])
def test_cache_is_read_and_appended(spark, odd, corpus, path, monkeypatch):
    monkeypatch.setattr(g, "HOT_SHARE", 20)
    cache = scratch_path(spark, "cache")
    half = corpus.where("doc_id % 2 = 0").select("doc_id", "text")
    first = g.count_tokens(half, path, cache, limit=300)
    assert shown(first) == wanted(half, path, 300) and not any(r.known for r in first.collect())
    both = corpus.select("doc_id", "text").union(odd.select("doc_id", "text"))
    second = g.count_tokens(both, path, cache, limit=300)
    assert shown(second) == wanted(both, path, 300)
    had = {r.text for r in half.collect()}
    assert {str(r.doc.doc_id) for r in second.collect() if r.known} == {str(r.doc_id) for r in both.collect() if r.text in had}
    calls = []
    monkeypatch.setattr(g, "_append", lambda *a: calls.append(a))
    third = g.count_tokens(both, path, cache, limit=300)
    assert shown(third) == wanted(both, path, 300) and not calls
    stored = g.cached(spark, f"{cache}/tokenizer={g.Counter.of(path).digest}")
    assert stored.count() == len({r.text or "" for r in both.collect()})
    assert spark.read.parquet(cache).count() == stored.count()  # nothing was encoded twice


def test_large_sides_are_not_broadcast(spark, corpus, monkeypatch):
    monkeypatch.setattr(g, "BROADCAST_ROWS", 10)
    assert shown(g.count_tokens(corpus.select("doc_id", "text"), MODEL)) == wanted(corpus)


def test_another_tokenizer_has_its_own_counts():
    a, b = g.Counter.of(MODEL), g.Counter.of(JSON)
    assert a.digest != b.digest and g.Counter(a.library, a.data + b"x", True, True).digest != a.digest


def test_pieces_add_up():
    rng = random.Random(3)
    model = SentencePieceProcessor(model_file=MODEL)
    parts = [" ", "  ", "\n", "word", "ä", "漢字", "▁", " ▁", "a b", "<s>", ". ", "\t", "\U0001f600", "thing "]
    for size in (1, 5, 30):
        for _ in range(200):
            text = "".join(rng.choice(parts) for _ in range(rng.randrange(60)))
            cut = list(g.pieces(text, size))
            assert sum(len(i) for i in model.encode(cut)) == len(model.encode(text))


def test_normal_form_keeps_counts():
    model = SentencePieceProcessor(model_file=MODEL)
    for text in ("a b", " a", "a  b ", "▁a b", "  "):
        assert model.encode(text) == model.encode(text.replace(" ", "▁"))


def test_long_texts_are_cut(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(g, "PIECE", 1_000)
    frame = odd.union(odd.selectExpr("doc_id", "repeat(text, 50)", "lang", "source", "n_chars", "row", "fp", "doc"))
    assert shown(g.count_tokens(frame, MODEL)) == wanted(frame)
    assert g.count_tokens(empty, MODEL).count() == 0
