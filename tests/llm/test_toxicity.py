from zlib import crc32

import numpy as np
import pytest

from millrace.llm import queries, toxic_grammar as g

FOLDER = "/root/testdata/sf0.1"


def matches(text, terms=("=fool", "^twerp")):
    return {p: n for p, n in zip(g.PATTERNS, g.Matcher(g.Lexicon.of(list(terms)))(text)) if n}


@pytest.mark.parametrize(
    "text,want",
    [
        ("a fool came", {"insult": 1}),
        ("you fool", {"directed_insult": 1}),
        ("what a fool you are", {"directed_insult": 1}),
        ("not a fool", {"negated_insult": 1}),
        ("not here or anywhere near a fool", {"insult": 1}),
        ("they said the fool came", {"reported_insult": 1}),
        ("they said so. The fool came", {"insult": 1}),
        ('the word "fool" is old', {"reported_insult": 1}),
        ("twerpish twerp", {"insult": 1}),
        ("I will kill you", {"directed_threat": 1}),
        ("never kill", {"negated_threat": 1}),
        ("a fool, then one more fool far away from any of them", {"insult": 2}),
        ("you and they said", {}),
        ("", {}),
    ],
)
def test_patterns(text, want):
    assert matches(text) == want


def test_composed_machine_equals_machines_in_turn():
    rng = np.random.default_rng(0)
    weights = {p: float(k + 1) for k, p in enumerate(g.PATTERNS)}
    whole = g.grammar(weights)
    for _ in range(300):
        symbols = "".join(rng.choice(list(g.SYMBOLS), rng.integers(0, 25)))
        first, _, _ = g.negation().run(symbols)
        second, _, _ = g.reported().run(first)
        third, _, weight = g.targeted(weights).run(second)
        out, _, total = whole.run(symbols)
        assert out == third and total == pytest.approx(weight)
        counts = g.Matcher(g.Lexicon.of([]))._clause(symbols)
        assert total == pytest.approx(sum(weights[p] * n for p, n in zip(g.PATTERNS, counts)))
        assert min(counts) >= 0


def test_long_clauses_are_folded_without_changing_them():
    m = g.Matcher(g.Lexicon.of(["=fool"]))
    for gap in range(12):
        text = "you " + "word " * gap + "fool " + "word " * gap + "you"
        symbols = "y" + "o" * gap + "i" + "o" * gap + "y"
        assert m(text) == list(m._clause(symbols))


def test_cover_takes_what_explains_most():
    assert g.cover([{0, 1}, {0, 1}, {0}, {2}, {2}, {3}], np.zeros(4), 2) == [0, 2]


def test_query_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = queries.op5_toxicity_grammar(spark, FOLDER).collect()
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    rows = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    caught, flagged = (np.mean([p for l, p in rows if l == k]) for k in (1, 0))
    # Some rows of label 1 hold no word that marks others, so not all can be caught.
    assert caught > 0.8 and flagged < 0.02


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (5, None, None), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    for frame, tags in ((odd, labels), (odd, labels.limit(0)), (empty, labels)):
        got = g.toxicity(frame, tags).collect()
        assert sorted(str(r.doc.doc_id) for r in got) == sorted(str(r.doc_id) for r in frame.collect())
        assert all(0 <= r.score <= 1 for r in got)


def test_arcs_carry_the_weights():
    weights = {p: 0.5 + k for k, p in enumerate(g.PATTERNS)}
    m = g.Matcher(g.Lexicon.of(["=fool"]), weights)
    assert any(w for _, _, w in m.machine.arcs.values())
    for text in ("you fool. a fool came! they said the fool came", "not a fool; I will kill you", "kind words only", "what a fool you are, fool"):
        counts, weight = m.score(text)
        assert counts == m(text) and weight == pytest.approx(sum(weights[p] * n for p, n in zip(g.PATTERNS, counts)))


def test_long_texts_are_read_clause_by_clause(monkeypatch):
    text = "You fool. They said the fool came; a \"fool\" is not a fool! " * 50 + "no end " * 30 + "fool"
    m = g.Matcher(g.Lexicon.of(["=fool"]), {p: 1.0 for p in g.PATTERNS})
    whole = m.score(text)
    monkeypatch.setattr(g, "PIECE", 40)
    assert m.score(text) == whole and len(list(g.pieces(text))) > 40 and "".join(g.pieces(text)) == text
