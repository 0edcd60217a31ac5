"""Rule statistics, the forest on them, and the additive model."""

import math
import re
import subprocess
import sys
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import additive_quality, queries, rule_forest, text_rules

FOLDER, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.01"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


def brute_all(text):
    """All COUNTS of a text, in their order."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [re.findall(r"[^\x20\x09-\x0D]+", line) for line in text.split("\n")]
    letters = [sum(c.isascii() and c.isalpha() or c > "\x7f" for c in w) for w in words]
    marked = [bool(re.search(r"[#*$%&|<>]", w)) for w in words]
    return brute(text) + (
        sum(map(bool, lines)),
        len(set(words)),
        sum(a == b for a, b in zip(words, words[1:])),
        len(re.findall("[A-Z]", text)),
        len(re.findall("[0-9]", text)),
        len(re.findall("[.!?,;:]", text)),
        len(re.findall(r"[^A-Za-z0-9.!?,;:#*$%&|<>\x20\x09-\x0D\x80-\U0010ffff]", text)),
        len(re.findall(r"[\x80-\U0010ffff]", text)),
        sum(n > 20 for n in letters),
        sum(n == 0 for n in letters),
        sum(marked),
        sum(any(re.search(r"[#*$%&|<>]", w) for w in line) for line in lines),
    )


def brute_shares(text):
    c = dict(zip(text_rules.COUNTS, brute_all(text)))
    words, chars, lines = (max(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    over = {
        "word_length": (c["word_chars"], words), "symbols": (c["n_symbols"], words), "dup_lines": (c["n_dup_lines"], lines), "repeated": (c["n_repeat_words"], words),
        "distinct": (c["n_distinct"], words), "same": (c["n_same"], words), "upper": (c["n_upper"], chars), "digits": (c["n_digits"], chars), "stops": (c["n_stops"], words),
        "marks": (c["n_marks"], chars), "other": (c["n_other"], chars), "long": (c["n_long"], words), "bare": (c["n_bare"], words), "line_words": (c["n_words"], lines),
        "symbol_chars": (c["n_symbols"], chars), "marked": (c["n_marked"], words), "marked_lines": (c["n_marked_lines"], lines),
    }
    return [math.log1p(c["n_words"]) if s == "log_words" else over[s][0] / over[s][1] for s in text_rules.SHARES]


def by_hash(ids, salt):
    """Ids in the order of Spark's xxhash64(id, salt)."""

    def place(i):
        first = xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), 42)
        second = xxhash.xxh64_intdigest(salt.to_bytes(4, "little"), first)
        return second - (1 << 64) if second >> 63 else second

    return sorted(ids, key=place)


def small_tables(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    return docs, {i: v for i, v in labels.items() if i in docs and v is not None and crc32(str(i).encode()) % 3 != 1}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab #|\n\r\x0b\x85 é漢Z7.,@")), st.text(max_size=40)), min_size=1, max_size=6))
def test_all_counts_and_shares_equal_brute_force(texts):
    got = text_rules.counts(pa.array(texts, pa.string()))
    assert [tuple(int(got[k][i]) for k in text_rules.COUNTS) for i in range(len(texts))] == [brute_all(t) for t in texts]
    assert np.allclose(text_rules.shares(got), [brute_shares(t) for t in texts], rtol=1e-12, atol=0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab #|\n\r\x0b\x85 é漢")), st.text(max_size=20)), min_size=1, max_size=6))
def test_counts_equal_brute_force(texts):
    got = text_rules.counts(pa.array(texts, pa.string()))
    assert [tuple(int(got[k][i]) for k in BASE) for i in range(len(texts))] == [brute(t) for t in texts]


def test_windows_of_many_distinct_words(monkeypatch):
    rng = np.random.default_rng(0)
    code = rng.integers(0, 6, 400)
    owner = np.sort(rng.integers(0, 9, 400))
    plain = text_rules._repeat_words(owner, code, 9)
    assert (text_rules._repeat_words(owner, code * 400_000, 9) == plain).all()  # too many for one number


def test_rule_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = queries.op1_isolation_rules(spark, FOLDER).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute(docs[r.doc_id])
        assert tuple(r[k] for k in BASE) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_forest_equals_plain_walk(spark):
    """Scores, threshold and verdicts of the whole table by a walk down each tree, text by text."""
    docs, told = small_tables(spark)
    shares = {i: brute_shares(t) for i, t in docs.items()}
    failed = {i: c[0] < 50 or 100 * c[4] > 50 * c[0] for i, c in ((i, brute(t)) for i, t in docs.items())}
    sample = by_hash([i for i in docs if not failed[i]], 5)[: rule_forest.SAMPLE]
    forest = rule_forest.grow_forest(rule_forest.looks(np.array([shares[i] for i in sample])))
    at = [text_rules.SHARES.index(s) for s in rule_forest.LOOKS]

    def score(x):
        x, total = [math.log(x[k] + 0.01) for k in at], 0.0
        for t in range(len(forest["path"])):
            node = 0
            while forest["feature"][t, node] >= 0:
                node = 2 * node + (2 if x[forest["feature"][t, node]] > forest["cut"][t, node] else 1)
            total += forest["path"][t, node]
        return 2 ** (-total / len(forest["path"]) / float(forest["usual"]))

    want = {i: score(x) for i, x in shares.items()}
    rows = [(want[i], told[i]) for i in told if not failed[i]]
    good, bad = ([s for s, label in rows if label == k] for k in (1, 0))
    worth = {}
    for b in range(rule_forest.BINS):
        cut = b / rule_forest.BINS
        lost, caught = (np.mean([math.floor(s * rule_forest.BINS) >= b for s in part]) for part in (good, bad))
        if lost <= rule_forest.COST and caught > 10 * lost:
            worth[cut] = caught - 10 * lost
    best = [c for c, w in worth.items() if w >= max(worth.values()) - 1e-12]
    threshold = math.floor((best[0] + best[-1]) * rule_forest.BINS / 2 + 1e-6) / rule_forest.BINS if best else 1.0
    judged = rule_forest.judge(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    assert len(judged) == len(docs)
    for r in judged:
        assert r.score == pytest.approx(want[r.id], abs=1e-9) and r.threshold == pytest.approx(threshold)
        assert r.kept == (not failed[r.id] and want[r.id] < threshold)
    assert len({r.kept for r in judged if not r.base_failed}) == 2


def test_additive_scores_equal_plain_sums(spark):
    """Scores of the whole table from the tables of a model, one entry per feature and pair, text by text."""
    docs, told = small_tables(spark)
    shares = {i: brute_shares(t) for i, t in docs.items()}
    picked = [i for k in (0, 1) for i in by_hash([i for i in told if told[i] == k], 6)]
    model = additive_quality.fit(np.array([shares[i] for i in picked]), np.array([told[i] for i in picked], float), np.ones(len(picked)))
    got = queries.op6_gam_quality(spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        x = shares[r.doc_id]
        total = model.base + sum(t[sum(v <= x[f] for v in e)] for f, (t, e) in enumerate(zip(model.tables, model.edges)))
        total += sum(t[sum(v <= x[a] for v in model.pair_edges[a])][sum(v <= x[b] for v in model.pair_edges[b])] for a, b, t in model.pairs)
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-6)


def test_memory_of_a_very_long_text():
    """Less than 30 bytes a byte of text, in a process of its own."""
    code = """
import random, resource, pyarrow as pa
from millrace.llm import text_rules
r = random.Random(3)
words = ["".join(r.choices("abcdefghij", k=r.randint(2, 9))) for _ in range(20000)]
texts = pa.array([" ".join(r.choices(words, k=3_000_000))])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text_rules.counts(texts)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024 / texts.nbytes)
"""
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=120)
    assert float(told.stdout) < 30


def held_out(spark, verdicts, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [(labels[i], v) for i, v in verdicts if i in labels and crc32(str(i).encode()) % 3 == 1]
    assert len(rows) > 300
    return [np.mean([v for l, v in rows if l == k]) for k in (0, 1)]


def test_forest_separates_held_out_rows(spark):
    got = queries.op1_isolation_rules(spark, FOLDER).where("not base_failed").collect()
    bad, good = held_out(spark, [(r.doc_id, r.kept) for r in got], "quality")
    assert good > 0.98 and bad < 0.15


def test_additive_model_on_held_out_rows(spark):
    got = queries.op6_gam_quality(spark, FOLDER).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    bad, good = held_out(spark, [(r.doc_id, r.predicted) for r in got], "quality")
    assert good > 0.98 and bad < 0.05


def test_pairs_find_what_single_features_cannot():
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, (3000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    alone = additive_quality.fit(x, y, np.ones(3000), pairs=0)
    paired = additive_quality.fit(x, y, np.ones(3000), pairs=2)
    assert ((alone.score(x) > 0.5) == y).mean() < 0.7
    assert ((paired.score(x) > 0.5) == y).mean() > 0.95
    assert (paired.pairs[0][0], paired.pairs[0][1]) == (1, 0)


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 2))
    model = additive_quality.fit(x, (x[:, 0] > 0).astype(float), np.ones(500), rounds=5, pairs=1)
    a, b, table = model.pairs[0]
    for row in x[:20]:
        total = model.base + sum(t[(e <= v).sum()] for t, e, v in zip(model.tables, model.edges, row))
        total += table[(model.pair_edges[a] <= row[a]).sum(), (model.pair_edges[b] <= row[b]).sum()]
        assert model.margin(row[None])[0] == pytest.approx(total)


def test_isolation_finds_rare_rows():
    rng = np.random.default_rng(4)
    usual, odd = rng.normal(0, 1, (2000, 3)), rng.normal(9, 1, (20, 3))
    forest = rule_forest.grow_forest(np.concatenate((usual, odd)))
    assert np.quantile(rule_forest.anomaly(forest, usual), 0.99) < np.quantile(rule_forest.anomaly(forest, odd), 0.05)
    assert (rule_forest.anomaly(rule_forest.grow_forest(np.zeros((5, 2))), np.zeros((3, 2))) > 0).all()


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 1), (None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    for frame, tags in ((odd, labels), (odd, labels.limit(0)), (empty, labels)):
        judged = rule_forest.judge(frame, tags).collect()
        scored = additive_quality.quality(frame, tags).collect()
        assert len(judged) == len(scored) == frame.count()
        assert all(0 <= r.score <= 1 for r in scored)
        assert all(r.base_failed for r in judged if r.n_words < 50)
