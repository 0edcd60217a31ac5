import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest

from millrace.llm import periodic_runs as g, queries

FOLDER = "/root/testdata/sf0.01"


def brute(w, least=12):
    """(start, length, period): for every period the maximal stretches of words that far apart, of equal stretches the least."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def some(rng, kind):
    if kind == 0:
        return [rng.randrange(2) for _ in range(rng.randrange(80))]
    if kind == 1:
        return [rng.randrange(30) for _ in range(rng.randrange(300))]
    if kind == 2:
        return [0] * rng.randrange(200)
    if kind == 3:
        p = [rng.randrange(50) for _ in range(rng.randrange(1, 60))]
        return [rng.randrange(50) for _ in range(rng.randrange(30))] + p * rng.randrange(1, 6) + p[: rng.randrange(len(p))]
    if kind == 4:
        a = [0] * rng.randrange(10, 90)
        return a + [1] + a + [2, 3] + a + [1] + a
    if kind == 5:
        f = [[0], [0, 1]]
        while len(f[-1]) < 150:
            f.append(f[-1] + f[-2])
        return f[-1][rng.randrange(20) :]
    if kind == 6:
        return [bin(i).count("1") % 2 for i in range(rng.randrange(200))]
    p = [rng.randrange(3) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 8)
    return (p + [9]) * rng.randrange(1, 6) + p


@pytest.mark.parametrize("kind", range(8))
def test_runs_equal_brute_force(kind, monkeypatch):
    monkeypatch.setattr(g, "AT_ONCE", 64)
    rng = random.Random(kind)
    texts = [some(rng, kind) for _ in range(40)]
    sizes = np.array([len(w) for w in texts], np.int64)
    got = g.runs_of(np.array([x for w in texts for x in w], np.int64), sizes)
    for k, w in enumerate(texts):
        assert [tuple(r[1:]) for r in got[got[:, 0] == k].tolist()] == brute(w)


@pytest.mark.parametrize("size", [2, 8, 64, 1024])
def test_transform_is_exact(size):
    rng = np.random.default_rng(size)
    a, b = (rng.integers(0, 1 << 9, (3, size)) for _ in range(2))
    a[:, size // 2 :] = 0
    b[:, size // 2 :] = 0
    got = g.back(g.transform(a.astype(np.uint64)) * g.transform(b.astype(np.uint64)) % g._P)
    assert all((got[k] == np.convolve(a[k], b[k])[:size]).all() for k in range(3))


def test_sums_are_exact_for_large_numbers():
    rng = np.random.default_rng(1)
    names = rng.integers(0, 1 << 22, 400)
    names[100:116] = names[60:76]
    got = g.mismatches(names, np.array([60, 64]), 16, 32, 64)
    assert got.shape == (2, 32) and np.argwhere(got == 0).tolist() == [[0, 8]]
    digit = (29 - 4) // 2
    digits = [names >> s & (1 << digit) - 1 for s in (0, digit)]
    want = [[sum(int(((d[a : a + 16] - d[a + q : a + q + 16]) ** 2).sum()) for d in digits) for q in range(32, 64)] for a in (60, 64)]
    assert got.tolist() == want


def test_long_periodic_texts_stay_fast():
    for w, want in (([0] * 50_000, 1), (list(range(50)) * 1000, 1), ([0] * 20_000 + [1] + [0] * 20_000, 2)):
        assert len(g.runs_of(np.array(w, np.int64), np.array([len(w)]))) == want


def looped(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, k = len(words), h // 10
        a = k % n
        p = 1 + (n - a) // (3 + k % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark):
    """Texts up to 1,500 words; longer ones against the stretches of all periods found by numpy."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, FOLDER).collect()}
    assert got.keys() == docs.keys()
    repeated = 0
    for i, text in docs.items():
        words = looped(i, text)
        if len(words) > 1_500:
            names = np.unique(np.array(words), return_inverse=True)[1]
            found = {}
            for q in range(1, len(words) // 2 + 1):
                edge = np.flatnonzero(np.diff(np.pad(names[:-q] == names[q:], 1).astype(np.int8)))
                for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    if e - s + q >= max(12, 2 * q):
                        found.setdefault((s, e - s + q), q)
            runs = sorted((s, n, q) for (s, n), q in found.items())
        else:
            runs = brute(words)
        assert got[i] == told(words, runs)
        repeated += bool(runs)
    assert repeated > 50


def test_odd_rows(spark, odd, empty):
    frame = odd.unionByName(odd.selectExpr("doc_id", "repeat(concat(text, ' '), 30) as text", "lang", "source", "n_chars", "row", "fp", "doc"))
    got = g.find_runs(frame).collect()
    assert len(got) == 2 * odd.count()
    want = sorted((str(r.doc_id), tuple(brute((r.text or "").split()))) for r in frame.select("doc_id", "text").collect() if len((r.text or "").split()) < 2000)
    mine = sorted((str(r.doc.doc_id), tuple(tuple(x) for x in r.runs)) for r in got if r.n_words < 2000)
    assert mine == want
    assert all(r.collapsed == "long" for r in got if r.n_words >= 2000)
    assert g.find_runs(empty).count() == 0
    with pytest.raises(ValueError):
        g.find_runs(odd, least=5)
