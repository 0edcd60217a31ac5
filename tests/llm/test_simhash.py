import numpy as np
import xxhash

from millrace.llm import queries, simhash_vp
from tests.llm.conftest import ODD

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    """rows: (id, text); every pair of rows compared."""
    prints = []
    for _, text in rows:
        parts = (text or "").encode().lower().split()
        shingles = [b" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))] if parts else []
        ones = [0] * 64
        for s in shingles:
            h = xxhash.xxh64_intdigest(s, seed=42)
            for bit in range(64):
                ones[bit] += h >> bit & 1
        prints.append(sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles)))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    lowest = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            lowest[g] = min(lowest.get(g, i), i)
    return sorted((str(i), f"{p:016x}", lowest.get(g)) for (i, _), p, g in zip(rows, prints, group))


def shown(df):
    return sorted((str(r.id), f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in df.collect())


def test_equals_brute_force(spark, corpus, monkeypatch):
    monkeypatch.setattr(simhash_vp, "FEW", 8)
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    assert shown(simhash_vp.near_copies(corpus)) == brute(rows)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = queries.op10_simhash_vptree(spark, FOLDER).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == brute(rows)


def test_many_shards_find_every_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(x) for x in rng.choice(63, 3, replace=False)) for b in np.repeat(base, 12)]
    points = sorted({*map(int, base), *near, 0})
    frame = spark.createDataFrame([(p,) for p in points], "fp bigint")
    got = {r.node: r.root for r in simhash_vp.link(frame, 3, shard=64).collect()}
    label = simhash_vp.linked(np.array(points, np.uint64), 3)
    want = {p: points[k] for p, k in zip(points, label)}
    size = {}
    for p in want.values():
        size[p] = size.get(p, 0) + 1
    assert got == {p: k for p, k in want.items() if size[k] > 1}
    for i, p in enumerate(points):
        for j in range(i):
            if (p ^ points[j]).bit_count() <= 3:
                assert label[i] == label[j]


def test_shards_beyond_the_first_tree(spark, monkeypatch):
    """Large shards are split again, level by level; a ball of points that no tree can part stays whole; no link is lost."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(x) for x in rng.choice(63, 3, replace=False)) for b in np.repeat(base, 8)]
    ball = [sum(1 << int(x) for x in rng.choice(8, 4, replace=False)) for _ in range(400)]
    points = sorted({*map(int, base), *near, *ball})
    monkeypatch.setattr(simhash_vp, "MOST_SHARDS", 4)
    monkeypatch.setattr(simhash_vp, "OVERLAP", 4)
    levels = []
    again = simhash_vp._deal_again
    monkeypatch.setattr(simhash_vp, "_deal_again", lambda *args: levels.append(args[3]) or again(*args))
    got = {r.node: r.root for r in simhash_vp.link(spark.createDataFrame([(p,) for p in points], "fp bigint"), 3, shard=16).collect()}
    label = simhash_vp.linked(np.array(points, np.uint64), 3)
    size = np.bincount(label, minlength=len(points))
    assert got == {p: points[k] for p, k in zip(points, label) if size[k] > 1}
    assert max(levels) > 1 and len(levels) > len(set(levels))


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert shown(simhash_vp.near_copies(odd)) == brute(rows)
    assert len(rows) == len(ODD) + 2
    assert simhash_vp.near_copies(empty).count() == 0


def test_survivors_are_one_row_of_each_component(spark, corpus, odd, empty):
    for frame in (corpus, odd):
        groups = {(r.root, r.component_id) for r in simhash_vp.near_copies(frame).collect()}
        kept = simhash_vp.survivors(frame)
        assert kept.columns == frame.columns
        assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(c) for _, c in groups)
    assert simhash_vp.survivors(empty).count() == 0
