import numpy as np
import pytest

import __spark_entry__ as entry
from check import compare, connect
from millrace.llm import mtree
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    assert compare(entry.queries()["op4_mtree_topk"](spark, FOLDER), connect(FOLDER), entry.oracle_sql()["op4_mtree_topk"]) == ""


def brute(rows, ask, k, scale=256):
    """rows: (id, vector), row numbers by place."""
    sound = [(n, i, np.floor(np.array(v, float) * scale).astype(int)) for n, (i, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all()]
    out = []
    for n, i, q in sound:
        if ask(i):
            best = sorted((-int(q @ v), 1 << 62 if j is None else j, m) for m, j, v in sound if m != n)[:k]
            out += [(str(i), r + 1, None if j == 1 << 62 else j, -s) for r, (s, j, _) in enumerate(best)]
    return sorted(out, key=str)


def shown(df):
    return sorted(((str(r.query_id), r["rank"], r.id, r.score) for r in df.collect()), key=str)


def clusters(rng, dims=8):
    centres = rng.normal(0, 1, (5, dims))
    rows = [(i, (centres[i % 5] * rng.choice([0.1, 1, 3]) + rng.normal(0, 0.2, dims)).tolist()) for i in range(400)]
    return rows + [(400 + i, rows[7][1]) for i in range(80)] + [(500 + i, [0.0] * dims) for i in range(30)]


@pytest.mark.parametrize("page,leaf", [(8, 4), (16, 8), (100, 8), (None, 8), (4096, 32)])
def test_equals_brute_force(spark, monkeypatch, page, leaf):
    monkeypatch.setattr(mtree, "LEAF", leaf)
    monkeypatch.setattr(mtree, "FAN", 4)
    monkeypatch.setattr(mtree, "GROUP", 150)
    monkeypatch.setattr(mtree, "BLOCK", 20)
    frame = spark.createDataFrame(clusters(np.random.default_rng(1)), "vec_id bigint, embedding array<float>").coalesce(1)
    rows = [(r[0], r[1]) for r in frame.collect()]
    got = mtree.top_k(frame, F.col("vec_id") % 7 == 0, k=5, page=page)
    assert shown(got) == brute(rows, lambda i: i % 7 == 0, 5)


@pytest.mark.parametrize("change", ["repartition", "dropDuplicates", "sort", "join"])
def test_shuffled_input(spark, change):
    frame = spark.createDataFrame([(*r, f"x{r[0] % 3}") for r in clusters(np.random.default_rng(3))], "vec_id bigint, embedding array<float>, kind string")
    rows = [(r[0], r[1]) for r in frame.select("vec_id", "embedding").collect()]
    if change == "repartition":
        frame = frame.repartition(8)
    elif change == "dropDuplicates":
        frame = frame.dropDuplicates(["vec_id", "kind"])
    elif change == "sort":
        frame = frame.orderBy(F.desc("kind"), F.rand(4))
    else:
        frame = frame.join(frame.select("kind").distinct(), "kind")
    got = mtree.top_k(frame, (F.col("vec_id") % 7 == 0) & F.col("kind").isNotNull(), k=5)
    assert shown(got) == brute(rows, lambda i: i % 7 == 0, 5)


def nodes(page):
    return len(page.children), sum(c is not None for c in page.children)


def test_pages_have_inner_nodes_that_cover_their_vectors():
    rng = np.random.default_rng(5)
    v = np.floor(rng.normal(0, 60, (2_000, 6))).astype(np.int64)
    longest = float((v * v).sum(1).max())
    lift = np.sqrt(longest - (v * v).sum(1))
    page = mtree.Page.unpack(mtree.Page(v, lift, np.arange(2_000), np.arange(2_000)).pack())
    every, inner = nodes(page)
    assert inner >= 1 and every > 2_000 // mtree.LEAF
    place = {int(r): n for n, r in enumerate(page.rows)}
    assert sorted(place) == list(range(2_000))

    def under(n):
        if page.children[n] is None:
            return list(range(*page.entries[n]))
        return [x for c in page.children[n][0] for x in under(int(c))]

    for n in range(every):
        held = page.rows[under(n)]
        to = page.routes[n]
        d = np.sqrt(((v[held] - to) ** 2).sum(1) + (lift[held] - np.sqrt(max(0, longest - (to * to).sum()))) ** 2)
        assert d.max() <= page.radius[n] + 1e-6
        if page.children[n] is not None:
            for c, parent, radius in zip(*page.children[n]):
                route = page.routes[c]
                apart = np.sqrt(((route - to) ** 2).sum() + (np.sqrt(max(0, longest - route @ route)) - np.sqrt(max(0, longest - to @ to))) ** 2)
                assert parent == pytest.approx(apart, abs=1e-6) and radius == page.radius[c]


def test_bounds_save_distances(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (40, 16))
    rows = [(i, (centres[i % 40] + rng.normal(0, 0.02, 16)).tolist()) for i in range(4000)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = mtree.top_k(frame, F.col("vec_id") < 50, k=5).groupBy("query_row").agg(F.max("computed").alias("n")).collect()
    assert len(found) == 50 and np.mean([r.n for r in found]) < 800


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0]), (None, [1.0, 2.0]), (6, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [-1.0, 0.0]), (8, [])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, row string, id int").coalesce(1)
    want = brute([(i, v if v and len(v) == 2 else None) for i, v in rows], lambda i: i in (0, 6), 3)
    assert shown(mtree.top_k(frame, F.col("vec_id").isin(0, 6), k=3)) == want
    assert mtree.top_k(frame.limit(0), F.lit(True)).count() == 0
    assert mtree.top_k(frame.limit(1), F.lit(True)).count() == 0
    assert mtree.top_k(frame, F.lit(False)).count() == 0
