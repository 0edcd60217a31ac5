import re

import pytest

import __spark_entry__ as entry
from check import compare, connect
from millrace.llm import mixing

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    assert compare(entry.queries()["op7_waterfill_mix"](spark, folder), connect(folder), entry.oracle_sql()["op7_waterfill_mix"]) == ""


def test_targets_fill_up_to_the_caps(spark):
    frame = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), ("d", 0), (None, 490)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(frame, [5, 2, 1], 1.5, 2.0).collect()}
    assert got["a"] == 20 and got["d"] == 0
    assert sum(got.values()) == pytest.approx(3000)
    assert got[None] == 980 and got["c"] == pytest.approx((3000 - 20 - 980) / 3) and got["b"] == pytest.approx((3000 - 20 - 980) / 3 * 2)


def test_taken_meets_targets_and_documents_follow(spark, corpus):
    taken = mixing.mix(corpus, [5, 2, 1], 1.5, 2.0).collect()
    assert sorted(r.id for r in taken) == list(range(300))
    for source in {r.source for r in taken}:
        own = [r for r in taken if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    out = {}
    texts = {r.doc_id: r.text for r in corpus.collect()}
    for r in mixing.mixed_documents(corpus, [5, 2, 1], 1.5, 2.0).collect():
        assert texts[r.doc.doc_id].startswith(r.text)
        out[r.doc.doc_id] = out.get(r.doc.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert out == {r.id: r.taken for r in taken if r.taken}


def test_odd_rows(spark, odd, empty):
    got = mixing.mix(odd, [5, 2, 1], 1.5, 2.0).collect()
    assert len(got) == odd.count()
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert {r.source for r in got} == {None, "s0", "s1"}
    assert mixing.mix(empty, [5, 2, 1], 1.5, 2.0).count() == 0
    assert mixing.mixed_documents(odd, [1], 1.0, 2.0).count() >= 5
