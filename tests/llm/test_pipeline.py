"""The pipeline's stages against plain versions of what they decide."""

import re

import corpus_pipeline as pipeline
import pytest
import sentencepiece

from millrace.llm import queries, simhash_vp, toxic_grammar
from millrace.session import stage_table
from tests.llm import test_simhash, test_suffix

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, function in pipeline.STAGES:
        docs.append(stage_table(function(spark, docs[-1], FOLDER)))
    return docs


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay(steps):
    for df in steps[:-1]:
        assert df.columns == steps[0].columns


def test_toxic_documents_go(spark, steps):
    scored = toxic_grammar.toxicity(steps[0], spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
    toxic = {r.doc.doc_id for r in scored if r.score >= 0.7}
    before, after = by_id(steps[0]), by_id(steps[1])
    assert toxic and set(after) == set(before) - toxic
    assert all(after[i] == before[i] for i in after)


def test_one_of_each_group_stays(steps):
    groups = {c for _, _, c in test_simhash.brute([(r.doc_id, r.text) for r in steps[1].collect()])}
    assert set(by_id(steps[2])) == groups < set(by_id(steps[1]))
    assert simhash_vp.survivors(steps[2]).count() == len(groups)


def test_repeats_are_cut(steps):
    have = steps[2].collect()
    after = by_id(steps[3])
    brute = test_suffix.brute([r.text.encode() for r in have], 200)
    assert len(after) == len(have)
    for r, (size, removed, _, _) in zip(have, brute):
        text = after[r.doc_id].text
        assert (text == r.text) == (removed == 0)
        assert size - removed - 6 * (removed > 0) * max(1, removed // 200) <= len(text.encode()) <= size - removed
        assert after[r.doc_id].n_chars == (len(text) if removed else r.n_chars)


def test_mix_repeats_documents(spark, steps):
    before = by_id(steps[3])
    rows = steps[4].collect()
    words = {}
    for r in rows:
        assert before[r.doc_id].text.startswith(r.text)
        words[r.source] = words.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    frame = spark.createDataFrame([(r.doc_id, r.text, r.source) for r in before.values()], "doc_id bigint, text string, source string")
    for r in queries.mixing.mix(frame, [5, 2, 1], 1.5, 2.0).select("source", "target").distinct().collect():
        assert abs(words.get(r.source, 0) - r.target) <= 1


def test_tokens_are_those_of_the_library(steps):
    reference = sentencepiece.SentencePieceProcessor(model_file=queries.SENTENCEPIECE_MODEL)
    want = sorted((r.doc_id, str(reference.encode(r.text))) for r in steps[4].collect())
    assert sorted((r.doc_id, str(r.ids)) for r in steps[5].collect()) == want


def test_run_gives_the_last_stage(spark, steps):
    assert sorted(map(str, pipeline.run(spark, FOLDER).collect())) == sorted(map(str, steps[5].collect()))


def test_odd_documents(spark, odd, empty):
    for frame in (odd, empty):
        docs = frame.select(*pipeline.COLUMNS, "row", "fp", "doc")
        for _, function in pipeline.STAGES:
            docs = stage_table(function(spark, docs, FOLDER))
        assert frame is odd or docs.count() == 0
        if frame is odd:
            assert docs.where("parity and round_trip").count() == docs.count() > 0
