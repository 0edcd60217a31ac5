"""Files that Spark cuts differently in each job, as it does when executors come or go: rows keep their numbers."""

import re

import pytest
from pyspark.sql import DataFrameWriter

from millrace.llm import mixing, simhash_vp, suffix_dedup, warc
from tests.llm import test_suffix


@pytest.fixture
def recut(spark, monkeypatch):
    """The first table of a test is staged from pieces of 8 KB, whatever follows reads whole files."""
    name, given, written = "spark.sql.files.maxPartitionBytes", DataFrameWriter.parquet, []

    def parquet(writer, path, *args, **options):
        given(writer, path, *args, **options)
        written.append(path)
        spark.conf.set(name, "128m")

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    spark.conf.set(name, "8k")
    yield
    spark.conf.unset(name)
    assert written


@pytest.fixture(scope="module")
def docs(spark, corpus, tmp_path_factory):
    """The corpus in one file of several row groups."""
    folder = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    corpus.coalesce(1).write.option("parquet.block.size", 8192).parquet(folder)
    return spark.read.parquet(folder)


def test_files_are_cut_differently(spark, docs):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    many = docs.select("*").rdd.getNumPartitions()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert many > docs.select("*").rdd.getNumPartitions()


def test_repeats(docs, recut):
    got = test_suffix.rows(suffix_dedup.remove_repeats(docs, length=200))
    assert got == test_suffix.wanted(docs, 200)


def test_survivors(docs, recut):
    kept = sorted(r.doc_id for r in simhash_vp.survivors(docs).collect())
    assert kept == sorted({r.component_id for r in simhash_vp.near_copies(docs).collect()})


def test_mixed_documents(docs, recut):
    out = {}
    for r in mixing.mixed_documents(docs, [5, 2, 1], 1.5, 2.0).collect():
        out[r.doc.doc_id] = out.get(r.doc.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert out == {r.id: r.taken for r in mixing.mix(docs, [5, 2, 1], 1.5, 2.0).collect() if r.taken}


def test_archives(docs, recut):
    got = warc.round_trip(docs, id_col="doc_id", url_col="source", payload_col="text").collect()
    first, texts = {}, {r.doc_id: r.text for r in docs.collect()}
    for i, text in sorted(texts.items()):
        first.setdefault(text, i)
    page = {r.capture.record_id: int(r.metadata.page) for r in got}
    assert sorted(page.values()) == sorted(texts)
    for r in got:
        own = int(r.metadata.page)
        assert (r.capture.kind == "response") == (first[texts[own]] == own)
        assert own == first[texts[own]] or page[r.capture.refers_to] == first[texts[own]]
