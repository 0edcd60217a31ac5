from zlib import crc32

from pyspark.sql import functions as F

from millrace.llm import kd_shards, queries

FOLDER = "/root/testdata/sf0.01"


def check(got, rows, shards):
    """Sizes and checksums belong to the rows, slots have no gaps."""
    assert sorted((str(r.id), r.size, r.text_crc32) for r in got) == sorted((str(i), len((t or "").encode()) + 8, crc32((t or "").encode())) for i, t in rows)
    for s in {r.shard for r in got}:
        assert 0 <= s < shards
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_query_gives_even_shards(spark):
    got = queries.op3_kd_shards(spark, FOLDER).withColumnRenamed("doc_id", "id").collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    check(got, [(r.doc_id, r.text) for r in docs], 24)
    sizes = {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
    mean = sum(sizes.values()) / 24
    assert len(sizes) == 24
    assert max(abs(v - mean) for v in sizes.values()) <= 1.5 * max(r.size for r in got)


def test_hot_value_is_cut(spark):
    """One source and one text hold nearly all rows; shards stay even."""
    frame = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 9, "the same").otherwise("other").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(8).alias("n_chars"))
    got = kd_shards.shard(frame, 7).collect()
    check(got, [(r.doc_id, r.text) for r in frame.collect()], 7)
    counts = [sum(r.shard == s for r in got) for s in range(7)]
    assert max(counts) - min(counts) < 40


def test_runs_agree_and_use_no_python(spark):
    first = {r.id: (r.shard, r.slot) for r in queries.kd_shards.shard(spark.read.parquet(f"{FOLDER}/documents.parquet"), 5).collect()}
    frame = kd_shards.shard(spark.read.parquet(f"{FOLDER}/documents.parquet"), 5)
    assert {r.id: (r.shard, r.slot) for r in frame.collect()} == first
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark, odd, empty):
    check(kd_shards.shard(odd, 24).collect(), [(r.doc_id, r.text) for r in odd.collect()], 24)
    assert kd_shards.shard(empty, 24).count() == 0
    check(kd_shards.shard(odd, 1).collect(), [(r.doc_id, r.text) for r in odd.collect()], 1)


def test_places_do_not_follow_the_cuts_of_files(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = {r.id: (r.shard, r.slot) for r in kd_shards.shard(docs, 24).collect()}
    for frame in (docs.repartition(7), docs.orderBy("n_chars"), docs.dropDuplicates(["doc_id"])):
        assert {r.id: (r.shard, r.slot) for r in kd_shards.shard(frame, 24).collect()} == want


def test_leaves_equal_sorted_lists(spark):
    """Two documents to a leaf along the widest dimension, and rows that agree in everything."""
    frame = spark.range(64).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(4).alias("n_chars"))
    got = {r.id: r.shard for r in kd_shards.shard(frame, 8, numbers=("doc_id",), names=()).collect()}
    assert got == {i: i // 8 for i in range(64)}
    copies = spark.range(64).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(4).alias("n_chars"))
    counts = [r["count"] for r in kd_shards.shard(copies, 4).groupBy("shard").count().collect()]
    assert sum(counts) == 64 and max(counts) <= 24
