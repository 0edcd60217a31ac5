"""A corpus pipeline: toxic documents go, near copies go, repeated passages are cut, sources are mixed, texts become tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again for the next one. All but the
last return the columns of ``documents``. Rows with NULL in any column, empty texts and repeated rows are taken by every
stage as its operator defines; without rows, a stage gives none. A document whose text is cut keeps its id, and ``n_chars``
becomes the new length. Mixing may give a document several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import mixing, sentencepiece_codec, simhash_vp, suffix_dedup, toxic_grammar
from millrace.llm.queries import SENTENCEPIECE_MODEL
from millrace.session import stage_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(df: DataFrame) -> DataFrame:
    """The columns of documents from ``doc`` and a new ``text``; n_chars follows a text that changed."""
    return df.select(*[F.col(c) if c == "text" else F.col(f"doc.{c}") for c in COLUMNS])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _columns(toxic_grammar.toxicity(docs.select(*COLUMNS), labels, cut=0.7).where("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_vp.survivors(docs.select(*COLUMNS), words=3, bits=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS), length=200, kept="string")
    rows = cut.select("doc", "n_removed", F.col("kept").alias("text"))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("doc.n_chars"))
    return _columns(rows.select(F.col("doc").withField("n_chars", length).alias("doc"), "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_documents(docs.select(*COLUMNS), weights=[5, 2, 1], share=1.5, epochs=2.0, seed=7)
    length = F.when(F.col("text") == F.col("doc.text"), F.col("doc.n_chars")).otherwise(F.length("text").cast("bigint"))
    return _columns(mixed.select(F.col("doc").withField("n_chars", length).alias("doc"), "text"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tokens = sentencepiece_codec.encode(docs.select(*COLUMNS), SENTENCEPIECE_MODEL)
    return tokens.select("doc.*", "n_tokens", "ids", "parity", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("sentencepiece encoding and decoding", encode_tokens),
]
#: Trained models, byte strings and tokens are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stage_table(docs)
    return docs
