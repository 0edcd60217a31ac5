"""Token counts by a digest cache.

The cache is a table in a shared folder, a partition for each tokenizer: (content digest, tokens). The tokenizer's digest is
that of its file, its library and the library's version, so counts of another version are never taken. The content digest is
SHA-256 of the normalised text, which is the text as far as texts of one normal form have the same tokens: for sentencepiece
models that rewrite nothing but blanks, the blanks' marker stands for blanks; for all others the text as it is.

``count_tokens`` digests every text, looks for digests that the cache lacks, encodes one text for each of these, appends
their counts to the cache, and reads all counts from it. Texts that the cache knows are not shuffled and not encoded. A
digest that holds more than one row in HOT_SHARE is joined by broadcast (there are HOT_SHARE such digests at most), so that
a group of copies never meets in one task.

A text of more than PIECE characters is encoded in pieces, if the model's pieces never reach from one word into the next:
cut at a single blank, the marker that the library puts in front of a piece takes that blank's place. Other texts and models
are encoded whole.

Defined results: NULL counts as the empty text, which has no tokens; equal texts have equal counts; strings that look like
special tokens are what the library makes of them by default; no rows give no rows and leave the cache as it was. Two jobs
may append the same digests; they agree, and one of them is read. The other columns stay inside ``doc``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from importlib.metadata import version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import slices, stage_table
from millrace.llm.sentencepiece_codec import MARKER, parse_model
from millrace.operators.series import BROADCAST_ROWS
from millrace.session import scratch_path

#: Characters of a piece of a long text; share of the rows (one in so many) from which a digest is joined by broadcast.
PIECE, HOT_SHARE = 200_000, 1_000
_CUT = re.compile(f"(?<=[^ {MARKER}]) (?=[^ {MARKER}])")
CACHE = "content binary, n_tokens bigint"


@dataclass
class Counter:
    """A tokenizer's file and what the cache must know of it."""

    library: str
    data: bytes
    by_words: bool  # a text's tokens are those of its words one after the other
    only_blanks: bool  # the normaliser replaces blanks and nothing else

    @staticmethod
    def of(path: str) -> Counter:
        """The tokenizers library for .json, sentencepiece for .model; the file is read on the driver only."""
        with open(path, "rb") as file:
            data = file.read()
        if path.endswith(".json"):
            return Counter("tokenizers", data, False, False)
        if not path.endswith(".model"):
            raise ValueError(f"{path} is neither .json nor .model")
        try:
            model = parse_model(data)
        except ValueError:  # a kind of model whose words are not known to be independent
            return Counter("sentencepiece", data, False, False)
        return Counter("sentencepiece", data, model.by_words, not (model.character_map or model.fold_blanks) and model.escape_blanks)

    @property
    def digest(self) -> str:
        return hashlib.sha256(f"{self.library} {version(self.library)}\n".encode() + self.data).hexdigest()

    def normal(self, text: Column) -> Column:
        return F.replace(text, F.lit(" "), F.lit(MARKER)) if self.only_blanks else text

    def counting(self):
        """A function from a list of texts to their numbers of tokens."""
        if self.library == "tokenizers":
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(self.data.decode())
            tokenizer.no_truncation()
            tokenizer.no_padding()
            return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_proto=self.data)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A text in pieces whose numbers of tokens add up to its own."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def cached(spark: SparkSession, folder: str) -> DataFrame:
    """(content, n_tokens) of a tokenizer's part of the cache, each digest once; empty if there is none yet."""
    try:
        rows = spark.read.schema(CACHE).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    return rows.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, cache: str | None = None, limit: int = 4096, text_col: str = "text") -> DataFrame:
    """For every row: the other columns as ``doc``, n_bytes, n_tokens, over_limit, and ``known``: the cache had its count before.

    ``cache`` is a folder that all executors share; without one, a new folder beside the checkpoints.
    """
    spark = docs.sparkSession
    counter = Counter.of(path)
    folder = f"{cache or scratch_path(spark, 'token-counts')}/tokenizer={counter.digest}"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    content = F.unhex(F.sha2(counter.normal(text), 256))
    others = [c for c in docs.columns if c != text_col]
    doc = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = stage_table(docs.select(doc.alias("doc"), content.alias("content"), F.octet_length(text).cast("bigint").alias("n_bytes")))
    sizes = stage_table(rows.groupBy("content").agg(F.count("*").alias("many")))
    told = sizes.join(cached(spark, folder), "content", "left")
    misses = stage_table(told.where("n_tokens is null").select("content"))
    if not misses.isEmpty():
        _append(docs.select(content.alias("content"), text.alias("text")), misses, counter, folder)
    counts = cached(spark, folder).join(misses.withColumn("known", F.lit(False)), "content", "left").na.fill({"known": True})
    total = sizes.agg(F.sum("many")).first()[0] or 0
    often = sizes.where(F.col("many") * HOT_SHARE > total).select("content").join(counts, "content")
    often = stage_table(often.select("content", F.struct("n_tokens", "known").alias("hot")))
    marked = rows.join(F.broadcast(often), "content", "left")
    # Rows that have their count already are dealt evenly, by keys that match nothing.
    apart = F.concat("content", F.monotonically_increasing_id().cast("string").cast("binary"))
    marked = marked.withColumn("key", F.when(F.col("hot").isNull(), F.col("content")).otherwise(apart))
    found = marked.join(counts.select(F.col("content").alias("key"), F.struct("n_tokens", "known").alias("cold")), "key", "left")
    found = found.select("doc", "n_bytes", F.coalesce("hot", "cold").alias("told"))
    return found.select("doc", "n_bytes", "told.n_tokens", (F.col("told.n_tokens") > limit).alias("over_limit"), "told.known")


def _append(texts: DataFrame, misses: DataFrame, counter: Counter, folder: str) -> None:
    """Encode one text for each digest of ``misses`` and append the counts to the cache."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter.counting()
        for batch in batches:
            for part in slices(batch):
                some = part.column("text").to_pylist()
                if counter.by_words and max(map(len, some)) > PIECE:
                    cut = [list(pieces(t)) for t in some]
                    totals = [sum(count([p])[0] for p in c) if len(c) > 1 else count(c)[0] for c in cut]
                else:
                    totals = count(some)
                yield pa.RecordBatch.from_arrays([part.column("content"), pa.array(totals, pa.int64())], ["content", "n_tokens"])

    one = F.first("text").alias("text")
    if misses.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        needed = texts.join(F.broadcast(misses), "content", "left_semi").groupBy("content").agg(one)
    else:  # copies are folded before the shuffle that both sides share
        needed = texts.groupBy("content").agg(one).join(misses, "content", "left_semi")
    needed.mapInArrow(run, CACHE).write.mode("append").parquet(folder)
