"""One query per operator on documents, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    additive_quality,
    conversation_repair,
    kd_shards,
    mixing,
    mtree,
    periodic_runs,
    rule_forest,
    sentencepiece_codec,
    simhash_vp,
    suffix_dedup,
    token_counts,
    toxic_grammar,
    warc,
)
from millrace.llm.common import WORD, stage_table
from millrace.plans.registry import load

#: A public model; another file may be given to the operator.
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: SHA-256 of nothing.
EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query()
def op10_simhash_vptree(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_vp.near_copies(load(spark, folder, "documents"), words=3, bits=3)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


@query()
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(load(spark, folder, "documents", "doc_id", "text"), length=200, kept=None)
    return cut.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query(
    r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS BIGINT) + 1] AS DOUBLE) AS weight
  FROM sized GROUP BY source
), whole AS (SELECT 1.5 * sum(source_size) AS budget FROM sources
), level(n, clamped, lvl) AS (
  SELECT 0, CAST(-1 AS BIGINT), CAST(NULL AS DOUBLE)
  UNION ALL
  SELECT n + 1, (SELECT count_if(2.0 * source_size <= coalesce(weight * lvl, 0)) FROM sources),
         (SELECT (any_value(budget) - coalesce(sum(2.0 * source_size) FILTER (2.0 * source_size <= coalesce(weight * lvl, 0)), 0))
                 / sum(weight) FILTER (2.0 * source_size > coalesce(weight * lvl, 0)) FROM sources, whole)
  FROM level WHERE n < 40
), filled AS (SELECT lvl FROM level WHERE lvl IS NOT NULL ORDER BY n DESC LIMIT 1
), goals AS (
  SELECT source, source_size, CAST(least(2.0 * source_size, weight * (SELECT lvl FROM filled)) AS DOUBLE) AS target FROM sources
), parts AS (
  SELECT *, CAST(floor(target / source_size) AS BIGINT) AS times, CAST(round(target - floor(target / source_size) * source_size) AS BIGINT) AS part
  FROM goals
), placed AS (
  SELECT sized.*, source_size, target, times, part,
         sum(size) OVER (PARTITION BY sized.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized JOIN parts ON sized.source IS NOT DISTINCT FROM parts.source
)
SELECT doc_id, size, source_size, target,
       CAST(coalesce(size * times + greatest(0, least(size, part - before)), 0) AS BIGINT) AS taken
FROM placed
"""
)
def op7_waterfill_mix(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.mix(load(spark, folder, "documents"), weights=[5, 2, 1], share=1.5, epochs=2.0, seed=7)
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query()
def op3_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = kd_shards.shard(load(spark, folder, "documents"), shards=24)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (SELECT payload, min(page_id) AS response FROM p GROUP BY payload),
hexed AS (SELECT page_id, CAST(strlen(p.payload) AS BIGINT) AS payload_bytes, upper(sha1(p.payload)) AS h, response FROM p JOIN firsts USING (payload)),
bits AS (
  SELECT *, list_transform(range(0, 8), lambda k: list_reduce(list_transform(range(1, 6), lambda j: CAST(instr('0123456789ABCDEF', h[k * 5 + j]) - 1 AS BIGINT)), lambda a, x: a * 16 + x)) AS fives
  FROM hexed
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(fives, lambda v: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[v // 32768 + 1] || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[v // 1024 % 32 + 1]
         || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[v // 32 % 32 + 1] || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[v % 32 + 1]), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM bits
"""
)
def op8_warc_transactions(spark: SparkSession, folder: str) -> DataFrame:
    captures = warc.round_trip(load(spark, folder, "pages"), least=0)
    page = F.col("metadata.page").cast("bigint")
    rows = captures.select(
        page.alias("page_id"), F.col("capture.payload_bytes").alias("payload_bytes"), F.col("capture.digest").alias("payload_digest"),
        F.col("capture.kind").alias("record_type"), F.col("capture.refers_to").alias("refers"), F.col("capture.record_id").alias("record_id"),
    )
    rows = stage_table(rows)
    responses = rows.where("record_type = 'response'").select(F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"))
    return rows.drop("record_id").join(responses, "refers", "left").drop("refers")


@query()
def op1_isolation_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rule_forest.judge(load(spark, folder, "documents", "doc_id", "text"), load(spark, folder, "labels"))
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score", "threshold"
    )


@query()
def op6_gam_quality(spark: SparkSession, folder: str) -> DataFrame:
    return additive_quality.quality(load(spark, folder, "documents", "doc_id", "text"), load(spark, folder, "labels")).withColumnRenamed("id", "doc_id")


@query(
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""
)
def op4_mtree_topk(spark: SparkSession, folder: str) -> DataFrame:
    found = mtree.top_k(load(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query()
def op5_toxicity_grammar(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxic_grammar.toxicity(load(spark, folder, "documents", "doc_id", "text"), load(spark, folder, "labels"), cut=0.7)
    return scored.select("doc.doc_id", "held_out", "score", "predicted")


@query()
def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    tokens = sentencepiece_codec.encode(load(spark, folder, "documents", "doc_id", "text"), SENTENCEPIECE_MODEL)
    return tokens.select("doc.doc_id", "n_tokens", "ids", "parity", "round_trip")


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Conversations with the faults that a checksum of (conversation, turn) picks; NULLs are one blank."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = (F.crc32(key.cast("binary")) % 20).alias("kind")
    rows = turns.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _repair_sql() -> str:
    """The edits in SQL: for each of the four states the least (cost, edits, lines) of the turns so far, turn by turn."""
    best = lambda *ways: f"list_sort([{', '.join(ways)}])[1]"
    way = lambda of, cost, letter, line="''": f"{{'c': {of}.c + {cost}, 'e': {of}.e || '{letter}', 'r': {of}.r || {line}}}"
    due = {0: "user", 1: "user", 2: "assistant", 3: "user"}
    new = {k: f"chr(10) || '{v}:'" for k, v in due.items()}
    third = best("w[3]", *(way(f"w[{s + 1}]", 2, "I", new[s]) for s in (0, 1, 3)))
    inserted = f"[w[1], w[2], {third}, {best('w[4]', way(third, 2, 'I', new[2]))}]"
    own, far = "chr(10) || role || ':' || text", 1_000_000_000
    keep = lambda s, kind: way(f"v[{s + 1}]", f"stays + (CASE WHEN kind = '{kind}' THEN 0 ELSE {far} END)", "K", own)
    again = lambda s: way(f"v[{s + 1}]", "stays + 2", "R", f"{new[s]} || text")
    gone = lambda s: way(f"v[{s + 1}]", 3, "D")
    taken = [
        gone(0),
        best(gone(1), keep(0, "s")),
        best(gone(2), *(x for s in (0, 1, 3) for x in (again(s), keep(s, "u")))),
        best(gone(3), again(2), keep(2, "a")),
    ]
    begin = ", ".join(f"{{'c': CAST({0 if s == 0 else far} AS BIGINT), 'e': '', 'r': ''}}" for s in range(4))
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
  FROM conversations
), marked AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM marked WHERE kind <> 0
), placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS kind, rtrim(text, {blanks}) AS rest,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS idx
  FROM damaged
), copies AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY idx) AS copy FROM placed
), turns AS (
  SELECT *, CASE WHEN rest = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate' WHEN right(rest, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         kind || lead(kind) OVER (PARTITION BY conv_id ORDER BY idx) AS pair
  FROM copies
), facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id
), steps AS (
  SELECT conv_id, idx, kind, role, text, CASE WHEN fault = 'truncated' THEN 1 WHEN fault IS NULL THEN 0 ELSE {far} END AS stays FROM turns
), ways(conv_id, i, w) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), [{begin}] FROM conversations
  UNION ALL
  SELECT conv_id, i + 1, [{', '.join(taken)}] FROM (
    SELECT ways.conv_id, i, kind, role, text, stays, {inserted} AS v FROM ways JOIN steps ON ways.conv_id IS NOT DISTINCT FROM steps.conv_id AND i = idx)
), ends AS (
  SELECT ways.conv_id, {best('v[1]', 'v[4]')} AS won FROM (SELECT conv_id, i, {inserted} AS v FROM ways) ways
  LEFT JOIN facts ON ways.conv_id IS NOT DISTINCT FROM facts.conv_id WHERE i = coalesce(n, 0)
)
SELECT ends.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, won.c AS cost, won.e AS audit, sha256(substr(won.r, 2)) AS repaired_sha256
FROM ends LEFT JOIN facts ON ends.conv_id IS NOT DISTINCT FROM facts.conv_id
"""


@query(_repair_sql())
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = load(spark, folder, "conversations")
    repaired = conversation_repair.repair(damaged_turns(turns))
    joined = turns.select("conv_id").distinct().join(repaired, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    return joined.na.fill({c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": "", "repaired_sha256": EMPTY})


@query()
def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(load(spark, folder, "documents", "doc_id", "text"), SENTENCEPIECE_MODEL, limit=4096)
    return counted.select("doc.doc_id", "n_bytes", "n_tokens", "over_limit")


def looped_texts(docs: DataFrame) -> DataFrame:
    """Documents of which the checksum of the id makes one in ten repeat some of its words to its end; a NULL id is the empty text."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g, words = F.floor(h / 10), F.regexp_extract_all("text", F.lit(f"({WORD})"))
    facts = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    facts = facts.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    facts = facts.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    looped = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", place(i))), " ")
    return facts.select("doc_id", F.when(F.col("n") > 0, looped).otherwise(F.col("text")).alias("text"))


@query()
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(looped_texts(load(spark, folder, "documents", "doc_id", "text")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    best = F.array_sort("runs", lambda x, y: F.when(x.length != y.length, y.length - x.length).when(x.start != y.start, x.start - y.start).otherwise(x.period - y.period).cast("int"))
    rows = found.select("doc.doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.get(best, F.lit(0)).alias("best"), lines.alias("lines"), "collapsed")
    milli = F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("bigint")
    digests = [F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")]
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), *digests)
