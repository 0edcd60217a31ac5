"""Itemsets of part brands per order, event sequences per user and day, and classifiers on the embeddings."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions.scalars import bracketed
from millrace.operators import classify, mining
from millrace.operators.stats import accuracy
from millrace.operators.tables import split_frames, with_vectors
from millrace.plans.registry import load, query, rounded
from millrace.session import stage_table

SUPPORT = 0.02
CONFIDENCE = 0.1

PAIRS = """pairs AS (SELECT DISTINCT l_orderkey AS basket, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey),
  least AS (SELECT ceil(count(DISTINCT basket) * 0.02::DOUBLE) AS n FROM pairs),
  ones AS (SELECT item, count(*) AS freq FROM pairs GROUP BY item HAVING count(*) >= (SELECT n FROM least)),
  twos AS (SELECT a.item AS x, b.item AS y, count(*) AS freq FROM pairs a JOIN pairs b ON a.basket = b.basket
    AND a.item < b.item GROUP BY 1, 2 HAVING count(*) >= (SELECT n FROM least)),
  threes AS (SELECT a.item AS x, b.item AS y, c.item AS z, count(*) AS freq FROM pairs a JOIN pairs b ON a.basket = b.basket
    AND a.item < b.item JOIN pairs c ON a.basket = c.basket AND b.item < c.item
    GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT n FROM least))"""


def _brand_model(spark, folder):
    lines = load(spark, folder, "lineitem", "l_orderkey", "l_partkey")
    brands = load(spark, folder, "part", F.col("p_partkey").alias("l_partkey"), "p_brand")
    pairs = lines.join(brands, "l_partkey")
    return mining.mine_pairs(pairs, ["l_orderkey"], "p_brand", SUPPORT, CONFIDENCE)


@query(
    f"""WITH {PAIRS} SELECT '[' || item || ']' AS items, freq FROM ones
        UNION ALL SELECT '[' || x || ',' || y || ']', freq FROM twos
        UNION ALL SELECT '[' || x || ',' || y || ',' || z || ']', freq FROM threes"""
)
def freq_itemsets(spark, folder):
    itemsets = mining.itemsets_of(_brand_model(spark, folder))
    return itemsets.select(bracketed("items").alias("items"), "freq")


@query(
    f"""WITH {PAIRS}, rules AS (SELECT x AS a, y AS c, freq FROM twos UNION ALL SELECT y, x, freq FROM twos)
        SELECT '[' || a || ']' AS antecedent, '[' || c || ']' AS consequent, rules.freq / ones.freq::DOUBLE AS confidence
        FROM rules JOIN ones ON a = item WHERE rules.freq / ones.freq::DOUBLE >= 0.1::DOUBLE"""
)
def assoc_rules(spark, folder):
    rules = mining.rules_of(_brand_model(spark, folder))
    return rules.select(bracketed("antecedent").alias("antecedent"), bracketed("consequent").alias("consequent"), "confidence")


STEPS = """steps AS (SELECT user_id, date_trunc('day', ts) AS day, ts, event_id, event_type AS item FROM events),
  least AS (SELECT ceil(count(*) * 0.02::DOUBLE) AS n FROM (SELECT DISTINCT user_id, day FROM steps)),
  ones AS (SELECT item AS sequence, count(*) AS freq FROM (SELECT DISTINCT user_id, day, item FROM steps)
    GROUP BY 1 HAVING count(*) >= (SELECT n FROM least)),
  twos AS (SELECT x || '>' || y AS sequence, count(*) AS freq FROM (SELECT DISTINCT a.user_id, a.day, a.item AS x, b.item AS y
    FROM steps a JOIN steps b ON a.user_id = b.user_id AND a.day = b.day AND (a.ts, a.event_id) < (b.ts, b.event_id))
    GROUP BY 1 HAVING count(*) >= (SELECT n FROM least)),
  threes AS (SELECT x || '>' || y || '>' || z AS sequence, count(*) AS freq FROM (SELECT DISTINCT a.user_id, a.day,
    a.item AS x, b.item AS y, c.item AS z FROM steps a
    JOIN steps b ON a.user_id = b.user_id AND a.day = b.day AND (a.ts, a.event_id) < (b.ts, b.event_id)
    JOIN steps c ON a.user_id = c.user_id AND a.day = c.day AND (b.ts, b.event_id) < (c.ts, c.event_id))
    GROUP BY 1 HAVING count(*) >= (SELECT n FROM least))"""


def _day_events(spark, folder):
    day = F.date_trunc("day", "ts").alias("day")
    return load(spark, folder, "events", "user_id", day, "ts", "event_id", "event_type")


@query(f"WITH {STEPS} SELECT * FROM ones UNION ALL SELECT * FROM twos")
def freq_sequences(spark, folder):
    found = mining.frequent_pairs(_day_events(spark, folder), ["user_id", "day"], ["ts", "event_id"], "event_type", SUPPORT)
    return found.select(F.array_join("sequence", ">").alias("sequence"), "freq")


@query(f"WITH {STEPS.replace('date_trunc(' + repr('day') + ', ts) AS day, ts,', 'date_trunc(' + repr('day') + ', ts) AS day, date_trunc(' + repr('day') + ', ts) AS ts,')} SELECT * FROM ones UNION ALL SELECT * FROM twos")
def freq_sequences_tied(spark, folder):
    """Events of a day all at the same time, so that only the second order column tells them apart."""
    events = _day_events(spark, folder).withColumn("ts", F.col("day"))
    found = mining.frequent_pairs(events, ["user_id", "day"], ["ts", "event_id"], "event_type", SUPPORT)
    return found.select(F.array_join("sequence", ">").alias("sequence"), "freq")


def steps_sql(length: int) -> str:
    """Frequent sequences of up to ``length`` events: every group keeps the earliest end of each pattern."""
    numbered = """steps AS MATERIALIZED (SELECT user_id, date_trunc('day', ts) AS day, event_type AS item,
        row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS i FROM events),
      least AS (SELECT ceil(count(*) * 0.02::DOUBLE) AS n FROM (SELECT DISTINCT user_id, day FROM steps)),
      p1 AS MATERIALIZED (SELECT user_id, day, item AS sequence, min(i) AS i FROM steps GROUP BY ALL)"""
    ctes = [numbered]
    for k in range(2, length + 1):
        ctes.append(
            f"""p{k} AS MATERIALIZED (SELECT p.user_id, p.day, p.sequence || '>' || s.item AS sequence, min(s.i) AS i
            FROM p{k - 1} p JOIN steps s ON p.user_id = s.user_id AND p.day = s.day AND s.i > p.i GROUP BY ALL)"""
        )
    every = " UNION ALL ".join(f"SELECT sequence, count(*) AS freq FROM p{k} GROUP BY 1 HAVING count(*) >= (SELECT n FROM least)" for k in range(1, length + 1))
    return f"WITH {', '.join(ctes)} {every}"


@query(steps_sql(5))
def freq_sequences_grown(spark, folder):
    found = mining.grow_sequences(
        _day_events(spark, folder), ["user_id", "day"], ["ts", "event_id"], "event_type", SUPPORT, max_length=5
    )
    return found.select(F.array_join("sequence", ">").alias("sequence"), "freq")


def sets_sql(length: int) -> str:
    """Frequent sequences of the hours' event types of a user's day, of up to ``length`` items: each row is a way to place a
    pattern's last item, in the same hour behind a smaller item or in a later hour."""
    ctes = [
        """sets AS MATERIALIZED (SELECT DISTINCT user_id, date_trunc('day', ts) AS day, date_trunc('hour', ts) AS hour, event_type AS item FROM events),
      least AS (SELECT ceil(count(*) * 0.02::DOUBLE) AS n FROM (SELECT DISTINCT user_id, day FROM sets)),
      p1 AS MATERIALIZED (SELECT user_id, day, item AS sequence, item, hour FROM sets)"""
    ]
    for k in range(2, length + 1):
        ctes.append(
            f"""p{k} AS MATERIALIZED (SELECT DISTINCT p.user_id, p.day, p.sequence || CASE WHEN p.hour = s.hour THEN '+' ELSE '>' END || s.item AS sequence,
            s.item, s.hour FROM p{k - 1} p JOIN sets s ON p.user_id = s.user_id AND p.day = s.day AND (s.hour > p.hour OR s.hour = p.hour AND s.item > p.item))"""
        )
    count = "SELECT sequence, count(DISTINCT (user_id, day)) AS freq FROM p{} GROUP BY 1 HAVING count(DISTINCT (user_id, day)) >= (SELECT n FROM least)"
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(count.format(k) for k in range(1, length + 1))}"


@query(sets_sql(5))
def freq_itemset_sequences(spark, folder):
    """The event types of an hour are one item set of a user's day."""
    hour = F.date_trunc("hour", "ts").alias("hour")
    events = load(spark, folder, "events", "user_id", F.date_trunc("day", "ts").alias("day"), hour, "event_type")
    found = mining.grow_set_sequences(events, ["user_id", "day"], "hour", "event_type", SUPPORT, max_length=5)
    sets = F.transform("sequence", lambda s: F.array_join(s, "+"))
    return found.select(F.array_join(sets, ">").alias("sequence"), "freq")


# --- classification --------------------------------------------------------------------------------------------


@query(
    """WITH ranked AS (SELECT event_type, count(*) AS n, (row_number() OVER (ORDER BY count(*) DESC, event_type) - 1)::DOUBLE
         AS label_index FROM events GROUP BY event_type) SELECT event_type, event_type AS label, label_index, n FROM ranked"""
)
def label_index(spark, folder):
    events = load(spark, folder, "events", "event_type")
    indexed = classify.with_label_index(events, "event_type")
    labels = indexed.schema["label_index"].metadata["ml_attr"]["vals"]
    back = classify.with_label_back(indexed, "label_index", labels)
    return back.groupBy("event_type", "label", "label_index").agg(F.count(F.lit(1)).alias("n"))


def _vectors(spark, folder):
    return classify.with_array_vector(load(spark, folder, "embeddings", "vec_id", "embedding", "label"), "embedding")


@query(
    """SELECT CASE l_linestatus WHEN 'F' THEN 0.0::DOUBLE ELSE 7.0::DOUBLE END AS raw,
              CASE l_linestatus WHEN 'F' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS indexed,
              count(*) AS n, round(sum(l_extendedprice), 2) AS kept FROM lineitem GROUP BY 1, 2"""
)
def vector_index(spark, folder):
    """A slot with two values is re-indexed, a continuous one is kept."""
    status = F.when(F.col("l_linestatus") == "F", 0.0).otherwise(7.0)
    rows = load(spark, folder, "lineitem", status.alias("status"), "l_extendedprice")
    vectors = with_vectors(rows, {"features": ["status", "l_extendedprice"]})
    vectors = classify.category_indexer(vectors).transform(vectors).withColumn("slots", vector_to_array("indexed_features"))
    counts = vectors.groupBy(F.col("status").alias("raw"), F.col("slots")[0].alias("indexed")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("slots")[1]).alias("kept")
    )
    return rounded(counts, 2, "kept")


@query(
    """SELECT 2 * (l_quantity > 20)::INT + (l_discount > 0.045::DOUBLE)::INT AS label,
              (2 * (l_quantity > 20)::INT + (l_discount > 0.045::DOUBLE)::INT)::VARCHAR AS predicted_label, count(*) AS n FROM lineitem GROUP BY ALL"""
)
def decision_tree(spark, folder):
    """Labels that two thresholds make, which a tree of two levels must return for every row."""
    label = (F.col("l_quantity") > 20).cast("int") * 2 + (F.col("l_discount") > 0.045).cast("int")
    rows = load(spark, folder, "lineitem", "l_quantity", "l_discount", "l_tax", label.alias("label"))
    vectors = stage_table(with_vectors(rows, {"features": ["l_quantity", "l_discount", "l_tax"]}).select("label", "features"))
    predicted = classify.fit_decision_tree(vectors, "label", maxDepth=2, maxBins=64).transform(vectors)
    return predicted.groupBy("label", "predicted_label").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS rows, count(*) AS equal, 1.0::DOUBLE AS accuracy FROM lineitem WHERE ('0x' || substr(md5(l_orderkey || '#1234'), 1, 8))::BIGINT % 10000 >= 6000")
def mlp(spark, folder):
    """Held-out accuracy of a perceptron on labels that a wide margin separates."""
    side = F.when(F.col("l_linestatus") == "F", -1.0).otherwise(1.0)
    wave = (F.col("l_quantity") / 50 - 0.5).alias("wave")
    rows = load(spark, folder, "lineitem", "l_orderkey", side.alias("side"), wave, (side > 0).cast("double").alias("label"))
    parts = split_frames(with_vectors(rows, {"features": ["side", "wave"]}), "l_orderkey", {"train": 0.6, "test": 0.4}, seed=1234)
    model = classify.fit_perceptron(parts["train"], [2, 3, 2], max_iter=50)
    return accuracy(model.transform(parts["test"]), "label", "prediction")


@query()
def decision_tree_embeddings(spark, folder):
    """Predictions of a tree fitted to all embeddings, counted per label."""
    rows = _vectors(spark, folder)
    predicted = classify.fit_decision_tree(rows, "label").transform(rows)
    return predicted.groupBy("label", "predicted_label").agg(F.count(F.lit(1)).alias("n"))


@query()
def mlp_embeddings(spark, folder):
    """Accuracy on held-out embeddings of a perceptron fitted to the others."""
    parts = split_frames(_vectors(spark, folder), "vec_id", {"train": 0.6, "test": 0.4}, seed=1234)
    model = classify.fit_perceptron(parts["train"], [64, 16, 10])
    return accuracy(model.transform(parts["test"]), "label", "prediction")
