"""Quality rules by an isolation forest on rule statistics.

Every text gets counts and shares (``text_rules``). A base rule turns away texts of few words and texts that mostly repeat
themselves. For the others a forest of random splits is grown from a bounded sample: each tree takes a few texts, and each
node splits a random share at a random place between the least and the largest value. Texts unlike most end up in a leaf
after few splits. The mean path length gives the anomaly score, and texts above a threshold are turned away. The threshold
is set on all labelled rows that were not kept for checking: among those that cost at most a given part of the good ones,
the one that turns away most bad ones, where a good one lost counts ten times.

Defined results: NULL and empty texts have no words and fail the base rule; repeated rows get the same verdict; labels that
are NULL or contradict each other are not used; without any labelled rows nothing fails but the base rule; no rows give no
rows. Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text_rules
from millrace.llm.common import stage_table, told_labels

#: Most rows that trees are grown from; trees; rows of a tree; part of good rows that the threshold may cost.
SAMPLE, TREES, TREE_ROWS, COST = 8_192, 128, 64, 0.005
BINS = 2_000
#: Shares that the forest looks at: none that only tells long texts from short ones or one language from another.
LOOKS = ("symbols", "symbol_chars", "marked", "marked_lines", "bare", "dup_lines", "repeated", "same")


def looks(shares: np.ndarray) -> np.ndarray:
    """The shares that the forest looks at, stretched near zero, where texts are told apart."""
    return np.log(shares[:, [text_rules.SHARES.index(s) for s in LOOKS]] + 0.01)


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean length of an unsuccessful search among n values in a random binary tree."""
    n = np.asarray(n, float)
    big = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big, np.where(n == 2, 1.0, 0.0))


def grow_forest(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 11) -> dict[str, np.ndarray]:
    """Trees as arrays [tree, node], node k's children being 2k+1 and 2k+2: feature (-1: leaf), cut, path length of a leaf."""
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    depth = max(1, int(np.ceil(np.log2(max(2, rows)))))
    shape = (trees, 2 ** (depth + 1) - 1)
    forest = {"feature": np.full(shape, -1, np.int16), "cut": np.zeros(shape), "path": np.zeros(shape)}
    for t in range(trees):
        todo = [(0, 0, rng.choice(len(x), rows, replace=False))]
        while todo:
            node, level, at = todo.pop()
            low, high = x[at].min(axis=0), x[at].max(axis=0)
            open_ = np.flatnonzero(high > low)
            if level == depth or not len(open_):
                forest["path"][t, node] = level + expected_path(len(at))
                continue
            f = rng.choice(open_)
            cut = rng.uniform(low[f], high[f])
            forest["feature"][t, node], forest["cut"][t, node] = f, cut
            above = x[at, f] > cut
            todo += [(2 * node + 1, level + 1, at[~above]), (2 * node + 2, level + 1, at[above])]
    forest["usual"] = np.maximum(expected_path(np.array(rows)), 1e-9)
    return forest


def anomaly(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """0 to 1, above 0.5 for rows whose mean path is shorter than usual."""
    total = np.zeros(len(x))
    every = np.arange(len(x))
    for feature, cut, path in zip(forest["feature"], forest["cut"], forest["path"]):
        node = np.zeros(len(x), np.int64)
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                break
            node = np.where(inner, 2 * node + 1 + (x[every, f] > cut[node]), node)
        total += path[node]
    return 2.0 ** (-total / len(forest["path"]) / forest["usual"])


def choose_threshold(good: np.ndarray, bad: np.ndarray, cost: float = COST) -> float:
    """From histograms over BINS scores: the threshold that turns away most bad rows less good ones, at that cost at most."""
    if not good.sum() or not bad.sum():
        return 1.0
    lost = good[::-1].cumsum()[::-1] / good.sum()
    caught = bad[::-1].cumsum()[::-1] / bad.sum()
    worth = np.where(lost <= cost, caught - 10 * lost, -1.0)
    best = np.flatnonzero(worth == worth.max())
    return float((best[0] + best[-1]) // 2) / BINS if worth.max() > 0 else 1.0


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", min_words: int = 50, most_repeated: float = 0.5) -> DataFrame:
    """(id, COUNTS, base_failed, score, threshold, kept) for every row; labels of every third id are not looked at."""
    counted = text_rules.count_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    counted = stage_table(counted.withColumn("base_failed", failed))
    told = told_labels(labels, id_col, label_col)
    picked = counted.where("not base_failed").orderBy(F.xxhash64("id", F.lit(5)), "id", "shares").limit(SAMPLE).select("shares").collect()
    forest = grow_forest(looks(np.array([r[0] for r in picked]))) if picked else None
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(values: pd.Series) -> pd.Series:
        if sent.value is None or not len(values):
            return pd.Series(np.zeros(len(values)))
        return pd.Series(anomaly(sent.value, looks(np.stack(values.to_numpy()))))

    scored = stage_table(counted.withColumn("score", score("shares")).drop("shares"))
    bins = scored.where("not base_failed").join(told, "id")
    bins = bins.groupBy("label", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).count().collect()
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for label, at, n in bins:
        (good if label == 1 else bad)[at] += n
    threshold = choose_threshold(good, bad)
    kept = ~F.col("base_failed") & (F.col("score") < threshold)
    return scored.select("id", *text_rules.COUNTS, "base_failed", "score", F.lit(threshold).alias("threshold"), kept.alias("kept"))

