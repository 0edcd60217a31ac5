"""Quality scores by a generalised additive model with pairwise interactions.

Texts are described by the shares of ``text_rules``. Each feature is cut into bins at quantiles. Boosting goes round the
features again and again: each turn fits a shallow tree of one feature (up to three cuts of its bins) to the current
residuals and adds a small part of it to that feature's lookup table. Then the pairs of features whose 2 x 2 cut lowers the
remaining error most get tables of their own, learned the same way. A score is the sum of one table entry per feature and
pair, through the logistic function: scoring is a look-up and an addition for each.

The model is fitted on the driver from a bounded sample of labelled rows (SAMPLE of each label, taken by hash); all texts
are described and scored in tasks.

Defined results: NULL and empty texts have the features 0 and are scored like others; repeated rows get equal scores; ids
with contradicting or NULL labels are not learned from; with labels of one kind only, every score is near that label, and
without labels 0.5; no rows give no rows. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text_rules
from millrace.llm.common import crc_bucket, stage_table, told_labels

#: Most labelled rows of each label; bins of a feature; bins of a feature in a pair; rounds; learning rate; pairs.
SAMPLE, BINS, PAIR_BINS, ROUNDS, RATE, PAIRS = 6_000, 64, 12, 150, 0.15, 8
LEAST = 5.0


@dataclass
class Model:
    """Bin edges and tables; ``pairs`` are (feature, feature, table)."""

    edges: list[np.ndarray]
    pair_edges: list[np.ndarray]
    base: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for a, b, table in self.pairs:
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"), np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]


def _shallow(grad: np.ndarray, hess: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Step per bin of a tree with up to ``leaves`` leaves over ordered bins, from sums of gradient and curvature per bin."""
    cuts = [0, len(grad)]
    g, h = np.concatenate(([0], np.cumsum(grad))), np.concatenate(([0], np.cumsum(hess)))

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + LEAST)

    while len(cuts) <= leaves:
        best = (1e-9, 0)
        for a, b in zip(cuts, cuts[1:]):
            k = np.arange(a + 1, b)
            if len(k):
                gain = worth(a, k) + worth(k, b) - worth(a, b)
                best = max(best, (float(gain.max()), int(k[gain.argmax()])))
        if not best[1]:
            break
        cuts = sorted([*cuts, best[1]])
    step = np.zeros(len(grad))
    for a, b in zip(cuts, cuts[1:]):
        step[a:b] = (g[b] - g[a]) / (h[b] - h[a] + LEAST)
    return step


def _quadrants(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """Step per cell of a tree of two levels: the best cut of the rows, and on each side the best cut of the columns."""
    best, step = -1.0, np.zeros(grad.shape)
    for cut in range(1, len(grad)):
        sides = [(slice(0, cut), grad[:cut].sum(0), hess[:cut].sum(0)), (slice(cut, None), grad[cut:].sum(0), hess[cut:].sum(0))]
        steps = [_shallow(g, h, 2) for _, g, h in sides]
        gain = sum(float(s @ g - 0.5 * (s * s) @ h) for s, (_, g, h) in zip(steps, sides))
        if gain > best:
            best = gain
            for s, (rows, _, _) in zip(steps, sides):
                step[rows] = s
    return step


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> Model:
    """Boost tables for labels y in {0, 1}; weights make up for how each label was sampled."""
    model = Model(_edges(x, BINS), _edges(x, PAIR_BINS))
    rate = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    model.base = float(np.log(rate / (1 - rate)))
    at = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    margin = np.full(len(x), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            grad, hess = slopes()
            step = RATE * _shallow(np.bincount(at[f], grad, len(table)), np.bincount(at[f], hess, len(table)))
            table += step
            margin += step[at[f]]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.pair_edges)]
    grad, hess = slopes()
    ranked = []
    for a in range(x.shape[1]):
        for b in range(a):
            shape = len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1
            cell = coarse[a] * shape[1] + coarse[b]
            g, h = (np.bincount(cell, v, shape[0] * shape[1]).reshape(shape).cumsum(0).cumsum(1) for v in (grad, hess))
            gain = sum(
                q[0] ** 2 / (q[1] + LEAST)
                for q in [(g, h), (g[-1:] - g, h[-1:] - h), (g[:, -1:] - g, h[:, -1:] - h), (g[-1, -1] - g[-1:] - g[:, -1:] + g, h[-1, -1] - h[-1:] - h[:, -1:] + h)]
            )
            ranked.append((float(gain.max()), a, b))
    chosen = [(a, b, np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1))) for _, a, b in sorted(ranked, reverse=True)[:pairs]]
    for _ in range(rounds // 3):
        for a, b, table in chosen:
            grad, hess = slopes()
            cell = coarse[a] * table.shape[1] + coarse[b]
            g, h = (np.bincount(cell, v, table.size).reshape(table.shape) for v in (grad, hess))
            step = _quadrants(g, h)
            table += RATE * step
            margin += RATE * step.ravel()[cell]
    model.pairs = chosen
    return model


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", cut: float = 0.5) -> DataFrame:
    """(id, held_out, score, predicted) for every row; labels of held-out ids are not looked at."""
    described = stage_table(text_rules.count_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))).select("id", "shares"))
    told = described.join(told_labels(labels, id_col, label_col), "id")
    found = {r[0]: r[1] for r in told.groupBy("label").count().collect() if r[0] in (0, 1)}
    parts = [told.where(F.col("label") == k).orderBy(F.xxhash64("id", F.lit(6)), "id", "shares").limit(SAMPLE).select("shares", "label").collect() for k in sorted(found)]
    rows = [r for p in parts for r in p]
    model = None
    if rows:
        y = np.array([r.label for r in rows], float)
        share = {k: found[k] / max(1, (y == k).sum()) for k in found}
        weight = np.array([share[int(k)] for k in y])
        model = fit(np.array([r.shares for r in rows]), y, weight / weight.mean())
    kind = described.schema["id"].dataType.simpleString()

    # The model goes with the function, by value like it: a broadcast value would need its class on the executors.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("shares").flatten().to_numpy().reshape(batch.num_rows, len(text_rules.SHARES))
            score = model.score(x) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score)], ["id", "score"])

    scored = described.mapInArrow(run, f"id {kind}, score double")
    return scored.select("id", (crc_bucket("id", 3) == 1).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
