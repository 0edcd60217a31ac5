"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are looked up in a lexicon and become symbols: insult, threat, target, negation, reporting word, quotation mark, other.
Small transducers rewrite the symbols of a clause one after the other, and are composed into one machine beforehand:

* negation: an insult or threat within a few words behind a negation is a negated one;
* reported speech: behind a reporting word or inside quotation marks it is a reported one;
* target: an insult or threat within a few words of a target word, on either side, is a directed one.

Arcs that complete a pattern carry its weight, and an arc that turns a plain match into a directed one takes the plain one's
weight back. A clause scores the weight of its way through the machine, a text the logistic of a constant and the scores of
its clauses, so isolated target or reporting words count for nothing. Long texts are read clause by clause.

Lexicon and weights are learned on the driver from a bounded sample of labelled rows. Insults are words or beginnings of
words found by greedy cover: again and again the term that explains most toxic texts not yet explained and hardly any
other, until a further term explains next to none; frequent terms of toxic texts only and a few general words come along.
The pattern weights are then fitted by regularised logistic regression, with bounds that keep their meaning (negated and
reported matches weigh no more than plain ones).

Defined results: NULL and empty texts have no matches and get the least score; repeated rows get equal scores; ids with
contradicting or NULL labels are not learned from; without labels only the general words count; no rows give no rows. The
other columns stay inside ``doc``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import crc_bucket, slices, stage, stage_table, told_labels

#: Most labelled rows of label 1 and of label 0 to learn from; terms that a text is searched for; words that a scope reaches.
TOXIC_SAMPLE, CLEAN_SAMPLE, MOST_TERMS, SCOPE = 4_000, 8_000, 20_000, 3
#: Characters of a text that are turned into words at once.
PIECE = 1_000_000
PREFIXES = (4, 5, 6)
INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = "i", "t", "y", "n", "r", "q", "o"
#: Pattern symbols: plain, directed, negated and reported insults, and threats alike.
PATTERNS = ("insult", "directed_insult", "negated_insult", "reported_insult", "threat", "directed_threat", "negated_threat", "reported_threat")

# General words of the four languages.
GENERAL = {
    INSULT: "idiot idiots stupid moron morons imbecile scumbag idiota imbécile dummkopf vollidiot",
    THREAT: "kill murder strangle stab töten umbringen tuer étrangler matar asesinar",
    TARGET: "you your yours he him she her they them these those du dich dir ihr euch sie tu toi vous te ti usted ustedes ellos",
    NEGATION: "not no never neither nor isn't aren't wasn't nicht kein keine nie niemals pas jamais aucun nunca jamás ningún tampoco",
    REPORT: "said says claimed claims wrote writes quoted reported sagte schrieb behauptet dit écrit affirme dijo escribió afirma",
}
CLAUSE_END = re.compile(r"[.!?;\n]")
WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]|[\"“”«»„]")


@dataclass
class Transducer:
    """A deterministic letter transducer: arcs[state, symbol] = (output symbols, next state, weight); state 0 starts."""

    arcs: dict[tuple[int, str], tuple[str, int, float]] = field(default_factory=dict)

    def run(self, symbols: str, state: int = 0) -> tuple[str, int, float]:
        out, weight = [], 0.0
        for s in symbols:
            o, state, w = self.arcs[state, s]
            out.append(o)
            weight += w
        return "".join(out), state, weight

    def then(self, other: Transducer, alphabet: str) -> Transducer:
        """The machine that runs both, one after the other: states are the pairs that can be reached."""
        number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
        while todo:
            pair = todo.pop()
            for s in alphabet:
                middle, a, w = self.arcs[pair[0], s]
                out, b, v = other.run(middle, pair[1])
                if (a, b) not in number:
                    number[a, b] = len(number)
                    todo.append((a, b))
                arcs[number[pair], s] = (out, number[a, b], w + v)
        return Transducer(arcs)


SYMBOLS = INSULT + THREAT + TARGET + NEGATION + REPORT + QUOTE + OTHER
PLAIN, NEGATED = {INSULT: "I", THREAT: "T"}, {INSULT: "J", THREAT: "U"}  # reported ones are K and V
MARKED = "IJKTUV"


def negation() -> Transducer:
    """States count down the words that a negation still reaches; plain matches become I and T, negated ones J and U."""
    arcs = {}
    for left in range(SCOPE + 1):
        for s in SYMBOLS:
            after = SCOPE if s == NEGATION else max(0, left - 1)
            arcs[left, s] = ((NEGATED if left else PLAIN).get(s, s), after, 0.0)
    return Transducer(arcs)


def reported() -> Transducer:
    """State 1: behind a reporting word; 2: inside quotation marks; 3: both."""
    arcs = {}
    for state in range(4):
        for s in MARKED + TARGET + NEGATION + REPORT + QUOTE + OTHER:
            out = {"I": "K", "J": "K", "T": "V", "U": "V"}.get(s, s) if state else s
            after = state | 1 if s == REPORT else state ^ 2 if s == QUOTE else state
            arcs[state, s] = (out, after, 0.0)
    return Transducer(arcs)


def targeted(weights: dict[str, float]) -> Transducer:
    """Puts out the patterns' numbers as digits and their weights; directed ones take the place of plain ones.

    A state is (words that a target still reaches, words that an open plain match still reaches, which match): if a target
    follows a plain match, the arc adds the pattern's digit and takes the plain one's weight back.
    """
    number: dict[tuple, int] = {(0, 0, ""): 0}
    todo, arcs = [(0, 0, "")], {}
    digit = {"I": 0, "J": 2, "K": 3, "T": 4, "U": 6, "V": 7}
    weight = [weights[p] for p in PATTERNS]
    while todo:
        state = todo.pop()
        near, open_, kind = state
        for s in MARKED + TARGET + NEGATION + REPORT + QUOTE + OTHER:
            out, w = "", 0.0
            after = (max(0, near - 1), max(0, open_ - 1), kind if open_ > 1 else "")
            if s == TARGET:
                after = (SCOPE, 0, "")
                if open_:
                    out, w = "-" + str(digit[kind]) + str(digit[kind] + 1), weight[digit[kind] + 1] - weight[digit[kind]]
            elif s in digit:
                directed = near and s in "IT"
                out = str(digit[s] + bool(directed))
                w = weight[int(out)]
                if s in "IT" and not directed:
                    after = (after[0], SCOPE, s)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            arcs[number[state], s] = (out, number[after], w)
    return Transducer(arcs)


def grammar(weights: dict[str, float]) -> Transducer:
    return negation().then(reported(), SYMBOLS).then(targeted(weights), SYMBOLS)


@dataclass
class Lexicon:
    """Symbols of whole words, and beginnings of insults by their length."""

    words: dict[str, str] = field(default_factory=dict)
    prefixes: dict[int, set[str]] = field(default_factory=dict)

    @staticmethod
    def of(terms: list[str]) -> Lexicon:
        words = {w: s for s, text in GENERAL.items() for w in text.split()}
        prefixes: dict[int, set[str]] = {}
        for t in terms:
            if t[0] == "=":
                words[t[1:]] = INSULT
            else:
                prefixes.setdefault(len(t) - 1, set()).add(t[1:])
        return Lexicon(words, prefixes)

    def insult(self, word: str) -> bool:
        return any(len(word) > n and word[:n] in known for n, known in self.prefixes.items())


class Matcher:
    """Counts the matches of the patterns in a text, and adds up the weights of its clauses."""

    def __init__(self, lexicon: Lexicon, weights: dict[str, float] | None = None):
        self.lexicon = lexicon
        self.machine = grammar(weights or dict.fromkeys(PATTERNS, 0.0))
        self.hits = {w for w, s in lexicon.words.items() if s in (INSULT, THREAT)}
        self.known = lru_cache(1 << 16)(lexicon.insult)
        self.clause = lru_cache(1 << 16)(self._clause)
        self.weigh = lru_cache(1 << 16)(lambda symbols: self.machine.run(symbols)[2])

    def _clause(self, symbols: str) -> tuple[int, ...]:
        """Matches of each pattern in a clause."""
        counts = [0] * len(PATTERNS)
        digits = self.machine.run(symbols)[0]
        at = 0
        while at < len(digits):
            if digits[at] == "-":  # a plain match turned into a directed one
                counts[int(digits[at + 1])] -= 1
                counts[int(digits[at + 2])] += 1
                at += 3
            else:
                counts[int(digits[at])] += 1
                at += 1
        return tuple(counts)

    def clauses(self, text: str) -> Iterator[str]:
        """The symbols of each clause that holds an insult or threat."""
        for piece in pieces(text.lower()):
            words = WORDS.findall(piece)
            hits, known = self.hits, self.known
            found = [i for i, w in enumerate(words) if w in hits or len(w) > 4 and known(w)]
            done = -1
            for i in found:
                if i <= done:
                    continue
                start = i
                while start > 0 and words[start - 1] not in ".!?;\n":
                    start -= 1
                end = i
                while end + 1 < len(words) and words[end + 1] not in ".!?;\n":
                    end += 1
                done = end
                symbols = "".join(self.lexicon.words.get(w) or (QUOTE if w in '"“”«»„' else INSULT if len(w) > 4 and known(w) else OTHER) for w in words[start : end + 1])
                # Symbols that change nothing: a run of other words longer than every scope is as good as one just longer.
                yield re.sub(f"{OTHER}{{{SCOPE + 2},}}", OTHER * (SCOPE + 1), symbols)

    def __call__(self, text: str) -> list[int]:
        total = [0] * len(PATTERNS)
        for symbols in self.clauses(text):
            for k, n in enumerate(self.clause(symbols)):
                total[k] += n
        return total

    def score(self, text: str) -> tuple[list[int], float]:
        """Matches of each pattern, and the weight of the ways that the clauses take."""
        total, weight = [0] * len(PATTERNS), 0.0
        for symbols in self.clauses(text):
            weight += self.weigh(symbols)
            for k, n in enumerate(self.clause(symbols)):
                total[k] += n
        return total, weight


def pieces(text: str) -> Iterator[str]:
    """A long text in pieces that end with a clause, others as they are."""
    at = 0
    while len(text) - at > PIECE:
        end = CLAUSE_END.search(text, at + PIECE)
        if not end:
            break
        yield text[at : end.end()]
        at = end.end()
    yield text[at:]


def terms_of(text: str) -> set[str]:
    """Words and beginnings of words of a text that may enter the lexicon."""
    words = {w for w in WORDS.findall(text.lower()) if len(w) > 3}
    return {"=" + w for w in words} | {"^" + w[:n] for n in PREFIXES for w in words if len(w) > n}


def cover(toxic: list[set[int]], clean: np.ndarray, least: int) -> list[int]:
    """Terms in the order of a greedy cover of toxic texts, given the share of clean texts that have each."""
    where: dict[int, set[int]] = {}
    for doc, terms in enumerate(toxic):
        for t in terms:
            where.setdefault(t, set()).add(doc)
    left, chosen = set(range(len(toxic))), []
    gains = {t: len(docs) for t, docs in where.items()}
    while gains:
        t = max(gains, key=lambda k: (gains[k], -clean[k], -k))
        now = len(where[t] & left)
        if now < gains[t]:  # counts only fall, so only the best one needs to be counted anew
            gains[t] = now
            continue
        if now < least:
            break
        chosen.append(t)
        left -= where[t]
        del gains[t]
    return chosen


def fit_weights(counts: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, float]]:
    """Constant and pattern weights by logistic regression on the numbers of matches with a small penalty."""
    x = np.column_stack((np.ones(len(counts)), counts))
    prior = np.array([-4.0, *([6.0, 6.5, 3.0, 3.0] * 2)])  # where a pattern has not been seen
    beta = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (label - p)) - 0.3 * (beta - prior)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.3 * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    w = beta[1:]
    for k in (0, 4):  # insult, directed, negated, reported
        w[k] = max(w[k], 0.0)
        w[k + 1] = max(w[k + 1], w[k])
        w[k + 2], w[k + 3] = min(w[k + 2], w[k]), min(w[k + 3], w[k])
    return float(beta[0]), dict(zip(PATTERNS, w.tolist()))


@dataclass
class Model:
    terms: list[str]
    constant: float
    weights: dict[str, float]

    def score(self, weight: np.ndarray) -> np.ndarray:
        """Of texts whose clauses weigh so much."""
        return 1 / (1 + np.exp(-np.clip(self.constant + weight, -30, 30)))


def _sample(docs: DataFrame, told: DataFrame, label: int, most: int) -> DataFrame:
    """Texts of the ids of one label that have the least hashes, ``most`` at most; equal texts count once."""
    ids = stage(told.where(F.col("label") == label).orderBy(F.xxhash64("id", F.lit(3)), "id").limit(most).select("id"))
    texts = docs.join(F.broadcast(ids), "id").where("text is not null").groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
    return texts.orderBy("h").limit(most).select("text")


def learn(docs: DataFrame, told: DataFrame) -> Model:
    """docs: (id, text); told: (id, label)."""
    toxic, clean = (stage_table(_sample(docs, told, k, n)) for k, n in ((1, TOXIC_SAMPLE), (0, CLEAN_SAMPLE)))
    many = {1: toxic.count(), 0: clean.count()}
    if not many[1] or not many[0]:
        return Model([], -4.0, dict(zip(PATTERNS, [6.0, 6.5, 3.0, 3.0] * 2)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                seen = Counter(t for text in part.column("text").to_pylist() for t in terms_of(text))
                yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

    def totals(texts: DataFrame, name: str) -> DataFrame:
        return texts.mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias(name))

    least = max(2, many[1] // 500)
    both = totals(toxic, "bad").where(F.col("bad") >= least).join(totals(clean, "good"), "term", "left").na.fill(0, ["good"])
    lift = ((F.col("bad") + 0.5) / many[1]) / ((F.col("good") + 0.5) / many[0])
    rows = both.where((lift >= 20) & (F.col("good") <= 0.002 * many[0])).orderBy(F.desc("bad"), "good", "term").limit(MOST_TERMS).collect()
    terms = [r.term for r in rows]
    index = {t: k for k, t in enumerate(terms)}
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = [sorted(sent.value[t] for t in terms_of(text) if t in sent.value) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(has, pa.list_(pa.int32()))], ["has"])

    incidence = [set(r.has) for r in toxic.mapInArrow(find, "has array<int>").collect()]  # bounded by TOXIC_SAMPLE
    share = np.array([r.good for r in rows]) / many[0] if rows else np.zeros(0)
    often = [r.term for r in rows if r.bad >= max(8, 0.03 * many[1]) and r.good <= 0.005 * r.bad]
    chosen = list(dict.fromkeys([terms[k] for k in cover(incidence, share, least)] + often))
    lexicon = Lexicon.of(chosen)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([matcher(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))], ["counts"])

    counts = {k: np.array([r.counts for r in f.mapInArrow(match, "counts array<int>").collect()], float) for k, f in ((1, toxic), (0, clean))}
    label = np.repeat([1.0, 0.0], [many[1], many[0]])
    weight = np.repeat([0.5 / many[1], 0.5 / many[0]], [many[1], many[0]]) * (many[1] + many[0])
    return Model(chosen, *fit_weights(np.concatenate((counts[1], counts[0])), label, weight))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", cut: float = 0.7) -> DataFrame:
    """For every row: the other columns as ``doc``, text, held_out, score, predicted, and the matches of each pattern.

    Labels of held-out ids are not looked at.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    model = learn(texts, told_labels(labels, id_col, label_col))
    others = [c for c in docs.columns if c != text_col]
    doc = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(doc.alias("doc"), F.col(text_col).cast("string").alias("text"), (crc_bucket(id_col, 3) == 1).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(Lexicon.of(model.terms), model.weights)  # goes with the function, by value like it
        for batch in batches:
            for part in slices(batch):
                found = [matcher.score(t or "") for t in part.column("text").to_pylist()]
                scores = pa.array(model.score(np.array([w for _, w in found])))
                lists = pa.array([c for c, _ in found], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, scores, lists], [*part.schema.names, "score", "matches"])

    kinds = f"doc {rows.schema['doc'].dataType.simpleString()}, text string, held_out boolean, score double, matches array<int>"
    return rows.mapInArrow(run, kinds).withColumn("predicted", (F.col("score") >= cut).cast("int"))
