"""Toxicity: a logistic classifier that is held to equal scores when identity terms are swapped.

Features are the words of a text and their first 3 to 8 letters, present or
not. Labelled texts that mention a group get a counterfactual: every identity
term is replaced by another of its list. The loss adds the squared change of the
score between both, so the mention of a group by itself stops counting.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.columns import hash_unit, sliced, without
from tabforge.session import materialize

# Lists of terms that may stand for each other; a term belongs to one list.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("frauen", "männer", "muslime", "christen", "juden", "ausländer", "deutsche"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "français"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros", "españoles"),
)

_WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(_WORDS.findall(text.lower())) if text else set()


def swapped(words: set[str], lists: tuple[tuple[str, ...], ...]) -> set[str] | None:
    """The words with each identity term replaced by the next of its list; None without such terms."""
    following = {t: terms[(i + 1) % len(terms)] for terms in lists for i, t in enumerate(terms)}
    if words.isdisjoint(following):
        return None
    return {following.get(w, w) for w in words}


class Features:
    """64-bit hashes of the features of words; words are remembered up to a bound and then forgotten."""

    def __init__(self, shortest: int = 3, longest: int = 8, remember: int = 50_000):
        self.lengths, self.remember, self.known = range(shortest, longest + 1), remember, {}

    def of_word(self, word: str) -> np.ndarray:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.remember:
                self.known.clear()
            parts = [word + "$", *(word[:k] for k in self.lengths if k <= len(word))]
            found = self.known[word] = np.array([xxhash.xxh3_64_intdigest(p) - 2**63 for p in parts], np.int64)
        return found

    def of_words(self, words: set[str]) -> np.ndarray:
        return np.unique(np.concatenate([self.of_word(w) for w in words])) if words else np.empty(0, np.int64)


@dataclass
class ToxicityModel:
    """Weights by feature hash; picklable and of bounded size (``features`` at fit time)."""

    bias: float
    weights: dict[int, float] = field(default_factory=dict)

    def scorer(self):
        """A function from text to score; what a word contributes is looked up once per word."""
        features, weights, known = Features(remember=1), self.weights, {}

        def hits(word: str) -> tuple[int, ...]:
            if len(known) > 50_000:
                known.clear()
            found = known[word] = tuple(h for h in features.of_word(word).tolist() if h in weights)
            return found

        def score(text: str | None) -> float:
            present: set[int] = set()
            for w in words_of(text):
                found = known.get(w)
                present.update(hits(w) if found is None else found)
            z = self.bias + sum(weights[h] for h in sorted(present))
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        return score


def training_labels(labels: DataFrame, id_col: str, label_col: str, max_rows: int, seed: int) -> DataFrame:
    """At most about ``max_rows`` labelled ids outside the held-out fold (crc32 of the id as text, mod 4, is 2).

    Chosen by a hash of the id, so the choice is the same in every run.
    """
    usable = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label")).where(
        "label IN (0, 1) AND label_id IS NOT NULL AND crc32(CAST(label_id AS STRING)) % 4 != 2"
    )
    share = max_rows / max(usable.count(), 1)
    return materialize(usable.where(hash_unit(seed, "label_id") < share), "toxicity-labels")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per feature and label in each batch of (label, text)."""
    features = Features()
    for batch in sliced(batches):
        labels = batch.column(0).to_pylist()
        sets = [features.of_words(words_of(t)) for t in batch.column(1).to_pylist()]
        for label in (0, 1):
            some = [s for s, y in zip(sets, labels, strict=True) if y == label]
            found, times = np.unique(np.concatenate([np.empty(0, np.int64), *some]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(np.full(len(found), label, np.int32)), pa.array(times.astype(np.int64))], names=["feature", "label", "docs"]
            )


def choose_features(texts: DataFrame, count: int, least_gain: float, least_docs: int = 3) -> list[int]:
    """The ``count`` features of ``texts(label, text)`` whose presence depends most on the label (likelihood ratio).

    Below ``least_gain`` a ratio is what chance gives among very many features,
    and with few labels such features would take the place of the telling ones.
    """
    n = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = texts.mapInArrow(_counted, "feature long, label int, docs long").groupBy("feature").agg(
        F.sum(F.when(F.col("label") == 1, F.col("docs")).otherwise(0)).cast("double").alias("a"),
        F.sum(F.when(F.col("label") == 0, F.col("docs")).otherwise(0)).cast("double").alias("b"),
    )
    one, zero = float(n.get(1, 0)), float(n.get(0, 0))
    share, both = F.col("a") + F.col("b"), one + zero

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = part(F.col("a"), share * one / both) + part(F.col("b"), share * zero / both)
    ratio += part(F.lit(one) - F.col("a"), (both - share) * one / both) + part(F.lit(zero) - F.col("b"), (both - share) * zero / both)
    best = totals.where(share >= least_docs).withColumn("gain", ratio).where(F.col("gain") >= least_gain).orderBy(F.col("gain").desc(), "feature").limit(count)
    return [r["feature"] for r in best.select("feature").collect()]


def fit_weights(
    rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], size: int, l2: float, fairness: float, steps: int = 400
) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise log loss + l2/2 |w|^2 + fairness/2 * mean squared score change over the pairs.

    Full-batch gradient steps with momentum and per-weight scaling, always from zero.
    """
    at = np.concatenate([np.empty(0, np.int64), *rows]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    sides = [np.concatenate([np.empty(0, np.int64), *[p[s] for p in pairs]]).astype(np.int64) for s in (0, 1)]
    where = [np.repeat(np.arange(len(pairs)), [len(p[s]) for p in pairs]) for s in (0, 1)]
    w, bias = np.zeros(size), float(np.log(labels.mean() / (1 - labels.mean())))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        z = bias + np.bincount(row, w[at], len(rows))
        off = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) / len(rows)
        gradient = np.bincount(at, off[row], size) + l2 * w
        if pairs:
            change = (np.bincount(where[0], w[sides[0]], len(pairs)) - np.bincount(where[1], w[sides[1]], len(pairs))) / len(pairs)
            gradient += fairness * (np.bincount(sides[0], change[where[0]], size) - np.bincount(sides[1], change[where[1]], size))
        g = np.append(gradient, off.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8) * min(1.0, 2 * (1 - t / (steps + 1)))
        w, bias = w - step[:-1], bias - step[-1]
    return float(bias), w


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = 20_000,
    features: int = 2048,
    least_gain: float = 11.0,
    l2: float = 1e-4,
    fairness: float = 1.0,
    identity: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    seed: int = 7,
) -> ToxicityModel:
    """Learn from a bounded sample of labelled documents outside the held-out fold.

    ``max_rows`` bounds the labelled rows and ``features`` the weights; both
    bound what the driver holds (per row the chosen features it has). Labels
    other than 0 and 1 and rows without an id are left out; repeated labels
    count as often as they occur. Without labels of both kinds the model is the
    share of label 1 (0 if there are no labels).
    """
    known = training_labels(labels, id_col, label_col, max_rows, seed)
    texts = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "label_id")
    texts = materialize(texts.select("label_id", "label", "text"), "toxicity-texts")
    counts = texts.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not counts[0] or counts[1] in (0, counts[0]):
        return ToxicityModel(500.0 if counts[0] and counts[1] else -500.0)
    chosen = choose_features(texts.select("label", "text"), features, least_gain)
    place = {f: i for i, f in enumerate(chosen)}

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features()

        def chosen_of(words: set[str] | None) -> list[int] | None:
            return None if words is None else [place[h] for h in of.of_words(words).tolist() if h in place]

        for batch in sliced(batches):
            words = [words_of(t) for t in batch.column(2).to_pylist()]
            arrays = [[chosen_of(w) for w in words], [chosen_of(swapped(w, identity)) for w in words]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), *[pa.array(a, pa.list_(pa.int32())) for a in arrays]], names=["id", "label", "own", "other"]
            )

    seen = texts.mapInArrow(reduced, "id long, label int, own array<int>, other array<int>").collect()
    seen = sorted(seen, key=lambda r: (r["id"], r["label"], r["own"]))
    rows = [np.array(r["own"], np.int64) for r in seen]
    pairs = [(np.array(r["own"], np.int64), np.array(r["other"], np.int64)) for r in seen if r["other"] is not None]
    bias, weights = fit_weights(rows, np.array([r["label"] for r in seen], float), pairs, len(chosen), l2, fairness)
    return ToxicityModel(bias, dict(zip(chosen, weights.tolist(), strict=True)))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; input columns of these names are replaced.

    Only the text is scored; null and empty texts get the score of no words.
    A row without an id is not held out, as no label can belong to it.
    """
    docs = docs.select(*without(docs, ["held_out", "score", "predicted"]))

    @F.arrow_udf("double")
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = model.scorer()
        for texts in parts:
            yield pa.array([of(t) for some in sliced([texts]) for t in some.to_pylist()], pa.float64())

    fold = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
    return (
        docs.withColumn("held_out", fold)
        .withColumn("score", scored(F.col(text_col)))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
