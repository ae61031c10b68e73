"""Toxicity by non-negative positive-unlabelled learning on words and word beginnings."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .tables import id_and_text

# Most labelled rows used for fitting, of each kind, chosen by a hash of their id.
MOST_POSITIVE, MOST_UNLABELLED = 4_000, 16_000
# A feature must occur in so many confirmed examples, and be more frequent there than in the
# unlabelled text by so many standard deviations of the difference of two shares.
LEAST_EXAMPLES, LEAST_DEVIATIONS = 2, 3.5
BEGINNINGS = (4, 5, 6)
_WORD = re.compile(r"\w+")
REMEMBERED = 100_000


def word_features(word: str) -> list[str]:
    """A word and its beginnings: inflected forms share the latter."""
    return [word, *("^" + word[:n] for n in BEGINNINGS if len(word) >= n)]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(text: str) -> set[str]:
    return {f for word in words_of(text) for f in word_features(word)}


class Rows:
    """Binary feature rows in compressed form."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.size, self.width = len(rows), width
        self.columns = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.columns], self.size)

    def back(self, slopes: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, slopes[self.row], self.width)


def fit_nnpu(positive: Rows, unlabelled: Rows, prior: float, rounds: int = 250, rate: float = 0.3,
             l1: float = 2e-5, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss.

    The risk of the positive class is ``prior * E_p[loss(+)]``. That of the negative class is
    ``E_u[loss(-)] - prior * E_p[loss(-)]``, which cannot be negative in truth: where an overfit
    model makes it so, the step goes up that term alone instead of down the sum.
    """
    width = positive.width
    weights, bias = np.zeros(width), -2.0
    squares, bias_squares = np.full(width, 1e-8), 1e-8
    for _ in range(rounds):
        fp, fu = positive.dot(weights) + bias, unlabelled.dot(weights) + bias
        sp, su = (1 / (1 + np.exp(-np.clip(f, -500, 500))) for f in (fp, fu))
        negative_risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        # Slopes of the losses: loss(+) has s - 1, loss(-) has s.
        from_u, from_p = su / max(1, unlabelled.size), -prior * sp / max(1, positive.size)
        if negative_risk >= 0:
            from_p = from_p + prior * (sp - 1) / max(1, positive.size)
        else:
            from_u, from_p = -from_u, -from_p
        slope = positive.back(from_p) + unlabelled.back(from_u) + l2 * weights
        bias_slope = from_p.sum() + from_u.sum()
        squares += slope * slope
        bias_squares += bias_slope * bias_slope
        step = rate / np.sqrt(squares)
        weights -= step * slope
        weights = np.sign(weights) * np.maximum(0, np.abs(weights) - step * l1)
        bias -= rate * bias_slope / np.sqrt(bias_squares)
    return weights, bias


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], names: list[str], prior: float) -> tuple[dict[str, float], float]:
    """Nonzero weights by feature, and the bias, from rows of places in ``names``.

    Without an example everything is clean.
    """
    if not positive:
        return {}, -5.0
    weights, bias = fit_nnpu(Rows(positive, len(names)), Rows(unlabelled, len(names)), prior)
    return {f: float(w) for f, w in zip(names, weights) if w}, float(bias)


def training_rows(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2):
    """``(positive, unlabelled, names, prior)``: bounded samples of labelled rows as places in a feature list.

    Only features that stand out in the confirmed examples are kept; those are counted by Spark,
    and the driver receives the kept ones of each sampled row alone.

    Rows held out, and rows without label or text, take no part. The unlabelled set is drawn
    from all training rows with their labels hidden; the class prior is the share of toxic
    rows among all of them. A document with contradicting labels counts as toxic.
    """
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(folds, held_out))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    by_hash = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    chosen = (marks.where("toxic = 1").orderBy(*by_hash).limit(MOST_POSITIVE).withColumn("kind", F.lit("p"))
              .unionByName(marks.orderBy(*by_hash).limit(MOST_UNLABELLED).withColumn("kind", F.lit("u"))))
    once = chosen.groupBy("doc_id").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
    texts = id_and_text(docs).where("text <> ''").join(F.broadcast(once), "doc_id").select("kinds", "text")
    sample = materialise(texts, "toxic-sample")

    def tally(batches):
        for batch in batches:
            own, other = Counter(), Counter()
            for kinds, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                features = features_of(text)
                if "p" in kinds:
                    own.update(features)
                if "u" in kinds:
                    other.update(features)
            names = list(own.keys() | other.keys())
            yield pa.record_batch([pa.array(names, pa.string()), *(pa.array([n[f] for f in names], pa.int64()) for n in (own, other))],
                                  ["feature", "own", "other"])

    sizes = sample.select(F.array_contains("kinds", "p").alias("p"), F.array_contains("kinds", "u").alias("u")).agg(
        F.count_if("p"), F.count_if("u")).first()
    of, others = (F.lit(float(max(1, n))) for n in sizes)
    share = (F.col("own") + F.col("other")) / (of + others)
    spread = F.sqrt(share * (1 - share) * (1 / of + 1 / others))
    counts = sample.mapInArrow(tally, "feature string, own bigint, other bigint").groupBy("feature").agg(
        F.sum("own").alias("own"), F.sum("other").alias("other"))
    standing = counts.where((F.col("own") >= LEAST_EXAMPLES) & (F.col("own") / of - F.col("other") / others >= LEAST_DEVIATIONS * spread))
    names = sorted(r[0] for r in standing.select("feature").collect())

    def reduce(batches):
        place = {f: i for i, f in enumerate(names)}
        for batch in batches:
            made = [np.array(sorted(place[f] for f in features_of(text) if f in place), "<i4").tobytes() for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(made, pa.binary())], ["kinds", "places"])

    rows = sample.mapInArrow(reduce, "kinds array<string>, places binary").collect()
    rows = [(r.kinds, np.frombuffer(r.places, "<i4")) for r in rows]
    return [p for kinds, p in rows if "p" in kinds], [p for kinds, p in rows if "u" in kinds], names, prior


def is_held_out(folds: int, held_out: int):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == held_out, F.lit(False))


def score(docs: DataFrame, weights: dict[str, float], bias: float, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text.

    The score depends on the text alone: the bias and the weights of its features, each once.
    A missing or empty text has the score of the bias. Repeated rows give repeated rows, an
    empty table none; extra columns are ignored.
    """

    def work(batches):
        known: dict[str, tuple] = {}
        for batch in batches:
            scores = [probability(text, weights, bias, known) for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = id_and_text(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """Fit on the training part of the labelled rows, score all documents.

    Returns ``doc_id, held_out, score, predicted``.
    """
    weights, bias = fit(*training_rows(docs, labels, folds, held_out))
    return score(docs, weights, bias, threshold).select("doc_id", is_held_out(folds, held_out).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``threshold``.

    A missing text scores as an empty one. No join: rows pass through the scoring task.
    """
    weights, bias = fit(*training_rows(docs, labels, folds, held_out))
    column = docs.columns.index("text")

    def work(batches):
        known: dict[str, tuple] = {}
        for batch in batches:
            clean = [probability(text or "", weights, bias, known) < threshold for text in batch.column(column).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def probability(text: str, weights: dict[str, float], bias: float, known: dict[str, tuple]) -> float:
    """The score of one text; ``known`` remembers the weighted features of words."""
    if len(known) > REMEMBERED:
        known.clear()
    found = set()
    for word in words_of(text):
        own = known.get(word)
        if own is None:
            own = known[word] = tuple(f for f in word_features(word) if f in weights)
        if own:
            found.update(own)
    total = bias + sum(weights[f] for f in sorted(found))
    return float(1 / (1 + np.exp(-max(-500.0, min(500.0, total)))))
