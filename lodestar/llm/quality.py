"""Quality by logistic regression on hashed word n-grams, trained with follow-the-regularised-leader."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .tables import id_and_text

# Most labelled rows used for fitting, chosen by a hash of their id.
MOST_ROWS = 12_000
# Small training sets are passed over more often, up to about so many updates.
STEPS = 40_000
BITS = 20
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_SAME = np.uint32(0x5BD1E995)
REMEMBERED = 100_000


class Hasher:
    """Positions of a text's word n-grams (one and two words) in a table of ``2**bits`` weights."""

    def __init__(self, bits: int = BITS):
        self.mask = np.uint32((1 << bits) - 1)
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        """One entry per occurrence; words repeated at once share one pair, whatever the word."""
        tokens = _TOKEN.findall(text)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        try:
            codes = [known[t] for t in tokens]
        except KeyError:
            for t in tokens:
                if t not in known:
                    known[t] = zlib.crc32(t.encode("utf-8", "surrogatepass"))
            codes = [known[t] for t in tokens]
        single = np.array(codes, np.uint32)
        left, right = single[:-1], single[1:]
        pair = np.where(left == right, _SAME, left * np.uint32(0x9E3779B1) ^ (right * np.uint32(0x85EBCA77) + np.uint32(1)))
        both = np.concatenate([single, pair])
        both ^= both >> np.uint32(15)
        both *= np.uint32(0x2C1B3C6D)
        return (both ^ (both >> np.uint32(16))) & self.mask


class Ftrl:
    """Follow-the-regularised-leader with per-coordinate rates; L1 keeps the weights sparse."""

    def __init__(self, width: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(width + 1), np.zeros(width + 1)  # the last entry is the bias

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = np.sign(z) * np.maximum(0, np.abs(z) - self.l1)
        return -pull / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        slope = (sigmoid(weights @ values) - label) * values
        grown = self.n[at] + slope * slope
        self.z[at] += slope - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.alpha * weights
        self.n[at] = grown


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def weigh(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and their values: the square root of each count, scaled to unit length."""
    at, counts = np.unique(places, return_counts=True)
    return at, np.sqrt(counts / max(1, counts.sum()))


def fit(rows: Iterable[tuple[np.ndarray, int]], bits: int = BITS, steps: int = STEPS, seed: int = 11) -> np.ndarray:
    """Weights, the bias last, from ``(places, label)`` rows, passed over in shuffled orders."""
    model, order = Ftrl(1 << bits), np.random.default_rng(seed)
    made = []
    for places, label in rows:  # small types: the sample is held whole
        at, values = weigh(places)
        made.append((np.append(at, 1 << bits).astype("i4"), np.append(values, 1.0).astype("f4"), label))
    for _ in range(max(4, min(40, steps // max(1, len(made))))):
        for i in order.permutation(len(made)):
            model.learn(*made[i])
    return model.weights(slice(None))


def is_held_out(folds: int, held_out: int):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == held_out, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, most: int = MOST_ROWS) -> DataFrame:
    """``doc_id, quality, places`` of a bounded sample of the labelled rows that are not held out, written once.

    Rows without label or text take no part; of contradicting labels the lower one counts.
    """
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(folds, held_out))
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marks = marks.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(most)
    texts = id_and_text(docs).where("text <> ''").join(F.broadcast(marks), "doc_id").select("doc_id", "quality", "text")

    def work(batches):
        hashed = Hasher()
        for batch in batches:
            made = [np.sort(hashed(text)).astype("<i4").tobytes() for text in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0).cast(pa.string()), batch.column(1), pa.array(made, pa.binary())], ["doc_id", "quality", "places"])

    return materialise(texts.mapInArrow(work, "doc_id string, quality int, places binary"), "quality-sample")


def trained(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, most: int = MOST_ROWS) -> np.ndarray:
    """Weights fitted by one task, which reads the sample in the order of its ids; only weights other than 0 reach the driver."""
    sample = training_sample(docs, labels, folds, held_out, most).repartition(1).sortWithinPartitions("doc_id", "quality", "places")

    def work(batches):
        weights = fit((np.frombuffer(p, "<i4"), label) for b in batches for label, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        kept = np.flatnonzero(weights)
        yield pa.record_batch([pa.array(kept, pa.int32()), pa.array(weights[kept], pa.float64())], ["at", "weight"])

    found = sample.select("quality", "places").mapInArrow(work, "at int, weight double").toArrow()
    weights = np.zeros((1 << BITS) + 1)
    weights[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text: one sparse dot product each.

    The score depends on the text alone. A missing or empty text has the score of the bias.
    Repeated rows give repeated rows, an empty table none; extra columns are ignored.
    """
    kept = np.flatnonzero(weights)
    sparse = (len(weights), kept.astype("i4"), weights[kept].astype("f4"))

    def work(batches):
        hashed, table = Hasher(), np.zeros(sparse[0])
        table[sparse[1]] = sparse[2]
        for batch in batches:
            scores = []
            for text in batch.column(1).to_pylist():
                at, values = weigh(hashed(text))
                scores.append(float(sigmoid(table[at] @ values + table[-1])))
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = id_and_text(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """Fit on the training part of the labelled rows, score all: ``doc_id, held_out, score, predicted``."""
    weights = trained(docs, labels, folds, held_out)
    return score(docs, weights, threshold).select("doc_id", is_held_out(folds, held_out).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``.

    A missing text scores as an empty one. No join: rows pass through the scoring task.
    """
    weights, column = trained(docs, labels, folds, held_out), docs.columns.index("text")
    kept = np.flatnonzero(weights)
    sparse = (len(weights), kept.astype("i4"), weights[kept].astype("f4"))

    def work(batches):
        hashed, table = Hasher(), np.zeros(sparse[0])
        table[sparse[1]] = sparse[2]
        for batch in batches:
            good = []
            for text in batch.column(column).to_pylist():
                at, values = weigh(hashed(text or ""))
                good.append(bool(sigmoid(table[at] @ values + table[-1]) >= threshold))
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
