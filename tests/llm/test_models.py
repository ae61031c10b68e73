
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import quality, toxicity

FOLDER = "/root/testdata/sf0.01"


def area(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(len(scores))
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(labels) - ones))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_quality_on_held_out_rows(spark, tables):
    rows = quality.score_quality(*tables).join(tables[1], "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    scores, labels = np.array([r.score for r in held]), np.array([r.quality for r in held])
    assert area(scores, labels) > 0.97
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.97


def test_toxicity_on_held_out_rows(spark, tables):
    rows = toxicity.score_toxicity(*tables).join(tables[1], "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted for r in held if r.toxic == 1]) > 0.5  # some 40 examples to learn from here
    assert np.mean([r.predicted for r in held if r.toxic == 0]) < 0.02


def test_labels_outside_training_do_not_matter(spark, tables):
    docs, labels = tables
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    changed = labels.withColumn("toxic", F.when(code % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    changed = changed.withColumn("quality", F.when(code % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    for fit, rows in ((toxicity.fit, toxicity.training_rows), ):
        assert fit(*rows(docs, labels)) == fit(*rows(docs, changed))
    assert np.array_equal(quality.trained(docs, labels), quality.trained(docs, changed))


@pytest.mark.parametrize("score, keep", [(quality.score_quality, quality.keep_good), (toxicity.score_toxicity, toxicity.keep_clean)])
def test_odd_documents(spark, odd, nothing, tables, score, keep):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, 1, 0), (7, 0, 1), (8, 0, 1), (9, None, None), (None, 1, 1), (2, 0, 1), (99, 1, 0)],
                                   "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("clash"))
    rows = score(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1  # missing and empty texts score alike
    kept = keep(odd, labels)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert score(nothing, labels).count() == keep(nothing, labels).count() == 0
    assert score(odd, labels.limit(0)).count() == odd.count()


def test_keep_agrees_with_score(tables):
    docs, labels = tables
    good = {r.doc_id for r in quality.score_quality(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in quality.keep_good(docs, labels).select("doc_id").collect()} == good
    bad = {r.doc_id for r in toxicity.score_toxicity(docs, labels).where("predicted = 1").collect()}
    clean = {r.doc_id for r in toxicity.keep_clean(docs, labels).select("doc_id").collect()}
    assert not bad & clean and len(bad) + len(clean) == docs.count()


def test_risk_stays_non_negative_on_separable_data():
    draw = np.random.default_rng(0)
    hit = [np.array([0, *draw.choice(np.arange(2, 40), 3, False)]) for _ in range(600)]
    miss = [np.array([1, *draw.choice(np.arange(2, 40), 3, False)]) for _ in range(2400)]
    positive, unlabelled = toxicity.Rows(hit[:300], 40), toxicity.Rows(hit[300:] + miss, 40)
    weights, bias = toxicity.fit_nnpu(positive, unlabelled, prior=300 / 2700)
    chance = 1 / (1 + np.exp(-(unlabelled.dot(weights) + bias)))
    assert chance[:300].min() > chance[300:].max() and np.median(chance[:300]) > 0.5 and np.median(chance[300:]) < 0.1


def test_ftrl_learns_a_sparse_separator():
    draw = np.random.default_rng(1)
    rows = [(np.array([i % 2, *draw.integers(10, 1 << 12, 6)], np.int32), i % 2) for i in range(400)]
    weights = quality.fit(rows, bits=12)
    assert weights[1] > 0 > weights[0]


def test_ftrl_agrees_with_a_plain_update():
    draw = np.random.default_rng(4)
    rows = [(draw.integers(0, 30, 8).astype(np.int32), int(draw.integers(2))) for _ in range(40)]
    model = quality.Ftrl(30)
    z, n = [0.0] * 31, [0.0] * 31

    def weight(i):
        if abs(z[i]) <= model.l1:
            return 0.0
        return -(z[i] - math.copysign(model.l1, z[i])) / ((model.beta + math.sqrt(n[i])) / model.alpha + model.l2)

    for places, label in rows:
        at, values = quality.weigh(places)
        model.learn(np.append(at, 30), np.append(values, 1.0), label)
        x = {30: 1.0} | {int(p): math.sqrt(np.count_nonzero(places == p) / len(places)) for p in places}
        slope = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in x.items()))) - label
        for i, v in {i: (v, weight(i)) for i, v in x.items()}.items():
            g = slope * v[0]
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / model.alpha * v[1]
            n[i] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)
    assert np.allclose(model.weights(slice(None)), [weight(i) for i in range(31)])
