"""Pair similarity against brute force, with hot partners, blocks and different partition counts."""

import random
from collections import defaultdict
from math import sqrt

import pytest
from pyspark.sql import functions as F

from lodestar.operators import pairs, prediction


def brute(rows, min_common):
    by_entity = defaultdict(dict)
    for e, v, x in rows:
        by_entity[e][v] = x
    out = {}
    names = sorted(by_entity)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            common = by_entity[a].keys() & by_entity[b].keys()
            if len(common) >= min_common:
                xs = [(by_entity[a][v], by_entity[b][v]) for v in common]
                out[a, b] = (len(common), sum(p * q for p, q in xs), sum(p * p for p, _ in xs), sum(q * q for _, q in xs))
    return out


def ratings(seed=7, entities=60, partners=40, hot=(0, 1, 2)):
    """Partners in ``hot`` are shared by every entity: they hold a third of all rows and more."""
    rng = random.Random(seed)
    rows = []
    for e in range(entities):
        chosen = set(hot) | set(rng.sample(range(partners), rng.randint(1, 6)))
        rows += [(e, v, rng.randint(-30, 90)) for v in sorted(chosen)]
    return rows


@pytest.mark.parametrize("min_common", [1, 2, 3, 5])
@pytest.mark.parametrize("block,small", [(4, 0), (16, 0), (1000, 0), (1000, 10 ** 6)])
def test_shared_sums(spark, min_common, block, small):
    rows = ratings()
    df = spark.createDataFrame(rows, "e long, v long, x long")
    got = {(r.a, r.b): (r.common, r.dot, r.sq_a, r.sq_b)
           for r in pairs.shared_sums(df, "e", "v", "x", min_common, block=block, broadcast_rows=small).collect()}
    assert got == brute(rows, min_common)


def test_partition_count_does_not_matter(spark):
    df = spark.createDataFrame(ratings(3), "e long, v long, x long")
    results = []
    for n in ("2", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        sums = pairs.shared_sums(df, "e", "v", "x", 3, block=8, broadcast_rows=0)
        results.append(sorted(sums.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_support_edge_and_band(spark):
    rows = [(1, u, u + 1) for u in range(11)] + [(2, u, u + 1) for u in range(11)] + [(3, u, 12 - u) for u in range(10)]
    df = spark.createDataFrame(rows, "item_id long, user_id long, x long")
    sims = pairs.support_cosine(df, "item_id", "user_id", "x", 11)
    got = {(r.a, r.b): r.sim for r in sims.collect()}
    assert list(got) == [(1, 2)] and abs(got[1, 2] - 1.0) < 1e-12  # 10 shared users are not enough
    assert pairs.in_band(sims).count() == 0  # identical ratings fall out of the band


def test_similarity_is_bounded_and_symmetric(spark):
    df = spark.createDataFrame(ratings(5), "e long, v long, x long")
    both = {(r.a, r.b): r.sim for r in pairs.mirror(pairs.support_cosine(df, "e", "v", "x", 2)).collect()}
    assert both and all(abs(s) <= 1 + 1e-12 and both[b, a] == s for (a, b), s in both.items())


def test_adaptive_support(spark):
    rows = [(1, b, c, 0.5) for b, c in ((2, 9), (3, 6), (4, 3), (5, 3))]
    df = spark.createDataFrame(rows, "a long, b long, common long, sim double")
    got = {r.a: r.support for r in prediction.adaptive_support(df, 5, 3).collect()}
    assert got[1] == 2  # the third largest common count is 3
    assert got[2] == 0  # fewer candidates than k: all are used


@pytest.mark.parametrize("small", [0, 10 ** 6])
def test_item_prediction(spark, small):
    similar = spark.createDataFrame([(1, 9, 0.8), (2, 9, 0.6)], "a long, b long, sim double")
    centered = spark.createDataFrame([(5, 1, 10), (5, 2, -10)], "user_id long, item_id long, c long")
    items = spark.createDataFrame([(9, 7.0)], "item_id long, mean_rating double")
    users = spark.createDataFrame([(5, 6.0)], "user_id long, mean_rating double")
    row = prediction.item_predictions(similar, centered, items, users, broadcast_rows=small).first()
    assert row.item_id == 9 and round(row.estimate, 4) == 7.1429


def test_estimates_are_capped_and_counted(spark):
    chosen = spark.createDataFrame([(1, 2, 1.0), (1, 3, 1.0)], "a long, b long, sim double")
    centered = spark.createDataFrame([(2, 7, 500), (3, 7, 500), (2, 8, 100)], "user_id long, item_id long, c long")
    users = spark.createDataFrame([(1, 8.0)], "user_id long, mean_rating double")
    got = {r.item_id: r.estimate for r in prediction.weighted_predictions(chosen, centered, users, 2).collect()}
    assert got == {7: 10.0}  # item 8 has one vote only
    rounded = prediction.neighbour_predictions(chosen, centered, users, 1).collect()
    assert {r.item_id: r.estimate for r in rounded} == {7: 13.0, 8: 9.0}


@pytest.mark.parametrize("small", [0, 10 ** 6])
def test_best_similarity_takes_the_most_similar(spark, small):
    similar = spark.createDataFrame([(1, 9, 0.9), (2, 9, 0.8), (1, 2, 0.9)], "a long, b long, sim double")
    centered = spark.createDataFrame([(5, 1, 20), (5, 2, -10)], "user_id long, item_id long, c long")
    items = spark.createDataFrame([(9, 5.0), (2, 9.5)], "item_id long, mean_rating double")
    users = spark.createDataFrame([(5, 6.0)], "user_id long, mean_rating double")
    got = prediction.best_similarity_predictions(similar, centered, items, users, centered, broadcast_rows=small).collect()
    assert [(r.item_id, r.estimate) for r in got] == [(9, 6.8)]  # item 2 is rated already


def test_similarity_band_starts_where_the_store_does(monkeypatch, spark):
    """Pairs from .75 on are in the band; before, those under .8 were left out."""
    from lodestar.plans import recommend_queries

    sims = spark.createDataFrame([(1, 2, 0.7499), (1, 3, 0.75), (2, 3, 0.79), (3, 4, 0.999), (4, 5, 0.9991)], "a long, b long, sim double")
    monkeypatch.setattr(recommend_queries, "item_pairs", lambda x: sims)
    assert sorted(map(tuple, recommend_queries.similarity_band(None).collect())) == [(1, 3, 0.75), (2, 3, 0.79), (3, 4, 0.999)]
