"""Users times catalog: the product meets ratings where it is made."""

from collections import Counter

from pyspark.sql import functions as F

from lodestar.operators import ratings


def test_unrated_items_without_a_shuffle_of_the_product(spark):
    users = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "user_id long")
    catalog = spark.createDataFrame([(i,) for i in [*range(20), 4, None]], "item_id long")
    rated = spark.createDataFrame([(1, i, 50) for i in range(0, 20, 2)] + [(2, 4, 10), (2, None, 10), (None, 3, 10), (9, 1, 10), (3, 77, 5)],
                                  "user_id long, item_id long, rating_x10 int")
    out = ratings.fill_unrated(users, catalog, rated, block=6)
    held = {(1, i) for i in range(0, 20, 2)} | {(2, 4)}
    every = [(u, i) for u in (1, 2, 2, 3, None) for i in [*range(20), 4, None]]
    assert Counter(map(tuple, ratings.every_item(users, catalog, block=6).collect())) == Counter(every)
    assert Counter(map(tuple, out.collect())) == Counter((*p, 0) for p in every if p not in held)
    # Before, users times items were shuffled to an anti-join on both.
    assert "LeftAnti" not in out._jdf.queryExecution().executedPlan().toString()
    assert ratings.fill_unrated(users, catalog.limit(0), rated).count() == 0 == ratings.fill_unrated(users.limit(0), catalog, rated).count()


def test_tasks_follow_the_product(spark, monkeypatch):
    monkeypatch.setattr(ratings, "_PRODUCT_ROWS", 50)
    users, catalog = spark.range(60).toDF("user_id"), spark.range(30).toDF("item_id")
    rated = users.withColumn("item_id", F.col("user_id") % 30)
    for made in (ratings.every_item(users, catalog, block=3), ratings.fill_unrated(users, catalog, rated, block=3)):
        assert made.rdd.getNumPartitions() == 36
