"""The recommendations use the reference's support, neighbours and target."""

from pyspark.sql import functions as F

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.01"
QUERIES = entry.queries()


def test_all_of_the_reference_neighbours_take_part(spark):
    chosen = QUERIES["topk_users"](spark, FOLDER)
    assert chosen.agg(F.max("rank")).first()[0] == 250
    assert chosen.agg(F.min("common")).first()[0] == 8


def test_profiles_grow_to_the_reference_target(spark):
    sizes = QUERIES["synthetic_ratings"](spark, FOLDER).groupBy("user_id").count()
    assert sizes.agg(F.max("count")).first()[0] >= 50
