"""A user's function that fails on some rows; distinct counts from merged sketches."""

import pytest
from pyspark.sql import functions as F

from lodestar.operators import pivots, plugin, sketches


def test_only_rows_at_fault_are_rejected(spark):
    rows = [(i, None if i % 10 == 0 else "bad" if i % 17 == 3 else f"text {i}") for i in range(200)]
    frame = spark.createDataFrame(rows, "id long, text string").repartition(3)

    def make():
        def embed(texts):
            if "bad" in texts:
                raise RuntimeError("no vector")
            return [[float(len(t)), 1.0] for t in texts]
        return embed

    mapped = plugin.map_batches(frame, "text", "vec", "array<double>", make, batch=32, tries=2)
    got = {r.id: (r.vec, r["_error"]) for r in mapped.collect()}
    assert got == {i: (None, None) if t is None else (None, "RuntimeError: no vector") if t == "bad" else ([float(len(t)), 1.0], None) for i, t in rows}
    assert plugin.rejected(mapped).count() == sum(t == "bad" for _, t in rows)
    assert plugin.accepted(mapped).count() == 200 - plugin.rejected(mapped).count()


def test_a_batch_that_fails_once_is_tried_again(spark):
    def make():
        calls = []

        def flaky(values):
            calls.append(1)
            if len(calls) == 1:
                raise OSError("busy")
            return values[:-1] if len(calls) == 2 else [v + 1 for v in values]
        return flaky

    mapped = plugin.map_batches(spark.range(5).coalesce(1), "id", "next", "long", make, tries=3)
    assert [(r.next, r["_error"]) for r in mapped.sort("id").collect()] == [(i + 1, None) for i in range(5)]


def test_odd_inputs(spark):
    frame = spark.createDataFrame([], "id long, text string")
    assert plugin.map_batches(frame, "text", "n", "long", lambda: lambda v: [len(x) for x in v]).collect() == []
    with pytest.raises(ValueError):
        plugin.map_batches(frame, "text", "id", "long", lambda: list)


def test_near_objects_from_text(spark):
    frame = spark.createDataFrame([(1, "aaab"), (2, "aab"), (3, "zzz"), (4, "zzzz")], "id long, text string")
    embed = lambda: lambda texts: [[float(t.count("a")), float(t.count("b")), float(t.count("z"))] for t in texts]
    vectors = plugin.accepted(plugin.map_batches(frame, "text", "vec", "array<double>", embed)).select("id", "vec")
    near = pivots.Search(vectors, vectors, 2).nearest(1)
    assert {(r.id, r.other) for r in near.collect()} == {(1, 2), (2, 1), (3, 4), (4, 3)}


def test_merged_parts_are_within_the_stated_error(spark):
    frame = spark.range(120_000).select((F.col("id") % 40_000).alias("v"), (F.col("id") % 7).alias("day"), (F.col("id") % 40_000 % 2).alias("cohort"))
    for size, error in ((10, sketches.standard_error(10)), (16, 0.0)):
        days = sketches.part_sketches(frame, ["day", "cohort"], "v", size)
        got = sketches.coverage(days, ["cohort"], spark.range(10_000).withColumnRenamed("id", "v"), "v", size).collect()
        assert len(got) == 2
        for r in got:
            assert abs(r.seen - 20_000) <= 4 * error * 20_000
            assert abs(r.covered - 5_000) <= 4 * error * 25_000


def test_sketches_of_nothing(spark):
    frame = spark.createDataFrame([("a", None), (None, 1), (None, 1)], "part string, v long")
    got = sketches.coverage(sketches.part_sketches(frame, ["part"], "v"), ["part"], frame.where("false"), "v")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("a", 0, 0, None), (None, 1, 0, None)], key=repr)
