"""Keyed state: keys once over long streams, times to live, totals in place, timers."""

import time
from decimal import Decimal

from pyspark.sql import functions as F

from lodestar.operators import ratings as R
from lodestar.streaming import jobs, keyed

DAY = 86_400


def add(spark, rows, schema, source):
    frame = spark.createDataFrame(rows, schema)
    if "s" in frame.columns:
        frame = frame.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    frame.coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(frame.schema).parquet(source)


def test_every_key_once_over_800_days_and_restarts(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for start in (800, 0, 400):  # old rows come late, too
        rows = [(d * DAY, d % 5 or None, "x" * (d % 3)) for d in range(start, start + 12)] * 2
        stream = add(spark, rows, "s long, user long, place string", source)
        keyed.write_first_of_keys(stream, "ts", ["user", "place"], target, checkpoint).awaitTermination()
    got = spark.read.parquet(target).select("user", "place", F.unix_seconds("ts").alias("s")).collect()
    first = {}
    for start in (800, 0, 400):
        batch = {}
        for d in range(start, start + 12):
            batch.setdefault((d % 5 or None, "x" * (d % 3)), d * DAY)
        first = batch | first  # a key stays with the batch that brought it
    assert sorted(map(repr, got)) == sorted(repr(r) for r in [type(got[0])(user=u, place=p, s=s) for (u, p), s in first.items()])


def test_a_key_comes_again_after_its_time_to_live(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for wait in (0, 3):
        time.sleep(wait)
        stream = add(spark, [(1, 7), (2, 7)], "s long, user long", source)
        keyed.write_first_of_keys(stream, "ts", ["user"], target, checkpoint, live_ms=2000).awaitTermination()
    assert [r.user for r in spark.read.parquet(target).collect()] == [7, 7]


def test_totals_over_batches_equal_bands_of_the_whole(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = [(i % 4, i * 7 % 100) for i in range(60)] + [(9, 55)]
    for part in (rows[:25], rows[25:26], rows[26:]):
        stream = add(spark, part, "item_id long, rating_x10 int", source)
        keyed.write_running_totals(stream.withColumn("r", F.col("rating_x10") / 10.0), "item_id", "r", target, checkpoint).awaitTermination()
    got = keyed.bands_of_totals(jobs.latest_stats(spark, target, "item_id"), "item_id")
    whole = R.item_bands(spark.createDataFrame(rows, "item_id long, rating_x10 int"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, whole.select(got.columns).collect()), key=repr)


def test_timers_tell_settled_keys_and_late_rows_wake_them(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run(rows):
        stream = add(spark, rows, "s long, item long, value double", source)
        keyed.write_running_totals(stream, "item", "value", target, checkpoint, unit=1, time="ts", quiet_ms=10 * DAY * 1000, delay="100 days").awaitTermination()
        return {r.item: (r.n, r.total_units, r.total_sq_units, r.settled) for r in jobs.latest_stats(spark, target, "item").collect()}

    assert run([(DAY, 1, 2.0), (5 * DAY, 1, 3.0), (200 * DAY, 2, 4.0)]) == {1: (2, 5, Decimal(13), True), 2: (1, 4, Decimal(16), False)}
    assert run([(190 * DAY, 1, 1.0), (201 * DAY, 3, None)]) == {1: (3, 6, Decimal(14), False), 2: (1, 4, Decimal(16), False), 3: (0, 0, Decimal(0), False)}
