"""Incremental jobs: what was seen is not read or counted again."""

from pyspark.sql import functions as F

from lodestar.streaming import jobs


def item(i, n):
    return f'<item id="{i}"><statistics><ratings><usersrated value="{n}"/></ratings></statistics></item>'


def test_only_new_files_are_ingested(spark, tmp_path):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    (source / "a.xml").write_text(f"<items>{item(1, 5)}{item(2, 6)}</items>")
    jobs.ingest_xml(spark, str(source), target, checkpoint).awaitTermination()
    (source / "b.xml").write_text(f"<items>{item(3, 7)}</items>")
    jobs.ingest_xml(spark, str(source), target, checkpoint).awaitTermination()
    assert sorted((r.item_id, r.num_ratings) for r in spark.read.parquet(target).collect()) == [(1, 5), (2, 6), (3, 7)]


def test_running_statistics_over_restarts(spark, tmp_path):
    source, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "item long, value double"
    for part in ([(1, 2.0), (2, 3.0)], [(1, 4.0)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.item_stats(stream, "item", "value", target, checkpoint).awaitTermination()
    got = {r.item: (r.n, r.total, r.total_sq) for r in jobs.latest_stats(spark, target, "item").collect()}
    assert got == {1: (2, 6.0, 20.0), 2: (1, 3.0, 9.0)}


def test_merged_folders_replace_older_batches(spark, tmp_path):
    source, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "item long, value double"
    for part in range(5):
        spark.createDataFrame([(part % 2, 0.1), (9, 0.2)], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.item_stats(stream, "item", "value", target, checkpoint, merge_every=2).awaitTermination()
    assert len(list((tmp_path / "out").glob("merged=*"))) == 2
    got = {r.item: (r.n, r.total) for r in jobs.latest_stats(spark, target, "item").collect()}
    assert got == {0: (3, 0.3), 1: (2, 0.2), 9: (5, 1.0)}


def test_replays_are_dropped(spark, tmp_path):
    source, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    rows = spark.range(6).select(
        F.timestamp_seconds(F.col("id")).alias("ts"), (F.col("id") % 2).alias("user_id"), F.lit(1).alias("item_id"))
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    jobs.write_append(jobs.dedup(stream, "ts", ["user_id", "item_id"], "1 hour"), target, checkpoint).awaitTermination()
    assert spark.read.parquet(target).count() == 2


def test_keys_come_once_over_800_days_and_restarts(spark, tmp_path):
    source, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    day, schema = 86_400, "ts timestamp, user_id long, item_id long"
    for start in (800, 0, 400):  # old rows come late, too
        rows = [(d, d % 5, d % 3) for d in range(start, start + 12)] * 2
        frame = spark.createDataFrame(rows, "d long, user_id long, item_id long").select(F.timestamp_seconds(F.col("d") * day).alias("ts"), "user_id", "item_id")
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.write_append(jobs.dedup(stream, "ts", ["user_id", "item_id"]), target, checkpoint).awaitTermination()
    got = [(r.user_id, r.item_id) for r in spark.read.parquet(target).collect()]
    assert sorted(got) == sorted({(d % 5, d % 3) for start in (800, 0, 400) for d in range(start, start + 12)})
