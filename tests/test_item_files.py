"""Files of items: how much one holds, and what reads them."""

import os

from pyspark.sql import functions as F

from lodestar.sources import readers, writers
from lodestar.streaming import jobs


def _files(path, suffix):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(suffix) and not f.startswith(".")]


def test_compressed_items_are_read_by_batch_and_stream(spark, tmp_path):
    path, target, checkpoint = (str(tmp_path / n) for n in ("items", "out", "checkpoint"))
    made = spark.range(50).select(F.col("id").alias("_id"), F.concat(F.lit("& "), F.col("id").cast("string")).alias("description"))
    writers.write_items(made.coalesce(1), path, records=20, compression="gzip")
    assert len(_files(path, ".xml.gz")) == 3
    assert sorted((r[0], r[1]) for r in readers.xml_items(spark, path).select("_id", "description").collect()) == [(i, f"& {i}") for i in range(50)]
    jobs.ingest_xml(spark, path, target, checkpoint).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(target).select("item_id").collect()) == list(range(50))


def test_compaction_bounds_a_file_by_its_bytes(spark, tmp_path, monkeypatch):
    """A group of few large items is spread over files that one task can read each."""
    monkeypatch.setattr(writers, "FILE_BYTES", 40_000)
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    items = spark.range(400).select(F.col("id").alias("_id"), F.repeat(F.lit("x"), 1000).alias("description"), F.when(F.col("id") < 300, "a").otherwise("b").alias("grp"))
    writers.write_items(items.repartition(4), source, by="grp")
    out = writers.compact_xml(spark, source, target)
    assert {r.combined: r["items"] for r in out.collect()} == {"a": 300, "b": 100}
    files = _files(target, ".xml")
    assert len(files) < 40 and max(os.path.getsize(f) for f in files) < 3 * 40_000
    ids = [r[0] for r in readers.xml_items(spark, target).select("_id").collect()]
    assert sorted(ids) == list(range(400))
