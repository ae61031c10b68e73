"""Structured Streaming versions of ingest, dedup and item statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources import schemas
from ..sources.readers import ITEM_FILES, typed_items


def ingest_xml(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Parse XML files that were not seen before and append their items to a table."""
    wanted = StructType.fromDDL(schemas.ITEM)
    items = (
        spark.readStream.format("xml").option("rowTag", "item").option("pathGlobFilter", ITEM_FILES)
        .option("recursiveFileLookup", "true").schema(schemas.as_text(wanted)).load(source)
    )
    flat = typed_items(items, wanted).select(
        F.col("_id").alias("item_id"), F.col("statistics.ratings.usersrated._value").alias("num_ratings")
    )
    return (
        flat.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def read_events(spark: SparkSession, folder: str, file: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(folder)


def dedup(stream: DataFrame, time: str, keys: list[str], delay: str | None = None) -> DataFrame:
    """Drop replays of a key.

    With ``delay`` state is one key per live watermark window: rows later than it are dropped, and keys
    that come again after it are returned again. Without, every key is kept and returned once.
    """
    if delay is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def write_append(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


# Batches after which the folders of changed keys are merged into one.
MERGE_EVERY = 50


def item_stats(stream: DataFrame, key: str, value: str, target: str, checkpoint: str, unit: int = 100,
               merge_every: int = MERGE_EVERY) -> StreamingQuery:
    """Running count, sum and sum of squares per key in update mode.

    Values are counted in whole units (hundredths), so the sums do not depend on the order of
    arrival. Each micro-batch writes the keys it changed to its own folder, overwritten if
    the batch is replayed, so a restart cannot count anything twice; every ``merge_every``
    batches the newest row of each key so far goes to one folder, after which readers pass the
    older ones by. State is one small row per key.
    """
    units = F.rint(F.col(value) * unit).cast("long")
    totals = stream.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(units).alias("total_units"), F.sum(units * units).alias("total_sq_units"))
    totals = totals.select(key, "n", (F.col("total_units") / unit).alias("total"), (F.col("total_sq_units") / unit ** 2).alias("total_sq"))

    return write_changes(totals, key, target, checkpoint, merge_every)


def write_changes(rows: DataFrame, key: str, target: str, checkpoint: str, merge_every: int = MERGE_EVERY) -> StreamingQuery:
    """Rows of the keys that each micro-batch changed, in a folder of the batch, merged from time to time."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id:012d}")
        if (batch_id + 1) % merge_every == 0:
            latest_stats(spark, target, key, batch_id).write.mode("overwrite").parquet(f"{target}/merged={batch_id:012d}")

    return (
        rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(merge).trigger(availableNow=True).start()
    )


def latest_stats(spark: SparkSession, target: str, key: str, until: int | None = None) -> DataFrame:
    """The newest row of every key, from the last merged folder and the batches after it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {"batch": [], "merged": []}
    for entry in files.listStatus(path):
        kind, _, number = entry.getPath().getName().partition("=")
        if kind in found and (until is None or int(number) <= until):
            # A folder without this mark is being written.
            whole = files.exists(spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS"))
            found[kind] += [int(number)] if whole else []
    start = max((n for n in found["merged"] if until is None or n < until), default=-1)
    parts = [f"{target}/merged={start:012d}"] if start >= 0 else []
    numbers = [start] * len(parts) + sorted(n for n in found["batch"] if n > start)
    parts += [f"{target}/batch={n:012d}" for n in numbers if n > start]
    rows = reduce(DataFrame.unionByName, [spark.read.parquet(p).withColumn("_batch", F.lit(n)) for p, n in zip(parts, numbers)])
    values = [c for c in rows.columns if c not in (key, "_batch")]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*values), "_batch").alias("v"))
    return newest.select(key, "v.*")
