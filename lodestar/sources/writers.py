"""Writers: suffix dispatch, catalog tables, XML compaction, lookups, key-value batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..operators.tables import sanitise_columns
from ..session import materialise, wide_tasks
from . import schemas


def write(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Choose the format from the suffix."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    writer = df.write.mode(mode)
    if kind == "parquet":
        writer.parquet(path)
    elif kind in ("tsv", "csv"):
        writer.option("header", "true").option("sep", "\t" if kind == "tsv" else ",").csv(path)
    elif kind in ("json", "jsonl"):
        writer.json(path)
    elif kind == "xml":
        write_items(df, path, mode)
    else:
        raise ValueError(f"unknown file type: {kind}")
    return path


def write_items(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None, records: int | None = None,
                compression: str | None = None) -> str:
    """Items as XML, optionally one folder per value of a column.

    A file is read by one task, as a whole: ``records`` is the most that one holds.
    """
    writer = df.write.mode(mode).format("xml").option("rowTag", "item").option("rootTag", "items").option(
        "extension", "xml")
    for name, value in (("maxRecordsPerFile", records), ("compression", compression)):
        writer = writer if value is None else writer.option(name, value)
    (writer.partitionBy(by) if by else writer).save(path)
    return path


def save_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Overwrite an external catalog table; column names are made safe first."""
    sanitise_columns(df).write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def csv_to_tsv(spark: SparkSession, source: str, target: str) -> str:
    """Change the delimiter; every field stays text."""
    spark.read.option("header", "true").csv(source).write.mode("overwrite").option("header", "true").option(
        "sep", "\t").csv(target)
    return target


# Bytes of text that a file of items holds about.
FILE_BYTES = 128 << 20


def compact_xml(spark: SparkSession, source: str, target: str, records_per_file: int = 200_000,
                schema: str = schemas.ITEM) -> DataFrame:
    """Many small ``<group>_<i>.xml`` files to few per group; returns items per group.

    The group is the file name (or ``grp=`` folder) up to the first underscore.
    Rows spread over all tasks by group and item id, so a group with a third of
    all items is written by many tasks. A file has at most ``records_per_file`` items and
    about ``FILE_BYTES``, twice that at most by the items' mean size: a task reads a file as a whole.
    """
    from .readers import xml_items

    items = xml_items(spark, source, schema)
    folder = F.regexp_extract("_metadata.file_path", r"/grp=([^/]+)/", 1)
    stem = F.split("_metadata.file_name", "[_.]")[0]
    combined = F.when(folder != "", folder).otherwise(stem).alias("combined")
    grouped = items.withColumn("combined", combined)
    files = items.groupBy(combined, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("n"))
    sizes = materialise(files.groupBy("combined").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")), "group-sizes")
    whole = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    slots = sizes.select("combined", F.ceil(F.greatest(F.col("n") / records_per_file, F.col("bytes") / FILE_BYTES)).cast("long").alias("slots"))
    spread = grouped.join(slots, "combined").withColumn(
        "slot", F.pmod(F.xxhash64("_id"), F.col("slots"))
    ).repartition(max(wide_tasks(spark), ceil(2 * whole["bytes"] / FILE_BYTES)), "combined", "slot").drop("slots", "slot")
    most = max(1, min(records_per_file, 2 * FILE_BYTES * whole["n"] // max(whole["bytes"], 1)))
    write_items(spread, target, by="combined", records=most)
    written = xml_items(spark, target, schema)
    return written.groupBy(
        F.regexp_extract("_metadata.file_path", r"/combined=([^/]+)/", 1).alias("combined")
    ).agg(F.count(F.lit(1)).alias("items"))


def lookup_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """One JSON entry per key, to be written as JSON lines; no document is built in one task."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(F.col(key).alias("id"), F.col(value).alias("name"))).alias("entry")
    )


def put_batches(rows: DataFrame, put: Callable[[list[dict]], None], size: int = 1000) -> None:
    """Hand rows to a key-value client in batches, inside the tasks.

    ``put`` must be idempotent by key: a lost executor's partition is sent again.
    """

    def send(partition: Iterator) -> None:
        batch: list[dict] = []
        for row in partition:
            batch.append({k: v for k, v in row.asDict().items() if v is not None})
            if len(batch) == size:
                put(batch)
                batch = []
        if batch:
            put(batch)

    rows.foreachPartition(send)


def counted(df: DataFrame, counters: dict[str, Column]) -> tuple[Observation, DataFrame]:
    """``df`` with counters that whatever job runs it takes on the way; read them from the observation's ``get``."""
    seen = Observation()
    return seen, df.observe(seen, *[c.alias(name) for name, c in counters.items()])


def write_counted(df: DataFrame, path: str, counters: dict[str, Column]) -> dict:
    """Write a table and return counters of the rows written, taken by the writing tasks themselves.

    No second job reads the table. Only tasks that end well are counted, and rows are counted after
    the last shuffle, so a task that runs twice counts once. An empty table gives zero counts and null sums.
    """
    seen, rows = counted(df, counters)
    rows.write.mode("overwrite").parquet(path)
    return seen.get


def counter_row(spark: SparkSession, counters: dict[str, int | None]) -> DataFrame:
    """Counters as a table of one row."""
    return spark.range(1).select(*[F.lit(value).cast("bigint").alias(name) for name, value in counters.items()])
