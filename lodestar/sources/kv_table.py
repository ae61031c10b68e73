"""A key-value table that tasks stage and the driver publishes: a batch writer of Spark's Python data source.

Every task writes its rows to a file of its own under ``staged``; the commit, which runs once on the
driver after all tasks ended well, publishes the files of the winning attempts in one manifest under
``commits``. Readers see files that a manifest names and no others, so a task that ran twice, or
on a lost executor, leaves one copy, and a job that fails leaves nothing to see. A job has a name; one
whose name was published before is not published again, so that it may be sent again after a doubt.

Paths are those that ``pyarrow.fs`` opens (a shared folder, HDFS, object stores).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

# Rows of a Parquet row group: what a point lookup reads of a file at least.
GROUP_ROWS = 50_000


@dataclass
class Staged(WriterCommitMessage):
    file: str | None
    rows: int


class KeyValueWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str, group_rows: int = GROUP_ROWS):
        self.path, self.job, self.group_rows = path.rstrip("/"), job, group_rows

    def folder(self, name: str) -> tuple[pafs.FileSystem, str]:
        files, root = pafs.FileSystem.from_uri(self.path)
        return files, f"{root}/{name}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """Stage one task's rows, batch by batch. The file's name is that of the attempt."""
        name, rows, out, writer = f"{self.job}-{uuid.uuid4().hex}.parquet", 0, None, None
        files, folder = self.folder("staged")
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    files.create_dir(folder, recursive=True)
                    out = files.open_output_stream(f"{folder}/{name}")
                    writer = pq.ParquetWriter(out, batch.schema)
                writer.write_batch(batch, row_group_size=self.group_rows)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
                out.close()
        return Staged(name if rows else None, rows)

    def commit(self, messages: list[Staged]) -> None:
        files, folder = self.folder("commits")
        files.create_dir(folder, recursive=True)
        found = commits(self.path)
        if any(c["job"] == self.job for c in found):
            return
        number = 1 + max((c["number"] for c in found), default=-1)
        named = {"number": number, "job": self.job, "files": sorted(m.file for m in messages if m and m.file), "rows": sum(m.rows for m in messages if m)}
        part = f"{folder}/.{self.job}.{uuid.uuid4().hex}"
        with files.open_output_stream(part) as out:
            out.write(json.dumps(named).encode())
        files.move(part, f"{folder}/{number:012d}-{self.job}.json")

    def abort(self, messages: list[Staged]) -> None:
        """Nothing was published; staged files stay unseen until the folder's own retention takes them."""


class KeyValueTable(DataSource):
    """``df.write.format("key_value_table").option("path", ...).option("job", ...).mode("append").save()``."""

    @classmethod
    def name(cls) -> str:
        return "key_value_table"

    def writer(self, schema: StructType, overwrite: bool) -> KeyValueWriter:
        if overwrite:
            raise ValueError("rows are put by key: write with mode append")
        return KeyValueWriter(self.options["path"], self.options["job"], int(self.options.get("group_rows", GROUP_ROWS)))


def commits(path: str) -> list[dict]:
    """Published jobs in order. One writer publishes at a time."""
    files, root = pafs.FileSystem.from_uri(path.rstrip("/"))
    listed = files.get_file_info(pafs.FileSelector(f"{root}/commits", allow_not_found=True))
    found = []
    for info in listed:
        if info.base_name.endswith(".json") and not info.base_name.startswith("."):
            with files.open_input_stream(info.path) as source:
                found.append(json.loads(source.readall()))
    return sorted(found, key=lambda c: c["number"])


def put(rows: DataFrame, path: str, job: str, key: list[str] | None = None, group_rows: int = GROUP_ROWS) -> None:
    """Put rows under a job's name, in all or not at all; with ``key`` clustered by it, so that a lookup skips files and row groups.

    Rows of equal keys are spread by range, so a key with many rows takes several files.
    """
    if not job or not job.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"a job's name has letters, digits, - and _ only: {job!r}")
    rows.sparkSession.dataSource.register(KeyValueTable)
    if key:
        spread = F.xxhash64(*rows.columns)
        rows = rows.repartitionByRange(*key, spread).sortWithinPartitions(*key)
    rows.write.format("key_value_table").option("path", path).option("job", job).option("group_rows", group_rows).mode("append").save()


def published(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of all published jobs with ``_number``, the order in which theirs was published. Null if nothing is."""
    found = [c for c in commits(path) if c["files"]]
    names = [f"{path.rstrip('/')}/staged/{file}" for c in found for file in c["files"]]
    if not names:
        return spark.createDataFrame([], schema).withColumn("_number", F.lit(0).cast("bigint"))
    numbers = spark.createDataFrame([(c["job"], c["number"]) for c in found], "_job string, _number bigint")
    rows = spark.read.schema(schema).parquet(*names)
    job = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)-[0-9a-f]{32}\.parquet$", 1)
    return rows.withColumn("_job", job).join(F.broadcast(numbers), "_job").drop("_job")


def newest(spark: SparkSession, path: str, schema: StructType | str, key: list[str]) -> DataFrame:
    """For each key the row put last, as a key-value store returns it; of equal keys in one job the greatest row."""
    rows = published(spark, path, schema)
    values = [c for c in rows.columns if c not in (*key, "_number")]
    last = rows.groupBy(*key).agg(F.max(F.struct("_number", *values)).alias("_last"))
    return last.select(*key, *[F.col(f"_last.{c}").alias(c) for c in values])


def layout(path: str, column: str, wanted: list) -> dict[str, int]:
    """Files and row groups, and those whose range of ``column`` may hold one of the wanted values."""
    files, root = pafs.FileSystem.from_uri(path.rstrip("/"))
    figures = {"files": 0, "files_read": 0, "groups": 0, "groups_read": 0}
    for file in (f for c in commits(path) for f in c["files"]):
        meta = pq.read_metadata(f"{root}/staged/{file}", filesystem=files)
        at = meta.schema.names.index(column)
        ranges = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        hits = sum(s is None or not s.has_min_max or any(s.min <= w <= s.max for w in wanted) for s in ranges)
        figures["files"] += 1
        figures["files_read"] += hits > 0
        figures["groups"] += len(ranges)
        figures["groups_read"] += hits
    return figures
