"""Reading documents and interval lookup, shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_BLOCK = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with a missing text read as an empty one; other columns go."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def in_intervals(rows: DataFrame, rank: str, intervals: DataFrame) -> DataFrame:
    """Join each row with the one interval ``[first, last)`` that holds its rank.

    Both sides meet in blocks of consecutive ranks, so the join is an equi-join with
    a bounded number of rows per block however long the intervals are. ``first`` stays.
    """
    blocks = F.sequence(F.floor(F.col("first") / _BLOCK), F.floor((F.col("last") - 1) / _BLOCK))
    spans = intervals.withColumn("_block", F.explode(blocks))
    keyed = rows.withColumn("_block", F.floor(F.col(rank) / _BLOCK))
    inside = (F.col(rank) >= F.col("first")) & (F.col(rank) < F.col("last"))
    return keyed.join(spans, "_block").where(inside).drop("_block", "last")
