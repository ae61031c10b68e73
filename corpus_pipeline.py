"""The training-data pipeline: quality, toxicity, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of the stage before it, which
are written to the shared folder as Parquet and read again. All but the last return the columns
of ``documents``; the last returns the pieces of the packed sequences. A missing text counts as
an empty one in every stage; an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import near_dedup, packing, quality, toxicity
from lodestar.llm.tables import documents, labels
from lodestar.session import materialise


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, labels(spark, sf_dir))


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.keep_clean(docs, labels(spark, sf_dir))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.keep_one(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack_documents(docs, capacity=2048, end_id=0)


STAGES = [
    ("quality", good_documents),
    ("toxicity", clean_documents),
    ("near_duplicates", distinct_documents),
    ("packing", packed_sequences),
]

# Learned models and alignments are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
