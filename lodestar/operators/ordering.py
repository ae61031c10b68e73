"""Ranks over a whole table or a very large group, without sorting either in one task."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.identity import HASH_BITS, stable_hash
from ..session import materialise, wide_tasks

# Rows that one sub-bucket of a hashed rank should hold about.
_BUCKET_ROWS = 100_000


def numbered(df: DataFrame, order: list, label: str = "order", out: str = "rank", tasks: int | None = None) -> DataFrame:
    """Number rows from 0 in a global order, written once to the shared folder.

    A range shuffle into as many tasks as the session's shuffles have sorts the rows; each
    keeps its place within its partition, and the partitions' first numbers come from one
    count per partition. Equal keys are spread by a tie-break in ``order``.
    """
    tasks = tasks or wide_tasks(df.sparkSession)
    placed = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = materialise(placed.withColumn("_at", F.monotonically_increasing_id()), label)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r[0]: r[1] for r in placed.groupBy(part.alias("p")).count().collect()}
    starts, total = [], 0
    for p in range(max(sizes, default=0) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    # One folded literal: a number per task of the range shuffle.
    start = F.get(F.from_json(F.lit(json.dumps(starts)), "array<bigint>"), part.cast("int"))
    return placed.withColumn(out, place + start).drop("_at")


def global_rank(df: DataFrame, key: str, tie: str, out: str = "rank", descending: bool = True,
                tasks: int | None = None) -> DataFrame:
    """1-based position in the order (key, tie ascending), by ranges that follow the shuffle's size.

    A key value shared by a third of all rows is cut by ``tie``. Null keys come last.
    """
    first = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    return numbered(df, [first, F.col(tie).asc()], out=out, tasks=tasks).withColumn(out, F.col(out) + 1)


def hashed_rank(df: DataFrame, groups: list[str], key: str, seed: int = 42, out: str = "rank",
                buckets: int | None = None) -> DataFrame:
    """Rank inside each group by a hash of ``key``, with every group split by the hash's leading part.

    Without ``buckets`` there are as many as the row count asks for, so one group may hold it all.

    Sub-buckets are contiguous in hash order, so sub-bucket offset plus the rank
    inside the sub-bucket equals the rank in the whole group; no task ever sorts
    more than one sub-bucket of a hot group.
    """
    if buckets is None:
        buckets = 1 << max(4, (df.count() // _BUCKET_ROWS).bit_length())
    hashed = df.withColumn("_h", stable_hash(key, seed=seed))
    hashed = hashed.withColumn("_b", F.floor(F.col("_h") / F.lit((1 << HASH_BITS) // buckets)))
    counts = hashed.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_n"))
    running = W.partitionBy(*groups).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *groups, "_b", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before")
    )
    within = W.partitionBy(*groups, "_b").orderBy("_h", key)
    return (
        hashed.join(offsets, [*groups, "_b"])
        .withColumn(out, F.col("_before") + F.row_number().over(within))
        .drop("_h", "_b", "_before")
    )


def top_per_group(df: DataFrame, groups: list[str], order: list, k: int, out: str = "rank") -> DataFrame:
    """First k rows of each group.

    ``row_number() <= k`` is turned into a per-task group limit before the
    shuffle, so a hot group sends at most k rows per input task.
    """
    w = W.partitionBy(*groups).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def tile(rank, total, tiles: int):
    """``ntile`` from a known rank and total: the first ``total % tiles`` tiles hold one more."""
    size = F.floor(total / F.lit(tiles))
    extra = total % F.lit(tiles)
    edge = extra * (size + 1)
    return F.when(rank <= edge, F.floor((rank - 1) / (size + 1)) + 1).otherwise(
        extra + F.floor((rank - 1 - edge) / F.greatest(size, F.lit(1))) + 1
    ).cast("int")
