"""Pairs of entities that share partners: the engine behind item-item and user-user similarity."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from ..functions.fixed_values import ITEM_SUPPORT, SIMILARITY_BAND
from ..functions.scalars import cosine
from ..session import BROADCAST_ROWS, materialise
from . import cells
from .ordering import numbered


def shared_sums(values: DataFrame, entity: str, via: str, value: str, min_common: int,
                block: int = 1024, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``(a, b, common, dot, sq_a, sq_b)`` for every pair a < b sharing >= ``min_common`` partners.

    Exact, with the sums over the shared partners only. The rows are written once
    to the shared folder, because the self-join and its preparation read them
    several times. A table of at most ``broadcast_rows`` rows is counted first and
    then sent to every task: each task meets it with its own share of entities, so
    pairs are summed where they arise and are never shuffled.

    Beyond that size hashed blocks of entities meet cell by cell (``cells.py``): the rows are
    shuffled once per block, pairs are summed where they arise, and only those with enough in
    common leave a task. Two things keep the work from being quadratic in the heaviest partner:

    * entities with fewer than ``min_common`` partners leave before the join;
    * of the partners with more than ``block`` entities, the ``min_common - 1``
      heaviest never generate pairs. A qualifying pair shares at least one other
      partner, so no pair is lost; their share of the sums is added afterwards.

    Values are integers, so the sums do not depend on the order of addition.
    """
    rows = values.select(
        F.col(entity).alias("e"), F.col(via).alias("v"), F.col(value).cast("long").alias("x")
    )
    if min_common > 1:
        support = rows.groupBy("e").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_common)
        rows = rows.join(support.select("e"), "e", "left_semi")
    # An entity's rows next to each other take less room when they are packed.
    rows = materialise(rows.hint("rebalance", "e"), "pair-input")
    degree = rows.groupBy("v").agg(F.count(F.lit(1)).alias("deg"))
    size = degree.agg(F.sum("deg").alias("rows"), F.sum(F.col("deg") * F.col("deg").cast("double")).alias("work")).first()
    if (size["rows"] or 0) <= broadcast_rows:
        return _sum_pairs(_local_pairs(rows, size["work"] or 0.0)).filter(F.col("common") >= min_common)

    wide = degree.filter((F.col("deg") > block) & F.col("v").isNotNull())
    # At most ``min_common`` rows reach the driver: the deferred keys, and whether more are wide.
    top = wide.orderBy(F.col("deg").desc(), F.col("v")).limit(max(min_common, 1)).collect()
    deferred = [r["v"] for r in top[: min_common - 1]]
    blocks = cells.block_count(size["rows"], rows.sparkSession.sparkContext.defaultParallelism)
    whole, names = _whole_keys(rows)
    if names is not None and deferred:
        deferred = [r[0] for r in names["v"].filter(F.col("v").isin(deferred)).select("_n").collect()]
    sums = cells.pair_sums(whole, blocks, min_common, deferred)
    if names is None:
        kind = rows.schema["e"].dataType
        return sums.withColumns({c: F.col(c).cast(kind) for c in ("a", "b")})
    for side in ("a", "b"):
        sums = sums.join(names["e"].toDF("_e", side), side).drop(side).withColumnRenamed("_e", side)
    return sums.select("a", "b", "common", "dot", "sq_a", "sq_b")


def _whole_keys(rows: DataFrame):
    """The rows with whole numbers as keys, and per key ``(key, _n)`` where other keys were numbered in their order."""
    if all(isinstance(rows.schema[c].dataType, IntegralType) for c in ("e", "v")):
        return rows.select(F.col("e").cast("long").alias("e"), F.col("v").cast("long").alias("v"), "x"), None
    names = {c: numbered(rows.where(F.col(c).isNotNull()).select(c).distinct(), [c], "pair-names", "_n").select(c, "_n") for c in ("e", "v")}
    out = rows.join(names["e"].toDF("e", "_e"), "e").join(names["v"].toDF("v", "_v"), "v")
    return out.select(F.col("_e").alias("e"), F.col("_v").alias("v"), "x"), names


def _local_pairs(rows: DataFrame, work: float) -> DataFrame:
    """Pairs of a small table, partitioned by their first entity.

    ``work`` is the number of rows the join looks at; a few million of them per task
    keep the sums of a task small enough for a hash map.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, ceil(work / 5e6))
    left = rows.select(F.col("e").alias("a"), "v", F.col("x").alias("xa")).repartition(tasks, "a")
    right = rows.select(F.col("e").alias("b"), "v", F.col("x").alias("xb"))
    return left.join(F.broadcast(right), "v").filter("a < b")


def _sum_pairs(met: DataFrame) -> DataFrame:
    return met.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("common"),
        F.sum(F.col("xa") * F.col("xb")).alias("dot"),
        F.sum(F.col("xa") * F.col("xa")).alias("sq_a"),
        F.sum(F.col("xb") * F.col("xb")).alias("sq_b"),
    )


def support_cosine(values: DataFrame, entity: str, via: str, value: str, min_common: int,
                   block: int = 1024) -> DataFrame:
    """``(a, b, common, sim)``: cosine over the shared partners, minimum support applied."""
    sums = shared_sums(values, entity, via, value, min_common, block)
    return sums.select(
        "a", "b", "common", cosine(F.col("dot"), F.col("sq_a"), F.col("sq_b")).alias("sim")
    ).filter("sim is not null")


def mirror(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Both directions of an undirected pair table, from one scan."""
    rest = [c for c in pairs.columns if c not in (a, b)]
    both = F.explode(F.array(F.struct(F.col(a), F.col(b)), F.struct(F.col(b).alias(a), F.col(a).alias(b))))
    return pairs.select(both.alias("_p"), *rest).select(f"_p.{a}", f"_p.{b}", *rest)


def in_band(pairs: DataFrame, low: float = SIMILARITY_BAND[0], high: float = SIMILARITY_BAND[1]) -> DataFrame:
    return pairs.filter((F.col("sim") >= low) & (F.col("sim") <= high))


def centered_item_similarity(ratings: DataFrame, support: int = ITEM_SUPPORT) -> DataFrame:
    """Item-item cosine on ratings minus the item mean; more than ``support`` shared users.

    A rating equal to the item's mean is zero and counts as not rated.
    """
    from .ratings import center

    return support_cosine(
        center(ratings, "item_id").filter("c <> 0"), "item_id", "user_id", "c", support + 1
    )


def centered_user_similarity(ratings: DataFrame, v: int) -> DataFrame:
    """User-user cosine on ratings minus the user mean; more than ``v`` shared items."""
    from .ratings import center

    return support_cosine(center(ratings, "user_id", 100), "user_id", "item_id", "c", v + 1)
