"""Neighbour choice and rating predictions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import IntegralType

from ..functions.fixed_values import RATING_CAP, SYNTHETIC_SIMILARITY
from ..session import BROADCAST_ROWS, materialise, wide_tasks
from . import cells
from .ordering import top_per_group
from .pairs import mirror


def neighbours(pairs: DataFrame, k: int) -> DataFrame:
    """``(a, b, common, sim, rank)``: the k most similar partners of every entity."""
    return top_per_group(mirror(pairs), ["a"], [F.col("sim").desc(), F.col("b")], k)


def neighbours_above(pairs: DataFrame, minimum: float = SYNTHETIC_SIMILARITY) -> DataFrame:
    return mirror(pairs).filter(F.col("sim") >= minimum)


def adaptive_support(pairs: DataFrame, v: int, k: int, keep_missing: bool = False) -> DataFrame:
    """Per user, the largest support not above ``v`` that leaves at least k candidates.

    Closed form of lowering v step by step: one less than the k-th largest common
    count. With fewer than k candidates all of them are used (support 0), or with
    ``keep_missing`` the support is null: the pair table may have a floor itself.
    """
    ranked = top_per_group(mirror(pairs), ["a"], [F.col("common").desc(), F.col("b")], k)
    kth = ranked.groupBy("a").agg(
        F.max(F.when(F.col("rank") == k, F.col("common"))).alias("kth")
    )
    enough = F.least(F.lit(v), F.col("kth") - 1)
    support = F.when(F.col("kth").isNotNull(), enough) if keep_missing else F.when(F.col("kth").isNotNull(), enough).otherwise(0)
    return kth.select("a", support.cast("int").alias("support"))


def lowered_support(values: DataFrame, pairs: DataFrame, users: DataFrame, v: int, k: int, entity: str = "user_id",
                    via: str = "item_id", value: str = "c") -> DataFrame:
    """``(a, support, candidates)`` of every user with partners, lowering ``v`` down to 0 if need be.

    ``pairs`` holds the pairs above some floor, both norms positive. Users who find ``k``
    partners there are done; the others alone are paired again with no floor, cell by cell, and
    only the number of partners per common count leaves a task, however many users lack partners.
    """
    found = materialise(adaptive_support(pairs, v, k, keep_missing=True), "support")
    lacking = users.join(found.where("support is not null"), F.col(entity) == F.col("a"), "left_anti").select(entity)
    rows = values.select(F.col(entity).cast("long").alias("e"), F.col(via).cast("long").alias("v"), F.col(value).cast("long").alias("x"))
    rows = materialise(rows, "support-input")
    mine = rows.join(lacking.withColumnRenamed(entity, "e"), "e", "left_semi")
    blocks = cells.block_count(rows.count(), rows.sparkSession.sparkContext.defaultParallelism)
    # A user's partners by their common count: as many rows as there are different counts.
    counts = materialise(cells.common_histogram(mine, rows, blocks), "low-support")
    above = F.sum("n").over(W.partitionBy("a").orderBy(F.col("common").desc()))
    lowered = counts.withColumn("above", above).groupBy("a").agg(
        F.max(F.when(F.col("above") >= k, F.col("common"))).alias("kth")
    ).select("a", F.least(F.lit(v), F.coalesce(F.col("kth") - 1, F.lit(0))).cast("int").alias("support"))
    parts = [(mirror(pairs).select("a", "common", F.lit(1).alias("n")), found.where("support is not null")), (counts, lowered)]
    made = [common.join(support, "a").where("common > support").groupBy("a", "support").agg(F.sum("n").alias("candidates"))
            for common, support in parts]
    return made[0].unionByName(made[1])


def apply_support(pairs: DataFrame, support: DataFrame) -> DataFrame:
    return mirror(pairs).join(support, "a").filter(F.col("common") > F.col("support")).drop("support")


# Ratings of no item are votes for one that is null: in the cells it goes by the least number there is.
_NO_ITEM = -(1 << 63)


def _votes(near: DataFrame, centered: DataFrame, supports: list, n: int, weigh, kind: str = "long") -> DataFrame:
    """``(v, user_id, item_id, total, known, votes)`` of ``near (a, b, sim, flags)``, summed cell by cell, at least ``n`` votes each."""
    ratings = centered.select(F.col("user_id").alias("e"), F.coalesce("item_id", F.lit(_NO_ITEM)).alias("v"), F.col("c").alias("x"))
    near, ratings = materialise(near, "near"), materialise(ratings.hint("rebalance", "v"), "rated")
    rows = cells.weighted_votes(near, ratings, supports, n, weigh, kind)
    return rows.withColumn("item_id", F.when(F.col("item_id") != _NO_ITEM, F.col("item_id")))


def _whole(chosen: DataFrame, centered: DataFrame) -> bool:
    """Are all keys whole numbers, which cells take?"""
    return all(isinstance(df.schema[c].dataType, IntegralType) for df, c in ((chosen, "a"), (chosen, "b"), (centered, "user_id"), (centered, "item_id")))


def neighbour_predictions(chosen: DataFrame, centered: DataFrame, users: DataFrame, n: int,
                          extra: tuple[str, ...] = (), cap: float | None = None) -> DataFrame:
    """Estimates from the neighbours' centred ratings (in 1/100), at least n of them per item.

    Each weighted rating is rounded to .1 first, an item needs a positive mean,
    and the user's mean is added back. ``users`` carries ``user_id, mean_rating``.
    Weighted ratings are whole tenths, so their sum is exact in any order. With whole numbers as
    keys and no ``extra`` ones the many met rows are summed cell by cell, and never shuffled.
    """
    if not extra and _whole(chosen, centered):
        sums = _votes(chosen.select("a", "b", "sim", F.lit(1).alias("flags")), centered, [0], n, _rounded_tenths)
    else:
        near = chosen.select(*extra, F.col("a").alias("user_id"), F.col("b").alias("user_b"), "sim")
        # No fixed partitioning: the runtime splits a neighbour that many users share.
        weighted = near.join(centered.select(F.col("user_id").alias("user_b"), "item_id", "c"), "user_b")
        sums = weighted.groupBy(*extra, "user_id", "item_id").agg(
            F.sum(F.rint(F.col("c") * F.col("sim") / 10).cast("long")).alias("total"),
            F.count(F.lit(1)).alias("votes"),
        )
    tenths = F.rint(F.col("total") / F.col("votes"))
    kept = sums.filter(F.col("votes") >= n).withColumn("tenths", tenths).filter("tenths > 0")
    estimate = F.col("tenths") / F.lit(10.0) + F.col("mean_rating")
    if cap is not None:
        estimate = F.least(estimate, F.lit(cap))
    return kept.join(users.select("user_id", "mean_rating"), "user_id").select(
        *extra, "user_id", "item_id", "votes", estimate.alias("estimate")
    )


def _rounded_tenths(c, sim):
    return np.rint(c * sim / 10).astype("int64")


def grid_predictions(near: DataFrame, centered: DataFrame, users: DataFrame, supports, n: int) -> DataFrame:
    """``(v, user_id, item_id, votes, estimate)`` for every support ``v`` of ``near``.

    As ``neighbour_predictions``, but a pair that is near under several supports meets the
    neighbour's ratings once: its row carries a flag for each support.
    """
    numbers = F.create_map(*[F.lit(x) for i, v in enumerate(supports) for x in (v, 1 << i)])
    pairs = near.groupBy("a", "b").agg(F.first("sim").alias("sim"), F.bit_or(numbers[F.col("v")]).cast("long").alias("flags"))
    rows = _votes(pairs, centered, list(supports), n, _rounded_tenths)
    rows = rows.withColumn("tenths", F.rint(F.col("total") / F.col("votes"))).where("tenths > 0")
    return rows.join(users.select("user_id", "mean_rating"), "user_id").select(
        "v", "user_id", "item_id", "votes", (F.col("tenths") / F.lit(10.0) + F.col("mean_rating")).alias("estimate"))


def weighted_predictions(chosen: DataFrame, centered: DataFrame, users: DataFrame, n: int,
                         cap: float = RATING_CAP) -> DataFrame:
    """The unrounded variant: mean of rating x similarity plus the user's mean, capped."""
    if _whole(chosen, centered):
        votes = _votes(chosen.select("a", "b", "sim", F.lit(1).alias("flags")), centered, [0], n, lambda c, sim: c / 100.0 * sim, "double")
        sums = votes.withColumn("m", F.when(F.col("known") > 0, F.col("total") / F.col("known")))
    else:
        near = chosen.select(F.col("a").alias("user_id"), F.col("b").alias("user_b"), "sim")
        sums = (
            near.join(centered.select(F.col("user_id").alias("user_b"), "item_id", "c"), "user_b")
            .groupBy("user_id", "item_id")
            .agg(F.avg(F.col("c") / F.lit(100.0) * F.col("sim")).alias("m"), F.count(F.lit(1)).alias("votes"))
            .filter(F.col("votes") >= n)
        )
    return sums.join(users.select("user_id", "mean_rating"), "user_id").select(
        "user_id", "item_id", "votes",
        F.least(F.col("m") + F.col("mean_rating"), F.lit(cap)).alias("estimate"),
    )


def _meet_similar(centered: DataFrame, similar: DataFrame, broadcast_rows: int) -> DataFrame:
    """``(user_id, target, item_id, c, sim)`` for each rated item and each item similar to it.

    The similarity store is written and counted. A small one goes to every task,
    with the ratings partitioned by user, so that what follows per (user, target)
    needs no shuffle of the many joined rows; a large one is joined on the item, where
    the runtime splits the rows of a popular item.
    """
    known = materialise(similar.select(F.col("a").alias("item_id"), F.col("b").alias("target"), "sim"), "store")
    rated = centered.select("user_id", "item_id", "c")
    if known.count() <= broadcast_rows:
        tasks = max(wide_tasks(known.sparkSession), 4 * known.sparkSession.sparkContext.defaultParallelism)
        return rated.repartition(tasks, "user_id").join(F.broadcast(known), "item_id")
    return rated.join(known, "item_id")


def item_predictions(similar: DataFrame, centered: DataFrame, items: DataFrame, users: DataFrame,
                     broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Weighted mean of the user's centred ratings of similar items plus the item's mean.

    Only estimates above the user's mean stay. ``similar`` is ``(a, b, sim)`` in
    both directions, ``centered`` in tenths. A large ``similar`` meets the ratings cell by cell
    of user and item blocks, so that the joined rows are summed where they arise.
    """
    known = materialise(similar.select("a", "b", "sim"), "store")
    held = known.count()
    if held > broadcast_rows:
        return _block_predictions(known, held, centered, items, users)
    sums = (
        _meet_similar(centered, known, broadcast_rows)
        .groupBy("user_id", "target")
        .agg(
            F.sum(F.col("sim") * F.col("c") / F.lit(10.0)).alias("weighted"),
            F.sum("sim").alias("weight"),
        )
        .filter("weight <> 0")
    )
    return (
        sums.select("user_id", F.col("target").alias("item_id"), "weighted", "weight")
        .join(items.select("item_id", F.col("mean_rating").alias("item_mean")), "item_id")
        .join(users.select("user_id", F.col("mean_rating").alias("user_mean")), "user_id")
        .withColumn("raw", F.col("weighted") / F.col("weight") + F.col("item_mean"))
        .filter("raw > user_mean")
        .select("user_id", "item_id", F.col("raw").alias("estimate"))
    )


def _block_predictions(similar: DataFrame, held: int, centered: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    rated = materialise(centered.select(F.col("user_id").alias("e"), F.col("item_id").alias("v"), F.col("c").alias("x")), "rated")
    blocks = cells.block_count(max(held, rated.count()), rated.sparkSession.sparkContext.defaultParallelism)
    return cells.weighted_means(
        rated, similar.select(F.col("b").alias("e"), F.col("a").alias("v"), F.col("sim").alias("x")),
        users.select(F.col("user_id").alias("e"), F.col("mean_rating").alias("mean")),
        items.select(F.col("item_id").alias("e"), F.col("mean_rating").alias("mean")), blocks)


def best_similarity_predictions(similar: DataFrame, centered: DataFrame, items: DataFrame, users: DataFrame,
                                rated: DataFrame, cap: float = RATING_CAP, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The single most similar rated item decides; similarities are rounded to two places.

    On a tie the larger source id wins (the later one in id order). The cap comes
    after rounding; estimates must beat the user's mean and be unrated. The
    maximum is taken of one number made of (similarity, source id, rating), which a
    hash aggregate updates in place; a struct would be sorted instead.
    """
    hundredths = F.rint(F.bround("sim", 2) * 100).cast("long")
    # 8 bits of similarity (-100..100), 46 of source id, 8 of centred rating (-100..100 tenths).
    fits = F.col("item_id").between(0, (1 << 46) - 1) & F.col("c").between(-128, 127)
    key = F.when(
        fits, (hundredths + 128) * F.lit(1 << 54) + F.col("item_id") * F.lit(1 << 8) + (F.col("c") + 128)
    ).otherwise(F.raise_error(F.lit("item id or centred rating out of range")).cast("long"))
    best = (
        _meet_similar(centered, similar, broadcast_rows)
        .groupBy("user_id", "target").agg(F.max(key).alias("key"))
    )
    return (
        best.select(
            "user_id", F.col("target").alias("item_id"),
            ((F.shiftright("key", 54) - 128) / F.lit(100)).alias("s"),
            (F.col("key").bitwiseAND(F.lit(255)) - 128).alias("c"),
        )
        .join(items.select("item_id", F.col("mean_rating").alias("item_mean")), "item_id")
        .withColumn("estimate", F.least(
            F.bround(F.col("c") / F.lit(10.0) * F.col("s") + F.col("item_mean"), 1), F.lit(cap)))
        .join(users.select("user_id", F.col("mean_rating").alias("user_mean")), "user_id")
        .filter("estimate > user_mean")
        .join(rated.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
        .select("user_id", "item_id", "estimate")
    )


def recommend(predictions: DataFrame, rated: DataFrame, names: DataFrame, k: int = 30) -> DataFrame:
    """The k best unrated items of every user, with names."""
    fresh = predictions.join(rated.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    best = top_per_group(fresh, ["user_id"], [F.col("estimate").desc(), F.col("item_id")], k)
    return best.join(names, "item_id", "left")
