"""Rating tables: activity, means, bands, centred forms, key-value rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import MIN_USER_RATINGS
from ..functions.scalars import bands, centered_units, fixed_text, half_even
from ..session import BROADCAST_ROWS, wide_tasks


def active_users(ratings: DataFrame, minimum: int = MIN_USER_RATINGS) -> DataFrame:
    """Ratings of users with at least ``minimum`` of them.

    A count per user (combined before the shuffle) and a semi-join, rather than
    a window over the user, so one very active user is never sorted in one task.
    """
    keep = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= minimum)
    return ratings.join(keep.select("user_id"), "user_id", "left_semi")


def totals(ratings: DataFrame, key: str) -> DataFrame:
    """Count and exact sum per key."""
    return ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("rating_x10").cast("long")).alias("total_x10")
    )


def means(ratings: DataFrame, key: str) -> DataFrame:
    return totals(ratings, key).select(
        key, "n", (F.col("total_x10") / F.col("n") / F.lit(10.0)).alias("mean_rating")
    )


def center(ratings: DataFrame, key: str, units: int = 10) -> DataFrame:
    """``(user_id, item_id, c)``: rating minus the key's mean, in whole 1/``units``."""
    return (
        ratings.join(totals(ratings, key), key)
        .select(
            "user_id", "item_id",
            centered_units(F.col("rating_x10").cast("long"), F.col("total_x10"), F.col("n"), units).alias("c"),
        )
    )


def _moments():
    rating = F.col("rating_x10") / F.lit(10.0)
    return F.avg(rating).alias("_mean"), F.stddev_samp(rating).alias("_std")


def overall_bands(ratings: DataFrame) -> DataFrame:
    stats = ratings.agg(*_moments())
    return stats.select(*[c.alias(k) for k, c in bands(F.col("_mean"), F.col("_std")).items()])


def item_bands(ratings: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Bands of every rated item in one aggregate; items without ratings do not appear."""
    stats = ratings.groupBy("item_id").agg(*_moments())
    if items is not None:
        stats = stats.join(items.select("item_id"), "item_id", "left_semi")
    return stats.select("item_id", *[c.alias(k) for k, c in bands(F.col("_mean"), F.col("_std")).items()])


def stats_rows(ratings: DataFrame, updated_at: str) -> DataFrame:
    """Key-value rows of the global and per-item bands: all strings, nulls left out as null."""
    per_item = item_bands(ratings).withColumn("game_id", F.col("item_id").cast("string")).drop("item_id")
    overall = overall_bands(ratings).withColumn("game_id", F.lit("all_stats"))
    rows = per_item.unionByName(overall)
    values = [c for c in rows.columns if c != "game_id"]
    return rows.select(
        "game_id", *[fixed_text(c, 2).alias(c) for c in values], F.lit(updated_at).alias("updated_at")
    )


def rating_rows(reviews: DataFrame, updated_at: str) -> DataFrame:
    """Key-value rows of single ratings: one per (item, user), all strings."""
    return reviews.select(
        F.col("item_id").cast("string").alias("game_id"),
        F.col("user_id").cast("string").alias("username"),
        fixed_text(F.col("rating_x10") / F.lit(10.0), 1).alias("rating"),
        F.col("value").cast("string").alias("value"),
        F.lit(updated_at).alias("updated_at"),
    )


def with_dates(ratings: DataFrame, dated: DataFrame) -> DataFrame:
    """Ratings that also appear in the dated table, with their date."""
    return ratings.join(dated.select("user_id", "item_id", "lastmodified"), ["user_id", "item_id"], "inner")


def outside_users(ratings: DataFrame, lower_x10, upper_x10) -> DataFrame:
    """Users whose every rating lies outside the bounds on one side."""
    return ratings.groupBy("user_id").agg(
        F.bool_and(F.col("rating_x10") > upper_x10).alias("above"),
        F.bool_and(F.col("rating_x10") < lower_x10).alias("below"),
    ).filter("above or below")


def iqr_bounds(df: DataFrame, column: str, rate: float, exact: bool = True):
    """Scalar subquery ``struct(low, high)`` of the interquartile fence."""
    probs = F.array(F.lit(0.25), F.lit(0.75))
    quartiles = (
        F.percentile(column, probs) if exact else F.percentile_approx(column, probs, F.lit(100000))
    )
    q = df.agg(quartiles.alias("q"))
    spread = F.col("q")[1] - F.col("q")[0]
    return q.select(
        F.struct(
            (F.col("q")[0] - spread * F.lit(rate)).alias("low"),
            (F.col("q")[1] + spread * F.lit(rate)).alias("high"),
        ).alias("fence")
    ).scalar()


def iqr_filter(df: DataFrame, column: str, rate: float = 1.5, exact: bool = True) -> DataFrame:
    """Rows inside the fence; the quartiles are one scalar subquery, not a join.

    The exact percentile keeps a count per distinct value, small for ratings; set
    ``exact=False`` for a column with more than about 10^8 distinct values.
    """
    fenced = df.withColumn("_fence", iqr_bounds(df, column, rate, exact))
    return fenced.filter(
        (F.col(column) >= F.col("_fence.low")) & (F.col(column) <= F.col("_fence.high"))
    ).drop("_fence")


def distribution(ratings: DataFrame) -> DataFrame:
    """Count of each rating value per item, beside the item's total."""
    per_value = ratings.groupBy("item_id", "rating_x10").agg(F.count(F.lit(1)).alias("n"))
    total = per_value.groupBy("item_id").agg(F.sum("n").alias("total"))
    return per_value.join(total, "item_id")


def activity_histogram(ratings: DataFrame, width: int, cut: int) -> DataFrame:
    """Users per bucket of rating counts, with the median count and the share under a cut."""
    per_user = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    overall = per_user.agg(
        F.struct(
            F.median("n").alias("median_n"),
            (F.count_if(F.col("n") <= cut) / F.count(F.lit(1))).alias("share_under"),
        ).alias("s")
    ).scalar()
    return (
        per_user.groupBy((F.floor(F.col("n") / width) * width).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("users"))
        .withColumn("_s", overall)
        .select(
            "bucket", "users",
            F.col("_s.median_n").alias("median_ratings"),
            half_even(F.col("_s.share_under"), 4).alias("share_under_cut"),
        )
    )


def clean_block(ratings: DataFrame, known_items: DataFrame, minimum: int = MIN_USER_RATINGS) -> DataFrame:
    return active_users(ratings.join(known_items.select("item_id"), "item_id", "left_semi"), minimum)


# Rows of a product that one task makes, and the most tasks.
_PRODUCT_ROWS, _PRODUCT_TASKS = 5_000_000, 20_000


def _user_blocks(users: DataFrame, catalog: DataFrame, block: int):
    """``(user_id, _b)`` for each user and block of the catalog; ``(_b, _items)``; ``_b`` of an item; the tasks that their product asks for."""
    n_users, n_items = users.count(), catalog.count()
    blocks = max(1, ceil(n_items / block))
    place = F.pmod(F.xxhash64("item_id"), F.lit(blocks).cast("long"))
    # In structs, because a list keeps no null.
    items = catalog.select("item_id").groupBy(place.alias("_b")).agg(F.collect_list(F.struct("item_id")).alias("_items"))
    tasks = min(_PRODUCT_TASKS, max(wide_tasks(users.sparkSession), ceil(n_users * n_items / _PRODUCT_ROWS)))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    wanted = users.select("user_id").withColumn("_b", every)
    return wanted, F.broadcast(items) if n_items <= BROADCAST_ROWS else items, place, tasks


def every_item(users: DataFrame, catalog: DataFrame, block: int = 4096) -> DataFrame:
    """``(user_id, item_id)`` of a stated set of users with all items of the catalog.

    The catalog is cut into blocks; a user row is copied once per block and meets the block's list
    of items, so no task or list holds the catalog, and only lists and user rows are shuffled, not their product.
    """
    wanted, items, _, tasks = _user_blocks(users, catalog, block)
    return wanted.repartition(tasks, "user_id", "_b").join(items, "_b").select("user_id", F.inline("_items"))


def fill_unrated(users: DataFrame, catalog: DataFrame, ratings: DataFrame, block: int = 4096) -> DataFrame:
    """Zero rows for every catalog item that users of a stated set have not rated.

    The output is users x catalog by definition, so the set must be a chosen one. What a user has rated of
    a block is a list beside the block's, so the product is not shuffled to meet the ratings.
    """
    wanted, items, place, tasks = _user_blocks(users, catalog, block)
    mine = ratings.select("user_id", "item_id").join(users.select("user_id"), "user_id", "left_semi")
    rated = mine.groupBy("user_id", place.alias("_b")).agg(F.collect_set("item_id").alias("_rated"))
    # Spread after the join, which would take the session's number of partitions.
    every = wanted.join(rated, ["user_id", "_b"], "left").repartition(tasks, "user_id", "_b").join(items, "_b").select("user_id", "_rated", F.inline("_items"))
    unrated = ~F.coalesce(F.array_contains("_rated", F.col("item_id")), F.lit(False))
    return every.where(unrated).select("user_id", "item_id", F.lit(0).alias("rating_x10"))


def surrogate_blocks(users: DataFrame, block: int) -> DataFrame:
    """0..n-1 ids in key order, and the block each id falls in."""
    from .ordering import global_rank

    ranked = global_rank(users, "user_id", "user_id", out="_r", descending=False)
    return ranked.select(
        "user_id",
        (F.col("_r") - 1).alias("surrogate"),
        F.floor((F.col("_r") - 1) / block).alias("block"),
    )
