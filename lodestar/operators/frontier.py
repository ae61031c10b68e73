"""Work lists for a crawler: id batches, page numbers, groups of about equal size."""

from __future__ import annotations

from math import ceil

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import IDS_PER_URL, RANK_BLOCK, RATINGS_PER_PAGE, URL_GROUPS
from ..functions.scalars import pages_for
from .ordering import global_rank, tile


def rank_blocks(items: DataFrame, score: str, size: int = RANK_BLOCK) -> DataFrame:
    """Consecutive blocks of the list sorted by score descending."""
    ranked = global_rank(items, score, "item_id")
    return ranked.withColumn("block", F.floor((F.col("rank") - 1) / size))


def id_chunks(items: DataFrame, size: int = IDS_PER_URL) -> DataFrame:
    """Consecutive chunks of ids in id order: ``(chunk, ids)``, ids joined by commas."""
    ranked = global_rank(items.select("item_id"), "item_id", "item_id", descending=False)
    return (
        ranked.groupBy(F.floor((F.col("rank") - 1) / size).alias("chunk"))
        .agg(F.array_sort(F.collect_list("item_id")).alias("ids"))  # at most ``size`` ids
        .select("chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    )


def user_groups(users: DataFrame, groups: int = URL_GROUPS) -> DataFrame:
    """Every user in one of ``groups`` consecutive groups whose sizes differ by at most one."""
    total = users.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = global_rank(users.select("user_id"), "user_id", "user_id", descending=False)
    return ranked.withColumn("_n", total).select("user_id", tile(F.col("rank"), F.col("_n"), groups).alias("grp"))


def batch_urls(chunks: DataFrame, base: str) -> DataFrame:
    return chunks.select("chunk", F.concat(F.lit(f"{base}/thing?id="), "ids", F.lit("&stats=1")).alias("url"))


def page_urls(counts: DataFrame, base: str, per_page: int = RATINGS_PER_PAGE) -> DataFrame:
    """One URL per page of ratings; ``counts`` is ``(item_id, n)``."""
    return (
        counts.withColumn("pages", pages_for(F.col("n"), per_page))
        .filter("pages > 0")
        .select("item_id", F.explode(F.sequence(F.lit(1), F.col("pages"))).alias("page"))
        .select(
            "item_id", "page",
            F.concat(
                F.lit(f"{base}/thing?id="), F.col("item_id").cast("string"),
                F.lit("&ratingcomments=1&page="), F.col("page").cast("string"), F.lit(f"&pagesize={per_page}"),
            ).alias("url"),
        )
    )


def user_urls(users: DataFrame, base: str) -> DataFrame:
    return users.select(
        "user_id",
        F.concat(F.lit(f"{base}/collection?username="), F.col("user_id").cast("string"), F.lit("&rated=1&stats=1")).alias("url"),
    )


def url_username(url) -> F.Column:
    return F.parse_url(url, F.lit("QUERY"), F.lit("username"))


def pack_pages(items: DataFrame, groups: int = URL_GROUPS) -> DataFrame:
    """``(item_id, pages, grp)``: items sorted by pages descending fill groups of about total/groups.

    A group takes items until it holds at least the target. The fill level resets
    at each group, so it is a sequential rule; but items with the same number of
    pages are interchangeable, so it only has to be followed once per distinct
    page count. There are at most sqrt(2 x total pages) of those, whatever the
    catalog holds. Every item's group then follows in closed form from its position.
    """
    runs = items.groupBy("pages").agg(F.count(F.lit(1)).alias("held"))

    def follow(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pages", ascending=False)
        target = max(ceil(int((frame["pages"] * frame["held"]).sum()) / groups), 1)
        fill, group, before, rows = 0, 1, 0, []
        for pages, held in zip(frame["pages"].tolist(), frame["held"].tolist()):
            if fill >= target:
                fill, group = 0, group + 1
            rows.append((pages, before, group, fill, target))
            before += held
            if pages:
                first, each = -(-(target - fill) // pages), -(-target // pages)
                if held < first:
                    fill += held * pages
                else:
                    full, left = divmod(held - first, each)
                    group, fill = group + 1 + full, left * pages
        return pd.DataFrame(rows, columns=["pages", "before", "start_group", "start_fill", "target"])

    starts = runs.groupBy(F.lit(1).alias("_all")).applyInPandas(
        lambda _, f: follow(f[["pages", "held"]]),
        "pages int, before long, start_group long, start_fill long, target long",
    )
    ranked = global_rank(items.withColumn("pages", F.col("pages").cast("int")), "pages", "item_id")
    index = F.col("rank") - 1 - F.col("before")
    first = F.ceil((F.col("target") - F.col("start_fill")) / F.col("pages"))
    each = F.ceil(F.col("target") / F.col("pages"))
    group = (
        F.when(F.col("pages") == 0, F.col("start_group"))
        .when(index < first, F.col("start_group"))
        .otherwise(F.col("start_group") + 1 + F.floor((index - first) / each))
    )
    return ranked.join(starts, "pages").select("item_id", "pages", group.cast("long").alias("grp"))
