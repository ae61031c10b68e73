"""Review curation for summaries: quality filter, stratified samples, prompts, replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixed_values import (
    FRESH_DAYS, MIN_SAMPLE, QUALITY_TOKENS_SAMPLE, QUALITY_TOKENS_TABLE, SAMPLE_SHARE,
    SUMMARY_ABOUT, SUMMARY_CONS, SUMMARY_PROS,
)
from ..functions.identity import uuid5
from ..functions.scalars import fixed_text, half_even
from ..functions.text import clean_review, is_quality, strip
from ..session import materialise
from .ordering import hashed_rank


def quality_table(reviews: DataFrame, more_than: int = QUALITY_TOKENS_TABLE, plain: bool = False, collapse: bool = True) -> DataFrame:
    """Reviews with text, cleaned, with more than ``more_than`` tokens left.

    The table keeps every script and punctuation; samples for prompts are ``plain``.

    The cleaned text is a generated column: a plain one would be cleaned again
    inside the filter that the optimizer moves below the projection.
    """
    others = [c for c in reviews.columns if c != "value"]
    cleaned = F.inline(F.array(F.struct(clean_review(F.col("value"), plain, collapse).alias("value"))))
    return (
        reviews.filter(F.col("value").isNotNull()).select(*others, cleaned)
        .filter(is_quality(F.col("value"), more_than))
    )


def sample_plan(reviews: DataFrame, share: float = SAMPLE_SHARE) -> DataFrame:
    """``(item_id, stratum, total, wanted, quota)`` from all ratings, before any text filter.

    Counts per (item, stratum) are combined before the shuffle; an item has as
    many strata as there are rounded ratings.
    """
    per = reviews.groupBy("item_id", "stratum").agg(F.count(F.lit(1)).alias("n"))
    total = per.groupBy("item_id").agg(F.sum("n").alias("total"))
    wanted = F.floor(F.col("total") * F.lit(share)).cast("long")
    return per.join(total, "item_id").select(
        "item_id", "stratum", "total", wanted.alias("wanted"),
        half_even(F.col("n") / F.col("total") * wanted, 0).cast("long").alias("quota"),
    )


def stratified_reviews(reviews: DataFrame, share: float = SAMPLE_SHARE, minimum: int = MIN_SAMPLE,
                       more_than: int = QUALITY_TOKENS_SAMPLE, seed: int = 42) -> DataFrame:
    """Quality reviews of every item, sampled by rounded rating where there are enough.

    Quotas come from all ratings. An item whose sample would be below ``minimum``,
    or with no more quality reviews than the sample, keeps them all; otherwise each
    stratum gives its quota, at most what it has. The sample is the smallest hashes
    of (user, seed), ranked without sorting a hot item in one task.
    """
    strata = reviews.withColumn("stratum", F.bround(F.col("rating_x10") / F.lit(10.0), 0).cast("int"))
    plan = sample_plan(strata, share)
    # Written once: the counts, the ranks and the result all read the cleaned text.
    quality = materialise(
        quality_table(strata, more_than, plain=True, collapse=False).select("user_id", "item_id", "rating_x10", "value", "stratum"), "quality")
    left = quality.groupBy("item_id").agg(F.count(F.lit(1)).alias("quality_n"))
    decided = plan.join(left, "item_id").withColumn(
        "take_all", (F.col("wanted") < minimum) | (F.col("quality_n") <= F.col("wanted"))
    ).select("item_id", "stratum", "quota", "take_all")
    ranked = hashed_rank(quality, ["item_id", "stratum"], "user_id", seed)
    return (
        ranked.join(decided, ["item_id", "stratum"])
        .filter("take_all or rank <= quota")
        .select(
            "item_id", "user_id", "stratum",
            F.concat_ws(" ", fixed_text(F.col("rating_x10") / F.lit(10.0), 1), "value").alias("combined_review"),
        )
    )


def grouped_context(sampled: DataFrame, size: int = 500, seed: int = 42) -> DataFrame:
    """Texts of at most ``size`` reviews per (item, part), in hash order.

    A share of a very popular item's reviews is still a lot of text, so an item gets
    as many parts as it needs instead of one unbounded row.
    """
    ranked = hashed_rank(sampled, ["item_id"], "user_id", seed).withColumn(
        "part", F.floor((F.col("rank") - 1) / size))
    ordered = F.array_sort(F.collect_list(F.struct("rank", "combined_review")))
    return ranked.groupBy("item_id", "part").agg(ordered.alias("r")).select(
        "item_id", "part", F.array_join(F.transform("r", lambda x: x["combined_review"]), "\n").alias("review_text"),
        F.size("r").alias("reviews"),
    )


def build_prompts(template: str, items: DataFrame, overall: DataFrame) -> DataFrame:
    """Fill the placeholders of a prompt; ``items`` is ``(item_id, name, item_mean)``.

    The overall bands are a one-row table read as a scalar subquery.
    """
    stats = overall.select(F.struct(*[fixed_text(c, 2).alias(c) for c in overall.columns]).alias("s")).scalar()
    filled = items.withColumn("_s", stats)
    prompt: Column = F.lit(template)
    for placeholder, value in (
        ("{GAME_NAME_HERE}", F.col("name")),
        ("{GAME_AVERAGE_HERE}", fixed_text("item_mean", 2)),
        ("{TWO_UNDER}", F.col("_s.two_under")),
        ("{ONE_UNDER}", F.col("_s.one_under")),
        ("{ONE_OVER}", F.col("_s.one_over")),
        ("{HALF_OVER}", F.col("_s.half_over")),
        ("{OVERALL_MEAN}", F.col("_s.overall_mean")),
    ):
        prompt = F.replace(prompt, F.lit(placeholder), value)
    return filled.select("item_id", prompt.alias("prompt"))


def parse_summary(summary) -> dict[str, Column]:
    """Description, pros and cons of a reply; a missing section is null."""
    text = F.replace(summary, F.lit("**"), F.lit(""))

    def bare(part):
        return strip(F.replace(F.replace(part, F.lit("\n"), F.lit("")), F.lit("-"), F.lit("")))

    after_pros = F.get(F.split(text, SUMMARY_PROS), F.lit(1))
    after_cons = F.get(F.split(text, SUMMARY_CONS), F.lit(1))
    return {
        "generated_description": F.replace(
            F.get(F.split(text, SUMMARY_PROS), F.lit(0)), F.lit(SUMMARY_ABOUT), F.lit("")),
        "generated_pros": bare(F.get(F.split(after_pros, SUMMARY_CONS), F.lit(0))),
        "generated_cons": bare(after_cons),
    }


def is_fresh(stamp, as_of, days: int = FRESH_DAYS) -> Column:
    """A ``yyyyMMdd`` stamp less than ``days`` old; a missing one counts as 1970."""
    date = F.to_date(F.coalesce(stamp, F.lit("19700101")), "yyyyMMdd")
    return F.datediff(as_of, date) < days


def worklist(ranked: DataFrame, stored: DataFrame, as_of, days: int = FRESH_DAYS) -> DataFrame:
    """Items not stored yet or not fresh; ``stored`` is ``(item_id, date_updated)``."""
    fresh = stored.filter(is_fresh(F.col("date_updated"), as_of, days))
    return ranked.join(fresh.select("item_id"), "item_id", "left_anti")


def with_uuid(objects: DataFrame, properties: list[str]) -> DataFrame:
    """Deterministic id of an object from its properties, in the order given."""
    canonical = F.to_json(F.struct(*properties))
    return objects.withColumn("uuid", uuid5(canonical))


def upsert(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append the incoming objects whose id is not stored yet."""
    new = incoming.dropDuplicates(["uuid"]).join(stored.select("uuid"), "uuid", "left_anti")
    return stored.unionByName(new.select(*stored.columns))


def delete(stored: DataFrame, gone: DataFrame) -> DataFrame:
    return stored.join(gone.select("uuid"), "uuid", "left_anti")
