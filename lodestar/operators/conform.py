"""Cleaning rules: routing, rare values, merged mechanics, flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixed_values import MECHANIC_GROUPS
from .tables import remap


def route(value: Column, drop: list[str], mechanics: list[str], themes: list[str], majors: list[str]) -> Column:
    """The bucket of a category value: the first rule list that takes it, else ``rest``."""
    out = F.when(F.lit(False), F.lit(""))
    for bucket, names in (("drop", drop), ("mechanic", mechanics), ("theme", themes), ("major", majors)):
        if names:
            out = out.when(value.isin(list(names)), F.lit(bucket))
    return out.otherwise(F.lit("rest"))


def route_categories(bridge: DataFrame, drop, mechanics: dict[str, str], themes, majors) -> DataFrame:
    """One pass that labels every row and renames mechanics; dropped rows leave."""
    bucket = route(F.col("value"), drop, list(mechanics), themes, list(majors))
    return (
        bridge.withColumn("bucket", bucket)
        .filter("bucket <> 'drop'")
        .withColumn("value", F.when(F.col("bucket") == "mechanic", remap(F.col("value"), mechanics)).otherwise(F.col("value")))
    )


def prune_rare(bridge: DataFrame, threshold: int) -> DataFrame:
    """Rows whose value occurs more than ``threshold`` times.

    A combined count and a semi-join; a value on a third of all rows is only split
    by the join's skew handling, never sorted in one window.
    """
    common = bridge.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > threshold)
    return bridge.join(common.select("value"), "value", "left_semi")


def low_entry_flag(bridge: DataFrame, threshold: int) -> DataFrame:
    """1 for items that hold any value with at most ``threshold`` rows."""
    rare = bridge.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= threshold)
    flagged = bridge.join(rare.select("value", F.lit(1).alias("rare")), "value", "left")
    return flagged.groupBy("item_id").agg(F.max(F.coalesce("rare", F.lit(0))).cast("int").alias("low_entry"))


def compact_mechanics(bridge: DataFrame, groups: dict[str, str] = MECHANIC_GROUPS) -> DataFrame:
    """Merge mechanics by substring, then drop turn-order ones, then dedup.

    Merging comes first: a turn-order mechanic that is also an auction stays as one.
    A value in two groups yields both names.
    """
    lowered = F.lower("value")
    hits = F.array_compact(F.array(*[F.when(F.contains(lowered, F.lit(k)), F.lit(v)) for k, v in groups.items()]))
    names = F.when(F.size(hits) > 0, hits).otherwise(F.array("value"))
    return (
        bridge.select("item_id", F.explode(names).alias("value"))
        .filter(~F.contains(F.lower("value"), F.lit("turn order")))
        .distinct()
    )


def category_flags(items: DataFrame, bridge: DataFrame, majors: dict[str, str]) -> DataFrame:
    """Flag columns set to 1 for the items a major category lists."""
    names = list(dict.fromkeys(majors.values()))
    values_of = {n: [v for v, flag in majors.items() if flag == n] for n in names}
    per_item = bridge.filter(F.col("value").isin(list(majors))).groupBy("item_id").agg(
        *[F.max(F.when(F.col("value").isin(values_of[n]), 1).otherwise(0)).alias(f"_{i}") for i, n in enumerate(names)]
    )
    joined = items.join(per_item, "item_id", "left")
    kept = [c for c in items.columns if c not in names]
    return joined.select(
        *[F.col(f"`{c}`") for c in kept],
        *[
            F.greatest(
                F.coalesce(F.col(f"`{n}`") if n in items.columns else F.lit(0), F.lit(0)),
                F.coalesce(F.col(f"_{i}"), F.lit(0)),
            ).cast("int").alias(n)
            for i, n in enumerate(names)
        ],
    )


def rank_flags(df: DataFrame, flags: dict[str, str], compat: bool = False) -> DataFrame:
    """1 where a rank holds a number; ``compat`` also flags texts such as "Not Ranked"."""
    out = df
    for rank, flag in flags.items():
        if rank in df.columns:
            col = F.col(f"`{rank}`").cast("string")
            present = col.isNotNull() if compat else F.regexp_replace(col, "[^0-9]", "") != ""
            out = out.withColumn(flag, F.when(present, 1).otherwise(0).cast("int"))
    return out


def fill_ranks(df: DataFrame, ranks: list[str]) -> DataFrame:
    """Digits of a rank; a missing rank becomes the number of rows plus one."""
    last = df.agg((F.count(F.lit(1)) + 1).alias("n")).scalar()
    out = df
    for rank in ranks:
        digits = F.regexp_replace(F.col(f"`{rank}`").cast("string"), "[^0-9]", "").try_cast("int")
        out = out.withColumn(rank, F.coalesce(digits, last.cast("int")))
    return out


def drop_rows(bridge: DataFrame, unwanted: list[str], uncredited: str = "(Uncredited)") -> DataFrame:
    value = F.col("value")
    return bridge.filter(value.isNotNull() & (value != uncredited) & ~value.isin(unwanted))


def released(items: DataFrame, year: int) -> DataFrame:
    return items.filter(F.col("year") <= year)


def min_players(col: Column) -> Column:
    return F.when(F.coalesce(col, F.lit(0)) == 0, F.lit(2)).otherwise(col)
