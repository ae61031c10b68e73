"""Dedup, set, lookup and reshaping operators shared by every job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.identity import sanitise


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key: the first in an explicit order (``dropDuplicates`` picks any)."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def last_wins(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Merge tables with the same key; the row of the last table in the list stays."""
    parts = [f.withColumn("_priority", F.lit(i)) for i, f in enumerate(frames)]
    merged = reduce(lambda a, b: a.unionByName(b), parts)
    values = [c for c in frames[0].columns if c not in keys]
    packed = merged.groupBy(*keys).agg(F.max_by(F.struct(*values), "_priority").alias("_v"))
    return packed.select(*keys, "_v.*")


def union_tables(frames: list[DataFrame], distinct: bool = False) -> DataFrame:
    merged = reduce(lambda a, b: a.unionByName(b), frames)
    return merged.distinct() if distinct else merged


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def sanitise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitise(c) for c in df.columns])


def prefix_columns(df: DataFrame, keys: list[str], prefixes: tuple[str, ...]) -> DataFrame:
    return df.select(*keys, *[c for c in df.columns if c.startswith(prefixes)])


def remap(col: Column, rules: dict[str, str]) -> Column:
    """Dictionary lookup for a short fixed rule list; unknown values become null."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for old, new in rules.items():
        out = out.when(col == old, F.lit(new))
    return out


def unpivot_long(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(keys, columns, name, value).filter(F.col(value).isNotNull())


def attach(df: DataFrame, lookup: DataFrame, on: list[str], fill: dict | None = None) -> DataFrame:
    """Left join that keeps every row; the planner broadcasts the lookup when it is small."""
    out = df.join(lookup, on, "left")
    return out.na.fill(fill) if fill else out


def matching(df: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    return df.join(ids.select(*on), on, "left_semi")


def missing(df: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    return df.join(ids.select(*on), on, "left_anti")


def one_hot(df: DataFrame, key: str, value: str, known: list[str], counts: bool = False) -> DataFrame:
    """Wide 0/1 (or count) export over a known, bounded list of values."""
    agg = F.count(F.lit(1)) if counts else F.max(F.lit(1))
    return df.groupBy(key).pivot(value, known).agg(agg).na.fill(0)


def value_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def group_members(df: DataFrame, item: str, group: str, wanted: DataFrame | None = None) -> DataFrame:
    """``(group, item, others)``: the members of each group, with how many others share it.

    The relation is kept as membership, not as pairs: a group that holds a third of
    the items stays as many rows as it has items. ``wanted`` limits the result to
    the groups of some items.
    """
    members = df.select(group, item)
    if wanted is not None:
        groups = df.join(wanted.select(item), item, "left_semi").select(group).distinct()
        members = members.join(groups, group, "left_semi")
    sizes = members.groupBy(group).agg((F.count(F.lit(1)) - 1).alias("others"))
    return members.join(sizes, group).filter("others > 0").select(group, item, "others")


def stage_counts(df: DataFrame, group: str, stages: dict[str, Column]) -> DataFrame:
    """One conditional count per processing stage, in one pass."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count_if(cond).alias(name) for name, cond in stages.items()],
    )


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one table and not in the other, both ways, with the side they are on."""
    return (
        a.exceptAll(b).withColumn("side", F.lit("left"))
        .unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
    )
