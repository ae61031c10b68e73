"""Distinct counts from theta sketches that are built part by part, merged and intersected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# 2**LOG_SIZE hashes at most are kept of a set: exact below, beyond with a standard error of about 1 / sqrt(2**LOG_SIZE).
LOG_SIZE = 14


def standard_error(log_size: int = LOG_SIZE) -> float:
    return 1 / (2 ** log_size - 1) ** 0.5


def part_sketches(df: DataFrame, by: list[str], value: str, log_size: int = LOG_SIZE) -> DataFrame:
    """``by, sketch``: the distinct values of every part, aggregated before the shuffle. Null values do not count; a null part is one."""
    return df.groupBy(*by).agg(F.theta_sketch_agg(value, log_size).alias("sketch"))


def merged(sketches: DataFrame, by: list[str], log_size: int = LOG_SIZE) -> DataFrame:
    """Sketches of wider parts from those of narrower ones; the rows they were made from are not read again."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("sketch", log_size).alias("sketch"))


def distinct(sketch) -> Column:
    return F.rint(F.theta_sketch_estimate(sketch)).cast("long")


def shared(one, two) -> Column:
    """Estimated count of values in both sets; its error follows the size of the union."""
    return F.rint(F.theta_sketch_estimate(F.theta_intersection(one, two))).cast("long")


def coverage(sketches: DataFrame, by: list[str], known: DataFrame, value: str, log_size: int = LOG_SIZE) -> DataFrame:
    """``by, seen, covered, share``: distinct values of a part, those that are known, and their share of all known ones.

    The known values are one sketch of bounded size, so no part's values are joined to them.
    """
    one = known.agg(F.theta_sketch_agg(value, log_size).alias("s")).scalar()
    wide = merged(sketches, by, log_size).withColumn("_known", one)
    rows = wide.select(*by, distinct("sketch").alias("seen"), shared("sketch", "_known").alias("covered"), distinct("_known").alias("_all"))
    return rows.withColumn("share", F.when(F.col("_all") > 0, F.col("covered") / F.col("_all"))).drop("_all")
