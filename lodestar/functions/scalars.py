"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def half_even(col, digits: int) -> Column:
    """Round half to even, as numpy and pandas do."""
    return F.bround(col, digits)


def centered_units(value_x10, total_x10, count, units: int = 10) -> Column:
    """``round(value - mean, .)`` as an integer number of 1/``units``.

    Integer inputs (ratings times ten, their sum and count) go through one
    division, so every engine and every partitioning gives the same integer.
    """
    numerator = value_x10 * count - total_x10
    if units != 10:
        numerator = numerator * F.lit(units // 10)
    return F.rint(numerator / count).cast("long")


def integer_reduce(col, fill=0, type_name: str = "int") -> Column:
    """Keep the digits of a text, cast, fill."""
    digits = F.regexp_replace(col.cast("string"), "[^0-9]", "")
    return F.coalesce(digits.try_cast(type_name), fill if isinstance(fill, Column) else F.lit(fill)).cast(type_name)


def narrowest_integer(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast each integer column to the narrowest type its min and max allow (one aggregate)."""
    bounds = df.agg(
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(columns)],
    ).first()
    out = df
    for i, c in enumerate(columns):
        lo, hi = bounds[f"lo_{i}"], bounds[f"hi_{i}"]
        if lo is None:
            continue
        for name, bits in (("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)):
            if -(1 << (bits - 1)) <= lo and hi < (1 << (bits - 1)):
                out = out.withColumn(c, F.col(c).cast(name))
                break
    return out


def fixed_text(col, digits: int) -> Column:
    """A number as text with a fixed number of decimals; null stays null."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col.isNotNull(), F.printf(F.lit(f"%.{digits}f"), col))


def cap(col, upper) -> Column:
    """Upper bound that keeps nulls."""
    return F.when(col > F.lit(upper), F.lit(upper)).otherwise(col)


def magnitude(col) -> Column:
    """``"3k"`` becomes 3000; plain numbers stay."""
    text = F.lower(F.trim(col))
    number = F.regexp_replace(text, "[^0-9.]", "").try_cast("double")
    return F.when(text.endswith("k"), number * F.lit(1000.0)).otherwise(number)


def min_max(col, low, high, to=(0.0, 1.0)) -> Column:
    """Linear scaling to ``to``; a constant column goes to its lower end."""
    a, b = to
    span = high - low
    return F.when(span == 0, F.lit(float(a))).otherwise(
        (col - low) / span * F.lit(float(b - a)) + F.lit(float(a))
    )


def scale_columns(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Min-max scale several columns with one aggregate, read as a scalar subquery."""
    stats = df.agg(
        F.struct(
            *[F.min(c).cast("double").alias(f"lo_{i}") for i, c in enumerate(ranges)],
            *[F.max(c).cast("double").alias(f"hi_{i}") for i, c in enumerate(ranges)],
        ).alias("s")
    ).scalar()
    out = df.withColumn("_stats", stats)
    for i, (c, to) in enumerate(ranges.items()):
        out = out.withColumn(
            c,
            min_max(F.col(c).cast("double"), F.col(f"_stats.lo_{i}"), F.col(f"_stats.hi_{i}"), to),
        )
    return out.drop("_stats")


def cosine(dot, sq_a, sq_b) -> Column:
    """Cosine from exact sums; null when a side is all zero."""
    product = sq_a.cast("double") * sq_b.cast("double")
    return F.when(product > 0, dot.cast("double") / F.sqrt(product))


def pages_for(count, per_page: int = 100) -> Column:
    return F.ceil(count / F.lit(per_page)).cast("int")


def bands(mean, std) -> dict[str, Column]:
    """The rating bands around a mean, each rounded to two places."""
    return {
        "overall_mean": half_even(mean, 2),
        "overall_std": half_even(std, 2),
        "two_under": half_even(mean - std * 2, 2),
        "one_under": half_even(mean - std, 2),
        "half_over": half_even(mean + std * 0.5, 2),
        "one_over": half_even(mean + std, 2),
    }
