"""Words and word windows as array columns, by built-in functions alone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, as the element of a one-element array.

    A value referred to inside a lambda would else be computed for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, _SPACE), "")


def window_hashes(tokens: Column, size: int) -> Column:
    """A 64-bit hash of each run of ``size`` words; one of all words if there are fewer; else none.

    ``tokens`` should be a column or lambda variable, not an expression.
    """
    return (
        F.when(F.size(tokens) >= size, F.transform(F.sequence(F.lit(1), F.size(tokens) - (size - 1)), lambda i: F.xxhash64(F.slice(tokens, i, size))))
        .when(F.size(tokens) > 0, F.array(F.xxhash64(tokens)))
        .otherwise(F.array().cast("array<bigint>"))
    )
