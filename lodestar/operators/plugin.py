"""The place where a user's model runs: embeddings, generated text, scores. No model is part of the library."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructField, StructType, StringType, _parse_datatype_string

ERROR = "_error"


def _attempt(function: Callable, values: list, tries: int, wait: float):
    for left in range(tries - 1, -1, -1):
        try:
            made = list(function(values))
            if len(made) != len(values):
                raise ValueError(f"{len(made)} results for {len(values)} rows")
            return made, None
        except Exception as error:  # the function is the user's: whatever it raises rejects its rows
            if not left:
                return None, f"{type(error).__name__}: {error}"
            time.sleep(wait)


def _apply(function: Callable, values: list, tries: int, wait: float) -> Iterator[tuple[object, str | None]]:
    """Result or error of every value, in order: a batch that keeps failing is halved until the rows at fault stand alone."""
    if not values:
        return
    made, error = _attempt(function, values, tries, wait)
    if made is not None:
        yield from ((m, None) for m in made)
    elif len(values) == 1:
        yield None, error
    else:
        middle = len(values) // 2
        yield from _apply(function, values[:middle], tries, wait)
        yield from _apply(function, values[middle:], tries, wait)


def map_batches(df: DataFrame, source: str, out: str, kind: str | DataType, make: Callable[[], Callable[[Sequence], Sequence]],
                batch: int = 256, tries: int = 3, wait: float = 0.0) -> DataFrame:
    """``df`` with column ``out`` of the declared type, made from column ``source`` by a user's function, and ``_error``.

    ``make`` runs once in a task and returns the function (it may load a model); the function takes a list of
    at most ``batch`` values and returns as many. A batch that raises, or returns another number, is tried ``tries`` times, then
    halved, so that only rows at fault are rejected: their ``out`` is null and ``_error`` tells why. Null
    values are passed to nobody: their ``out`` and ``_error`` are null. Rows keep their partition; an empty table stays
    empty; a lost executor's rows are computed again, so the function must not count its calls.
    """
    if {out, ERROR} & set(df.columns):
        raise ValueError(f"columns {out} and {ERROR} must be new")
    kind = _parse_datatype_string(kind) if isinstance(kind, str) else kind
    schema = StructType([*df.schema.fields, StructField(out, kind), StructField(ERROR, StringType())])

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        function = None
        for frame in frames:
            held = frame[source].notna().to_numpy()
            values = frame[source][held].tolist()
            if values and function is None:
                function = make()
            made: list = []
            for at in range(0, len(values), batch):
                made += _apply(function, values[at:at + batch], tries, wait)
            results, errors = [None] * len(frame), [None] * len(frame)
            for place, (result, error) in zip(held.nonzero()[0], made):
                results[place], errors[place] = result, error
            yield frame.assign(**{out: pd.Series(results, index=frame.index, dtype=object), ERROR: pd.Series(errors, index=frame.index, dtype=object)})

    return df.mapInPandas(work, schema)


def accepted(mapped: DataFrame) -> DataFrame:
    return mapped.where(f"{ERROR} is null").drop(ERROR)


def rejected(mapped: DataFrame) -> DataFrame:
    return mapped.where(f"{ERROR} is not null")
