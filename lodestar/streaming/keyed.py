"""Keyed state with a time to live and timers, held in a RocksDB state store.

Each key's state is one small value; a micro-batch touches the keys it brings and no others, so
the cost of a batch follows its own rows and not the keys seen so far. State is spilled to the
executor's disk and its changes are kept in the checkpoint, so a lost executor's keys come back
from there. A key's rows of one micro-batch pass one task in bounded frames; where a hot key brings
too many of them, ``jobs.item_stats`` aggregates before the shuffle, or batches are made smaller.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from ..functions.scalars import bands
from .jobs import write_append, write_changes

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state_store(spark: SparkSession, idle_batches: bool = True):
    """The state store that keyed state needs, for the queries started inside.

    ``idle_batches``: whether batches without rows run, which timers of event time need. State with
    a time to live always asks for one more, so a job that ends with its input has none.
    """
    wanted = {PROVIDER: ROCKSDB, IDLE: str(idle_batches).lower()}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def one_key(*columns: str):
    """Key columns as one text: a null part in a key of several columns is not kept apart by the Python runner."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("_key")


class FirstOfKey(StatefulProcessor):
    """Returns the earliest row of a key in the batch that first brings it, and no other."""

    def __init__(self, time: str, columns: list[str], live_ms: int | None):
        self.time, self.columns, self.live_ms = time, columns, live_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "rows long", ttlDurationMs=self.live_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, first = self.seen.exists(), None
        for part in rows:  # a key's rows come in bounded frames; one row is kept
            if known:
                continue
            part = part if first is None else pd.concat([first, part])
            first = part.sort_values(self.time, kind="stable", na_position="last").head(1)
        if not known:
            self.seen.update((1,))
            yield first[self.columns]

    def close(self) -> None:
        pass


def first_of_keys(stream: DataFrame, time: str, keys: list[str], live_ms: int | None = None) -> DataFrame:
    """One row a key, however late or often it comes.

    No watermark is involved, so no row is dropped for being late. Without ``live_ms`` a key is kept
    for good; with it a key is forgotten that many milliseconds (of processing time) after it was first
    returned, and is returned again if it comes after that. Null keys are a key like any other.
    A key's rows without a time come after its others; of rows of one time the first read is returned.
    """
    processor = FirstOfKey(time, stream.columns, live_ms)
    mode = "None" if live_ms is None else "ProcessingTime"
    return stream.withColumn("_key", one_key(*keys)).groupBy("_key").transformWithStateInPandas(processor, stream.schema, "Append", mode)


def write_first_of_keys(stream: DataFrame, time: str, keys: list[str], target: str, checkpoint: str, live_ms: int | None = None) -> StreamingQuery:
    with keyed_state_store(stream.sparkSession, idle_batches=live_ms is None):
        return write_append(first_of_keys(stream, time, keys, live_ms), target, checkpoint)


class RunningTotals(StatefulProcessor):
    """Count, sum and sum of squares of a key's whole units; with ``quiet_ms`` also when it has settled.

    A key settles when event time passes its newest row by ``quiet_ms``: its timer returns its
    totals once more, marked. A later row unmarks it and sets the timer anew.
    """

    def __init__(self, quiet_ms: int | None):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "n long, total long, total_sq decimal(38,0), last_ms long, settled boolean")

    def row(self, key, state, settled: bool) -> pd.DataFrame:
        n, total, total_sq, last_ms = state
        return pd.DataFrame({"key": [key[0]], "n": [n], "total_units": [total], "total_sq_units": [total_sq], "last_ms": [last_ms], "settled": [settled]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, total, total_sq, last, _ = self.totals.get() if self.totals.exists() else (0, 0, Decimal(0), None, False)
        total_sq = int(total_sq)
        before = last
        for part in rows:
            units = part["units"].dropna()
            n += len(units)
            total += int(units.sum())
            total_sq += sum(int(u) ** 2 for u in units)
            times = part["at_ms"].dropna()
            if len(times):
                last = max(int(times.max()), -1 if last is None else last)
        if self.quiet_ms is not None and last is not None and last != before:
            if before is not None:
                self.handle.deleteTimer(before + self.quiet_ms)
            self.handle.registerTimer(last + self.quiet_ms)
        state = (n, total, Decimal(total_sq), last)
        self.totals.update((*state, False))
        yield self.row(key, state, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        *state, _ = self.totals.get()
        self.totals.update((*state, True))
        yield self.row(key, state, True)

    def close(self) -> None:
        pass


def running_totals(stream: DataFrame, key: str, value: str, unit: int = 10, time: str | None = None,
                   quiet_ms: int | None = None, delay: str = "0 seconds") -> DataFrame:
    """``key, n, total_units, total_sq_units, last_ms, settled``: a row for every change of a key.

    Values are counted in whole ``1 / unit``; null values count nothing, but their key appears. Sums do
    not depend on the order of arrival. With ``quiet_ms`` event time is ``time`` and ``settled`` is told by
    timers; then rows that are ``delay`` older than the newest of the batches before are dropped by the
    watermark, which starts at 1970. Without it nothing is dropped.
    """
    at = F.unix_millis(F.col(time).cast("timestamp")) if time else F.lit(None).cast("long")
    rows = stream.withColumns({"units": F.rint(F.col(value) * unit).cast("long"), "at_ms": at, "_key": one_key(key)})
    kept = ["_key", "units", "at_ms"]
    if quiet_ms is not None:
        rows, kept = rows.withWatermark(time, delay), [*kept, time]
    made = "key string, n long, total_units long, total_sq_units decimal(38,0), last_ms long, settled boolean"
    mode = "None" if quiet_ms is None else "EventTime"
    totals = rows.select(*kept).groupBy("_key").transformWithStateInPandas(RunningTotals(quiet_ms), made, "Update", mode)
    parsed = F.from_json("key", StructType([stream.schema[key]]))[key].alias(key)
    return totals.select(parsed, *[c for c in totals.columns if c != "key"])


def write_running_totals(stream: DataFrame, key: str, value: str, target: str, checkpoint: str, **options) -> StreamingQuery:
    """The totals of changed keys, batch by batch; ``jobs.latest_stats`` reads the newest row of each key."""
    with keyed_state_store(stream.sparkSession):
        return write_changes(running_totals(stream, key, value, **options), key, target, checkpoint)


def bands_of_totals(totals: DataFrame, key: str, unit: int = 10) -> DataFrame:
    """The rating bands that follow from running totals."""
    n, total, squares = F.col("n"), F.col("total_units").cast("decimal(38,0)"), F.col("total_sq_units")
    # n * sum of squares - square of the sum is a whole number, so nothing cancels.
    spread = (squares * n - total * total).cast("double") / (n * (n - 1))
    mean = F.col("total_units") / n / unit
    std = F.when(n > 1, F.sqrt(spread) / unit)
    return totals.where("n > 0").select(key, *[c.alias(name) for name, c in bands(mean, std).items()])
