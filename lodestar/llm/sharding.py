"""Shards of near equal size by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, functions as F

from ..operators.ordering import numbered
from ..session import materialise
from .tables import id_and_text, in_intervals

# Group sizes with more bits than this are rounded up to so many leading bits, which bounds
# the size histogram at any scale and wastes less than 1 part in 8,192 of a shard.
SIZE_BITS = 14


class RoomTree:
    """A balanced tree (treap) of bins ordered by their remaining room."""

    def __init__(self, seed: int = 7):
        self._root, self._draw = None, random.Random(seed).random

    def add(self, room: int, which: int) -> None:
        low, high = self._split(self._root, (room, which))
        self._root = self._merge(self._merge(low, [(room, which), self._draw(), None, None]), high)

    def take_tightest(self, size: int):
        """Remove and return the bin with the least room that still holds ``size``, or None."""
        low, high = self._split(self._root, (size, -1))
        if high is None:
            self._root = low
            return None
        above, node = None, high
        while node[2] is not None:
            above, node = node, node[2]
        if above is None:
            high = node[3]
        else:
            above[2] = node[3]
        self._root = self._merge(low, high)
        return node[0]

    def _split(self, node, key):
        """Nodes below ``key`` and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return high if low is None else low
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int, most: int | None = None):
    """Place ``(size, count)`` classes, largest first; None if more than ``most`` bins are needed.

    Returns ``(bins, runs)`` with runs ``(first, last, bin)`` over the groups in descending
    order of size. A bin stays the tightest one until the next group of the class no longer
    fits, so a whole run is placed in one step with the same result as one group at a time.
    A group larger than the capacity gets a bin of its own.
    """
    tree, runs, bins, at = RoomTree(), [], 0, 0
    for size, count in sorted(classes, reverse=True):
        while count:
            found = tree.take_tightest(size)
            if found is None:
                found, bins = (max(capacity, size), bins), bins + 1
                if most is not None and bins > most:
                    return None
            room, which = found
            fit = min(count, room // size)
            if runs and runs[-1][2] == which:
                runs[-1] = (runs[-1][0], at + fit, which)
            else:
                runs.append((at, at + fit, which))
            tree.add(room - fit * size, which)
            at, count = at + fit, count - fit
    return bins, runs


def least_capacity(classes: list[tuple[int, int]], shards: int):
    """``(capacity, runs)`` of the smallest capacity found for which ``shards`` bins suffice."""
    if not classes:
        return 0, []
    total = sum(size * count for size, count in classes)
    low = max(max(size for size, _ in classes), -(-total // shards))
    best, step, fails = None, max(1, low >> 16), low - 1
    while best is None:
        tried = low if fails < low else fails + step
        placed = best_fit_decreasing(classes, tried, shards)
        if placed:
            best = (tried, placed[1])
        else:
            step, fails = step * (2 if fails >= low else 1), tried
    while best[0] - fails > max(1, low >> 16):
        middle = (best[0] + fails) // 2
        placed = best_fit_decreasing(classes, middle, shards)
        if placed:
            best = (middle, placed[1])
        else:
            fails = middle
    return best


def shard(docs: DataFrame, shards: int | None = 8, capacity: int | None = None) -> DataFrame:
    """Pack documents into shards; equal texts stay together.

    With ``capacity`` as few shards of so many bytes as best fit finds, else exactly ``shards``
    shards under the least capacity found. Returns ``doc_id, size, text_crc32, shard, slot``.

    A missing text is an empty one. Repeated rows are all placed, in the shard of their text;
    ties of size are ordered by the text's hash, slots by ``doc_id``. A group larger than the
    capacity has a shard of its own. An empty table gives no rows. Extra columns are ignored.
    The driver sees only the histogram of group sizes, whose length ``SIZE_BITS`` bounds.
    """
    text = F.col("text").cast("binary")
    keyed = materialise(id_and_text(docs).select(
        "doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
    ), "shard-keys")
    groups = keyed.groupBy("key").agg(F.sum("size").alias("bytes"))
    extra = F.greatest(F.lit(0), F.length(F.bin("bytes")) - SIZE_BITS)
    unit = F.expr(f"shiftleft(1L, greatest(0, length(bin(bytes)) - {SIZE_BITS}))")
    groups = groups.withColumn("class", F.when(extra == 0, F.col("bytes")).otherwise(F.ceil(F.col("bytes") / unit) * unit))
    groups = numbered(groups.select("key", "class"), [F.col("class").desc(), F.col("key")], "shard-groups")
    classes = [(r[0], r[1]) for r in groups.groupBy("class").count().collect()]
    runs = best_fit_decreasing(classes, capacity)[1] if capacity else least_capacity(classes, shards)[1]
    spans = docs.sparkSession.createDataFrame(runs, "first bigint, last bigint, shard int")
    placed = in_intervals(groups.select("key", "rank"), "rank", spans).select("key", "shard")
    ordered = numbered(keyed.join(placed, "key").drop("key"), ["shard", "doc_id", "text_crc32"], "shard-slots")
    firsts = ordered.groupBy("shard").agg(F.min("rank").alias("start"))
    return ordered.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("start")).alias("slot"))
