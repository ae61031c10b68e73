"""Matching a dictionary of many patterns in one pass over a text.

The patterns become one automaton per Python worker, built once from a broadcast list. A text is read
once, however many patterns there are, and the plan holds one expression, not one per pattern. An automaton
takes some 30 times the room of its patterns; a larger dictionary is an index of hashes beside the patterns
themselves, about twice their room, and finds the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

# Characters of patterns and their values that are sent to every executor, and of those that become an automaton.
MOST_CHARACTERS = 400_000_000
AUTOMATON_CHARACTERS = 4_000_000

_BUILT: dict[str, ahocorasick.Automaton] = {}
_INDEXED: dict[str, Index] = {}


def automaton(name: str, entries: Iterable[tuple[str, str]]) -> ahocorasick.Automaton:
    """The automaton of ``(pattern, value)`` entries; the last one used stays in the worker."""
    if name not in _BUILT:
        _BUILT.clear()
        made = ahocorasick.Automaton()
        for pattern, value in entries:
            made.add_word(pattern, (len(pattern), value))
        made.make_automaton()
        _BUILT[name] = made
    return _BUILT[name]


def leftmost_longest(found: ahocorasick.Automaton, text: str) -> list[tuple[int, int, str]]:
    """``start, end, value`` of matches that do not overlap: the leftmost first, of one start the longest."""
    longest: dict[int, tuple[int, str]] = {}
    for last, (size, value) in found.iter(text):
        longest[last + 1 - size] = (last + 1, value)  # ends rise, so a longer one replaces a shorter one
    chosen, free = [], 0
    for start in sorted(longest):
        if start >= free:
            free, value = longest[start]
            chosen.append((start, free, value))
    return chosen


# An odd factor and its inverse among the 64-bit numbers.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


class _Hashes:
    """The hash of any part of a row of characters: their sum, each times a power of a factor, divided by that of the first."""

    def __init__(self, codes: np.ndarray):
        powers = lambda x: np.concatenate([np.ones(1, "uint64"), np.cumprod(np.full(len(codes), x, "uint64"))])
        self.sums = np.concatenate([np.zeros(1, "uint64"), np.cumsum((codes.astype("uint64") + np.uint64(1)) * powers(_FACTOR)[:-1])])
        self.back = powers(_INVERSE)

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return _mixed((self.sums[start + length] - self.sums[start]) * self.back[start])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _hashes_of(rows: np.ndarray, size: int) -> np.ndarray:
    """The hashes of the first ``size`` characters of each row, as ``_Hashes`` has them."""
    h, power = np.zeros(len(rows), "uint64"), 1
    for k in range(size):
        h += (rows[:, k].astype("uint64") + np.uint64(1)) * np.uint64(power)
        power = power * _FACTOR % (1 << 64)
    return _mixed(h)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


class Index:
    """Patterns by length, each length in the order of hashes; a place of a text is looked at if its first characters begin a pattern.

    Patterns of similar lengths have as many first characters as the least power of two among these lengths. A hash that
    is found is compared character by character.
    """

    def __init__(self, patterns: pa.Array, values: pa.Array):
        self.values = values
        parts = (_codes("".join(patterns.slice(at, 1 << 16).to_pylist())) for at in range(0, len(patterns), 1 << 16))
        whole = np.concatenate([np.zeros(0, "u1"), *(c.astype(np.min_scalar_type(int(c.max(initial=0)))) for c in parts)])
        sizes = pc.utf8_length(patterns).to_numpy(zero_copy_only=False).astype("int64")
        starts = np.cumsum(sizes) - sizes
        self.gates: dict[int, tuple[int, np.ndarray]] = {}
        self.lengths: dict[int, list[tuple]] = {}
        begun: dict[int, list[np.ndarray]] = {}
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            rows = whole[starts[own][:, None] + np.arange(size)]
            found = _hashes_of(rows, size)
            order = np.argsort(found, kind="stable")
            rows, first = rows[order], 1 << (size.bit_length() - 1)
            self.lengths.setdefault(first, []).append((size, found[order], own[order], rows))
            begun.setdefault(first, []).append(_hashes_of(rows, first))
        for first, held in begun.items():
            held = np.concatenate(held)
            bits = max(16, len(held).bit_length() + 4)
            gate = np.zeros(1 << bits, bool)
            gate[held >> np.uint64(64 - bits)] = True
            self.gates[first] = (bits, gate)

    def found(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``start, size, pattern`` of all occurrences within the joined texts, by start and size, and the ends of the texts there."""
        ends = np.cumsum([len(t) for t in texts]).astype("int64")
        codes = _codes("".join(texts))
        hashes, end = _Hashes(codes), np.repeat(ends, np.diff(ends, prepend=0))
        out = [(np.zeros(0, "int64"),) * 3]
        for first, held in self.lengths.items():
            bits, gate = self.gates[first]
            at = np.arange(max(0, len(codes) - first + 1))
            at = at[gate[hashes.of(at, first) >> np.uint64(64 - bits)] & (at + first <= end[:len(at)])]
            for size, known, own, rows in held:
                here = at[at + size <= end[at]]
                sought = hashes.of(here, size)
                place = np.searchsorted(known, sought)
                # Patterns may share a hash: each of them is compared.
                while len(here):
                    same = np.flatnonzero((place < len(known)) & (known[np.minimum(place, len(known) - 1)] == sought))
                    here, sought, place = here[same], sought[same], place[same]
                    if len(here):
                        equal = (codes[here[:, None] + np.arange(size)] == rows[place]).all(axis=1)
                        out.append((here[equal], np.full(int(equal.sum()), size), own[place[equal]]))
                    place = place + 1
        start, size, pattern = (np.concatenate(c) for c in zip(*out))
        order = np.lexsort((size, start))
        return start[order], size[order], pattern[order], ends

    def leftmost_longest(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """Of each text what ``leftmost_longest`` gives."""
        start, size, pattern, ends = self.found(texts)
        longest = np.flatnonzero(np.append(start[1:] != start[:-1], True)) if len(start) else np.zeros(0, "int64")
        chosen, free = [], 0
        for k, s, n in zip(longest.tolist(), start[longest].tolist(), size[longest].tolist()):
            if s >= free:
                free = s + n
                chosen.append(k)
        chosen = np.array(chosen, "int64")
        start, size, values = start[chosen], size[chosen], self.values.take(pa.array(pattern[chosen])).to_pylist()
        cuts = np.searchsorted(start, ends).tolist()
        begins = np.concatenate([[0], ends])[:-1]
        owner = np.searchsorted(ends, start, "right")
        start = start - begins[owner] if len(start) else start
        spans = list(zip(start.tolist(), (start + size).tolist(), values))
        return [spans[a:b] for a, b in zip([0, *cuts], cuts)]

    def values_of(self, texts: list[str]) -> list[list[str]]:
        """Of each text the values of all patterns that occur, as often as they do."""
        start, _, pattern, ends = self.found(texts)
        cuts, values = np.searchsorted(start, ends).tolist(), self.values.take(pa.array(pattern)).to_pylist()
        return [values[a:b] for a, b in zip([0, *cuts], cuts)]


# Texts are joined up to about so many characters.
_JOINED = 1 << 20


def _in_parts(texts: list, one: Callable) -> list:
    """What ``one`` gives for lists of texts, a null for a null."""
    out, held, size = [], [], 0

    def flush():
        nonlocal held, size
        made = iter(one([t for t in held if t is not None]))
        out.extend(None if t is None else next(made) for t in held)
        held, size = [], 0

    for t in texts:
        held.append(t)
        size += len(t or "")
        if size >= _JOINED:
            flush()
    flush()
    return out


def index(name: str, entries: Broadcast) -> Index:
    """The index of a broadcast table of patterns and values; the last one used stays in the worker."""
    if name not in _INDEXED:
        _INDEXED.clear()
        table = pa.ipc.open_stream(entries.value).read_all().combine_chunks()
        _INDEXED[name] = Index(*(pa.chunked_array(table.column(c)).combine_chunks() for c in ("pattern", "value")))
    return _INDEXED[name]


class Dictionary:
    """Patterns and their values, as column expressions over texts.

    Patterns are literal and case counts. Null and empty patterns are left out; of equal patterns the one
    with the greatest value stays. A null text gives null (no hit); an empty dictionary matches nothing.
    """

    def __init__(self, entries: DataFrame, pattern: str, value: str, most_characters: int = MOST_CHARACTERS):
        rows = entries.select(F.col(pattern).cast("string").alias("pattern"), F.coalesce(F.col(value).cast("string"), F.lit("")).alias("value"))
        rows = rows.where(F.length("pattern") > 0).groupBy("pattern").agg(F.max("value").alias("value"))
        held = rows.agg(F.coalesce(F.sum(F.length("pattern") + F.length("value")), F.lit(0)).alias("size")).first().size
        if held > most_characters:
            raise ValueError(f"a dictionary of {held} characters is beyond the {most_characters} that are sent to executors")
        self.indexed = held > AUTOMATON_CHARACTERS
        if self.indexed:
            table = rows.sort("pattern").toArrow().cast(pa.schema([("pattern", pa.large_string()), ("value", pa.large_string())]))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            listed = sink.getvalue().to_pybytes()
            self.name, self.size = hashlib.sha256(listed).hexdigest(), len(table)
        else:
            listed = [(r.pattern, r.value) for r in rows.sort("pattern").toLocalIterator()]
            self.name, self.size = hashlib.sha256(repr(listed).encode()).hexdigest(), len(listed)
        self.entries: Broadcast = entries.sparkSession.sparkContext.broadcast(listed)

    def _over(self, text, kind: str, one: Callable, many: Callable) -> Column:
        name, entries, indexed = self.name, self.entries, self.indexed

        @F.pandas_udf(kind)
        def each(texts: pd.Series) -> pd.Series:
            if indexed:
                held = index(name, entries)
                return pd.Series(_in_parts([None if t is None else t for t in texts], lambda some: many(held, some)), dtype=object)
            found = automaton(name, entries.value)
            return pd.Series([None if t is None else one(found, t) for t in texts], dtype=object)

        return each(text)

    def contains(self, text) -> Column:
        """Whether any pattern occurs; the reading ends with the first."""

        def hit(found, t):
            return len(found) > 0 and next(found.iter(t), None) is not None

        return F.coalesce(self._over(text, "boolean", hit, lambda held, some: [len(v) > 0 for v in held.values_of(some)]), F.lit(False))

    def replace(self, text) -> Column:
        """Every leftmost-longest match replaced by its value, in one pass: what was put in is not matched again."""

        def put(t, spans):
            parts, at = [], 0
            for start, end, value in spans:
                parts += [t[at:start], value]
                at = end
            return "".join([*parts, t[at:]])

        def swap(found, t):
            return put(t, leftmost_longest(found, t) if len(found) else ())

        return self._over(text, "string", swap, lambda held, some: map(put, some, held.leftmost_longest(some)))

    def matches(self, text) -> Column:
        """``ARRAY<STRUCT<start, length, value>>`` of the leftmost-longest matches, places in characters from 0."""

        def listed(spans):
            return [{"start": s, "length": e - s, "value": v} for s, e, v in spans]

        def spans(found, t):
            return listed(leftmost_longest(found, t) if len(found) else ())

        return self._over(text, "array<struct<start: int, length: int, value: string>>", spans, lambda held, some: map(listed, held.leftmost_longest(some)))

    def all_values(self, text) -> Column:
        """Distinct values of all patterns that occur, overlapping ones too, in order."""

        def values(found, t):
            return sorted({v for _, (_, v) in found.iter(t)}) if len(found) else []

        return self._over(text, "array<string>", values, lambda held, some: [sorted(set(v)) for v in held.values_of(some)])
