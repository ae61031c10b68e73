"""Entities that share partners, met cell by cell: hashed blocks of entities, a pair of blocks a task.

A self-join on the partner shuffles every met pair of rows. Here the rows themselves travel, packed
into columns of the narrowest type and copied once per block of entities, and a task sums the pairs of
its two blocks, some millions of met rows at a time. What is shuffled grows with the rows and the
number of blocks; the many pairs below the minimum never leave a task.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# Most rows of a block: a task holds two blocks.
BLOCK_ROWS = 6_000_000
# Rows in one packed piece, and met rows that a task looks at together.
_PIECE, _MET = 1 << 18, 1 << 19
_WIDTHS, _STEPS = (1, 2, 4, 8), 9
_FIRST = np.zeros(1, "int64")


def block_count(rows: int, tasks: int) -> int:
    """Blocks of at most ``BLOCK_ROWS`` rows, enough for about four cells a core."""
    return max(ceil(rows / BLOCK_ROWS), ceil(sqrt(8 * tasks)))


def _pack(values: np.ndarray, starts: np.ndarray | None = None) -> bytes:
    """Differences to the least value, after that value and their width: all lowest bytes, then all next ones, for bytes that are mostly 0 take little room once compressed.

    With ``starts`` the values rise in runs from there, and their steps are kept. Fractions stay as they are.
    """
    if values.dtype.kind == "f":
        return np.array([0, 0], "int64").tobytes() + values.astype("float64").tobytes()
    least = int(values.min())
    if starts is not None:
        steps = np.diff(values, prepend=values[:1])
        steps[starts] = values[starts] - least
        return np.array([least, _STEPS], "int64").tobytes() + _pack(steps)
    wide = int(values.max()) - least
    width = next(w for w in _WIDTHS if wide < 1 << (8 * w))
    apart = (values.astype("uint64") - np.uint64(least % (1 << 64))).astype(f"<u{width}")
    return np.array([least, width], "int64").tobytes() + apart.view("u1").reshape(-1, width).T.tobytes()


def _unpack(body: bytes, starts: np.ndarray | None = None) -> np.ndarray:
    least, width = np.frombuffer(body, "int64", 2)
    if width == _STEPS:
        steps = _unpack(body[16:])
        out = np.cumsum(steps)
        out -= np.repeat(out[starts] - steps[starts], np.diff(np.append(starts, len(out))))
        return out + least
    if not width:
        return np.frombuffer(body, "float64", offset=16)
    planes = np.frombuffer(body, "u1", offset=16).reshape(width, -1)
    return (np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype("uint64") + least.astype("uint64")).astype("int64")


def packed(rows: DataFrame, blocks: int) -> DataFrame:
    """``own, e, v, x, known, flags``: pieces of up to ``_PIECE`` rows of one block; ``known`` tells the rows whose ``x`` is not null.

    The rows of a piece are in the order of entity and partner, so that both are small steps.
    Rows without entity or partner meet nothing and stay out. ``rows`` may have ``flags``, a whole number each.
    """
    flagged = "flags" in rows.columns

    def piece(own, part):
        order = np.lexsort((part[1], part[0]))
        e, v, x, known, *flags = (column[order] for column in part)
        starts, _ = runs(e)
        return own, _pack(e, _FIRST), _pack(v, starts), _pack(x), b"" if known.all() else np.packbits(known).tobytes(), _pack(flags[0]) if flags else b""

    def batch(pieces):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*pieces), (pa.int32(), *[pa.binary()] * 5))], ["own", "e", "v", "x", "known", "flags"])

    def work(batches):
        held, size = [[] for _ in range(blocks)], [0] * blocks
        for b in batches:
            columns = [b.column(i) for i in range(b.num_columns)]
            known = columns[3].is_valid().to_numpy(zero_copy_only=False)
            own, e, v, x, *flags = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in columns)
            order = np.argsort(own, kind="stable")
            ends = np.searchsorted(own[order], np.arange(blocks + 1))
            for i in np.flatnonzero(np.diff(ends)):
                part = order[ends[i]:ends[i + 1]]
                held[i].append((e[part], v[part], x[part], known[part], *[f[part] for f in flags]))
                size[i] += len(part)
                if size[i] >= _PIECE:
                    yield batch([piece(i, [np.concatenate(c) for c in zip(*held[i])])])
                    held[i], size[i] = [], 0
        for i in np.flatnonzero(size):
            yield batch([piece(i, [np.concatenate(c) for c in zip(*held[i])])])

    own = F.pmod(F.xxhash64("e"), F.lit(blocks)).cast("int").alias("own")
    x = F.col("x") if rows.schema["x"].dataType.typeName() == "double" else F.col("x").cast("long")
    flags = [F.col("flags").cast("long")] if flagged else []
    return rows.where("e is not null and v is not null").select(own, "e", "v", x.alias("x"), *flags).mapInArrow(
        work, "own int, e binary, v binary, x binary, known binary, flags binary")


def narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type that holds them."""
    if values.dtype.kind == "f" or not len(values):
        return values
    low, high = int(values.min()), int(values.max())
    return values.astype(next(t for t in ("int8", "int16", "int32", "int64") if np.iinfo(t).min <= low and high <= np.iinfo(t).max), copy=False)


class Block:
    """The rows of one block as columns, as narrow as their numbers allow: most of a task's memory."""

    def __init__(self, pieces: list):
        lists = [[], [], [], []]
        for p in pieces:
            e = _unpack(p[0], _FIRST)
            starts, _ = runs(e)
            known = np.unpackbits(np.frombuffer(p[3], "uint8"), count=len(e)).astype(bool) if p[3] else np.ones(len(e), bool)
            for held, column in zip(lists, (narrow(e), narrow(_unpack(p[1], starts)), narrow(_unpack(p[2])), known)):
                held.append(column)
        self.e, self.v, self.x, self.known = (np.concatenate(c) for c in lists)
        self.flags = np.concatenate([narrow(_unpack(p[4])) for p in pieces]) if any(pieces[0][4:]) else None

    def taken(self, rows) -> Block:
        out = Block.__new__(Block)
        out.e, out.v, out.x, out.known = self.e[rows], self.v[rows], self.x[rows], self.known[rows]
        out.flags = None if self.flags is None else self.flags[rows]
        return out

    def values(self, rows) -> np.ndarray:
        """``x`` of some rows in 64 bits, to multiply and add."""
        x = self.x[rows]
        return x if x.dtype.kind == "f" else x.astype("int64")

    def bits(self, rows) -> np.ndarray:
        return self.flags[rows].astype("int64")


def met_rows(left: Block, right: Block, same: bool):
    """``(ids of left, ids of right, key, i, j)`` batch by batch: rows ``i`` of ``left`` and ``j`` of ``right`` with one partner.

    A key is one pair: place of the left entity times the number of right entities plus place of the
    right one. A left entity is met within one batch. ``same`` blocks give each pair once.
    """
    order = np.argsort(right.v, kind="stable").astype("int32")
    sorted_v = right.v[order]
    starts, counts = runs(sorted_v)
    partners = sorted_v[starts]
    del sorted_v
    ids, place = _places(right.e)
    at = np.minimum(np.searchsorted(partners, left.v), len(partners) - 1).astype("int32")
    rows = np.flatnonzero(partners[at] == left.v).astype("int32")
    rows = rows[np.argsort(left.e[rows], kind="stable")]
    at = at[rows]
    start, count = starts[at].astype("int32"), counts[at].astype("int32")
    del at
    own, own_place = _places(left.e[rows])
    upto = np.cumsum(count, dtype="int64")
    begin = 0
    while begin < len(rows):
        end = int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + _MET)) + 1
        end = len(rows) if end >= len(rows) else int(np.searchsorted(own_place, own_place[end - 1], "right"))
        n = count[begin:end].astype("int64")
        i = np.repeat(np.arange(begin, end), n)
        first = np.cumsum(n) - n
        j = order[np.arange(len(i)) + np.repeat(start[begin:end] - first, n)]
        key = own_place[i].astype("int64") * len(ids) + place[j]
        if same:
            once = own[own_place[i]] < ids[place[j]]
            i, j, key = i[once], j[once], key[once]
        if len(key):
            yield own, ids, key, rows[i], j
        begin = end


def _places(values: np.ndarray):
    """The distinct values, 64 bits wide, and the place of each value among them."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    starts, counts = runs(ordered)
    place = np.empty(len(values), "int32")
    place[order] = np.repeat(np.arange(len(starts), dtype="int32"), counts)
    return ordered[starts].astype("int64"), place


def frequent(key: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Rows whose key may come ``least`` times: a count of hashed keys rules most of the others out."""
    if least.max() < 2:
        return np.arange(len(key))
    bits = max(10, int(len(key)).bit_length())
    slot = ((key.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype("int64")
    return np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] >= least)


def runs(ordered: np.ndarray):
    """Starts and lengths of the runs of equal values."""
    if not len(ordered):
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return starts, np.diff(np.append(starts, len(ordered)))


def in_cells(rows: DataFrame, blocks: int, work, schema: str, others: DataFrame | None = None, other_blocks: int | None = None) -> DataFrame:
    """Rows that ``work(left, right, same)`` makes, as record batches, of every pair of blocks.

    ``rows`` is ``(e, v, x)``. With ``others`` every block of ``rows`` meets every one of the
    ``other_blocks`` (else as many) of ``others``; without, the blocks of ``rows`` meet each other and themselves, each pair once.
    """
    own, to = F.col("own"), F.col("to")
    other_blocks = other_blocks or blocks
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("to")
    pieces = packed(rows, blocks).select("*", every(other_blocks))
    if others is None:
        low, high = F.least(own, to), F.greatest(own, to)
        cell = (high * (high + 1) / 2 + low).cast("int")
        cells, placed = blocks * (blocks + 1) // 2, pieces.withColumn("cell", cell).withColumn("left", own == low)
        placed = placed.withColumn("same", own == to)
    else:
        more = packed(others, other_blocks).select("*", every(blocks))
        cells = blocks * other_blocks
        placed = pieces.withColumn("cell", own * other_blocks + to).withColumn("left", F.lit(True)).unionByName(
            more.withColumn("cell", to * other_blocks + own).withColumn("left", F.lit(False))).withColumn("same", F.lit(False))

    def cell_rows(pieces):
        left, right, same = [p[2:] for p in pieces if p[1]], [p[2:] for p in pieces if not p[1]], pieces[0][0]
        pieces.clear()
        if same:
            block = Block(left)
            yield from work(block, block, True)
        elif left and right:
            yield from work(Block(left), Block(right), False)

    placed = placed.select("cell", "same", "left", "e", "v", "x", "known", "flags").repartitionById(cells, F.col("cell"))
    return placed.sortWithinPartitions("cell").mapInArrow(lambda batches: _cell_by_cell(batches, cell_rows), schema)


def pair_sums(rows: DataFrame, blocks: int, min_common: int, deferred: list) -> DataFrame:
    """``(a, b, common, dot, sq_a, sq_b)`` of the pairs a < b with at least ``min_common`` shared partners.

    Partners in ``deferred``, fewer than ``min_common``, generate no pairs; pairs that meet in
    others get their share of them from the dense rows of the two blocks.
    """
    schema = "a long, b long, common long, dot long, sq_a long, sq_b long"
    heavy = np.array(deferred, "int64")

    def work(left, right, same):
        held_left = held_right = None
        if len(heavy):
            light_left, held_left = _split(left, heavy)
            light_right, held_right = (light_left, held_left) if same else _split(right, heavy)
            left, right = light_left, light_right
        if not len(left.e) or not len(right.e):
            return
        least = np.full(len(left.e), min_common, "int32")
        if len(heavy):
            # A pair may lack as many light partners as its left entity has heavy ones.
            least = np.maximum(1, least - sum(np.isin(left.e, h[0]) for h in held_left))
        for own, ids, key, i, j in met_rows(left, right, same):
            some = frequent(key, least[i])
            order = some[np.argsort(key[some], kind="stable")]
            if not len(order):
                continue
            starts, common = runs(key[order])
            enough = common >= least[i[order[starts]]]
            if not enough.any():
                continue
            order, common = order[np.repeat(enough, common)], common[enough]
            starts = np.cumsum(common) - common
            pair = key[order[starts]]
            i, j = i[order], j[order]
            p, q, kp, kq = left.values(i), right.values(j), left.known[i], right.known[j]
            sums = [np.add.reduceat(np.where(k, w, 0), starts) for k, w in ((kp & kq, p * q), (kp, p * p), (kq, q * q))]
            seen = [np.logical_or.reduceat(k, starts) for k in (kp & kq, kp, kq)]
            e, f = own[pair // len(ids)], ids[pair % len(ids)]
            if len(heavy):
                common, sums, seen = _with_deferred(e, f, common, sums, seen, held_left, held_right)
                kept = common >= min_common
                e, f, common, sums, seen = e[kept], f[kept], common[kept], [s[kept] for s in sums], [s[kept] for s in seen]
            swap = e > f
            dot, sq_e, sq_f = (pa.array(s, pa.int64(), mask=~k) for s, k in zip(sums, seen))
            sq_a, sq_b = (pc.if_else(pa.array(swap), x, y) for x, y in ((sq_f, sq_e), (sq_e, sq_f)))
            yield pa.record_batch([pa.array(np.minimum(e, f)), pa.array(np.maximum(e, f)), pa.array(common, pa.int64()), dot, sq_a, sq_b],
                                  ["a", "b", "common", "dot", "sq_a", "sq_b"])

    return in_cells(rows, blocks, work, schema)


# Partners of ``sparse_products`` that are no feature: one without a name, and the number of items a profile stands for.
NO_NAME, HELD = -1, -2


class _Profiles:
    """The profiles of a block: rows in the order of profile and feature, and per profile its norms and what it stands for."""

    def __init__(self, block: Block, floor: float):
        block = block.taken(np.lexsort((block.v, block.e)))
        self.ids, place = _places(block.e)
        place = place.astype("int64")
        total = lambda rows, weights: np.bincount(place[rows], weights=weights[rows], minlength=len(self.ids))
        square = np.where(block.known, block.x * block.x, 0.0)
        self.held = total(block.v == HELD, np.where(block.known, block.x, 0.0)).astype("int64")
        self.sq = total(block.v != HELD, square)
        named = np.flatnonzero(block.v >= 0)
        # A profile that lacks a weight has no similarity.
        lacking = total(np.flatnonzero(~block.known & (block.v != HELD)), np.ones(len(place))) > 0
        named = named[~lacking[place[named]]]
        self.rows, self.place = block.taken(named), place[named]
        square, place = square[named], self.place
        whole = np.bincount(place, weights=square, minlength=len(self.ids))
        # From common to rare: what stays below the floor carries no pair alone.
        order = np.lexsort((self.rows.v, -self.rows.flags, place))
        run = np.cumsum(square[order])
        starts = np.flatnonzero(np.concatenate([[True], place[order][1:] != place[order][:-1]])) if len(order) else order
        before = np.repeat(run[starts] - square[order][starts], np.diff(np.append(starts, len(order)))) if len(order) else run
        kept = np.empty(len(order), bool)
        kept[order] = run - before >= floor ** 2 * whole[place[order]] * (1 - 1e-6)
        self.norm = np.sqrt(whole)
        self.head = np.sqrt(np.bincount(place[~kept], weights=square[~kept], minlength=len(self.ids)))
        self.tails = self.rows.taken(kept)
        self.begin, self.end = (np.searchsorted(place, np.arange(len(self.ids)), side) for side in ("left", "right"))


def sparse_products(rows: DataFrame, blocks: int, floor: float) -> DataFrame:
    """``(a, b, held_a, held_b, dot, sq_a, sq_b)`` of the pairs a < b of sparse vectors whose cosine can be ``floor`` or more.

    ``rows`` is ``(e, v, x, flags)``: profile, feature, weight, and how many profiles have the feature. Pairs are
    met in the features that can carry them; what they have in common there, plus the most that their other features
    can add, decides whether the full vectors are looked at. Products are added in the order of the features.
    """
    schema = "a long, b long, held_a long, held_b long, dot double, sq_a double, sq_b double"

    def products(left, right, p, q):
        """The dot product of each pair of places ``p`` and ``q``."""
        n = left.end[p] - left.begin[p]
        pair = np.repeat(np.arange(len(p)), n)
        i = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + left.begin[p][pair]
        wide = int(max(left.rows.v.max(), right.rows.v.max())) + 1
        starts, counts = runs(right.place * wide + right.rows.v)
        keys = right.place[starts] * wide + right.rows.v[starts]
        sought = q[pair] * wide + left.rows.v[i]
        at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == sought)
        times = counts[at[hit]]
        j = np.repeat(starts[at[hit]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        hit = np.repeat(hit, times)
        return np.bincount(pair[hit], weights=left.rows.x[i[hit]] * right.rows.x[j], minlength=len(p))

    def work(left, right, same):
        left = _Profiles(left, floor)
        right = left if same else _Profiles(right, floor)
        if not len(left.tails.e) or not len(right.tails.e):
            return
        for own, ids, key, i, j in met_rows(left.tails, right.tails, same):
            low = int(key.min())
            size = int(key.max()) - low + 1
            if size <= 8 * len(key):
                partial = np.bincount(key - low, weights=left.tails.x[i] * right.tails.x[j], minlength=size)
                met = np.flatnonzero(np.bincount(key - low, minlength=size))
                partial, pair = partial[met], met + low
            else:
                pair, place = np.unique(key, return_inverse=True)
                partial = np.bincount(place, weights=left.tails.x[i] * right.tails.x[j], minlength=len(pair))
            p, q = np.searchsorted(left.ids, own[pair // len(ids)]), np.searchsorted(right.ids, ids[pair % len(ids)])
            reach = partial + left.head[p] * right.norm[q] + right.head[q] * left.norm[p]
            some = np.flatnonzero(reach >= floor * left.norm[p] * right.norm[q] * (1 - 1e-9) - 1e-9)
            step = max(1, _MET // int((left.end - left.begin).max()))
            for at in range(0, len(some), step):
                part = some[at:at + step]
                a, b = p[part], q[part]
                dot = products(left, right, a, b)
                good = dot >= floor * np.sqrt(left.sq[a] * right.sq[b]) * (1 - 1e-9) - 1e-9
                if not good.any():
                    continue
                a, b, dot = a[good], b[good], dot[good]
                swap = left.ids[a] > right.ids[b]
                (low_e, high_e), (low_n, high_n), (low_s, high_s) = (
                    (np.where(swap, y, x), np.where(swap, x, y))
                    for x, y in ((left.ids[a], right.ids[b]), (left.held[a], right.held[b]), (left.sq[a], right.sq[b])))
                yield pa.record_batch([pa.array(c) for c in (low_e, high_e, low_n, high_n, dot, low_s, high_s)],
                                      ["a", "b", "held_a", "held_b", "dot", "sq_a", "sq_b"])

    return in_cells(rows, blocks, work, schema)


def _split(block: Block, heavy: np.ndarray):
    """The rows of other partners, and per heavy partner the entities' rows in the order of their ids."""
    held = []
    for v in heavy:
        mine = block.taken(block.v == v)
        order = np.argsort(mine.e, kind="stable")
        held.append((mine.e[order], mine.values(order), mine.known[order]))
    return block.taken(~np.isin(block.v, heavy)), held


def _with_deferred(e, f, common, sums, seen, held_left, held_right):
    """The sums with the share of the heavy partners; an entity has at most one row for each."""
    def value(held, ids):
        if not len(held[0]):
            return np.zeros(len(ids), bool), np.zeros(len(ids), "int64"), np.zeros(len(ids), bool)
        at = np.minimum(np.searchsorted(held[0], ids), len(held[0]) - 1)
        return held[0][at] == ids, held[1][at], held[2][at]

    for one, two in zip(held_left, held_right):
        (here, p, kp), (there, q, kq) = value(one, e), value(two, f)
        both = here & there
        common = common + both
        for n, (k, w) in enumerate(((kp & kq, p * q), (kp, p * p), (kq, q * q))):
            sums[n] = sums[n] + np.where(both & k, w, 0)
            seen[n] = seen[n] | (both & k)
    return common, sums, seen


def common_histogram(rows: DataFrame, others: DataFrame, blocks: int) -> DataFrame:
    """``(a, common, n)``: how many other entities of ``others`` share ``common`` partners with ``a`` of ``rows``.

    Only pairs whose shared values are not all zero on either side. No pair leaves a task.
    """
    def work(left, right, same):
        filled = [b.known & (b.x != 0) for b in (left, right)]
        for own, ids, key, i, j in met_rows(left, right, same):
            bits = np.sort(key * 4 + filled[0][i] * 2 + filled[1][j])
            starts, common = runs(bits >> 2)
            pair = bits[starts] >> 2
            usable = np.bitwise_or.reduceat(bits & 3, starts) == 3
            usable &= own[pair // len(ids)] != ids[pair % len(ids)]
            most = int(common.max()) + 1
            kinds, n = np.unique((pair // len(ids) * most + common)[usable], return_counts=True)
            if len(kinds):
                yield pa.record_batch([pa.array(own[kinds // most]), pa.array(kinds % most), pa.array(n)], ["a", "common", "n"])

    parts = in_cells(rows, blocks, work, "a long, common long, n long", others)
    return parts.groupBy("a", "common").agg(F.sum("n").alias("n"))


def weighted_means(rated: DataFrame, similar: DataFrame, users: DataFrame, items: DataFrame, blocks: int) -> DataFrame:
    """``(user_id, item_id, estimate)``: mean of ``rated (e, v, x)`` over the items ``v`` similar to an item, weighted, plus its mean.

    ``similar`` is ``(e, v, x)``: the item, one similar to it, the similarity. ``users`` and ``items`` are
    ``(e, mean)``; estimates that do not beat the user's mean stay in their task. The means travel as
    rows with a flag.
    """
    def with_means(rows, means):
        return rows.select("e", "v", F.col("x").cast("double").alias("x"), F.lit(0).alias("flags")).unionByName(
            means.select("e", F.lit(0).cast("long").alias("v"), F.col("mean").cast("double").alias("x"), F.lit(1).alias("flags")))

    def means_of(block, ids):
        mine = np.flatnonzero((block.flags == 1) & block.known)
        mine = mine[np.argsort(block.e[mine], kind="stable")]
        found = np.full(len(ids), np.nan)
        if len(mine):
            at = np.minimum(np.searchsorted(block.e[mine], ids), len(mine) - 1)
            found = np.where(block.e[mine][at] == ids, block.x[mine][at], np.nan)
        return found

    def work(left, right, same):
        kept = left.taken(left.flags == 0), right.taken((right.flags == 0) & right.known)
        if not len(kept[0].e) or not len(kept[1].e):
            return
        user_means = item_means = None
        for own, ids, key, i, j in met_rows(*kept, False):
            if user_means is None:
                user_means, item_means = means_of(left, own), means_of(right, ids)
            sim, known = kept[1].values(j), kept[0].known[i]
            weighted = np.where(known, sim * kept[0].values(i) / 10.0, 0.0)
            low = key[0] // len(ids) * len(ids)
            size = (int(key[-1]) // len(ids) + 1) * len(ids) - int(low)
            if size <= 8 * len(key):
                place, pair = key - low, None
            else:
                pair, place = np.unique(key, return_inverse=True)
                size = len(pair)
            total, weight = (np.bincount(place, weights=w, minlength=size) for w in (weighted, sim))
            some = weight != 0
            if not known.all():
                some &= np.bincount(place, weights=known, minlength=size) > 0
            at = np.flatnonzero(some)
            pair = pair[at] if pair is not None else at + low
            e, f = pair // len(ids), pair % len(ids)
            raw = total[at] / weight[at] + item_means[f]
            better = np.flatnonzero(raw > user_means[e])
            if len(better):
                yield pa.record_batch([pa.array(own[e[better]]), pa.array(ids[f[better]]), pa.array(raw[better])], ["user_id", "item_id", "estimate"])

    return in_cells(with_means(rated, users), blocks, work, "user_id long, item_id long, estimate double", with_means(similar, items))


def two_counts(rows: int, others: int, tasks: int) -> tuple[int, int]:
    """Blocks of two tables that meet: at most ``BLOCK_ROWS`` rows each and two cells a core, with few copies of rows."""
    counts = [max(1, ceil(n / BLOCK_ROWS)) for n in (rows, others)]
    while counts[0] * counts[1] < 2 * tasks:
        # One block more on a side is one copy more of the other side.
        counts[0 if others * counts[0] <= rows * counts[1] else 1] += 1
    return counts[0], counts[1]


def weighted_votes(near: DataFrame, ratings: DataFrame, supports: list, least: int, weigh, kind: str = "long") -> DataFrame:
    """``(v, user_id, item_id, total, known, votes)``: per support ``v`` the sum of ``weigh(rating, similarity)`` over the neighbours' ratings.

    ``near`` is ``(a, b, sim, flags)`` with a bit for each support, ``ratings`` is ``(e, v, x)``: user, item, rating.
    Blocks of users ``a`` meet blocks of items cell by cell, so that a task holds a share of either table and sums
    the many met rows itself; sums with fewer than ``least`` votes stay there. ``known`` are the votes without a null.
    """
    mine = near.select(F.col("a").cast("long").alias("e"), F.col("b").cast("long").alias("v"), F.col("sim").cast("double").alias("x"), "flags")
    theirs = ratings.select(F.col("v").cast("long").alias("e"), F.col("e").cast("long").alias("v"), "x")
    names = ["v", "user_id", "item_id", "total", "known", "votes"]

    def work(left, right, same):
        for own, ids, key, i, j in met_rows(left, right, False):
            known = left.known[i] & right.known[j]
            weighted = np.where(known, weigh(right.values(j), left.values(i)), 0)
            order = np.argsort(key, kind="stable")
            first, _ = runs(key[order])
            pair, weighted, known, bits = key[order[first]], weighted[order], known[order], left.bits(i[order])
            for number, v in enumerate(supports):
                chosen = bits >> number & 1
                total, some, held = (np.add.reduceat(n * chosen, first) for n in (weighted, known, np.ones_like(chosen)))
                enough = np.flatnonzero((held >= least) & (held > 0))
                if len(enough):
                    yield pa.record_batch([
                        pa.array(np.full(len(enough), v), pa.int32()), pa.array(own[pair[enough] // len(ids)]), pa.array(ids[pair[enough] % len(ids)]),
                        pa.array(total[enough].astype("int64" if kind == "long" else "float64")), pa.array(some[enough]), pa.array(held[enough])], names)

    blocks = two_counts(near.count(), ratings.count(), near.sparkSession.sparkContext.defaultParallelism)
    schema = f"v int, user_id long, item_id long, total {kind}, known long, votes long"
    return in_cells(mine, blocks[0], work, schema, theirs, blocks[1])


def _cell_by_cell(batches, work):
    """What ``work`` makes of the pieces of each cell; a partition holds its cells one after the other."""
    now, pieces = None, []
    for b in batches:
        numbers = [b.column(i).to_pylist() for i in range(3)]
        for k, cell in enumerate(numbers[0]):
            # The packed columns stay where they are; what is made of them is a copy.
            piece = [numbers[1][k], numbers[2][k], *(memoryview(b.column(i)[k].as_buffer()) for i in range(3, b.num_columns))]
            if cell != now and pieces:
                yield from work(pieces)
                pieces = []
            now = cell
            pieces.append(piece)
    if pieces:
        yield from work(pieces)
