"""Near-duplicate classes by Order MinHash candidates and banded alignment."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .graph import components
from .tables import id_and_text

WORDS, SIMILARITY = 5, 0.8
# Sketches of MINIMA k-mers each; BAND of them make a bucket. Two texts with a shingle resemblance
# of r agree in r**MINIMA of the sketches. Members are compared with their bucket's hub, and with
# each other, if they agree in AGREE of them.
SKETCHES, MINIMA, BAND, AGREE = 64, 2, 2, 8
# Members of a large bucket meet block by block.
BLOCK = 256
REMEMBERED = 100_000
_CELLS = 1 << 20


class OrderMinHash:
    """Sketches of a word sequence that agree often for texts of small edit distance."""

    def __init__(self, words: int = WORDS, sketches: int = SKETCHES, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.words = words
        self.factors = draw.integers(1, 1 << 63, sketches, np.uint64) | np.uint64(1)
        self.shifts = draw.integers(1, 1 << 63, sketches, np.uint64)
        self.known: dict[str, int] = {}

    def labelled(self, tokens: list[str]) -> np.ndarray:
        """A hash of every k-mer together with how often it occurred before."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for t in tokens:
            if t not in known:
                known[t] = xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"))
        codes = np.array([known[t] for t in tokens], np.uint64)
        size = min(self.words, len(codes))
        grams = np.zeros(len(codes) - size + 1, np.uint64)
        for i in range(size):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + codes[i:i + len(grams)]
        order = np.argsort(grams, kind="stable")
        ordered = grams[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))
        earlier = np.empty(len(grams), np.uint64)
        earlier[order] = np.arange(len(ordered)) - first
        return mixed(grams + earlier * np.uint64(0xD6E8FEB86659FD93))

    def __call__(self, tokens: list[str]) -> np.ndarray:
        """One 32-bit value per sketch: its ``MINIMA`` least k-mers, in the order of the text."""
        if not tokens:
            return np.zeros(0, np.int32)
        grams = self.labelled(tokens)
        made, step = [], max(1, _CELLS // len(grams))
        for at in range(0, len(self.factors), step):
            values = grams[None, :] * self.factors[at:at + step, None] + self.shifts[at:at + step, None]
            values ^= values >> np.uint64(29)
            rows, places = np.arange(len(values)), []
            for _ in range(min(MINIMA, len(grams))):
                places.append(values.argmin(axis=1))
                values[rows, places[-1]] = np.iinfo(np.uint64).max
            code = np.zeros(len(values), np.uint64)
            for place in np.sort(np.stack(places), axis=0):
                code = mixed(code + grams[place] * np.uint64(0x9E3779B97F4A7C15))
            made.append(code)
        return (np.concatenate(made) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def banded_distance(a: list, b: list, most: int) -> int | None:
    """The edit distance of two sequences, or None if it is over ``most``.

    Only the cells within ``most`` of the diagonal are computed, a row of the band at a time as
    the bits of one integer: differences of neighbouring cells are 1, 0 or -1. The band moves
    down one place with each element of ``b``.
    """
    if abs(len(a) - len(b)) > most:
        return None
    if not a or not b:
        return max(len(a), len(b))
    width = 2 * most + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    # Bit i of the band at step j stands for a[j - most + i]; places before the start never match.
    held: dict = {}

    def matches(item, at):
        mask, since = held.get(item, (0, at))
        return mask >> (at - since)

    for i in range(min(most, len(a))):
        held[a[i]] = (matches(a[i], 0) | 1 << (most + i), 0)
    # Below the diagonal the first column grows by one a place; above it nothing is known yet.
    down, up = full & ~((1 << most) - 1), 0
    edge = min(most, len(a))  # the value of the band's lowest cell
    end = len(b) - max(0, len(a) - most)  # steps along the last row, each lowers the value by 1 at most
    for j, item in enumerate(b):
        if j + most < len(a):
            new = a[j + most]
            held[new] = (matches(new, j) | top, j)
        same = matches(item, j)
        diagonal = ((((same & down) + down) ^ down) | same | up) & full
        right = up | (full & ~(diagonal | down))
        left = diagonal & down
        if j + most < len(a):
            edge += not diagonal & top
            left_over = end
        else:
            bit = 1 << (width - 2 - (j + most - len(a)))
            edge += bool(right & bit) - bool(left & bit)
            left_over = len(b) - 1 - j
        if edge - left_over > most:
            return None
        shifted = diagonal >> 1
        down, up = (left | (full & ~(shifted | right))), shifted & right
    return edge if edge <= most else None


def similarity(a: list, b: list, least: float) -> float | None:
    """``1 - edit distance / length of the longer``, or None if it is below ``least``."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    distance = banded_distance(a, b, int((1 - least) * longer + 1e-9))
    return None if distance is None else 1 - distance / longer


def buckets_of(sketch: Column) -> Column:
    """One hash for each run of ``BAND`` neighbouring sketches."""
    return F.transform(F.sequence(F.lit(0), F.lit(SKETCHES // BAND - 1)), lambda i: F.xxhash64(
        i, *[F.get(sketch, i * BAND + j) for j in range(BAND)]))


def agreeing(one: Column, other: Column) -> Column:
    same = F.zip_with(one, other, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, x: total + x)


def signed(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, key, n_words, sketch`` of every row; the key is a hash of the whole text."""
    rows = id_and_text(docs).select("doc_id", text_key("text").alias("key"), "text")

    def work(batches):
        minhash = OrderMinHash(words)
        for batch in batches:
            sizes, sketches = [], []
            for text in batch.column(2).to_pylist():
                tokens = text.split()
                sizes.append(len(tokens))
                sketches.append(minhash(tokens))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(sketches, pa.list_(pa.int32()))],
                                  ["doc_id", "key", "n_words", "sketch"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, key binary, n_words int, sketch array<int>")


def text_key(text: str) -> Column:
    """Sixteen bytes that stand for a text."""
    return F.substring(F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)), 1, 16)


def lengths_fit(one: str, other: str, least: float) -> Column:
    """Whether two word counts allow a similarity of ``least`` at all."""
    return F.least(F.col(one), F.col(other)) >= F.greatest(F.col(one), F.col(other)) * least - 1e-9


def texts_of(keys: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(key, text)`` of the given text keys, from the row that owns each."""
    owners = keys.join(nodes.select("key", "owner"), "key").withColumnRenamed("key", "_key")
    texts = id_and_text(docs).select("doc_id", "text", text_key("text").alias("key"))
    return texts.join(owners, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("owner"))).select("key", "text")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, least: float, label: str) -> DataFrame:
    """The ``(a, b)`` pairs of text keys whose texts are similar by banded alignment, written once."""
    needed = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
    texts = texts_of(needed, docs, nodes)
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def work(batches):
        for batch in batches:
            texts = zip(*(map(str.split, batch.column(c).to_pylist()) for c in (2, 3)))
            kept = [i for i, (x, y) in enumerate(texts) if bags_fit(x, y, least) and similarity(x, y, least) is not None]
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))

    return materialise(rows.mapInArrow(work, "a binary, b binary"), label)


def by_block(rows: DataFrame, each, schema: str) -> DataFrame:
    """Apply ``each`` to the table of every ``(bucket, x, y)`` group of ``rows``, in sorted order.

    Groups are cut out of the stream of batches; one at a time is held.
    """
    rows = rows.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")

    def work(batches):
        held, last = [], None
        for batch in batches:
            names, start = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "x", "y")))), 0
            for at in range(len(names)):
                if names[at] != last:
                    if at > start:
                        held.append(batch.slice(start, at - start))
                    if held:
                        yield from each(pa.Table.from_batches(held).combine_chunks())
                    held, last, start = [], names[at], at
            if start < len(names):
                held.append(batch.slice(start))
        if held:
            yield from each(pa.Table.from_batches(held).combine_chunks())

    return rows.mapInArrow(work, schema)


def agreeing_pairs(group: pa.Table, least: float) -> list[tuple[int, int, int]]:
    """``(agreement, i, j)`` of members of different parts, each pair in its first shared bucket only.

    Pairs with the bucket's hub have been examined before.
    """
    if len(group) < 2:
        return []
    size, own = group.column("n_words").to_numpy(), group.column("own").to_numpy()
    sketch = group.column("sketch").combine_chunks().flatten().to_numpy().reshape(len(group), -1)
    hub, band = np.array(group.column("is_hub").to_pylist(), bool), group.column("band")[0].as_py()
    number: dict[bytes, int] = {}
    part = np.array([number.setdefault(p, len(number)) for p in group.column("part").to_pylist()])
    crossing = group.column("x")[0].as_py() != group.column("y")[0].as_py()
    found = []
    for i in np.flatnonzero(~hub):
        ok = ~hub & (part != part[i]) & (np.minimum(size, size[i]) >= np.maximum(size, size[i]) * least - 1e-9)
        ok[:i + 1] = False
        if crossing:
            ok &= own != own[i]
        others = np.flatnonzero(ok)
        if not len(others):
            continue
        same = sketch[others] == sketch[i]
        shared = same.reshape(len(others), -1, BAND).all(axis=2)
        agree = same.sum(axis=1)
        good = (agree >= AGREE) & (shared.argmax(axis=1) == band)
        found += zip(agree[good].tolist(), [int(i)] * int(good.sum()), others[good].tolist())
    return found


def bags_fit(a: list, b: list, least: float) -> bool:
    """Whether the words that two texts have in common, in any order, allow the similarity."""
    left = Counter(a)
    left.subtract(b)
    common = len(a) - sum(n for n in left.values() if n > 0)
    return common >= max(len(a), len(b)) * least - 1e-9


def linked_members(group: pa.Table, least: float) -> list[tuple[bytes, bytes]]:
    """Verified links between parts within one block, none between parts already joined there."""
    key, part = group.column("key").to_pylist(), group.column("part").to_pylist()
    tokens: dict[int, list[str]] = {}
    root = {p: p for p in part}

    def find(p):
        while root[p] != p:
            root[p] = p = root[root[p]]
        return p

    def words(i):
        if i not in tokens:
            tokens[i] = group.column("text")[i].as_py().split()
        return tokens[i]

    links = []
    for _, i, j in sorted(agreeing_pairs(group, least), key=lambda f: (-f[0], f[1], f[2])):
        one, two = find(part[i]), find(part[j])
        if one != two and bags_fit(words(i), words(j), least) and similarity(words(i), words(j), least) is not None:
            root[one] = two
            links.append((key[i], key[j]) if key[i] < key[j] else (key[j], key[i]))
    return links


def links_between_parts(members: DataFrame, docs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Verified ``(a, b)`` links between components that share buckets, written once.

    ``members`` has ``bucket, band, hub, size, key, part, n_words, sketch``; ``part`` is the
    component found so far. The members of a bucket meet in blocks of bounded size, first by
    their sketches; only those that agree with a member of another part come with their texts
    to be aligned. A block gives at most one link fewer than it has parts.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("key"), blocks).cast("int")
    rows = members.withColumns({"blocks": blocks, "own": own}).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "band", "key", "part", "n_words",
        "sketch", (F.col("key") == F.col("hub")).alias("is_hub"))

    def involved(group: pa.Table):
        at = sorted({i for _, *pair in agreeing_pairs(group, least) for i in pair})
        if at:
            yield from group.take(pa.array(at, pa.int64())).to_batches()

    def linked(group: pa.Table):
        links = linked_members(group, least)
        yield pa.record_batch([pa.array([k for k, _ in links], pa.binary()), pa.array([k for _, k in links], pa.binary())], ["a", "b"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    close = materialise(by_block(rows, involved, schema), "near-close")
    with_text = close.join(texts_of(close.select("key").distinct(), docs, nodes), "key")
    return materialise(by_block(with_text, linked, "a binary, b binary").distinct(), "near-links")


def near_classes(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """``doc_id, key, class_id, class_key``: the near-duplicate class of every row.

    Equal texts are one node, and a class is a connected component; its id is the least ``doc_id``
    in it. What is searched is resemblance of five-word shingles: candidates share a bucket of
    Order MinHash sketches and agree in ``AGREE`` of ``SKETCHES``, which shingle resemblances of
    0.6 or more nearly always do. Candidates whose texts have an edit similarity over words of
    ``least`` are linked. Pairs whose edits are scattered can reach ``least`` with few shingles in
    common and are then missed, short texts above all; the README has the share by band.
    Each bucket's least key is compared with all members; members that this leaves in different
    components are then compared among themselves, block by block.

    A missing text is an empty one. Texts without words are linked only if equal; a text of
    fewer than ``words`` words is a single shingle. Repeated rows are all returned, in the class
    of their text; an empty table gives no rows; extra columns are ignored.
    """
    rows = materialise(signed(docs, words), "near-rows")
    nodes = materialise(rows.groupBy("key").agg(
        F.min("doc_id").alias("owner"), F.first("n_words").alias("n_words"), F.first("sketch").alias("sketch")), "near-nodes")
    spread = nodes.where("n_words > 0").select("key", "n_words", F.posexplode(buckets_of(F.col("sketch"))).alias("band", "bucket"))
    tops = materialise(spread.groupBy("bucket").agg(F.min("key").alias("hub"), F.count("*").alias("size")).where("size > 1"), "near-tops")
    stars = spread.join(tops, "bucket").where("key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b"), F.col("n_words").alias("n_b")).distinct()
    one = nodes.select(F.col("key").alias("a"), F.col("n_words").alias("n_a"), F.col("sketch").alias("sketch_a"))
    two = nodes.select(F.col("key").alias("b"), F.col("sketch").alias("sketch_b"))
    stars = stars.join(one, "a").where(lengths_fit("n_a", "n_b", least)).join(two, "b")
    stars = materialise(stars.where(agreeing(F.col("sketch_a"), F.col("sketch_b")) >= AGREE).select("a", "b"), "near-stars")
    edges = verified(stars, docs, nodes, least, "near-edges")
    parts = components(edges)

    part = F.coalesce(F.col("root"), F.col("key"))
    placed = spread.join(tops, "bucket").join(parts, F.col("key") == F.col("node"), "left").withColumn("part", part)
    placed = materialise(placed.select("bucket", "band", "hub", "size", "key", "part"), "near-placed")
    apart = placed.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("bucket")
    members = placed.join(apart, "bucket").join(nodes.select("key", "n_words", "sketch"), "key")
    more = links_between_parts(members, docs, nodes, least)
    if not more.isEmpty():
        parts = components(edges.unionByName(more))

    classes = nodes.select("key", "owner").join(parts, F.col("key") == F.col("node"), "left").select("key", "owner", part.alias("root"))
    heads = classes.groupBy("root").agg(F.min(F.struct("owner", "key")).alias("head"))
    named = classes.join(heads, "root").select("key", F.col("head.owner").alias("class_id"), F.col("head.key").alias("class_key"))
    return rows.select("doc_id", "key").join(named, "key")


def keep_one(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """The documents with one row of each near-duplicate class: that of the least ``doc_id``.

    Columns as given. Where the chosen id has several rows of the same text, one of them stays.
    """
    classes = near_classes(docs, words, least)
    heads = materialise(classes.where(F.col("key") == F.col("class_key")).where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("doc_id", "key").agg(
        F.count("*").alias("times")).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "times"), "near-kept")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), text_key("text").alias("text_key"))
    kept = rows.join(heads, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    once = kept.where("times = 1").select("row.*")
    if heads.where("times > 1").isEmpty():
        return once
    return once.unionByName(kept.where("times > 1").dropDuplicates(["id", "text_key"]).select("row.*"))
