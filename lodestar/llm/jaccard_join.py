"""A Jaccard join of shingle sets by vertical partitioning of the global shingle order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .graph import components
from .tables import id_and_text

WORDS, PERCENT = 4, 85
# The global order of shingles is that of their hashes; it is cut into 2**CUTS fragments of equal width.
CUTS = 3
# Fragments in which unmatched shingles of all sets are counted first. Together they must hold more
# than the share of a set that a link can do without; the others follow for the sets that are left.
FIRST = 2
# Words of 64 bits that stand for the difference of two sets.
MASKS = 4
# Words of 64 parity bits that a set has: two sets differ in as many shingles as bits, at least.
PARITY = 8


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles, as signed 64-bit numbers.

    Words of a whole batch are split, numbered and hashed together. Only A-Z are lower-cased, and
    only ASCII white space separates.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    counts = np.concatenate([[0], np.cumsum(full)])
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
    ends = counts[ends]
    coded = flat.filter(pa.array(full)).dictionary_encode()
    table = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    codes = table[coded.indices.to_numpy()] if len(coded) else table
    for start, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
        size = min(words, end - start)
        if not size:
            yield np.zeros(0, np.int64)
            continue
        last = end - size + 1
        grams = np.full(last - start, size, np.uint64)
        for i in range(size):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + codes[start + i:last + i]
            grams ^= grams >> np.uint64(32)
        grams = (grams ^ (grams >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        grams = (grams ^ (grams >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        yield np.unique((grams ^ (grams >> np.uint64(31))).view(np.int64))


def fragments(grams: np.ndarray) -> list[np.ndarray]:
    """The sorted shingles cut where the global order is cut."""
    edges = np.array([(i << (64 - CUTS)) - (1 << 63) for i in range(1, 1 << CUTS)], np.int64)
    return np.split(grams, np.searchsorted(grams, edges))


def set_key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.astype("<i8").tobytes())


def parity(grams: np.ndarray) -> np.ndarray:
    """Whether an odd number of the shingles fall on each of ``64 * PARITY`` bits."""
    odd = np.bincount(grams & (64 * PARITY - 1), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def signed(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, key, n`` of every row: the hash and the size of its set."""
    rows = id_and_text(docs)

    def work(batches):
        for batch in batches:
            made = [(set_key(g), len(g)) for g in shingle_sets(batch.column(1), words)]
            yield pa.record_batch([batch.column(0), pa.array([k for k, _ in made], pa.binary()), pa.array([n for _, n in made], pa.int64())], ["doc_id", "key", "n"])

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, key binary, n bigint")


def half(key: bytes) -> int:
    """Half of a set's key, which stands for the set where shingles are shuffled."""
    return int.from_bytes(key[:8], "big", signed=True)


def first_fragments(docs: DataFrame, words: int) -> DataFrame:
    """``half, grams`` of every text with a word: the shingles of the first fragments."""

    def work(batches):
        for batch in batches:
            made = [(half(set_key(g)), np.concatenate(fragments(g)[:FIRST])) for g in shingle_sets(batch.column(0), words) if len(g)]
            yield pa.record_batch([pa.array([k for k, _ in made], pa.int64()), pa.array([g for _, g in made], pa.list_(pa.int64()))], ["half", "grams"])

    return id_and_text(docs).select("text").mapInArrow(work, "half bigint, grams array<bigint>")


def whole_sets(owners: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``half, key, n, alone, parity, parts`` of the sets of ``(key, owner, alone)``, the shingles fragment by fragment, from their owners' texts, written once."""
    owners = owners.select(F.col("key").alias("want"), "owner", "alone")
    rows = id_and_text(docs).join(owners, F.col("doc_id").eqNullSafe(F.col("owner"))).select("want", "alone", "text")

    def work(batches):
        for batch in batches:
            want, alone = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            # An id may stand for several texts.
            made = [(half(k), k, len(g), a, parity(g), fragments(g)) for k, a, g in zip(want, alone, shingle_sets(batch.column(2), words)) if set_key(g) == k]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]
            yield pa.record_batch([pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)], ["half", "key", "n", "alone", "parity", "parts"])

    sets = materialise(rows.mapInArrow(work, "half bigint, key binary, n bigint, alone bigint, parity array<bigint>, parts array<array<bigint>>"), "jaccard-sets")
    if sets.groupBy("key").count().where("count > 1").isEmpty():
        return sets
    return materialise(sets.dropDuplicates(["key"]), "jaccard-sets")  # rows repeated in full


def unmatched(sets: DataFrame, grams: str | Column) -> DataFrame:
    """``half, alone``: how many of a set's ``grams``, an array, no other set has.

    A shingle is one set's own if the least and the greatest half key that hold it are the same;
    they are aggregated before the shuffle and after, so copies and common shingles cost one row a task.
    """
    ends = sets.select("half", F.explode(grams).alias("gram")).groupBy("gram").agg(F.min("half").alias("half"), F.max("half").alias("other"))
    return ends.where("half = other").groupBy("half").agg(F.count("*").alias("alone"))


def of_keys(counts: DataFrame, sets: DataFrame) -> DataFrame:
    """``key, alone`` of the ``half, alone`` counts; sets that share half a key, should there be any, are left out."""
    single = sets.groupBy("half").agg(F.min("key").alias("key"), F.count("*").alias("sets")).where("sets = 1")
    return counts.join(single, "half").select("key", "alone")


def with_more_unmatched(sets: DataFrame, known: DataFrame, cuts: range, percent: int) -> DataFrame:
    """The ``key, n, alone`` of ``known`` sets that may still be linked once some more fragments are counted, written once."""
    grams = F.flatten(F.slice("parts", cuts.start + 1, len(cuts)))
    live = sets.select("half", "key", grams.alias("grams")).join(known, "key", "left_semi")
    more = of_keys(unmatched(live, "grams"), sets.select("half", "key")).withColumnRenamed("alone", "more")
    rows = known.join(more, "key", "left").select("key", "n", (F.col("alone") + F.coalesce("more", F.lit(0))).alias("alone"))
    return materialise(rows.where(can_link(F.col("n"), F.col("alone"), percent)), "jaccard-left")


def can_link(n, alone, percent: int) -> Column:
    """Whether a set has enough shingles that others have, too."""
    return 100 * (n - alone) >= percent * n


def mask_word(grams: str, which: int) -> Column:
    """Word ``which`` of the ``64 * MASKS`` bits that an array of shingles sets, one each."""
    mine = F.filter(grams, lambda g: F.shiftrightunsigned(g, 6).bitwiseAND(F.lit(MASKS - 1)) == which)
    one = F.lit(1).cast("bigint")
    return F.aggregate(mine, F.lit(0).cast("bigint"), lambda mask, g: mask.bitwiseOR(F.call_function("shiftleft", one, g.bitwiseAND(F.lit(63)).cast("int"))))


def overlaps(pairs: DataFrame, sets: DataFrame, differences: bool = False) -> DataFrame:
    """The ``(a, b, n_a, n_b)`` pairs with ``common``, how many shingles their sets share, written once.

    Overlaps are counted in each fragment of the shingle order on its own, and summed per pair;
    a task holds two fragments of two sets, however long the texts are. With ``differences`` also
    ``mask_0`` and so on: ``64 * MASKS`` bits, those of the shingles that only one of the two has.
    """
    needed = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    segments = sets.join(needed, "key", "left_semi").select("key", F.posexplode("parts").alias("fragment", "grams"))
    segments = materialise(segments, "jaccard-segments")
    left = segments.select(F.col("key").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    right = segments.select(F.col("key").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    met = pairs.join(left, "a").join(right, ["b", "fragment"])
    aggregates = {"common": (F.size(F.array_intersect("grams_a", "grams_b")), F.sum)}
    if differences:
        met = met.withColumn("apart", F.concat(F.array_except("grams_a", "grams_b"), F.array_except("grams_b", "grams_a")))
        aggregates |= {f"mask_{i}": (mask_word("apart", i), F.bit_or) for i in range(MASKS)}
    partial = met.select("a", "b", "n_a", "n_b", *[c.alias(n) for n, (c, _) in aggregates.items()])
    return materialise(partial.groupBy("a", "b", "n_a", "n_b").agg(*[f(n).alias(n) for n, (_, f) in aggregates.items()]), "jaccard-overlaps")


def may_match(n_a: Column, alone_a: Column, n_b: Column, alone_b: Column, percent: int) -> Column:
    """Whether sizes and unmatched shingles allow two sets to be linked."""
    most = F.least(n_a - alone_a, n_b - alone_b)
    return 100 * most >= percent * (n_a + n_b - most)


def similar(percent: int) -> Column:
    return 100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))


def in_buckets(entries: DataFrame, percent: int) -> DataFrame:
    """``gram, key, n, alone, parity, hub, near`` of every set that shares a prefix shingle, written once.

    The hub is the set with the fewest unmatched shingles, which near copies of one text have in
    common, so that all their shingles have the same hub. ``near`` tells whether the sizes and
    unmatched shingles of the two allow a link.
    """
    hubs = entries.groupBy("gram").agg(F.min(F.struct("alone", "key", "n")).alias("hub"), F.count("*").alias("sets")).where("sets > 1")
    near = may_match(F.col("n"), F.col("alone"), F.col("hub.n"), F.col("hub.alone"), percent)
    return materialise(entries.join(hubs.select("gram", "hub"), "gram").withColumn("near", near), "jaccard-buckets")


def ordered_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct ``a, b, n_a, n_b`` with the lesser key first."""
    low = F.col("a") < F.col("b")
    return pairs.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(low, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.when(low, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b")).distinct()


def far_pairs(buckets: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components, one of them not near the hub of a shingle that they share.

    Sizes, unmatched shingles and parity bits have to allow a link.
    """
    far = buckets.where(~F.col("near")).select("gram", *[F.col(c).alias(f"{c}_a") for c in ("key", "n", "alone", "parity")])
    two = buckets.select("gram", *[F.col(c).alias(f"{c}_b") for c in ("key", "n", "alone", "parity")])
    size = F.col("n_a") + F.col("n_b")
    apart = sum(F.bit_count(F.get("parity_a", F.lit(i)).bitwiseXOR(F.get("parity_b", F.lit(i)))) for i in range(PARITY))
    fits = may_match(F.col("n_a"), F.col("alone_a"), F.col("n_b"), F.col("alone_b"), percent) & ((100 + percent) * (size - apart) >= 2 * percent * size)
    pairs = ordered_pairs(far.join(two, "gram").where((F.col("key_a") != F.col("key_b")) & fits).select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), "n_a", "n_b"))
    for side in "ab":
        own = parts.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return pairs.where("root_a <> root_b").select("a", "b", "n_a", "n_b")


def loose_pairs(compared: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one hub that are in different components and may be linked.

    Of the components among a hub's members the largest stays where it is; members of the others
    meet all members. What two sets share follows from how each differs from the hub, up to the
    overlap of the two differences, and that is bounded by the masks: sets that lie around the
    hub in different directions are told apart here, and few pairs leave the join.
    """
    part = F.coalesce("root", F.col("b"))
    rows = compared.join(parts, F.col("b") == F.col("node"), "left").withColumn("part", part).drop("node", "root")
    own = rows.select("a").distinct().join(parts, F.col("a") == F.col("node"), "left").select("a", F.coalesce("root", "a").alias("part"))
    held = rows.select("a", "part").unionByName(own).groupBy("a", "part").agg(F.count("*").alias("sets"))
    main = held.groupBy("a").agg(F.max(F.struct("sets", "part")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("a", F.col("main.part").alias("main"))
    masks = [f"mask_{i}" for i in range(MASKS)]
    apart = F.col("n_a") + F.col("n_b") - 2 * F.col("common")
    bits = sum((F.bit_count(m) for m in masks[1:]), F.bit_count(masks[0]))
    rows = materialise(rows.join(main, "a").select(
        F.col("a").alias("hub"), F.col("b").alias("key"), F.col("n_b").alias("n"), "part", "main", (F.col("n_b") - apart).alias("kept"), (apart - bits).alias("hidden"), *masks), "jaccard-open")
    one = rows.where("part <> main").select("hub", *[F.col(c).alias(f"{c}_a") for c in ("key", "part", "n", "kept", "hidden", *masks)])
    two = rows.select("hub", *[F.col(c).alias(f"{c}_b") for c in ("key", "part", "n", "kept", "hidden", *masks)])
    met = sum((F.bit_count(F.col(f"{m}_a").bitwiseAND(F.col(f"{m}_b"))) for m in masks), F.least("hidden_a", "hidden_b"))
    # n_a + n_b - apart_a - apart_b, plus twice what the differences share, is twice what the sets share.
    twice = F.col("kept_a") + F.col("kept_b") + 2 * met
    pairs = one.join(two, "hub").where((F.col("part_a") != F.col("part_b")) & (100 * twice >= percent * (2 * (F.col("n_a") + F.col("n_b")) - twice)))
    return ordered_pairs(pairs.select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), "n_a", "n_b"))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Sets of word shingles are linked from a Jaccard similarity of ``percent`` on; the component's
    id is the least ``doc_id`` reachable by links. No link between different texts is lost, and
    none is added:

    * Equal sets are one. Shingles that one set alone has are counted, first in some fragments of the
      order for all sets, then in all of them for the sets left; a set with too many of its own
      has no link.
    * Two linked sets share one of the first ``n - ceil(n * percent / 100) + 1`` shingles of the
      order. Sets that share one are compared with the most central of them, where sizes and
      unmatched shingles allow a link; then sets of different components with each other, unless
      these, or their differences from that set, rule a link out.
    * A comparison counts the overlap fragment by fragment and sums up.

    Words are lower-cased in A-Z. A text with fewer words is one shingle; without words, or
    missing, it has none and is linked with nothing, so its component is its own id. Null ids
    count as greater than any; a component of null ids has a null id. Repeated rows and ties are
    all returned. Texts of any length count whole. An empty table gives no rows. Extra columns are ignored.
    """
    rows = materialise(signed(docs, words), "jaccard-rows")
    owners = materialise(rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("owner"), F.first("n").alias("n")), "jaccard-owners")
    halves = owners.withColumn("half", F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("bigint"))
    alone = of_keys(unmatched(first_fragments(docs, words), "grams"), halves)
    left = owners.join(alone, "key", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
    sets = whole_sets(left.where(can_link(F.col("n"), F.col("alone"), percent)), docs, words)
    known = sets.select("key", "n", "alone")
    for cuts in (range(FIRST, 2 * FIRST), range(2 * FIRST, 1 << CUTS)):
        known = with_more_unmatched(sets, known, cuts, percent)
    prefix = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    entries = sets.select("key", "parity", F.slice(F.flatten("parts"), F.lit(1), prefix).alias("prefix")).join(known, "key").select("key", "n", "alone", "parity", F.explode("prefix").alias("gram"))
    entries = materialise(entries, "jaccard-entries")

    buckets = in_buckets(entries, percent)
    members = buckets.where(F.col("near") & (F.col("key") != F.col("hub.key"))).select(
        F.col("hub.key").alias("a"), F.col("key").alias("b"), F.col("hub.n").alias("n_a"), F.col("n").alias("n_b")).distinct()
    compared = overlaps(materialise(members, "jaccard-members"), sets, differences=True)
    links = compared.where(similar(percent)).select("a", "b")
    parts = components(links)
    more = loose_pairs(compared, parts, percent).unionByName(far_pairs(buckets, parts, percent)).distinct()
    more = materialise(more, "jaccard-loose")
    if not more.isEmpty():
        parts = components(links.unionByName(overlaps(more, sets).where(similar(percent)).select("a", "b")))

    classes = owners.join(parts, F.col("key") == F.col("node"), "left").select("key", "owner", F.coalesce("root", "key").alias("root"))
    named = classes.join(classes.groupBy("root").agg(F.min("owner").alias("least")), "root").select("key", "least")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "key").join(named, "key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
