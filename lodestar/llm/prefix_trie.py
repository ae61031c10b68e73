"""The prefix trie of rebuilt conversations, by collapsing whole sequences first."""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.ordering import numbered
from ..session import materialise
from .wording import words

# Turns, and ids of an end list, are taken together in runs of so many.
RUN = 4096


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, digest, words`` of every turn, ``at`` from 1: its place in its conversation.

    Places come from a range shuffle of digests, so a conversation of any length is spread.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.size(words(text)).cast("bigint").alias("words"))
    placed = numbered(turns, ["conv_id", F.col("turn").asc_nulls_first(), "digest"], "trie-turns")
    firsts = placed.groupBy("conv_id").agg(F.min("rank").alias("first"))
    return placed.join(firsts, "conv_id").select("conv_id", (F.col("rank") - F.col("first") + 1).alias("at"), "digest", "words")


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Turns of the rebuilt conversations: the first ``h`` of the conversation at the head of the group, then own ones after ``h``.

    ``h`` is the id's checksum modulo ``most``. Heads give at most ``most - 1`` rows each, which
    meet the ids of their group; nothing else is copied.
    """
    head = F.col("conv_id") - F.col("conv_id") % group
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    ids = turns.where("at = 1").select("conv_id", head.alias("head"), taken.alias("h"))
    shared = turns.where((F.col("at") < most) & (F.col("conv_id") == head)).select(F.col("conv_id").alias("head"), "at", "digest", "words")
    copied = ids.join(shared, "head").where("at <= h").select("conv_id", "at", "digest", "words")
    held = ids.join(shared.groupBy("head").agg(F.max("at").alias("there")), "head", "left").select(
        "conv_id", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("before"))
    own = turns.join(held, "conv_id").where("at > h").select("conv_id", (F.col("at") - F.col("h") + F.col("before")).alias("at"), "digest", "words")
    return copied.unionByName(own)


def running(rows: DataFrame, key: str, columns: dict[str, Column], after: bool = False) -> DataFrame:
    """Running aggregates along ``at`` within ``key``, from the start, or from each row to the end.

    ``columns`` names the aggregates, each its own combiner (sum, xor). Runs of ``RUN`` rows are aggregated first,
    then the runs, so the rows of a long key are shared out.
    """
    order = F.col("at").desc() if after else F.col("at")
    rows = rows.withColumn("_run", F.floor(F.col("at") / RUN))
    inner = W.partitionBy(key, "_run").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    run_order = F.col("_run").desc() if after else F.col("_run")
    outer = W.partitionBy(key).orderBy(run_order).rowsBetween(W.unboundedPreceding, -1)
    runs = rows.groupBy(key, "_run").agg(*[f(c).alias(c) for c, f in columns.items()])
    runs = runs.select(key, "_run", *[f(c).over(outer).alias(f"_{c}") for c, f in columns.items()])
    rows = rows.withColumns({c: f(c).over(inner) for c, f in columns.items()}).join(runs, [key, "_run"])

    def both(c, f):
        total = F.coalesce(F.col(f"_{c}"), F.lit(0))
        return F.col(c) + total if f is F.sum else F.col(c).bitwiseXOR(total)

    return rows.withColumns({c: both(c, f) for c, f in columns.items()}).drop("_run", *[f"_{c}" for c in columns])


def sequence_rows(turns: DataFrame) -> DataFrame:
    """Every turn with ``one, two``: hashes that stand for the whole sequence up to it.

    A sequence is the set of its (place, turn) pairs, so its hash is the xor of theirs, 128 bits.
    """
    hashes = {name: F.xxhash64(F.lit(name), "at", "digest") for name in ("one", "two")}
    return running(turns.withColumns(hashes), "conv_id", {"one": F.bit_xor, "two": F.bit_xor}).drop("digest")


def end_lists(members: DataFrame) -> DataFrame:
    """``one, two, ends_sha256`` of ``(one, two, conv_id)``: the hash of the ids, ascending, joined by commas.

    Ids are joined run by run first; a sequence's runs then pass one hash in order, so a sequence
    that a third of all conversations share costs its task one row per ``RUN`` ids, held one at a time.
    """
    placed = numbered(members, ["one", "two", "conv_id"], "trie-ends")
    runs = placed.groupBy("one", "two", F.floor(F.col("rank") / RUN).alias("run")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    runs = runs.select("one", "two", "run", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("joined"))
    runs = runs.repartition("one", "two").sortWithinPartitions("one", "two", "run")

    def work(batches):
        last, state, done = None, None, []

        def batch():
            return pa.record_batch([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.string())],
                                   ["one", "two", "ends_sha256"])

        for part in batches:
            for one, two, joined in zip(*(part.column(n).to_pylist() for n in ("one", "two", "joined"))):
                if (one, two) == last:
                    state.update(b",")
                else:
                    if last:
                        done.append((*last, state.hexdigest()))
                    last, state = (one, two), sha256()
                state.update(joined.encode())
            if done:
                yield batch()
                done = []
        if last:
            done.append((*last, state.hexdigest()))
            yield batch()

    return runs.mapInArrow(work, "one bigint, two bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Returns ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``:
    the least member, the number of turns, the parent's least member (the root has none), members,
    children, childless nodes below, words that sharing the nodes below saves, and the hash of the
    ids that end here.

    Identical rebuilt conversations become one weighted sequence with the list of its ends.
    Sequences that are proper prefixes of others leave by an anti-join; the rest are the leaves.
    Weighted prefixes of sequences are then aggregated, partly before each shuffle, so a first
    turn that all share costs no task more than its own rows.

    Null turns come first; ties of ``turn`` are ordered by role and text; rows repeated in full are
    turns of their own. A missing role or text is empty. Rows without ``conv_id`` belong to no
    conversation. Texts of any length count whole. Without conversations there is no node. Extra columns are ignored.
    """
    turns = materialise(ordered_turns(conversations), "trie-ordered")
    ids = turns.where("at = 1").select("conv_id")
    rows = materialise(sequence_rows(rebuilt(turns)), "trie-rows")

    # Whole sequences: their hash is that of their last turn; conversations without turns end at the root.
    lengths = rows.groupBy("conv_id").agg(F.max(F.struct("at", "one", "two")).alias("last"))
    whole = ids.join(lengths, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col(f"last.{c}"), F.lit(0)).cast("bigint").alias(c) for c in ("one", "two")], F.coalesce("last.at", F.lit(0)).cast("bigint").alias("length"))
    whole = materialise(whole, "trie-whole")
    sequences = whole.groupBy("one", "two", "length").agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"))
    sequences = materialise(sequences, "trie-sequences")

    # The turns of one conversation per sequence, each a prefix; the root is the empty one.
    steps = rows.join(sequences.select("conv_id", "weight"), "conv_id")
    before = steps.select("conv_id", (F.col("at") + 1).alias("at"), F.col("one").alias("parent_one"), F.col("two").alias("parent_two"))
    steps = steps.join(before, ["conv_id", "at"], "left").select(
        F.col("conv_id").alias("sequence"), "at", "one", "two", "words", "weight",
        *[F.coalesce(f"parent_{c}", F.lit(0)).cast("bigint").alias(f"parent_{c}") for c in ("one", "two")])
    root = sequences.select(F.col("conv_id").alias("sequence"), F.lit(0).cast("bigint").alias("at"), *[F.lit(0).cast("bigint").alias(c) for c in ("one", "two")],
                            F.lit(0).cast("bigint").alias("words"), "weight", *[F.lit(None).cast("bigint").alias(f"parent_{c}") for c in ("one", "two")])
    steps = materialise(steps.unionByName(root), "trie-steps")
    proper = steps.select(F.col("parent_one").alias("one"), F.col("parent_two").alias("two")).distinct()
    leaves = sequences.join(proper, ["one", "two"], "left_anti").select(F.col("conv_id").alias("sequence"), F.lit(1).alias("is_leaf"))

    steps = steps.join(leaves, "sequence", "left")
    nodes = steps.groupBy("one", "two").agg(
        F.min("sequence").alias("conv_id"), F.first("at").alias("depth"), F.sum("weight").alias("n_convs"), F.first("words").alias("words"),
        F.count("is_leaf").alias("n_leaves"), F.first("parent_one").alias("parent_one"), F.first("parent_two").alias("parent_two"))
    nodes = materialise(nodes, "trie-nodes")

    # A node's saving counts at its least sequence; sums from the end of a sequence give every subtree.
    saved = nodes.select(F.col("conv_id").alias("sequence"), F.col("depth").alias("at"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    below = steps.select("sequence", "at", "one", "two").join(saved, ["sequence", "at"], "left").withColumn("saved", F.coalesce("saved", F.lit(0)).cast("bigint"))
    below = running(below, "sequence", {"saved": F.sum}, after=True).groupBy("one", "two").agg(F.sum("saved").alias("saved_tokens"))

    children = nodes.groupBy(F.col("parent_one").alias("one"), F.col("parent_two").alias("two")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("one").alias("parent_one"), F.col("two").alias("parent_two"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(below, ["one", "two"]).join(children, ["one", "two"], "left").join(end_lists(whole.select("one", "two", "conv_id")), ["one", "two"], "left")
    return nodes.join(parents, ["parent_one", "parent_two"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256().hexdigest())).alias("ends_sha256"))
