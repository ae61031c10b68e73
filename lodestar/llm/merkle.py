"""A Merkle manifest of a dataset, its trees stored in blocks of van Emde Boas layout."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.ordering import numbered
from ..session import materialise

# A block is an aligned subtree of so many levels of hashing, at most 2**HEIGHT leaves.
HEIGHT = 10
_NONE, _LEFT, _RIGHT = 0, 1, 2  # on which side of the path the sibling stands
_STEP = 33  # bytes of one step of a path: the side and the sibling's digest


def address(levels: int, depth: int, at):
    """Place of node ``at`` of ``depth`` (the root is 0) in a van Emde Boas layout of ``levels`` levels.

    A tree is cut at half height: the top part comes first, then the bottom parts from left to
    right, each laid out in the same way. ``at`` may be an array.
    """
    place = 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        levels, depth = levels - top, depth - top
        place = place + (1 << top) - 1 + (at >> depth) * ((1 << levels) - 1)
        at = at & ((1 << depth) - 1)
    return place


def joined(digests: list[bytes]) -> bytes:
    """The hash of digests as hex text, concatenated."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def height_of(leaves: int) -> int:
    """Rounds of pairing that leave one node of so many."""
    return max(0, leaves - 1).bit_length()


class Block:
    """An aligned subtree: its nodes in one array of 32-byte digests, in van Emde Boas order.

    The leaves may be fewer than ``2**height``; a node is there if a leaf is below it, and one
    without a sibling is hashed alone.
    """

    def __init__(self, height: int, count: int, nodes):
        self.height, self.count = height, count
        self.nodes = nodes

    @classmethod
    def build(cls, leaves: list[bytes], height: int) -> Block:
        self = cls(height, len(leaves), np.zeros(((2 << height) - 1, 32), np.uint8))
        row = leaves
        for level in range(height + 1):
            if level:
                row = [joined(row[i:i + 2]) for i in range(0, len(row), 2)]
            self.nodes[address(height + 1, height - level, np.arange(len(row)))] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, 32)
        return self

    @classmethod
    def load(cls, height: int, count: int, stored: bytes) -> Block:
        return cls(height, count, np.frombuffer(stored, np.uint8).reshape(-1, 32))

    def node(self, level: int, at: int) -> bytes:
        return self.nodes[address(self.height + 1, self.height - level, at)].tobytes()

    @property
    def root(self) -> bytes:
        return self.node(self.height, 0)

    def path(self, leaf: int) -> bytes:
        """The steps from a leaf to the root: side and digest of the sibling at every level."""
        steps = []
        for level in range(self.height):
            at, held = leaf >> level, -(-self.count >> level)
            if at ^ 1 >= held:
                steps.append(bytes(_STEP))
            else:
                steps.append(bytes([_LEFT if at & 1 else _RIGHT]) + self.node(level, at ^ 1))
        return b"".join(steps)


def steps(path: bytes) -> Iterator[tuple[int, bytes]]:
    for i in range(0, len(path), _STEP):
        yield path[i], path[i + 1:i + _STEP]


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for side, sibling in steps(path):
        digest = joined([digest] if side == _NONE else [sibling, digest] if side == _LEFT else [digest, sibling])
    return digest


def proof(path: bytes) -> str:
    """The hash of the siblings of a path."""
    return joined([sibling for side, sibling in steps(path) if side != _NONE]).hex()


def leaf_text(*columns) -> F.Column:
    """The columns one after the other, each ``-`` if null, else its UTF-8 length, a colon and its value."""
    return F.concat(*[F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns])


def digest_of(*columns) -> F.Column:
    return F.unhex(F.sha2(leaf_text(*columns).cast("binary"), 256))


_BLOCKS = "tree string, block bigint, height int, count int, total bigint, ids array<{id}>, changed array<binary>, nodes binary"


def blocks_of(leaves: DataFrame, height: int) -> DataFrame:
    """The blocks of every tree's lowest ``height`` levels, written once.

    ``leaves`` has ``tree, at, total, id, digest, changed``: the place in its tree, the number of the
    tree's leaves, the digest and, where it differs, the digest after tampering. A tree of one
    block ends at its root; other blocks are hashed ``height`` times, however few leaves they have.
    Leaves are dealt by block, so a tree of any size is spread, and a task holds one block.
    """
    rows = leaves.withColumn("block", F.shiftright("at", height))
    rows = rows.select("tree", "block", "at", "total", "id", "digest", "changed").repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    schema = _BLOCKS.format(id=leaves.schema["id"].dataType.simpleString())
    kind = leaves.schema["id"].dataType.simpleString()
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

    def made(name, held):
        total, leaf_digests = held[0][0], [r[2] for r in held]
        own = min(height, height_of(total))
        block = Block.build(leaf_digests, own)
        return [*name, own, len(held), total, [r[1] for r in held], [r[3] for r in held], block.nodes.tobytes()]

    def batch_of(rows):
        columns = list(zip(*rows))
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(arrow_id), pa.list_(pa.binary()), pa.binary()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["tree", "block", "height", "count", "total", "ids", "changed", "nodes"])

    def work(batches):
        last, held, ready = None, [], []
        for batch in batches:
            tree, block, _, total, ids, digest, changed = (c.to_pylist() for c in batch.columns)
            for row in zip(tree, block, total, ids, digest, changed):
                if row[:2] != last:
                    if held:
                        ready.append(made(last, held))
                    last, held = row[:2], []
                    if len(ready) == 64:
                        yield batch_of(ready)
                        ready = []
                held.append(row[2:])
        if held:
            ready.append(made(last, held))
        if ready:
            yield batch_of(ready)

    return materialise(rows.mapInArrow(work, schema), "merkle-blocks")


def block_roots(blocks: DataFrame) -> DataFrame:
    """``tree, at, digest, height`` of every block's root, read at its place in the layout."""

    def work(batches):
        for batch in batches:
            tree, block, height, nodes = (batch.column(n) for n in ("tree", "block", "height", "nodes"))
            found = []
            for h, stored in zip(height.to_pylist(), nodes):
                place = address(h + 1, 0, 0) * 32
                found.append(stored.as_buffer()[place:place + 32].to_pybytes())
            yield pa.record_batch([tree, block, pa.array(found, pa.binary())], ["tree", "at", "digest"])

    return blocks.select("tree", "block", "height", "nodes").mapInArrow(work, "tree string, at bigint, digest binary")


def layers_of(leaves: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """Blocks layer by layer, the roots of one layer's blocks being the leaves of the next, and ``tree, root``.

    A layer has ``2**height`` times fewer rows than the one below. Trees that end early leave.
    """
    layers, roots = [], None
    while True:
        blocks = blocks_of(leaves, height)
        layers.append(blocks)
        tops = block_roots(blocks.where(F.col("total") <= 1 << height)).select("tree", F.col("digest").alias("root"))
        roots = tops if roots is None else roots.unionByName(tops)
        more = blocks.where(F.col("total") > 1 << height)
        if more.isEmpty():
            return layers, roots
        above = more.select("tree", F.col("block").alias("at"), F.ceil(F.col("total") / (1 << height)).cast("bigint").alias("total"))
        leaves = block_roots(more).join(above, ["tree", "at"]).select(
            "tree", "at", "total", F.lit(None).cast("bigint").alias("id"), "digest", F.lit(None).cast("binary").alias("changed"))


def paths_down(layers: list[DataFrame], upper: DataFrame, height: int) -> DataFrame:
    """The lowest blocks with ``path``: the steps from their root to the very root.

    ``upper`` has ``tree, path`` from the root of each tree on. Every layer's blocks hand down to
    the blocks below what a path from there to the top is, one short row per block.
    """

    def handed(batches):
        for batch in batches:
            trees, ats, found = [], [], []
            for r in batch.to_pylist():
                block = Block.load(r["height"], r["count"], r["nodes"])
                for i in range(r["count"]):
                    trees.append(r["tree"])
                    ats.append((r["block"] << height) + i)
                    found.append(block.path(i) + r["path"])
            yield pa.record_batch([pa.array(trees, pa.string()), pa.array(ats, pa.int64()), pa.array(found, pa.binary())], ["tree", "block", "path"])

    known = None
    for blocks in reversed(layers):
        rows = blocks.where(F.col("total") <= 1 << height).join(upper, "tree")
        if known is not None:
            rows = rows.unionByName(blocks.join(known, ["tree", "block"]))
        if blocks is layers[0]:
            return rows
        known = materialise(rows.select("tree", "block", "height", "count", "nodes", "path").mapInArrow(handed, "tree string, block bigint, path binary"), "merkle-paths")


def results(blocks: DataFrame, id_type: str) -> DataFrame:
    """``id, tree, leaf, proof_sha256, folded_root`` of every leaf of blocks that know their way up."""

    def work(batches):
        for batch in batches:
            for r in batch.to_pylist():
                block = Block.load(r["height"], r["count"], r["nodes"])
                up = folded(block.root, r["path"])  # the same for every leaf that leads to the block's root
                leaves, proofs, ends = [], [], []
                for i, changed in enumerate(r["changed"]):
                    leaf, path = block.node(0, i), block.path(i)
                    root = folded(changed or leaf, path)
                    leaves.append(leaf.hex())
                    proofs.append(proof(path + r["path"]))
                    ends.append((up if root == block.root else folded(root, r["path"])).hex())
                n = r["count"]
                yield pa.record_batch(
                    [pa.array(r["ids"], batch.schema.field("ids").type.value_type), pa.array([r["tree"]] * n, pa.string()), pa.array(leaves, pa.string()), pa.array(proofs, pa.string()),
                     pa.array(ends, pa.string())], ["id", "tree", "leaf", "proof_sha256", "folded_root"])

    return blocks.select("tree", "height", "count", "ids", "changed", "nodes", "path").mapInArrow(
        work, f"id {id_type}, tree string, leaf string, proof_sha256 string, folded_root string")


def manifest(docs: DataFrame, height: int = HEIGHT, every: int = 7) -> DataFrame:
    """A Merkle tree per language, their roots joined by one more tree, and a proof for every row.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``. A leaf is the hash of
    ``doc_id, source, lang, n_chars, text``; the leaves of a language stand in the order of
    ``doc_id``, and two neighbours at a time (the last maybe alone) become one node, until one is
    left. Rows whose id has a checksum divisible by ``every`` are tampered with: one is added to
    ``n_chars``, and the root is recomputed from that leaf with the siblings as they were.

    Null ids come first in their language and are not tampered with, nor are rows without
    ``n_chars``. A missing language has a tree of its own, first in order. Ties of ``doc_id`` are ordered by leaf, and
    repeated rows are leaves of their own. Texts of any length count whole; empty and missing
    ones differ. An empty table gives no rows. Extra columns are ignored.

    Subtrees of ``2**height`` leaves are blocks, rows of a written table, with their nodes in van
    Emde Boas order; the same arithmetic places nodes when a block is built and finds siblings
    afterwards. Roots of blocks are the leaves of the next layer of blocks.
    """
    spark = docs.sparkSession
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    bad = (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(every)) == 0) & F.col("n_chars").isNotNull()
    more = [F.col("n_chars") + 1 if i == 3 else c for i, c in enumerate(fields)]
    rows = docs.select(
        F.col("doc_id").alias("id"), leaf_text(F.col("lang")).alias("tree"), F.col("lang"), digest_of(*fields).alias("digest"),
        F.when(bad, digest_of(*more)).alias("changed"))
    order = [F.col("lang").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest").asc()]
    rows = numbered(rows, order, "merkle-leaves")
    trees = materialise(rows.groupBy("tree", "lang").agg(F.min("rank").alias("first"), F.count("*").alias("total")), "merkle-trees")
    leaves = rows.drop("lang").join(trees.drop("lang"), "tree").withColumn("at", F.col("rank") - F.col("first"))

    layers, subroots = layers_of(leaves, height)
    subroots = materialise(subroots, "merkle-subroots")
    tops = numbered(subroots.join(trees, "tree").select("lang", "root", "tree"), [F.col("lang").asc_nulls_first()], "merkle-tops")
    total = tops.count()
    upper = tops.select(F.lit("").alias("tree"), F.col("rank").alias("at"), F.lit(total).cast("bigint").alias("total"), F.col("tree").alias("id"),
                        F.col("root").alias("digest"), F.lit(None).cast("binary").alias("changed"))
    top_layers, top = layers_of(upper, height)
    top = top.select(F.lower(F.hex("root")).alias("root")).first()
    start = spark.createDataFrame([("", b"")], "tree string, path binary")
    top_blocks = paths_down(top_layers, start, height)

    def ways(batches):
        for batch in batches:
            for r in batch.to_pylist():
                block = Block.load(r["height"], r["count"], r["nodes"])
                yield pa.record_batch([pa.array(r["ids"], pa.string()), pa.array([block.path(i) + r["path"] for i in range(r["count"])], pa.binary())], ["tree", "path"])

    ways_up = materialise(top_blocks.select("ids", "height", "count", "nodes", "path").mapInArrow(ways, "tree string, path binary"), "merkle-ways")
    lowest = paths_down(layers, ways_up, height)
    found = results(lowest, rows.schema["id"].dataType.simpleString()).join(subroots.withColumnRenamed("root", "_subroot"), "tree")
    root = F.lit(top.root if top else None).cast("string")
    return found.select(
        F.col("id").alias("doc_id"), "leaf", F.lower(F.hex("_subroot")).alias("subroot"), root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"))
