import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from lodestar.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, n_chars):
    return h(*[field(v) for v in (row.doc_id, row.source, row.lang, n_chars, row.text)])


def tree_of(leaves):
    """All levels of a tree, and each leaf's siblings as (side, digest)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(*row[i:i + 2]) for i in range(0, len(row), 2)])
    ways = []
    for i in range(len(leaves)):
        way = []
        for row in levels[:-1]:
            other = i ^ 1
            way.append(("", "") if other >= len(row) else ("left" if i & 1 else "right", row[other]))
            i >>= 1
        ways.append(way)
    return levels[-1][0], ways


def brute_force(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r.lang, []).append(r)
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    made = {}
    for lang in order:
        own = sorted(trees[lang], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.n_chars)))
        made[lang] = (own, *tree_of([leaf_of(r, r.n_chars) for r in own]))
    root, tops = tree_of([made[lang][1] for lang in order])
    found = []
    for lang, top in zip(order, tops):
        own, subroot, ways = made[lang]
        for r, way in zip(own, ways):
            leaf = leaf_of(r, r.n_chars)
            bad = r.doc_id is not None and r.n_chars is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            end = leaf_of(r, r.n_chars + 1) if bad else leaf
            for side, sibling in way + top:
                end = h(end) if not side else h(sibling, end) if side == "left" else h(end, sibling)
            found.append((r.doc_id, leaf, subroot, root, h(*[s for _, s in way + top]), end, end == root))
    return found


def test_addresses_fill_the_block_and_keep_subtrees_together():
    for levels in range(1, 12):
        places = [merkle.address(levels, depth, at) for depth in range(levels) for at in range(1 << depth)]
        assert sorted(places) == list(range((1 << levels) - 1))
    # Six levels: the top three stand first, then each of the eight lower parts in one run.
    for at in range(8):
        part = [merkle.address(6, 3 + d, (at << d) + i) for d in range(3) for i in range(1 << d)]
        assert sorted(part) == list(range(7 + 7 * at, 14 + 7 * at))


@pytest.mark.parametrize("leaves", [1, 2, 3, 5, 8, 13, 16])
def test_block_agrees_with_levels(leaves):
    digests = [sha256(bytes([i])).digest() for i in range(leaves)]
    block = merkle.Block.build(digests, merkle.height_of(leaves))
    root, ways = tree_of([d.hex() for d in digests])
    assert block.root.hex() == root
    again = merkle.Block.load(block.height, leaves, block.nodes.tobytes())
    for i, way in enumerate(ways):
        assert [s.hex() for side, s in merkle.steps(again.path(i)) if side] == [s for side, s in way if side]
        assert merkle.folded(digests[i], again.path(i)).hex() == root
        assert merkle.folded(digests[i - 1] + b"x", again.path(i)).hex() != root


@pytest.mark.parametrize("height", [1, 2, 10])
def test_given_documents_in_blocks_of_any_height(spark, given, height):
    docs, _ = given
    got = merkle.manifest(docs, height=height)
    assert sorted(map(tuple, got.collect())) == sorted(brute_force(docs.collect()))


def test_odd_documents(odd, nothing):
    got = sorted(map(tuple, merkle.manifest(odd, height=2).collect()), key=repr)
    assert got == sorted(brute_force(odd.select("doc_id", "source", "lang", "n_chars", "text").collect()), key=repr)
    assert merkle.manifest(nothing).count() == 0


def test_one_language_and_one_row(spark, given):
    docs, _ = given
    one = docs.orderBy("doc_id").limit(1)
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == h()
    same = docs.withColumn("lang", F.lit(None).cast("string"))
    assert sorted(map(tuple, merkle.manifest(same, height=3).collect())) == sorted(brute_force(same.collect()))
