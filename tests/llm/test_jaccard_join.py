import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import graph, jaccard_join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i:i + 4]) for i in range(len(words) - 3)} or ({tuple(words)} if words else set())


def brute_force(texts):
    """``(id, set size, component)`` of ``(id, text)`` rows, by all pairs."""
    sets = [shingles(t) for _, t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(texts)), key=repr)


def found(docs):
    return sorted(map(tuple, jaccard_join.jaccard_components(docs).collect()), key=repr)


def test_given_documents(given):
    docs, texts = given
    assert found(docs) == brute_force(texts)


def test_odd_documents(odd, texts, nothing):
    assert found(odd) == brute_force(texts)
    assert jaccard_join.jaccard_components(nothing).count() == 0


def hot_groups(seed):
    """Variants around texts that are not there themselves, and texts that mostly consist of one passage."""
    draw = random.Random(seed)
    rows = []
    for size, copies in ((60, 60), (160, 120), (12, 25)):
        base = [f"b{size}x{i}" for i in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(draw.randint(0, 4)):
                words[draw.randrange(size)] = f"e{draw.randrange(10 ** 6)}"
            if draw.random() < 0.3:
                del words[:draw.randint(1, 3)]
            rows.append(" ".join(words))
    passage = " ".join(f"p{i}" for i in range(55))
    rows += [passage + " " + " ".join(f"u{draw.randrange(10 ** 6)}" for _ in range(draw.randint(0, 9))) for _ in range(60)]
    rows += ["one two three", "ONE two\tthree", "one two three four", "one two three four five", "É two three four", "é two three four"]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_groups_lose_no_link(spark, seed):
    rows = hot_groups(seed)
    want = brute_force(rows)
    assert len({c for _, _, c in want}) < len(rows) - 50
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)) == want


def test_masks_hold_every_shingle(spark):
    grams = [random.Random(3).getrandbits(64) - (1 << 63) for _ in range(300)]
    row = spark.createDataFrame([(grams,)], "g array<bigint>").select(*[jaccard_join.mask_word("g", i).alias(f"m{i}") for i in range(jaccard_join.MASKS)]).first()
    want = [0] * jaccard_join.MASKS
    for g in grams:
        want[g >> 6 & 3] |= 1 << (g & 63)
    assert [m & (1 << 64) - 1 for m in row] == want


def test_parity_bounds_the_difference():
    draw = random.Random(5)
    for n in (3, 60, 500):
        x, y = ({draw.getrandbits(64) - (1 << 63) for _ in range(n)} for _ in range(2))
        for other in (y, x | set(list(y)[:2]), x):
            bits = [jaccard_join.parity(np.array(sorted(s), np.int64)).view(np.uint64) for s in (x, other)]
            differ = sum(int(a).bit_count() for a in bits[0] ^ bits[1])
            assert differ <= len(x ^ other) and (differ - len(x ^ other)) % 2 == 0


def test_overlaps_are_sums_over_fragments(spark):
    a, b = (" ".join(f"w{i}" for i in r) for r in (range(500), range(100, 640)))
    sets = [(jaccard_join.set_key(g), len(g), [p.tolist() for p in jaccard_join.fragments(g)]) for g in jaccard_join.shingle_sets(pa.array([a, b]))]
    assert all(len(s[2]) == 1 << jaccard_join.CUTS and sum(map(len, s[2])) == s[1] for s in sets)
    frame = spark.createDataFrame(sets, "key binary, n bigint, parts array<array<bigint>>")
    pairs = spark.createDataFrame([(sets[0][0], sets[1][0], sets[0][1], sets[1][1])], "a binary, b binary, n_a bigint, n_b bigint")
    assert jaccard_join.overlaps(pairs, frame).first().common == len(shingles(a) & shingles(b))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)] + [(0, 500 + i) for i in range(50)]
    edges = [e for e in edges if e[0] != e[1]]
    least = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(least[a], least[b])
            changed |= least[a] != least[b]
            least[a] = least[b] = low
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(9))
    assert {r.node: r.root for r in got.collect()} == {n: m for n, m in least.items() if n != m}
    assert graph.components(spark.createDataFrame([], "a binary, b binary")).count() == 0
    assert got.select(F.count("*"), F.countDistinct("node")).first()[0] == len([n for n in least if least[n] != n])
