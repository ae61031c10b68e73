import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import near_dedup


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance():
    draw = random.Random(3)
    for _ in range(4000):
        alphabet = "abcde"[:draw.randint(1, 5)]
        a = [draw.choice(alphabet) for _ in range(draw.randint(0, 14))]
        b = list(a) if draw.random() < 0.6 else [draw.choice(alphabet) for _ in range(draw.randint(0, 14))]
        for _ in range(draw.randint(0, 4)):
            if b and draw.random() < 0.6:
                b.pop(draw.randrange(len(b)))
            if draw.random() < 0.6:
                b.insert(draw.randint(0, len(b)), draw.choice(alphabet))
        most = draw.randint(0, 6)
        distance = edits(a, b)
        assert near_dedup.banded_distance(a, b, most) == (distance if distance <= most else None)


def classes_by_brute_force(rows, least=0.8):
    root = {d: d for d, _ in rows}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    tokens = {d: t.split() for d, t in rows}
    text = dict(rows)
    pairs = []
    ids = sorted(tokens, key=lambda d: len(tokens[d]))
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = tokens[a], tokens[b]
            if len(x) < least * len(y):
                break
            if not x and text[a] != text[b]:
                continue
            if sum((Counter(x) & Counter(y)).values()) >= least * len(y) and near_dedup.similarity(x, y, least) is not None:
                shingles = [{tuple(z[k:k + 5]) for k in range(max(1, len(z) - 4))} for z in (x, y)]
                pairs.append((a, b, len(shingles[0] & shingles[1]) / len(shingles[0] | shingles[1])))
                a_root, b_root = find(a), find(b)
                root[max(a_root, b_root)] = min(a_root, b_root)
    return pairs, {d: find(d) for d in root}


def test_classes_against_brute_force(spark, given):
    docs, rows = given
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    pairs, want = classes_by_brute_force(rows)
    assert all(got[a] == got[b] for a, b, shared in pairs if shared >= 0.6)
    assert sum(got[a] == got[b] for a, b, _ in pairs) >= 0.95 * len(pairs)
    assert all(want[d] == want[c] for d, c in got.items())  # nothing is joined without a chain of links


def test_large_group_and_common_passage(spark):
    draw = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    own = lambda n: [f"w{draw.randrange(10 ** 6)}" for _ in range(n)]
    source = own(80)
    rows = []
    for i in range(300):
        words = list(source)
        words[draw.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(words)))
    for i in range(300, 900):
        rows.append((i, " ".join(own(40) + passage + own(40))))
    twin = rows[650][1].split()
    twin[3] = "changed"
    rows.append((900, " ".join(twin)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    assert {got[i] for i in range(300)} == {0}
    assert got[900] == 650
    assert all(got[i] == i for i in range(300, 900))


def test_members_apart_from_the_hub_meet(spark, monkeypatch):
    """Two texts that share a bucket with a hub unlike both, over several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    words = {k: [f"{k}{i}" for i in range(40)] for k in "abcde"}
    words["c"] = [*words["b"][:39], "other"]
    docs = spark.createDataFrame([(i, " ".join(words[k])) for i, k in enumerate("abcde")], "doc_id bigint, text string")
    made = near_dedup.OrderMinHash()
    rows = docs.select("doc_id", near_dedup.text_key("text").alias("key")).collect()
    key = {"abcde"[r.doc_id]: bytes(r.key) for r in rows}
    nodes = spark.createDataFrame([(key[k], i) for i, k in enumerate("abcde")], "key binary, owner bigint")
    sketch = {k: made(words[k]).tolist() for k in "abcde"}
    band = next(i for i in range(32) if sketch["b"][2 * i:2 * i + 2] == sketch["c"][2 * i:2 * i + 2])
    members = spark.createDataFrame([(7, band, key["a"], 5, key[k], key[k], 40, sketch[k]) for k in "abcde"],
                                    "bucket bigint, band int, hub binary, size bigint, key binary, part binary, n_words int, sketch array<int>")
    got = {(bytes(r.a), bytes(r.b)) for r in near_dedup.links_between_parts(members, docs, nodes, 0.8).collect()}
    assert got == {tuple(sorted((key["b"], key["c"])))}


def test_members_pass_the_same_gate_as_pairs_with_a_hub():
    """Two members that agree in few sketches, with a bucket in common and a hub unlike both."""
    made, draw = near_dedup.OrderMinHash(), random.Random(8)
    source = [f"w{i}" for i in range(100)]
    one, met = np.array(made(source)), 0
    for n in range(60):
        words = list(source)
        for i in draw.sample(range(100), 9):
            words[i] = f"x{n}x{i}"
        two = made(words)
        shared = np.flatnonzero((one == two).reshape(-1, near_dedup.BAND).all(axis=1))
        if not (near_dedup.AGREE <= (one == two).sum() < 16 and len(shared)):
            continue
        other = made([f"h{i}" for i in range(100)])
        group = pa.table({"x": [0] * 3, "y": [0] * 3, "own": [0] * 3, "band": [int(shared[0])] * 3, "key": [b"a", b"b", b"c"],
                          "part": [b"a", b"b", b"c"], "n_words": [100] * 3, "sketch": [v.tolist() for v in (other, one, two)],
                          "is_hub": [True, False, False], "text": ["", " ".join(source), " ".join(words)]})
        assert near_dedup.linked_members(group, 0.8) == [(b"b", b"c")]
        met += 1
    assert met > 10


def test_components_of_a_chain(spark):
    edges = [(str(i).zfill(3).encode(), str(i + 1).zfill(3).encode()) for i in range(40)] + [(b"x", b"y"), (b"y", b"x")]
    got = {bytes(r.node): bytes(r.root) for r in near_dedup.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert set(got.values()) == {b"000", b"x"} and len(got) == 41


def test_odd_documents(spark, odd, texts, nothing):
    got = Counter((r.doc_id, r.class_id) for r in near_dedup.near_classes(odd).select("doc_id", "class_id").collect())
    assert got == Counter({(1, 1): 1, (5, 1): 1, (2, 2): 1, (3, 2): 1, (4, 4): 1, (6, 6): 1, (7, 7): 1, (8, 8): 1, (9, 8): 2, (None, None): 1,
                           (11, 11): 1, (12, 12): 2})
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 4, 6, 7, 8, None, 11, 12, 12])
    assert near_dedup.near_classes(nothing).collect() == [] and near_dedup.keep_one(nothing).collect() == []


def test_repeated_rows_keep_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")] * 5 + [(2, "a b c d e f")], "doc_id bigint, text string")
    assert [tuple(r) for r in near_dedup.keep_one(docs).collect()] == [(1, "a b c d e f")]


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 300])
def test_sketches_have_one_value_each(n):
    sketch = near_dedup.OrderMinHash()([f"w{i}" for i in range(n)])
    assert len(sketch) == (near_dedup.SKETCHES if n else 0)


def test_order_matters():
    made, words = near_dedup.OrderMinHash(), [f"w{i}" for i in range(100)]
    swapped = words[50:] + words[:50]
    assert (made(words) == made(swapped)).mean() < (made(words) == made(words[:97] + ["x", "y", "z"])).mean()
