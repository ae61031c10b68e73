import re
import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from lodestar.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_force(rows):
    convs = {}
    for r in sorted(rows, key=lambda r: (r.turn is not None, r.turn or 0)):
        if r.conv_id is not None:
            convs.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    built = {}
    for c, own in convs.items():
        n = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(convs.get(c - c % 20, [])[:n] + own[n:])
    if not built:
        return []
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    found = []
    for node, members in nodes.items():
        below = [(n, m) for n, m in nodes.items() if n[:len(node)] == node]
        parents = {n[:-1] for n in nodes if n}
        ends = ",".join(str(c) for c in sorted(m for m in members if built[m] == node))
        found.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), sum(len(n) == len(node) + 1 for n, _ in below),
            sum(n not in parents for n, _ in below),
            sum((len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n, m in below if n), sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_given_conversations(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert rows_of(prefix_trie.prefix_trie(given)) == brute_force(given.collect())


def test_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 3)  # long sequences and end lists pass through several runs
    rows = [(0, i, "user" if i % 2 else "assistant", f"turn {i} of it") for i in range(9)]
    rows += [(c, i, "user", f"turn {i} of it") for c in (1, 2, 3, 4, 5, 6, 7) for i in range(3)]
    rows += [(8, None, None, None), (8, 0, "user", " \t\n"), (9, 0, "user", "x y z"), (10, 0, "", "x"), (10, 1, "x", ""), (10, 1, "x", "")]
    rows += [(41, 0, "user", "alone"), (43, 0, "user", "alone"), (45, 5, "user", "w " * 40_000), (None, 0, "user", "nobody's")]
    rows += [(c, t, "user", "same") for c in range(100, 125) for t in range(2)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({n: F.lit("clash") for n in ("at", "one", "rank", "first", "words", "depth")})
    got = rows_of(prefix_trie.prefix_trie(frame))
    assert got == brute_force(spark.createDataFrame(rows, SCHEMA).collect())
    assert sum(r[1] == 0 for r in got) == 1


def test_no_conversations(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_running_sums_cross_runs(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 4)
    rows = spark.range(1, 24).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.col("id").alias("v"))
    got = prefix_trie.running(rows, "k", {"v": F.sum}, after=True).orderBy("at").collect()
    assert [r.v for r in got] == [sum(range(i, 24)) for i in range(1, 24)]
