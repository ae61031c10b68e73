"""Dictionary automaton against plain search; counters against counts."""

import random

import pytest
from pyspark.sql import functions as F

from lodestar.operators.dictionary import Dictionary
from lodestar.sources import writers


def plain_matches(entries, text):
    at, found = 0, []
    while at < len(text):
        sizes = [p for p in entries if p and text.startswith(p, at)]
        if sizes:
            best = max(sizes, key=len)
            found.append((at, len(best), entries[best]))
            at += len(best)
        else:
            at += 1
    return found


def replaced(text, spans):
    out, at = [], 0
    for start, size, value in spans:
        out += [text[at:start], value]
        at = start + size
    return "".join([*out, text[at:]])


def test_random_dictionaries_equal_plain_search(spark):
    rng = random.Random(5)
    letters = "abé"
    entries = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 5))): f"<{i}>" for i in range(40)}
    texts = ["".join(rng.choice(letters + "x") for _ in range(rng.randint(0, 40))) for _ in range(200)] + ["", "a" * 20_000, None]
    words = Dictionary(spark.createDataFrame(list(entries.items()), "k string, v string"), "k", "v")
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    got = frame.select("id", words.matches(F.col("text")).alias("m"), words.replace(F.col("text")).alias("r"), words.contains(F.col("text")).alias("c"),
                       words.all_values(F.col("text")).alias("v")).collect()
    for row in got:
        text = texts[row.id]
        if text is None:
            assert (row.m, row.r, row.c, row.v) == (None, None, False, None)
            continue
        spans = plain_matches(entries, text)
        assert [tuple(m) for m in row.m] == spans
        assert row.r == replaced(text, spans)
        assert row.c == any(p in text for p in entries)
        assert row.v == sorted(v for p, v in entries.items() if p in text)


def test_odd_dictionaries(spark):
    frame = spark.createDataFrame([("abc",), (None,)], "text string")
    kind = "k string, v string"
    empty = Dictionary(spark.createDataFrame([], kind), "k", "v")
    assert [tuple(r) for r in frame.select(empty.replace(F.col("text")), empty.contains(F.col("text")), empty.matches(F.col("text"))).collect()] == [("abc", False, []), (None, False, None)]
    odd = Dictionary(spark.createDataFrame([(None, "n"), ("", "e"), ("b", "1"), ("b", "2"), ("c", None)], kind), "k", "v")
    assert odd.size == 2
    assert [r[0] for r in frame.select(odd.replace(F.col("text"))).collect()] == ["a2", None]
    with pytest.raises(ValueError):
        Dictionary(spark.createDataFrame([("abcdef", "v")], kind), "k", "v", most_characters=3)


def test_plan_does_not_grow_with_the_dictionary(spark):
    frame = spark.createDataFrame([("abc",)], "text string")
    sizes = []
    for n in (2, 5000):
        words = Dictionary(spark.range(n).select(F.concat(F.lit("word"), "id").alias("k"), F.lit("v").alias("v")), "k", "v")
        plan = frame.select(words.replace(F.col("text")).alias("r"))._jdf.queryExecution().executedPlan().toString()
        sizes.append(len(plan))
    assert abs(sizes[0] - sizes[1]) < 20


def test_counters_of_a_write(spark, tmp_path):
    frame = spark.range(100).withColumn("v", F.when(F.col("id") % 3 > 0, F.col("id")))
    counters = {"rows": F.count(F.lit(1)), "held": F.count("v"), "total": F.sum("v")}
    got = writers.write_counted(frame, str(tmp_path / "a"), counters)
    assert got == {"rows": 100, "held": 66, "total": sum(i for i in range(100) if i % 3)}
    assert spark.read.parquet(str(tmp_path / "a")).count() == 100
    assert writers.write_counted(frame.where("id < 0"), str(tmp_path / "b"), counters) == {"rows": 0, "held": 0, "total": None}
    assert writers.counter_row(spark, got | {"none": None}).first().asDict() == got | {"none": None}


@pytest.mark.parametrize("one_hash", [False, True])
def test_a_large_dictionary_finds_the_same(spark, monkeypatch, one_hash):
    """Beyond the automaton's size, where there was an error, hashes find the patterns; patterns that share one are compared."""
    import numpy as np

    from lodestar.operators import dictionary

    rng = random.Random(9)
    letters = "abé\U0001f600"
    entries = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))): f"<{i}>" for i in range(300)}
    texts = ["".join(rng.choice(letters + "x") for _ in range(rng.randint(0, 60))) for _ in range(100)] + [None, "", "ab" * 50]
    rows = spark.createDataFrame(list(entries.items()), "k string, v string")
    monkeypatch.setattr(dictionary, "AUTOMATON_CHARACTERS", 100)
    monkeypatch.setattr(dictionary, "_JOINED", 500)
    assert Dictionary(rows, "k", "v").indexed
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    if one_hash:
        import pyarrow as pa

        monkeypatch.setattr(dictionary, "_mixed", lambda h: np.zeros(len(h), "uint64"))
        held = dictionary.Index(pa.array(list(entries)), pa.array(list(entries.values())))
        some = [t for t in texts if t is not None]
        assert [[(s, e - s, v) for s, e, v in spans] for spans in held.leftmost_longest(some)] == [plain_matches(entries, t) for t in some]
        return
    words = Dictionary(rows, "k", "v")
    for row in frame.select("id", words.matches("text").alias("m"), words.replace("text").alias("r"), words.contains("text").alias("c"), words.all_values("text").alias("v")).collect():
        text = texts[row.id]
        if text is None:
            assert (row.m, row.r, row.c, row.v) == (None, None, False, None)
            continue
        spans = plain_matches(entries, text)
        assert [tuple(m) for m in row.m] == spans and row.r == replaced(text, spans)
        assert row.c == any(p in text for p in entries) and row.v == sorted(v for p, v in entries.items() if p in text)
    with pytest.raises(ValueError):
        Dictionary(rows, "k", "v", 200)
