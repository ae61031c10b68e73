"""Pairs met cell by cell: what is shuffled, nulls, repeats, empty blocks, keys that are no numbers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import cells, pairs, prediction

ROWS = [(1, 1, 5), (1, 2, None), (1, 3, 2), (2, 1, 4), (2, 2, 3), (2, 3, None), (3, 1, None), (3, 2, None),
        (None, 1, 9), (4, None, 7), (5, None, 7), (4, 1, 0), (2, 1, 6)]


def joined(df, least):
    df.createOrReplaceTempView("cell_rows")
    return sorted(map(tuple, df.sparkSession.sql(f"""
        SELECT p.e, q.e, count(*), sum(p.x * q.x), sum(p.x * p.x), sum(q.x * q.x) FROM cell_rows p JOIN cell_rows q ON p.v = q.v AND p.e < q.e
        GROUP BY 1, 2 HAVING count(*) >= {least}""").collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_shuffle_by_pair(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(e, v, 1) for e in range(80) for v in rng.sample(range(30), 8)], "e long, v long, x long")
    made = plan(pairs.shared_sums(df, "e", "v", "x", 5, broadcast_rows=0))
    assert "HashAggregate" not in made and "Join" not in made


@pytest.mark.parametrize("least", [1, 2])
def test_nulls_and_repeats_as_a_join(spark, least):
    df = spark.createDataFrame(ROWS, "e long, v long, x long")
    got = pairs.shared_sums(df, "e", "v", "x", least, broadcast_rows=0)
    assert sorted(map(tuple, got.collect()), key=str) == joined(df, least)


def test_text_keys(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(f"u{e:02}", f"v{v}", rng.randint(-9, 9)) for e in range(20) for v in {0, *rng.sample(range(12), 4)}], "e string, v string, x long")
    got = pairs.shared_sums(df, "e", "v", "x", 2, block=8, broadcast_rows=0)
    assert sorted(map(tuple, got.collect()), key=str) == joined(df, 2)


def test_many_met_rows_come_in_batches(spark, monkeypatch):
    monkeypatch.setattr(cells, "_MET", 50)
    rng = random.Random(3)
    rows = [(e, v, rng.randint(1, 9)) for e in range(60) for v in rng.sample(range(20), 9)]
    left = cells.Block([(*[cells._pack(np.array(c)) for c in zip(*rows)], b"")])
    met = list(cells.met_rows(left, left, True))
    assert len(met) > 5
    seen = [k for own, ids, key, i, j in met for k in set(zip(own[key // len(ids)].tolist(), ids[key % len(ids)].tolist()))]
    assert len(seen) == len(set(seen))  # a pair lies in one batch
    assert sum(len(m[2]) for m in met) == sum(1 for a in rows for b in rows if a[0] < b[0] and a[1] == b[1])


def test_lowered_support_keeps_pairs_in_their_tasks(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(u, i, 5) for u in range(50) for i in rng.sample(range(12), 5)], "user_id long, item_id long, c long")
    high = pairs.support_cosine(df, "user_id", "item_id", "c", 5)
    out = prediction.lowered_support(df, high, df.select("user_id").distinct(), 4, 60)
    folder = next(f for f in out.inputFiles() if "low-support" in f).rsplit("/", 1)[0]
    assert spark.read.parquet(folder).count() <= 50 * 5  # a row per user and common count; before, one per pair


def test_grid_votes_stay_in_their_tasks(spark):
    near = spark.createDataFrame([(5, 1, 2, 0.5), (3, 1, 2, 0.5), (3, 1, 3, 1.0)], "v int, a long, b long, sim double")
    rated = spark.createDataFrame([(2, 7, 500), (3, 7, 500), (2, 8, None), (2, None, 300), (3, None, 100)], "user_id long, item_id long, c long")
    users = spark.createDataFrame([(1, 1.0)], "user_id long, mean_rating double")
    out = prediction.grid_predictions(near, rated, users, (5, 3), 1)
    got = {(r.v, r.item_id): (r.votes, r.estimate) for r in out.collect()}
    assert got == {(5, 7): (1, 3.5), (3, 7): (2, 4.8), (5, None): (1, 2.5), (3, None): (2, 2.2)}
    assert "HashAggregate" not in plan(out)  # before, each met row was shuffled to its user and item


def test_item_predictions_are_summed_in_cells(spark):
    rng = random.Random(8)
    similar = spark.createDataFrame([(a, b, rng.random()) for a in range(12) for b in range(12) if a != b], "a long, b long, sim double")
    rated = spark.createDataFrame([(u, i, rng.choice([-20, 5, 30, None])) for u in range(30) for i in rng.sample(range(12), 4)], "user_id long, item_id long, c long")
    items = spark.createDataFrame([(i, 5.0 + i / 9) for i in range(11)], "item_id long, mean_rating double")
    users = spark.createDataFrame([(u, 5.0) for u in range(25)], "user_id long, mean_rating double")
    small, large = (prediction.item_predictions(similar, rated, items, users, broadcast_rows=n) for n in (10 ** 6, 0))
    rows = [{(r.user_id, r.item_id): round(r.estimate, 9) for r in df.collect()} for df in (small, large)]
    assert rows[0] == rows[1] and rows[0]
    assert "HashAggregate" not in plan(large) and "Join" not in plan(large)


def test_votes_of_neighbours_stay_in_their_tasks(spark, monkeypatch):
    """Before, each met row of a neighbour and a rating was shuffled to its user and item."""
    rng = random.Random(9)
    near = spark.createDataFrame([(a, b, rng.choice([None, rng.uniform(-1, 1)])) for a in range(15) for b in rng.sample(range(15), 6)] * 2, "a long, b long, sim double")
    rated = spark.createDataFrame([(u, rng.choice([None, *range(9)]), rng.choice([None, -250, 40, 310])) for u in range(15) for _ in range(6)], "user_id long, item_id long, c long")
    users = spark.createDataFrame([(u, 5.0 + u / 7) for u in range(13)], "user_id long, mean_rating double")
    texts = [df.select(*[F.col(c).cast("string") if c in ("a", "user_id") else F.col(c) for c in df.columns]) for df in (near, rated, users)]
    monkeypatch.setattr(cells, "BLOCK_ROWS", 40)
    for made in (prediction.neighbour_predictions, prediction.weighted_predictions):
        summed, joined_ = made(near, rated, users, 2), made(texts[0].withColumn("b", F.col("b").cast("string")), *texts[1:], 2)
        assert "HashAggregate" not in plan(summed)
        got, want = ({(str(r.user_id), r.item_id, r.votes): r.estimate for r in df.collect()} for df in (summed, joined_))
        assert got.keys() == want.keys() and got and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)


def test_neither_table_is_whole_in_a_task():
    for rows, others, tasks in ((127_000_000, 216_000_000, 12), (1, 300_000_000, 8), (0, 0, 4)):
        mine, theirs = cells.two_counts(rows, others, tasks)
        assert rows / mine <= cells.BLOCK_ROWS and others / theirs <= cells.BLOCK_ROWS and mine * theirs >= 2 * tasks


def test_rows_in_order_take_little_room(spark):
    """A piece holds steps from row to row; before, each row took the whole width of its entity and partner."""
    import zlib

    rows = spark.createDataFrame([(e * 7919, v * 911, v % 50) for e in range(300) for v in range(e % 13, 4000, 37)], "e long, v long, x long").coalesce(1)
    pieces = cells.packed(rows, 1).collect()
    held = sum(len(cells.Block([p[1:]]).e) for p in pieces)
    assert held == rows.count() and sum(len(zlib.compress(p[n], 1)) for p in pieces for n in ("e", "v")) < 2 * held


def test_blocks_hold_narrow_columns():
    numbers = np.arange(0, 70_000, 7)
    block = cells.Block([(cells._pack(numbers, cells._FIRST), cells._pack(numbers % 90, np.arange(len(numbers))), cells._pack(numbers % 90), b"", b"")])
    assert block.e.tolist() == numbers.tolist() and block.v.tolist() == (numbers % 90).tolist()
    assert (block.e.itemsize, block.v.itemsize, block.x.itemsize) == (4, 1, 1)
    wide = np.array([-(1 << 63), 5, (1 << 63) - 1])
    assert cells._unpack(cells._pack(wide, cells._FIRST), cells._FIRST).tolist() == wide.tolist()


def test_shuffles_go_when_their_rows_are_written(spark):
    from lodestar.session import materialise

    def shuffles():
        return int(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size())

    before = shuffles()
    assert materialise(spark.range(1000).repartition(3, "id"), "dropped").count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    made = shuffles() - before
    assert made <= 1  # that of the count alone; before, that of the write stayed too
