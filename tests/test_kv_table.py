"""The committing writer: attempts, failures and repeated jobs; what lookups skip."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.sources import kv_table

SCHEMA = "game string, user string, rating string"


def rows(spark, n, rating):
    return spark.range(n).select(F.format_string("g%03d", F.col("id") % 10).alias("game"), F.format_string("u%d", "id").alias("user"), F.lit(rating).cast("string").alias("rating"))


def test_the_last_put_of_a_key_is_read(spark, tmp_path):
    path = str(tmp_path)
    kv_table.put(rows(spark, 100, "1"), path, "first")
    kv_table.put(rows(spark, 40, None), path, "second")
    kv_table.put(rows(spark, 100, "9"), path, "first")  # sent again after a doubt
    got = {(r.game, r.user): r.rating for r in kv_table.newest(spark, path, SCHEMA, ["game", "user"]).collect()}
    assert got == {(f"g{i % 10:03d}", f"u{i}"): None if i < 40 else "1" for i in range(100)}
    assert [(c["number"], c["job"], c["rows"]) for c in kv_table.commits(path)] == [(0, "first", 100), (1, "second", 40)]


def test_a_task_that_runs_twice_leaves_one_copy(spark, tmp_path):
    writer = kv_table.KeyValueWriter(str(tmp_path), "job")
    batch = pa.record_batch([pa.array(["g"] * 3), pa.array(["a", "b", "c"]), pa.array(["1", None, "3"])], ["game", "user", "rating"])
    lost, kept, empty = writer.write(iter([batch])), writer.write(iter([batch, batch])), writer.write(iter([]))
    assert lost.file != kept.file and empty.file is None
    assert kv_table.published(spark, str(tmp_path), SCHEMA).count() == 0
    writer.commit([kept, empty])
    assert kv_table.published(spark, str(tmp_path), SCHEMA).count() == 6
    writer.commit([lost])  # the same job once more
    assert kv_table.published(spark, str(tmp_path), SCHEMA).count() == 6


def test_a_job_that_fails_publishes_nothing(spark, tmp_path):
    path = str(tmp_path)
    broken = rows(spark, 100, "1").withColumn("rating", F.when(F.col("user") == "u99", F.raise_error(F.lit("broken row"))).otherwise(F.col("rating")))
    with pytest.raises(Exception, match="broken row"):
        kv_table.put(broken, path, "broken")
    assert kv_table.commits(path) == [] and kv_table.newest(spark, path, SCHEMA, ["game", "user"]).count() == 0
    kv_table.put(rows(spark, 0, "1"), path, "empty")
    assert kv_table.newest(spark, path, SCHEMA, ["game", "user"]).count() == 0
    for wrong in ("", "a/b", "a b"):
        with pytest.raises(ValueError):
            kv_table.put(rows(spark, 1, "1"), path, wrong)


def test_lookups_skip_row_groups_of_a_clustered_table(spark, tmp_path):
    for name, key in (("clustered", ["game"]), ("scattered", ["user"])):
        path = str(tmp_path / name)
        kv_table.put(rows(spark, 2000, "1"), path, name, key=key, group_rows=100)
        figures = kv_table.layout(path, "game", ["g003"])
        assert figures["groups"] >= 20 and (figures["groups_read"] <= 4 if name == "clustered" else figures["groups_read"] == figures["groups"])
        found = kv_table.published(spark, path, SCHEMA).where("game = 'g003'")
        assert found.count() == 200 and "EqualTo(game,g003)" in found._jdf.queryExecution().executedPlan().toString()
