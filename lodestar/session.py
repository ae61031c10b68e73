"""Session helpers: a default builder and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.functions import broadcast

_SCRATCH: dict[str, str] = {}


def build_session(app_name: str = "lodestar", master: str | None = None, **conf) -> SparkSession:
    """A session with AQE, UTC and Arrow on; anything in ``conf`` wins.

    Shuffle partitions are left to the caller: AQE coalesces a generous number
    on a cluster, a local run wants about one per core.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only on one machine (a local master) that names none a fresh temporary folder is
    made and set as the checkpoint directory; a cluster without the setting is an error,
    because its executors could not read each other's files.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SCRATCH:
        return _SCRATCH[app]
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    _SCRATCH[app] = root
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for intermediate tables, below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def wide_tasks(spark: SparkSession) -> int:
    """Tasks for joins that multiply rows: the session's shuffle partitions, at least its cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


# Largest table, in rows of three numbers, that a job sends to every executor (about 50 MB).
BROADCAST_ROWS = 1_000_000


def sent(df):
    """``df``, written, with the hint to send it to every task if it is small enough to."""
    df = materialise(df, "lookup")
    return broadcast(df) if df.count() <= BROADCAST_ROWS else df


def enough_splits(df):
    """Spread a scan over the cores when its files give fewer splits than that.

    Only for expensive per-row work on small inputs: a large table has many more
    splits than there are cores, and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 2 * cores else df


_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What is written in here is read back from its folder: the shuffles it took are deleted as soon as it is written.

    Otherwise they stay until the driver collects its garbage, and those of all steps of a job lie beside each other.
    """
    before = spark.conf.get(_DROPPED, None)
    spark.conf.set(_DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROPPED) if before is None else spark.conf.set(_DROPPED, before)


def materialise(df, label: str = "table"):
    """Cut the lineage of ``df`` by writing it to the shared folder and reading it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
