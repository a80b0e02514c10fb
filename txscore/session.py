"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import functools
import math
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "txscore", master: str | None = None, **extra: str) -> SparkSession:
    """A session for scripts and tests; a cluster job brings its own and calls `tune`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan here relies on to a given session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_for(spark: SparkSession, input_bytes: int, per_task: int = 256 * 1024 * 1024) -> None:
    """Size scans and shuffles for a large input.

    Shuffles start with one partition per `per_task` bytes and adaptive execution merges
    small ones, so no task has to hold more than fits; scans read splits of the same size.
    Not for streams: their number of partitions is part of the checkpoint.
    """
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                     math.ceil(input_bytes / per_task))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(per_task))


@functools.cache
def _local_root() -> str:
    """A temporary folder for a local session, removed when the process ends."""
    root = tempfile.mkdtemp(prefix="txscore-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder all executors share (`spark.checkpoint.dir`).

    Only a local-mode session may go without that setting: there one machine is
    the whole cluster, and a temporary folder is as good.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    For rows many passes go over: the plan starts at the files from then on, and a lost
    executor costs a read instead of everything before.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
