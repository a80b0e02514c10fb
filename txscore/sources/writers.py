"""Where scored rows, messages and reports go."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.operators.serving import report, with_event_time
from txscore.sources.readers import COMMIT, commits_of, read_committed

log = logging.getLogger(__name__)

BatchWriter = Callable[[DataFrame, int], None]


def encode_messages(df: DataFrame, key: str | None = "trans_num") -> DataFrame:
    """Rows as JSON messages: `value`, and `key` when a column is named for it."""
    # Missing fields are written out, as the consumer expects all of them.
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def write_kafka(df: DataFrame, servers: str, topic: str, key: str | None = "trans_num") -> None:
    (
        encode_messages(df, key).write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def run_of(batch: DataFrame) -> str:
    """The id of the stream a micro-batch belongs to. It is kept in the checkpoint, so it is
    the same after a restart and differs for another checkpoint, whose batches count from 0 again."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise ValueError("not in a stream: name the run")
    return run


def not_yet_written(batch: DataFrame, stored: DataFrame, batch_id: int, run: str) -> DataFrame:
    """The rows of a batch that the stored table does not have under this run and batch number."""
    present = stored.filter(
        (F.col("batch_id") == batch_id) & (F.col("run_id") == run)).select("trans_num")
    return batch.join(present, "trans_num", "left_anti").select(
        *batch.columns, F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(run).alias("run_id"))


def jdbc_append(
    batch: DataFrame, url: str, table: str, props: dict[str, str], batch_id: int | None = None,
    connections: int = 16, run: str | None = None,
) -> None:
    """Append rows to a database table.

    Plain append writes a batch twice when it is replayed. With `batch_id` the table has
    columns `batch_id` and `run_id`, and rows of the batch that are there already are left
    out, so a replay, also after a half-written batch, completes it. `connections` bounds
    the throughput: every partition opens one, and the database bears only so many.
    """
    if batch_id is not None:
        stored = batch.sparkSession.read.format("jdbc").options(
            url=url, dbtable=table, **props).load()
        batch = not_yet_written(batch, stored, batch_id, run or run_of(batch))
    writer = batch.write.format("jdbc").mode("append")
    writer.options(url=url, dbtable=table, numPartitions=str(connections), **props).save()


def jdbc_writer(url: str, table: str, props: dict[str, str], idempotent: bool = False) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        jdbc_append(batch, url, table, props, batch_id if idempotent else None)

    return write


def write_scored(df: DataFrame, path: str, mode: str = "append") -> None:
    """Scored rows as Parquet, one folder per day, so a time window reads few of them.

    Rebalancing brings the rows of a day together, so a day gets few files instead of one
    per task; adaptive execution splits a hot day again.
    """
    with_event_time(df).hint("rebalance", "trans_day").write.mode(mode).partitionBy(
        "trans_day").parquet(path)


def parquet_writer(path: str, run: str | None = None) -> BatchWriter:
    """Each micro-batch of a checkpoint owns one folder and replaces it when replayed.

    Another checkpoint writes beside it, as its run differs. `compact` brings the folders of
    many small batches together.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_scored(batch, f"{path}/run_id={run or run_of(batch)}/batch_id={batch_id}",
                     mode="overwrite")

    return write


def manifest_writer(path: str, run: str | None = None) -> BatchWriter:
    """Each attempt at a micro-batch has a folder of its own, and counts once it is in the manifest.

    A replay writes beside the attempt before it and replaces it with one appended line, so
    readers that follow the manifest (`read_committed`) see the batch whole, once, at any moment,
    and a reader that has begun keeps its files. Attempts are ordered by the driver's clock.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        own, attempt = run or run_of(batch), time.time_ns()
        write_scored(batch, f"{path}/run_id={own}/batch_id={batch_id}/attempt={attempt}", mode="error")
        batch.sparkSession.createDataFrame([(own, batch_id, attempt)], COMMIT).coalesce(1).write.mode(
            "append").parquet(commits_of(path))

    return write


def compact(spark: SparkSession, path: str, to: str) -> None:
    """The scored rows of all batches as one folder per day, in a new place."""
    rows = spark.read.parquet(path)
    write_scored(rows.drop("trans_day"), to, mode="error")


def compact_committed(spark: SparkSession, path: str, to: str) -> None:
    """The same for a folder with a manifest: of each batch the attempt that counts."""
    write_scored(read_committed(spark, path).drop("trans_day"), to, mode="error")


def skip_if_empty(writer: BatchWriter) -> BatchWriter:
    """Skip empty batches. The batch is kept, so the test does not run it twice.

    Errors are not caught: a swallowed one would commit the batch and lose its rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                log.info("batch %s is empty", batch_id)
            else:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def export_report(df: DataFrame, path: str, as_of: Column | None = None, hours: int = 24) -> None:
    """The report of the last hours as CSV, newest first across its part files."""
    report(df, hours, as_of).write.mode("overwrite").csv(path, header=True)
