"""Structured Streaming: decode, clean, derive, score, write."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txscore.constants import KEY, TRIGGER
from txscore.functions import parse_ts
from txscore.operators.cleaning import (
    clean_stream, drop_missing, drop_unscorable, missing_features, non_negative, project_scored,
)
from txscore.operators.features import CategoryReference, prepare_features
from txscore.session import STATE_STORE
from txscore.sources.readers import decode_messages
from txscore.sources.writers import BatchWriter, skip_if_empty


def configure_state(spark: SparkSession, partitions: int | None = None) -> None:
    """State in RocksDB, so keys need not fit in memory, and a fixed number of partitions.

    A checkpoint keeps its partition number for good: choose it for the final size.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    if partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))


def dedup_within(df: DataFrame, delay: str) -> DataFrame:
    """One row per transaction among those at most `delay` apart in event time.

    Bounds the state of the dedup; repeats further apart come through again.
    """
    return (
        df.withColumn("_seen_at", parse_ts(F.col("trans_date_trans_time")))
        .withWatermark("_seen_at", delay)
        .dropDuplicatesWithinWatermark([KEY])
        .drop("_seen_at")
    )


def clean_incoming(df: DataFrame, watermark: str | None = None) -> DataFrame:
    """Stream cleaning; by default a transaction is known for the life of the stream."""
    if watermark is None:
        return clean_stream(df)
    return non_negative(dedup_within(drop_missing(df), watermark))


def stream_features(
    messages: DataFrame, reference: CategoryReference, watermark: str | None = None
) -> DataFrame:
    """JSON messages to model features. Rows without a full set of features are dropped
    and counted in the query progress as `unscorable`."""
    features = prepare_features(clean_incoming(decode_messages(messages), watermark), reference)
    counted = features.observe(
        "unscorable", F.count_if(missing_features(features)).alias("rows"))
    return drop_unscorable(counted)


def score_stream(
    messages: DataFrame, reference: CategoryReference, model: PipelineModel,
    watermark: str | None = None,
) -> DataFrame:
    """JSON messages to serving rows."""
    return project_scored(model.transform(stream_features(messages, reference, watermark)))


def progress_rows(query: StreamingQuery) -> list[tuple[int, int, str, int]]:
    """(batch_id, input_rows, counter, rows) of each recorded batch that had input, for every
    counter it observed, such as `unscorable` or `repeats`."""
    return [
        (batch.batchId, batch.numInputRows, name, counted["rows"])
        for batch in query.recentProgress if batch.numInputRows
        for name, counted in batch.observedMetrics.items()
    ]


def start_scoring(
    df: DataFrame, writer: BatchWriter, checkpoint: str, trigger: str | None = TRIGGER,
    name: str | None = None, state_partitions: int | None = None,
) -> StreamingQuery:
    """Start writing a stream batch by batch. Without a trigger interval it takes what is
    there and ends. The checkpoint keeps offsets and state, so a restart continues.

    State is in RocksDB, dealt to `state_partitions` for the life of the checkpoint (by
    default the session's shuffle partitions)."""
    configure_state(df.sparkSession, state_partitions)
    timing = {"processingTime": trigger} if trigger else {"availableNow": True}
    stream = (
        df.writeStream.outputMode("append")
        .trigger(**timing)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(skip_if_empty(writer))
    )
    return (stream.queryName(name) if name else stream).start()
