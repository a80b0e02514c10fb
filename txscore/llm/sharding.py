"""Sharding by jump consistent hashing.

A stable key and the number of shards decide the shard; no table of a ring is kept. When a
shard is appended, only the rows that move into it change place, a 1/(n + 1) share.

Slots number the rows of a shard from 0 without gaps. A first pass numbers the rows of each
shard within a task while it writes the placement to the shared folder; what those files hold
is final, so the counts per (task, shard), of which there are few, give each task its offsets.
No row is shuffled and no shard meets in one task.

Defined results: a null text has no bytes (size 1) and the crc32 of an empty text; a null key
is placed like a key of its own; rows that repeat a key go to the same shard and get slots of
their own; an empty table gives no rows. Which slot a row has within its shard depends on how
the table is split. Other columns are not read by `place`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txscore.llm.tasks import clean_table, map_batches, written_table
from txscore.llm.words import U64, mix

#: The generator's multiplier, from the published algorithm: a fixed value.
_MULTIPLIER = U64(2862933555777941757)
NULL_KEY = U64(0x6E756C6C)
#: Above this many (task, shard) counts the offsets are joined by a shuffle.
BROADCAST_COUNTS = 1_000_000


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: the last of a key's jumps that is below `shards`."""
    state = keys.astype(U64).copy()
    shard = np.zeros(len(keys), np.int64)
    ahead = np.zeros(len(keys), np.int64)
    active = np.arange(len(keys))
    while len(active):
        shard[active] = ahead[active]
        state[active] = state[active] * _MULTIPLIER + U64(1)
        step = ((state[active] >> U64(33)) + U64(1)).astype(np.float64)
        ahead[active] = ((shard[active] + 1) * (2.0 ** 31 / step)).astype(np.int64)
        active = active[ahead[active] < shards]
    return shard


def stable_keys(ids: pa.Array) -> np.ndarray:
    """Ids as well-mixed 64-bit keys."""
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
    keys = mix(numbers)
    if ids.null_count:
        keys[np.asarray(ids.is_null())] = mix(np.array([NULL_KEY]))[0]
    return keys


def _placing(shards: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(shards, np.int64)
        for batch in batches:
            keys = stable_keys(batch.column("doc_id"))
            shard = jump_hash(keys, shards)
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            within = np.empty(len(shard), np.int64)
            within[order] = np.arange(len(shard)) - np.repeat(np.cumsum(counts) - counts, counts)
            within += seen[shard]
            seen += counts
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shard.astype(np.int32)),
                 pa.array(jump_hash(keys, shards + 1).astype(np.int32)), pa.array(within)],
                names=[*batch.schema.names, "shard", "grown_shard", "within"])

    return work


def place(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row (doc_id, text)."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    narrow = clean_table(docs, doc_id="doc_id", text="text").select(
        "doc_id", (F.length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    placed = map_batches(narrow, _placing(shards),
                         "doc_id long, size long, text_crc32 long, shard int, grown_shard int, "
                         "within long").withColumn("task", F.spark_partition_id())
    placed = written_table(placed, "placed")
    counts = placed.groupBy("task", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written_table(counts.select(
        "task", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    if offsets.count() <= BROADCAST_COUNTS:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, ["task", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("within")).alias("slot"), "grown_shard")


def _with_shard(shards: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = jump_hash(stable_keys(batch.column("doc_id")), shards)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard.astype(np.int32))],
                                             names=[*batch.schema.names, "own_shard"])

    return work


def write_shards(docs: DataFrame, path: str, shards: int = 16, files: int = 8) -> None:
    """Write whole rows below `path`/own_shard=N; a shard is split over several tasks by id."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    rows = map_batches(docs, _with_shard(shards), f"{schema}, own_shard int")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(files))
    rows.repartition(shards * files, "own_shard", salt).write.partitionBy("own_shard").parquet(path)
