"""What every operator here needs around its Python tasks: shipping the package, the shared
folder, and Arrow batches cut to a bounded number of text bytes."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import txscore
from txscore.session import shared_dir

__all__ = ["SLICE_BYTES", "clean_table", "col", "keep_texts", "map_batches", "prepare", "shared_dir", "ship", "slices",
           "text_bytes", "written_table"]

#: Text bytes that are expanded to arrays at once; one text longer than this is one slice.
SLICE_BYTES = 1 << 20

#: Bounds of an Arrow batch on its way to a Python task, in rows and bytes: each task has two or
#: three of them outside of the heap.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20

#: Bytes of a row group in written tables. Reading a column chunk takes buffers of its size
#: outside of the heap, one per reading thread, so chunks stay small.
ROW_GROUP = 16 << 20
#: Rows in a file of a table whose size is known.
ROWS_A_FILE = 20_000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors, once per application.

    The driver serves the archive itself, so executors need no folder in common with it.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.abspath(txscore.__file__))
        folder = tempfile.mkdtemp(prefix="txscore-ship-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = os.path.join(folder, "txscore_tasks.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for place, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(place, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


def col(name: str) -> Column:
    """A column by its whole name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_table(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so no other name can clash."""
    return df.select(*(col(name).alias(own) for own, name in columns.items()))


def written_table(df: DataFrame, name: str, at_most: int | None = None,
                  rows_a_file: int = ROWS_A_FILE) -> DataFrame:
    """Write `df` to the shared folder and read it back: the plan starts at the files from then
    on, and a lost executor costs a read instead of everything before.

    Where it is known how many rows there can be at most, they go to as many tasks and files as
    these need, not to one for each shuffle partition."""
    if at_most is not None:
        df = df.coalesce(max(1, -(-at_most // rows_a_file)))
    path = shared_dir(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.option("parquet.hadoop.vectored.io.enabled", "false").parquet(path)


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package, and bound the session's Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return ship(spark)


def _give_back() -> None:
    """Return the memory of a finished task: workers are used again, and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which keeps what it has


def _tidily(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            _give_back()

    return run


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """`mapInArrow` with the package shipped first and batches bounded."""
    prepare(df.sparkSession)
    return df.mapInArrow(_tidily(work), schema)


def keep_texts(df: DataFrame, judge: Callable[[np.ndarray, np.ndarray], list[bool]],
               text: str = "text") -> DataFrame:
    """The rows whose text is kept by `judge`, which gets the bytes of several texts and their
    offsets. Only texts go to Python and only flags come back; the rows stay where they are."""
    prepare(df.sparkSession)

    @F.arrow_udf("boolean")
    def kept(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            rows = pa.RecordBatch.from_arrays([batch], names=["text"])
            yield pa.array([x for _, data, offsets in slices(rows) for x in judge(data, offsets)], pa.bool_())
        _give_back()

    return df.filter(kept(col(text)))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and n + 1 offsets into them; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n, at = len(column), column.offset
    _, offsets, data = column.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[at:at + n + 1]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with about `limit` text bytes each, with their bytes and offsets."""
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield (batch.slice(row, end - row), data[offsets[row]:offsets[end]],
               offsets[row:end + 1] - offsets[row])
        row = end
