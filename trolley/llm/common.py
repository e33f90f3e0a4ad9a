"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trolley.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/trolley-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: the lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this package has written and no longer reads."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def id_bucket(key: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """A value kept for the life of a Python worker, over all its tasks."""
    holder = sys.modules.setdefault("_trolley_llm_worker", types.ModuleType("_trolley_llm_worker"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def slices(batches: Iterator[pa.RecordBatch], text: str, max_rows: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds at most ``max_rows`` rows and about ``max_bytes`` of text
    (one longer text makes a slice of its own)."""
    for batch in batches:
        ends = offsets(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(ends, ends[start] + max_bytes, "right")) - 1
            end = min(max(end, start + 1), start + max_rows, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    give_back()


def bounded_batches(spark: SparkSession, rows: int = 2_000, size: str = "4m") -> None:
    """Bound the Arrow batches of this session by bytes and rows. A batch exists in the JVM, outside its
    heap, and in the worker at once, and its buffers double as they grow, so the usual 10,000 long texts
    take hundreds of megabytes of an executor. The setting is read when a job is planned, so it stays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: the worker lives on with other stages' tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of a text or binary column, one more than its rows."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    found = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, kind)
    return found.astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of the column, offsets starting at 0); a null row has length 0."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    ends = offsets(column)
    data = column.buffers()[2] if len(column) else None
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def empty_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


BROADCAST_ROWS = 1_000_000  # ids or digests, some ten bytes each; a longer list is joined by shuffling


def few(keys: DataFrame) -> DataFrame:
    """A stored list of keys, broadcast only if its counted rows are within the bound."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
