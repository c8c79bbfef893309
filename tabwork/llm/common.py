"""Helpers shared by the operators on text corpora: shared storage, size-checked broadcast, Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwork.plans.base import scratch_path

#: Bytes of text handled by one round of array work inside a task. Arrays of hashes take many times that in each worker, and a worker keeps much of it.
CHUNK_BYTES = 1 << 19
#: A side of a join is broadcast only if its rows, at their stated width, stay below this.
BROADCAST_BYTES = 32 << 20
#: Rows of a few numbers that are worth a task.
ROWS_A_TASK = 50_000


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lost executors then cost no recomputation."""
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int, more: Column | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its rows fit the limit; else as it is, for a shuffled join.

    ``row_bytes`` is the width of the columns of fixed width, ``more`` the bytes that texts and arrays of a row take
    besides; it must be given where there are any. ``df`` should be stored or cheap, as it is summed here.
    """
    each = F.lit(row_bytes) if more is None else row_bytes + F.coalesce(more, F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(each.cast("long"))).first()[0] or 0) <= limit else df


def gathered(df: DataFrame, rows: int, each: int = ROWS_A_TASK) -> DataFrame:
    """``df``, of at most about ``rows`` rows, in the partitions they are worth, one per core at least: many small jobs else pass their time in starting tasks."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def sent_if(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df``, known to have at most ``rows`` rows, marked for broadcast if they stay below the limit."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def fold(column: str, parts: int) -> Column:
    """The remainder of crc32 of the column as text; NULL for NULL."""
    return F.crc32(F.col(column).cast("string")) % parts


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row starts and ends. NULL becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"" if kind == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), ends


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [lo, hi) of about ``size`` bytes, one row at least."""
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, min(hi, rows)
        lo = min(hi, rows)


def blobs(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Rows of bytes cut from one array; ``starts`` has one entry more than rows, in elements."""
    offsets = (starts * values.itemsize).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    ).cast(pa.binary())


def long_array(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def free_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name
