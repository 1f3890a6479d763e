"""Shared helpers: table access, materialised intermediates, Arrow batch sizing."""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import delete_path, scratch_path

#: Arrow batches sent to Python tasks: rows and bytes per batch (memory bound of a worker).
BATCH_ROWS = 2048
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str, made: list[str] | None = None) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back (cuts lineage, survives executor loss).

    Its path is added to ``made``, for ``discard`` once nothing reads it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, made: list[str]) -> None:
    """Delete materialised tables that nothing reads any more."""
    while made:
        delete_path(spark, made.pop())


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of this session, so that very long texts don't pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def release_memory() -> None:
    """Give what this process has freed back to the system: a Python worker goes on to other tasks, beside its executor's JVM."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; nulls read as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def in_share(hashed: Column, share: Column | float) -> Column:
    """Whether a 64-bit hash falls into the given share of all hashes."""
    return F.pmod(hashed, F.lit(1 << 31)) < share * F.lit(float(1 << 31))


def hash_sample(rows: DataFrame, n: int, hashed: str) -> DataFrame:
    """The ``n`` rows first by their hash; only a share of about ``4 * n`` rows is sorted, however many there are."""
    total = rows.count()
    return rows.where(in_share(F.col(hashed), min(1.0, 4 * n / max(total, 1)))).orderBy(F.pmod(hashed, F.lit(1 << 31)), hashed).limit(n)
