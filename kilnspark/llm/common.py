"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kilnspark.operators.graph import components
from kilnspark.sources.workspace import materialise

__all__ = ["components", "free_name", "materialise", "parts", "release_memory", "small_batches", "table", "texts"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [x or b"" for x in binary.to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the named text column holds about ``most_bytes`` in each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = batch.column(column).nbytes
        pieces = max(1, -(-size // most_bytes))
        step = max(1, -(-batch.num_rows // pieces))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, or that with underscores behind it, so that it is no column yet."""
    lowered = {c.lower() for c in taken}
    while wanted.lower() in lowered:
        wanted += "_"
    return wanted


def release_memory() -> None:
    """Give memory that earlier tasks of this worker have freed back to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
