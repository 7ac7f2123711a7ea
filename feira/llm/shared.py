"""Helpers of this subpackage: batch sizes, text columns, byte spans."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes that Spark hands to a Python worker at once; long texts make smaller batches.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def bounded_batches(spark: SparkSession) -> None:
    """Keeps what a Python worker holds of its input at a few megabytes."""
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)


def utf8(column: str) -> Column:
    """The UTF-8 bytes of a text; a null text is empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parts_for(rows: int, rows_per_part: int) -> int:
    """Number of parts so that each holds about ``rows_per_part``."""
    return max(1, -(-rows // rows_per_part))


def merge_spans(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans, sorted, with touching and overlapping ones joined."""
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(a, b) for a, b in merged]


def cut_spans(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``data`` without the given merged spans."""
    kept, at = [], 0
    for start, end in spans:
        kept.append(data[at:start])
        at = end
    kept.append(data[at:])
    return b"".join(kept)


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk so that no UTF-8 character is cut in two."""
    shrunk = []
    for start, end in spans:
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            shrunk.append((start, end))
    return shrunk


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the stretches of true values."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def packed_bytes(batches):
    """Batches with their last column, of bytes, compressed and called ``packed``: texts shuffle at a third of their size."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = pa.array([packer.compress(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, packed], names=[*batch.schema.names[:-1], "packed"])


def release() -> None:
    """Gives free memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not every C library has it
        pass


def tidy(work: Callable) -> Callable:
    """``work`` on batches; the worker, which Spark keeps for later stages, then gives free memory back."""
    def run(batches):
        yield from work(batches)
        release()

    return run


def tidy_group(work: Callable) -> Callable:
    """``work`` on the table of a group; free memory goes back after each."""
    def run(table):
        made = work(table)
        release()
        return made

    return run
