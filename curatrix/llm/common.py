"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from curatrix.session import materialise

# An Arrow batch holds whole texts; these bounds keep a worker's batch small.
BATCH_ROWS = 1_000
BATCH_BYTES = 2 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, tag: str) -> DataFrame:
    """`df` written to the shared folder and read back; cuts the lineage."""
    return materialise(df, tag)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@functools.cache
def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def giving_back(step: Callable) -> Callable:
    """A step over Arrow batches whose worker returns its free memory when a task ends.

    Workers are used again, and would otherwise keep the most that any earlier step took
    beside what the next one needs.
    """
    @functools.wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if (libc := _libc()) is not None and hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return run


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and the `len + 1` offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), at - (at[0] if len(at) else 0)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def strings(column: pa.Array) -> Iterator[str]:
    """Texts of an Arrow column one at a time; null counts as empty."""
    for value in column:
        yield value.as_py() or ""


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression, Newton steps, the constant last."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
