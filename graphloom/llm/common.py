"""What the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

#: A-Z to a-z and nothing else.
ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: Texts are worked on in groups of about this many bytes, which bounds a worker's memory.
GROUP_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def on_workers(spark: SparkSession) -> None:
    """Let the Python workers import this package from where the driver has it.

    Functions are sent to the workers by name. A cluster that ships the package with
    ``--py-files`` finds it there; the folder added here does no harm then.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def mapped(rows: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers, which give back at the end what memory a task no longer needs."""
    on_workers(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return rows.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, beside those of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps its memory
            ctypes.CDLL(None).malloc_trim(0)


def groups(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts of a batch with about ``GROUP_BYTES`` of text each, or one longer text."""
    sizes = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0))
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + GROUP_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and the n + 1 offsets of the texts; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


class Registered:
    """Queries by name, with the SQL of those that have one."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def keep(query):
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return keep


QUERIES = Registered()
