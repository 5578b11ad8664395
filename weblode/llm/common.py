"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.scratch import remove, scratch_dir, stage

__all__ = [
    "arrow_batches", "blank", "fold", "mix64", "read_table", "remove", "scratch_dir", "share_code", "slices",
    "stage", "text_buffer",
]

#: Bytes of text that one numpy step works on; a longer document is a step of its own.
STEP_BYTES = 2 << 20


def share_code(spark: SparkSession) -> None:
    """Let Python workers on this machine, or on machines with the package at
    the same path, import it; otherwise it is shipped by ``--py-files``."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows, and so the memory, of one Arrow batch of whole texts."""
    share_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; null ids are in no fold."""
    return F.crc32(doc_id.cast("string")) % parts


def blank(text: Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(text, F.lit(""))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each row begins (one more
    entry than rows). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, ends, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(ends, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, step: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``step`` bytes each, whole rows only."""
    low, n = 0, len(at) - 1
    while low < n:
        high = int(np.searchsorted(at, at[low] + step, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
