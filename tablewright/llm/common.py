"""Helpers of the corpus operators: cut points in the shared folder, and texts of Arrow batches as byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.sources.files import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cut(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: later steps survive lost executors without a rerun."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lean_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of each query when it has ended, not when the driver collects garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def lean_batches(spark: SparkSession) -> None:
    """Let Python workers get texts a thousand at a time: what a worker holds stays small beside the executor's heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else unchanged; texts of ASCII alone take the byte-wise path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins and the last ends; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0 or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
    return data, bounds - bounds[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts have about `limit` bytes at most; one longer text is a slice of its own."""
    for batch in batches:
        pa.default_memory_pool().release_unused()
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.concatenate(([0], np.cumsum(sizes)[:-1])) // limit if len(sizes) else sizes
        for start, end in runs(part):
            yield batch.slice(start, end - start)


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal neighbours."""
    if len(values):
        at = np.flatnonzero(np.diff(values)) + 1
        yield from zip([0, *at.tolist()], [*at.tolist(), len(values)])


def within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... length - 1 for each of the lengths, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def fold(table: str) -> str:
    """Reading `table` in DuckDB: its text with A-Z in lower case."""
    return f"translate({table}, '{UPPER}', '{LOWER}')"
