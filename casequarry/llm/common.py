"""What the operators share: table access and bounded chunks of Arrow texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 1 << 19
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_bytes(column: pa.Array) -> pa.LargeBinaryArray:
    """A text column as UTF-8 bytes; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    return column.cast(pa.large_binary())


def layout(column: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the column and where each row begins and ends in them."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data, offsets


def chunks(column: pa.LargeBinaryArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole rows, some ``limit`` bytes at a time: first row, end row, bytes, offsets.

    A row longer than ``limit`` is a chunk of its own.
    """
    if not len(column):
        return
    data, offsets = layout(column)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def sliced(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some ``limit`` bytes of ``text``, so that a task makes Python values of few texts at once.

    Workers are used again and keep much of what they once took. A row longer
    than ``limit`` is a batch of its own; a batch without rows stays one.
    """
    for batch in batches:
        for at, end, _, _ in chunks(as_bytes(batch.column("text")), limit):
            yield batch.slice(at, end - at)
        if not batch.num_rows:
            yield batch
