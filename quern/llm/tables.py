"""Reading the tables, durable intermediate tables, and Arrow batch helpers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from quern.session import durable, shared_folder, ship, small  # noqa: F401 - used by the operators

#: Bytes of text that one vectorised step holds at most, unless one row alone is longer.
PIECE_BYTES = 1 << 19
#: Rows that one vectorised step holds at most.
PIECE_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as the empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES, rows: int = PIECE_ROWS):
    """``batch`` cut into runs of at most ``rows`` rows whose texts have about ``limit`` bytes together."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64) + 64)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(ends, done + limit, "right"))))
        yield batch.slice(at, end - at)
        at = end
