"""Arrow batches in tasks: cut by bytes, so that long texts keep a worker's memory bounded."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import SparkSession

CHUNK_BYTES = 4 << 20


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about `size` bytes; a longer text is a slice of its own."""
    texts = batch.column(column)
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start, rows = 0, batch.num_rows
    while start < rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b or b"" for b in texts.cast(pa.binary()).to_pylist()]


@contextlib.contextmanager
def byte_batches(spark: SparkSession, size: int = CHUNK_BYTES) -> Iterator[None]:
    """Arrow batches of about `size` bytes for jobs started inside: a worker never holds thousands of long texts at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
