"""Helpers the operators share: tables, bounded slices of Arrow batches, digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Text bytes that one slice of a batch may hold, one row at least. It bounds a worker's memory.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(
    batches: Iterable[pa.RecordBatch], column: int = 1, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose text or binary column holds about ``limit`` bytes."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
        start = size = 0
        for row, length in enumerate(sizes):
            if row > start and size + length > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += int(length)
        if batch.num_rows > start:
            yield batch.slice(start)


def encoded_texts(batch: pa.RecordBatch, column: int = 1) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; a null text is empty."""
    binary = pa.large_binary() if pa.types.is_large_string(batch.schema.types[column]) else pa.binary()
    return [text or b"" for text in batch.column(column).cast(binary).to_pylist()]


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def record_batch(columns: dict[str, tuple[pa.DataType, list]]) -> pa.RecordBatch:
    arrays = [pa.array(values, kind) for kind, values in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))
