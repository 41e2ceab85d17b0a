"""Bitmaps of fixed size over hashed values: what is not in them can be left out early.

The size does not depend on the data. With many more values than bits a bitmap lets
everything pass, which costs time and changes no result, since an exact join follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import mix, release_memory
from tallyloom.llm.tables import stored

BITMAP_BITS = 1 << 25  # four megabytes
BUCKET_BYTES = 4096  # fixed by the bitmap functions: 32768 bits a bucket


def _spots(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(values.view(np.uint64)) % np.uint64(bits)).astype(np.int64)


def bitmap_of(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """One bit for each value's place. Buckets are put together on the executors, so at most
    `bits` bits reach the driver, however many rows there are."""

    def places(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            values = batch.column(0).drop_null().to_numpy()
            spots = np.unique(_spots(values, bits))
            # The bitmap functions count from 1.
            yield pa.RecordBatch.from_arrays([pa.array(spots + 1, pa.int64())], names=["bit"])

    marked = rows.select(F.col(column).cast("long")).mapInArrow(places, "bit long")
    parts = marked.groupBy(F.expr("bitmap_bucket_number(bit)").alias("part")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")
    )
    out = np.zeros(-(-bits // (8 * BUCKET_BYTES)) * BUCKET_BYTES, np.uint8)
    for part, piece in parts.collect():
        begin = (part - 1) * BUCKET_BYTES
        out[begin : begin + BUCKET_BYTES] = np.frombuffer(bytes(piece), np.uint8)
    return out


def in_bitmap(values: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    spots = _spots(values, bits)
    return (bitmap[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1 == 1


def probably_in(
    rows: DataFrame, column: str, bitmap: np.ndarray, bits: int, inside: bool = True
) -> DataFrame:
    """The rows whose value may be in the bitmap, or the others; null values are not in it."""
    at = rows.columns.index(column)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids = batch.column(at).cast(pa.int64())
            hit = in_bitmap(ids.fill_null(0).to_numpy(), bitmap, bits)
            hit &= ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit == inside))
            release_memory()

    return rows.mapInArrow(batches, rows.schema)


def without(rows: DataFrame, key: str, gone: DataFrame, column: str) -> DataFrame:
    """The rows whose key is not in the column; only rows that may be in it are shuffled."""
    gone = stored(gone.select(F.col(column).alias("_gone")).distinct(), "gone")
    bitmap = bitmap_of(gone, "_gone", BITMAP_BITS)
    doubtful = probably_in(rows, key, bitmap, BITMAP_BITS)
    kept = doubtful.join(gone, doubtful[key] == gone["_gone"], "left_anti")
    return probably_in(rows, key, bitmap, BITMAP_BITS, inside=False).union(kept)
