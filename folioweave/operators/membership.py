"""A Bloom filter of bounded size that keeps rows without a partner out of a shuffle.

The filter is made of bitmaps which executors aggregate, FILTER_BITS bits a key and at most
MAX_FILTER_BITS in all, so it can be sent to every executor whatever the data. It never loses a
row; beyond its bound it only lets more rows through, and the exact join afterwards decides.

Defined results: null keys are no members; an empty key table lets nothing through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BITS, MAX_FILTER_BITS, BITMAP = 24, 1 << 29, 32768
# Odd 64-bit multipliers whose products have well mixed upper bits.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def probes(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Three places of every 64-bit key in a filter of 2 ** n bits."""
    x = keys.view(np.uint64)
    for multiplier in MULTIPLIERS:
        with np.errstate(over="ignore"):
            yield ((x * np.uint64(multiplier)) >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


def _flat(column: pa.Array) -> np.ndarray:
    values = column.flatten() if pa.types.is_list(column.type) else column
    return values.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)


def key_filter(keys: DataFrame, n_keys: int) -> np.ndarray:
    """The filter of all values in the columns of ``keys``, bigint or array<bigint>."""
    bits = BITMAP
    while bits < min(FILTER_BITS * n_keys, MAX_FILTER_BITS):
        bits *= 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.concatenate([np.empty(0, dtype=np.int64), *(_flat(c) for c in batch.columns)])
            at = np.unique(np.concatenate(list(probes(values, bits))))
            yield pa.RecordBatch.from_arrays([pa.array(at // BITMAP), pa.array(at % BITMAP)], names=["no", "at"])

    # At most MAX_FILTER_BITS / BITMAP rows of 4 KiB.
    rows = keys.mapInArrow(places, "no bigint, at bigint").groupBy("no").agg(F.bitmap_construct_agg("at").alias("b")).collect()
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:
        out[r["no"] * (BITMAP // 8) : (r["no"] + 1) * (BITMAP // 8)] = np.frombuffer(bytes(r["b"]), dtype=np.uint8)
    return out


def contains(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter."""
    hit = np.ones(len(keys), dtype=bool)
    for at in probes(keys, 8 * len(bitmap)):
        hit &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return hit


def may_be_in(df: DataFrame, bitmap: np.ndarray, key: Column) -> DataFrame:
    """The rows of ``df`` whose ``key`` (bigint) may be in the filter, in one narrow stage."""
    kept = df.sparkSession.sparkContext.broadcast(bitmap)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            hit = contains(kept.value, column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            hit &= column.is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(pa.array(hit))

    return df.withColumn("__key", key).mapInArrow(test, df.schema)
