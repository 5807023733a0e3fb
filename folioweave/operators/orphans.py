"""References to records that do not exist at their time (problem 4).

Both sides are reduced to one row per key and month: referenced, and the last state in the month.
These rows are partitioned and sorted by key, and every task cuts its keys into ranges of up to
RANGE_BITS keys. Within a range a key's number is its bit. Per month of a range the referenced
keys, the keys that changed and their last states form compressed bitmaps; one pass over the months
keeps the bitmap of the keys that exist and computes ``referenced AND NOT (existing AND NOT changed
in the month)``. Surviving bits are decoded to keys in the same task, as it holds the range's
dictionary. References are then tested against a Bloom filter of the open keys, and only those
that pass are joined back; keys that changed within the month are checked by the exact time.

Bitmaps are stored compressed: at most ``ARRAY_MAX`` bits as a sorted uint16 array, more as a
packed bitset of 4 KiB.

Defined results: null and blank references, null keys and references without a time are no
cases; a null parent key or time is no change; of several changes at one time a delete wins
over an upsert; repeated rows count once; an empty parent table makes every reference an
orphan; extra columns are ignored.

Skew: a hot key is reduced to its months before it is shuffled; the last joins are salted by the
largest number of references to one open key in a month (HOT_ROWS a salt).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioweave.operators.membership import key_filter, may_be_in
from folioweave.session import cut, partitions

RANGE_BITS = 32768
ARRAY_MAX = 2048
HOT_ROWS = 100_000
OPEN_SCHEMA = "a bigint, b bigint, month_no int, changed boolean, before boolean"


def compress(bits: np.ndarray) -> bytes:
    """Sorted distinct bit numbers below RANGE_BITS as an array or a bitset."""
    if len(bits) <= ARRAY_MAX:
        return b"a" + bits.astype("<u2").tobytes()
    return b"b" + pack(bits).tobytes()


def pack(bits: np.ndarray) -> np.ndarray:
    flags = np.zeros(RANGE_BITS, dtype=np.uint8)
    flags[bits] = 1
    return np.packbits(flags)


def expand(stored: bytes) -> np.ndarray:
    """A stored bitmap as a packed bitset."""
    if stored[:1] == b"a":
        return pack(np.frombuffer(stored, dtype="<u2", offset=1))
    return np.frombuffer(stored, dtype=np.uint8, offset=1)


def decode(packed: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(packed)).astype(np.int64)


def bitmaps(bit: np.ndarray, month: np.ndarray, is_ref: np.ndarray, state: np.ndarray) -> list[tuple[int, bytes, bytes, bytes]]:
    """Month, and the bitmaps of the references, of the keys left existing and of those left absent, in order of months.

    ``state`` is 1 or 0 after the last change of the month, -1 without one.
    """
    order = np.lexsort((bit, month))
    bit, month, is_ref, state = bit[order], month[order], is_ref[order], state[order]
    cuts = np.flatnonzero(np.diff(month)) + 1
    parts = zip(*(np.split(x, cuts) for x in (bit, month, is_ref, state)))
    return [(int(m[0]), compress(b[r]), compress(b[s == 1]), compress(b[s == 0])) for b, m, r, s in parts if len(b)]


def open_bits(maps: list[tuple[int, bytes, bytes, bytes]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Month, bits, changed and before of the references AND NOT existing throughout the month."""
    there = np.zeros(RANGE_BITS // 8, dtype=np.uint8)
    for month, *stored in maps:
        refs, ups, downs = map(expand, stored)
        changed = ups | downs
        bits = decode(refs & ~(there & ~changed))
        if len(bits):
            yield month, bits, np.unpackbits(changed)[bits].astype(bool), np.unpackbits(there)[bits].astype(bool)
        there = (there | ups) & ~downs


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows a, b, month_no, is_ref, state sorted by key, a range of keys at a time."""
    kept = [np.empty(0, dtype=np.int64)] * 5

    def scan_range(columns: list[np.ndarray], first: np.ndarray, bit: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = columns[0][first], columns[1][first]  # the dictionary of the range
        for month, bits, changed, before in open_bits(bitmaps(bit, columns[2], columns[3] == 1, columns[4])):
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[bits]), pa.array(b[bits]), pa.array(np.full(len(bits), month, dtype=np.int32)), pa.array(changed), pa.array(before)],
                names=["a", "b", "month_no", "changed", "before"],
            )

    def ranges(columns: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
        a, b = columns[0], columns[1]
        starts = np.flatnonzero(np.concatenate(([len(a) > 0], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        code = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(a))))
        # The last key may go on in the next batch.
        while len(starts) > RANGE_BITS or last and len(starts):
            n = min(RANGE_BITS, len(starts))
            end = starts[n] if n < len(starts) else len(code)
            yield from scan_range([c[:end] for c in columns], starts[:n], code[:end])
            columns, code, starts = [c[end:] for c in columns], code[end:] - n, starts[n:] - end
        kept[:] = columns

    for batch in batches:
        rows = [np.concatenate([k, c.to_numpy(zero_copy_only=False).astype(np.int64)]) for k, c in zip(kept, batch.columns)]
        yield from ranges(rows, False)
    yield from ranges(list(kept), True)


def _month_no(ts: Column) -> Column:
    return (F.year(ts) * 12 + F.month(ts) - 1).alias("month_no")


def _micros(at: Column, kind: str) -> Column:
    """A time as a number that keeps the order; times without a zone do not go through the session's zone."""
    if kind != "timestamp_ntz":
        return F.unix_micros(at.cast("timestamp"))
    seconds = F.datediff(at, F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("bigint")


def _hash_key(key: Column) -> list[Column]:
    """Keys as 128 bits of hash, 16 bytes in every shuffle; two keys of 10^12 share them with a chance below 10^-14."""
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit(7919), key).alias("b")]


def orphan_references(refs: DataFrame, changes: DataFrame) -> DataFrame:
    """ref_id, which and at of the rows of ``refs`` whose key does not exist at their time.

    ``refs``: ref_id (unique with ``which``), which, key, at. ``changes``: key, at, up (boolean).
    ``key`` may be any type that can be grouped, also a struct.
    """
    key = F.col("key")
    refs = cut(refs.where(key.isNotNull() & F.col("at").isNotNull()).select("ref_id", "which", *_hash_key(key), "at"))
    changes = cut(changes.where(key.isNotNull() & F.col("at").isNotNull() & F.col("up").isNotNull()).select(*_hash_key(key), "at", "up"))

    # One row per key and month. The order of changes as a number: by time, at equal times a delete wins.
    last = _micros(F.col("at"), dict(changes.dtypes)["at"]) * 2 + (~F.col("up")).cast("int")
    used = refs.select("a", "b", _month_no(F.col("at")), F.lit(1).alias("is_ref"), F.lit(None).cast("bigint").alias("last"))
    used = used.unionByName(changes.select("a", "b", _month_no(F.col("at")), F.lit(0).alias("is_ref"), last.alias("last")))
    months = used.groupBy("a", "b", "month_no").agg(F.max("is_ref").alias("is_ref"), F.max("last").alias("last"))
    months = months.select("a", "b", "month_no", "is_ref", F.coalesce(F.when(F.pmod("last", F.lit(2)) == 0, 1).otherwise(F.when(F.col("last").isNotNull(), 0)), F.lit(-1)).alias("state"))
    open_keys = months.repartition(partitions(refs), "a", "b").sortWithinPartitions("a", "b").mapInArrow(_scan, OPEN_SCHEMA)
    open_keys = cut(open_keys)

    tag = F.xxhash64("a", "b", _month_no(F.col("at")))
    open_tag = F.xxhash64("a", "b", "month_no")
    hits = may_be_in(refs, key_filter(open_keys.select(open_tag), open_keys.count()), tag).withColumn("month_no", _month_no(F.col("at")))
    hits = cut(hits)
    top = hits.groupBy("a", "b", "month_no").count().agg(F.max("count")).head()[0]
    salts = -(-(top or 1) // HOT_ROWS)
    hits = hits.withColumn("salt", F.pmod(F.xxhash64("ref_id", "which"), F.lit(salts)).cast("int"))
    salted = open_keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = ["a", "b", "month_no", "salt"]
    hit = hits.join(salted, on)

    # Keys with changes in the month: the last change at or before the reference decides.
    moved = open_keys.where("changed")
    moves = may_be_in(changes, key_filter(moved.select(open_tag), moved.count()), tag).withColumn("month_no", _month_no(F.col("at")))
    moves = moves.join(salted.where("changed").select(*on), ["a", "b", "month_no"])
    kind = dict(refs.dtypes)
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    both = (
        hit.where("changed").select(*on, "ref_id", "which", "at", "before", none("up", "boolean"))
        .unionByName(moves.select(*on, none("ref_id", kind["ref_id"]), none("which", kind["which"]), "at", none("before", "boolean"), "up"))
    )
    # Order at equal times: upsert, delete, reference.
    order = F.when(F.col("up").isNull(), 2).when(F.col("up"), 0).otherwise(1)
    w = Window.partitionBy(*on).orderBy("at", order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    late = both.withColumn("state", F.last("up", ignorenulls=True).over(w)).where(F.col("ref_id").isNotNull() & ~F.coalesce("state", "before"))
    absent = hit.where(~F.col("changed"))
    return absent.select("ref_id", "which", "at").unionByName(late.select("ref_id", "which", "at"))
