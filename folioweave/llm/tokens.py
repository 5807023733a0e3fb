r"""Encoding of a whole corpus with a byte-level BPE tokenizer (problem 6).

Forced-boundary splitting: a pair of adjacent bytes that occurs inside no token of the
vocabulary is a certain cut, since no merge can ever join its two bytes. All texts of a batch are
cut at all such places at once by looking the byte pairs up in a 64 Ki table. The fragments
(mostly single words) are dictionary-encoded, each distinct one is encoded once, and the ids
are gathered back in order, so the cost follows the distinct fragments, not the text.

A cut must also leave the pre-tokenizer's splitting unchanged: it lies at a character start,
the character before is no white space (whose runs look ahead), and an apostrophe is cut off
only from an ASCII letter or digit (within other signs it might otherwise open a contraction).

Defined results: a null or empty text has no ids; special-token strings inside a text are
ordinary text; texts of any length are cut the same way and never shortened; equal texts get
equal ids; an empty table gives an empty table; extra columns are ignored.

The vocabulary file (tiktoken rank format) is a parameter. Executors read it from the path, so
it must exist there; it is loaded once per worker process.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-tokenizer of the byte-level vocabularies. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text encoded at a time within a task.
BLOCK_BYTES = 4 << 20
#: Distinct fragments kept by a worker process; beyond it the memo starts anew.
MEMO_SIZE = 300_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _space_bytes() -> np.ndarray:
    """Bytes that may end a white-space character; every other byte certainly ends none."""
    ends = {chr(c).encode()[-1] for c in range(0x3001) if chr(c).isspace()} | {0x80, 0x85, 0xA0, *range(9, 14), *range(0x1C, 0x21)}
    out = np.zeros(256, dtype=bool)
    out[list(ends)] = True
    return out


def cut_table(ranks: dict[bytes, int]) -> np.ndarray:
    """``table[256 * a + b]``: a text may be cut between the bytes a and b."""
    free = np.ones((256, 256), dtype=bool)
    for token in ranks:
        t = np.frombuffer(token, dtype=np.uint8)
        free[t[:-1], t[1:]] = False
    free[:, 0x80:0xC0] = False  # within a character
    # A multi-byte white space ends in a continuation byte; not cutting after any of its last bytes is safe.
    free[_space_bytes(), :] = False
    plain = np.zeros(256, dtype=bool)
    plain[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
    free[~plain, 0x27] = False
    return free.reshape(-1)


class Encoder:
    """Encodes batches of texts; one per worker process and vocabulary."""

    def __init__(self, path: str) -> None:
        import tiktoken

        ranks = load_ranks(path)
        self.free = cut_table(ranks)
        self.bpe = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.memo: dict[str, list[int]] = {}

    def fragments(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Start offsets of all fragments of the texts that begin at ``starts`` in ``data``."""
        pairs = (data[:-1].astype(np.uint16) << 8) | data[1:]
        mark = np.empty(len(data) + 1, dtype=bool)
        mark[1:-1] = self.free[pairs]
        mark[0] = mark[-1] = True
        mark[starts] = True  # texts never share a fragment
        return np.flatnonzero(mark)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and the ids of all texts."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if texts.null_count:  # nulls may cover bytes; give them none
            texts = pa.concat_arrays([texts.fill_null("")])
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        base, end = offsets[0], offsets[-1]
        if base == end:
            return np.zeros(len(texts) + 1, dtype=np.int64), np.empty(0, dtype=np.int32)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[base:end]
        cuts = self.fragments(data, offsets[:-1][offsets[:-1] < end] - base)
        pieces = pa.LargeStringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(np.ascontiguousarray(cuts, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        code = pieces.indices.to_numpy(zero_copy_only=False)
        words = pieces.dictionary.to_pylist()
        memo = self.memo
        if len(memo) > MEMO_SIZE:
            memo.clear()
        missing = [w for w in words if w not in memo]
        memo.update(zip(missing, map(self.bpe.encode_ordinary, missing)))
        ids = [memo[w] for w in words]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter((i for w in ids for i in w), dtype=np.int32, count=int(sizes.sum()))
        first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        n = sizes[code]
        ends = np.cumsum(n)
        total = int(ends[-1])
        source = np.repeat(first[code] - (ends - n), n) + np.arange(total)
        at = np.concatenate(([0], ends))  # ids before each cut
        return at[np.searchsorted(cuts, offsets - base)], flat[source]


def encoder(path: str) -> Encoder:
    """The encoder of this process; kept in a module, as functions travel to workers by value."""
    kept = sys.modules.setdefault("_folioweave_encoders", types.ModuleType("_folioweave_encoders"))
    if path not in kept.__dict__:
        kept.__dict__[path] = Encoder(path)
    return kept.__dict__[path]


def blocks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in row ranges of about BLOCK_BYTES of text each."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, before + BLOCK_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def encode_table(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``key`` and ``ids`` array<int> of every row, in one narrow stage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for part in blocks(batch, text):
                offsets, ids = e.encode(part.column(text))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(key), lists], names=[key, "ids"])

    return df.select(key, text).mapInArrow(run, f"{key} {dict(df.dtypes)[key]}, ids array<int>")


def count_tokens(df: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``keep`` and ``n_tokens`` of every row."""
    types_of = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for part in blocks(batch, text):
                offsets, _ = e.encode(part.column(text))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(np.diff(offsets))], names=[*keep, "n_tokens"])

    return df.select(*keep, text).mapInArrow(run, ", ".join(f"{k} {types_of[k]}" for k in keep) + ", n_tokens bigint")
