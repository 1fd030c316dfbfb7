"""Words and shingles of whole Arrow text columns, as numpy arrays.

All functions work on a slice of a record batch at a time, so the memory of a
task follows ``SLICE_BYTES`` or its longest single text, never its row count.
Word boundaries are found on UTF-8 bytes, which is exact for separators below
0x80: no byte of a longer character is below 0x80.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20

# Bytes and rows that Spark hands to a Python worker at a time.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 4096

# Longer words are hashed one by one; shorter ones column by column.
_SHORT = 48
_FNV = np.uint64(0x100000001B3)
_SEED = np.uint64(0xCBF29CE484222325)

# White space of the contracts: space and 0x09 to 0x0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# ASCII letters and digits and every byte of a longer character.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def bounded(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on hands texts to Python workers in batches of bounded size."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(_offsets(batch.column(column)))
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(low, high - low)


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on every other."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Text:
    """Bytes of a text column: ``data`` and the byte range of each row (a null row is empty)."""

    def __init__(self, column: pa.Array, lower: bool = False):
        offsets = _offsets(column)
        buffer = column.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        self.data = data[offsets[0] : offsets[-1]]
        if lower:
            self.data = LOWER[self.data]
        self.bounds = offsets - offsets[0]
        self.rows = len(column)


class Words(Text):
    """The words of each row: ``starts`` and ``ends`` in ``data``; row ``r`` has words ``first[r]`` to ``first[r + 1]``."""

    def __init__(self, column: pa.Array, inside: np.ndarray = NOT_SPACE, lower: bool = False):
        super().__init__(column, lower)
        flag = inside[self.data]
        size = len(flag)
        filled = self.bounds[:-1][np.diff(self.bounds) > 0]
        before = np.empty(size, bool)
        after = np.empty(size, bool)
        if size:
            before[1:], before[filled] = ~flag[:-1], True
            before[0] = True
            after[:-1], after[-1] = ~flag[1:], True
            after[filled[1:] - 1] = True
        self.starts = np.flatnonzero(flag & before)
        self.ends = np.flatnonzero(flag & after) + 1
        self.first = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; it depends on the word and the seed alone."""
        lengths = self.ends - self.starts
        value = np.full(len(lengths), _SEED ^ mix(np.array([seed], np.uint64))[0], np.uint64)
        live = np.flatnonzero(lengths <= _SHORT)
        at = 0
        while len(live):
            value[live] = (value[live] ^ self.data[self.starts[live] + at]) * _FNV
            at += 1
            live = live[lengths[live] > at]
        for i in np.flatnonzero(lengths > _SHORT):
            value[i] = xxhash.xxh64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes(), seed)
        return mix(value + lengths.astype(np.uint64))

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)

    def bytes_of(self, i: int, j: int) -> bytes:
        """The words ``i`` to ``j - 1``, joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[i:j], self.ends[i:j], strict=True))


def rolling(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` words by its first word; runs across rows are the caller's to leave out."""
    count = max(0, len(words) - size + 1)
    out = np.full(count, np.uint64(seed), np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count]
    return mix(out)


def run_starts(first: np.ndarray, size: int, total: int) -> np.ndarray:
    """True for each of the first ``total - size + 1`` words that begins a run of ``size`` words inside its row."""
    count = max(0, total - size + 1)
    counts = np.diff(first)
    left = np.repeat(first[1:], counts)[:count] - np.arange(count)
    return left >= size
