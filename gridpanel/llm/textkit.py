"""Vectorised text primitives for Arrow batches: words, lines and their hashes.

A batch's text column is viewed as one byte array with offsets, without a copy.
Words are runs of bytes outside space and 0x09-0x0D and never cross documents.
Word and line keys are 64-bit polynomial hashes over a random byte table.
Null texts count as empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Arrays of eight bytes for each of these stay in a core's cache, and their memory is used again instead of asked for anew.
CHUNK_BYTES = 1 << 18
_rng = np.random.default_rng(20_240_229)
BYTE_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_TABLE = BYTE_TABLE.copy()
LOWER_TABLE[65:91] = BYTE_TABLE[97:123]
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i < n."""
    if len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and one offset more than it has rows; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(batch: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``limit`` text bytes (one row at least): first, end, bytes, offsets."""
    raw, at = text_buffers(batch.column("text"))
    first = 0
    while first < len(at) - 1:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, end, raw[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


class Hasher:
    """Prefix sums of a byte array that give the hash of any range at once."""

    def __init__(self, raw: np.ndarray, lower: bool):
        up, self.down = powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((LOWER_TABLE if lower else BYTE_TABLE).take(raw) * up[:-1], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + length)


class WordSums:
    """Prefix sums of word hashes that give the hash of any run of words at once."""

    def __init__(self, words: np.ndarray):
        up, self.down = powers(len(words) + 1)
        self.words = len(words)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[:-1], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def word_ranges(raw: np.ndarray, at: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in order, and the first word of each document (one more than rows)."""
    solid = ~separators.take(raw)
    border = np.zeros(len(raw) + 1, bool)
    border[at] = True
    before = np.empty(len(raw), bool)
    after = np.empty(len(raw), bool)
    if len(raw):
        before[0], before[1:] = True, ~solid[:-1]
        after[-1], after[:-1] = True, ~solid[1:]
        before |= border[:-1]
        after |= border[1:]
    starts = np.flatnonzero(solid & before)
    return starts, np.flatnonzero(solid & after) + 1, np.searchsorted(starts, at)


def before(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of set flags before each position, from the bit counts of 64 flags at a time."""
    words = np.zeros(len(flags) // 64 + 1, "<u8")
    bits = np.packbits(flags, bitorder="little")
    words.view(np.uint8)[: len(bits)] = bits
    sums = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.bitwise_count(words), out=sums[1:])
    word = at >> 6
    below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
    return sums[word] + np.bitwise_count(words[word] & below)


def per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of a 0/1 array over each document's range."""
    return np.diff(before(flags, at))


def row_of(first: np.ndarray) -> np.ndarray:
    """Row number of each element, from the positions of the rows' first elements."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
