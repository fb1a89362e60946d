"""Numpy helpers over whole Arrow string columns: word bounds and window hashes.

All hashes are the same on every machine and in every run. A hash of a range is a polynomial in an
odd base modulo 2**64 over per-symbol random numbers, read off one running sum, so hashing every
window of a block costs a few passes over the block whatever the window's length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
MASK = (1 << 64) - 1
#: Odd base and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

SPACE_BYTES = np.zeros(256, dtype=bool)
SPACE_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finalizer of splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def random_table(size: int, seed: int) -> np.ndarray:
    """`size` fixed 64-bit numbers that look random."""
    steps = np.arange(1, size + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)
    return mixed(steps + U64(seed))


#: Positions that are hashed at a time, so that a very long text needs little beside its result.
PIECE = 1 << 17


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    steps = np.full(n, base & MASK, dtype=U64)
    steps[:1] = 1
    return np.cumprod(steps)


class Powers:
    """Any powers below base**n, from two short tables."""

    LOW = 1 << 12

    def __init__(self, base: int, n: int):
        self.low = powers(base, self.LOW)
        self.high = powers(pow(base, self.LOW, 1 << 64), n // self.LOW + 1)

    def of(self, at: np.ndarray) -> np.ndarray:
        return self.high[at // self.LOW] * self.low[at % self.LOW]

    def between(self, begin: int, end: int) -> np.ndarray:
        return self.of(np.arange(begin, end))


def _of_length(raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return mixed(raw + lengths.astype(U64) * U64(0xD1B54A32D192ED03))


class RangeHash:
    """Hashes of any ranges of one array of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.sums = np.zeros(n + 1, dtype=U64)
        self.inverse, steps = Powers(BASE_INVERSE, n), Powers(BASE, n)
        for a in range(0, n, PIECE):
            b = min(n, a + PIECE)
            np.cumsum(symbols[a:b] * steps.between(a, b), out=self.sums[a + 1 : b + 1])
            self.sums[a + 1 : b + 1] += self.sums[a]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), U64)
        for a in range(0, len(starts), PIECE):
            low, high = starts[a : a + PIECE], ends[a : a + PIECE]
            out[a : a + PIECE] = _of_length((self.sums[high] - self.sums[low]) * self.inverse.of(low), high - low)
        return out


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in one array, and the n+1 offsets; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a block of texts: byte bounds, and each text's range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE_BYTES):
        inside = ~space[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: Words of text i are first[i] .. first[i + 1].
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.data = data

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, seed: int = 1) -> np.ndarray:
        """The same as a `RangeHash` of the bytes' random numbers gives; sums are kept at the words' bounds only."""
        table, n = random_table(256, seed), len(self.data)
        steps, inverse = Powers(BASE, n), Powers(BASE_INVERSE, n)
        low, high = np.empty(len(self.starts), U64), np.empty(len(self.starts), U64)
        before, i, j = np.zeros(1, U64), 0, 0
        for a in range(0, n, PIECE):
            b = min(n, a + PIECE)
            sums = np.concatenate([before, table[self.data[a:b]] * steps.between(a, b)])
            np.cumsum(sums, out=sums)
            k, m = np.searchsorted(self.starts, b), np.searchsorted(self.ends, b, side="right")
            low[i:k], high[j:m] = sums[self.starts[i:k] - a], sums[self.ends[j:m] - a]
            before, i, j = sums[-1:], k, m
        for a in range(0, len(low), PIECE):
            part = slice(a, a + PIECE)
            low[part] = _of_length((high[part] - low[part]) * inverse.of(self.starts[part]), self.ends[part] - self.starts[part])
        return low


def marked(ranges_from: np.ndarray, ranges_to: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in any of the half-open ranges."""
    steps = np.bincount(ranges_from, minlength=n + 1) - np.bincount(ranges_to, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0
