"""Vectorised text primitives shared by the corpus operators.

Arrow string columns are handled as one byte buffer with offsets. A block of
about half a megabyte is processed at a time, so memory stays bounded whatever
the batch size is (a single longer text is a block of its own; texts are never
cut).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: ASCII white space: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
WORD = ~SPACE
#: Digits, lower-case letters and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

_powers = np.ones(1, U64)
_inverses = np.ones(1, U64)


def _grow(n: int) -> None:
    """Make the power tables hold at least n entries."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, BLOCK_BYTES + 8)
        p = np.full(size, _BASE, U64)
        q = np.full(size, _BASE_INV, U64)
        p[0] = q[0] = 1
        _powers, _inverses = np.cumprod(p, dtype=U64), np.cumprod(q, dtype=U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of symbols[start:end], equal for equal content."""
    n = len(symbols)
    _grow(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum((symbols.astype(U64) + U64(1)) * _powers[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * _inverses[starts])


class Block:
    """Rows [first, last) of a batch: their bytes and the offsets of each text in them."""

    def __init__(self, data: bytes, offsets: np.ndarray, first: int, last: int):
        self.raw, self.offsets, self.first, self.last = data, offsets, first, last
        self.bytes = np.frombuffer(data, np.uint8)
        self.n = last - first

    def lower(self) -> "Block":
        return Block(self.raw.translate(LOWER), self.offsets, self.first, self.last)

    def text(self, i: int) -> bytes:
        return self.raw[self.offsets[i] : self.offsets[i + 1]]

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of bytes for which member holds, within each text."""
        inside = member[self.bytes]
        if not inside.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        edges = self.offsets[:-1][self.offsets[:-1] < inside.size]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        begin[edges] = inside[edges]
        close = inside.copy()
        close[:-1] &= ~inside[1:]
        before = edges[edges > 0] - 1
        close[before] = inside[before]
        return np.flatnonzero(begin), np.flatnonzero(close) + 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """span_hashes() of the block's bytes; the prefix sums are kept for further calls."""
        if not hasattr(self, "_prefix"):
            n = len(self.bytes)
            _grow(n + 1)
            self._prefix = np.zeros(n + 1, U64)
            np.cumsum((self.bytes.astype(U64) + U64(1)) * _powers[:n], out=self._prefix[1:])
        return mix((self._prefix[ends] - self._prefix[starts]) * _inverses[starts])

    def words(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the runs of member bytes, the index of each text's first run, and the texts of the runs."""
        starts, ends = self.runs(member)
        first = np.searchsorted(starts, self.offsets)
        return self.hashes(starts, ends), first, np.repeat(np.arange(self.n), np.diff(first))

    def rows_of(self, positions: np.ndarray) -> np.ndarray:
        """The text that each byte position lies in."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def counts(self, starts: np.ndarray) -> np.ndarray:
        """How many of the sorted positions lie in each text."""
        return np.diff(np.searchsorted(starts, self.offsets))

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Per text, the sum of a per-byte array."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def buffer_of(column) -> tuple[memoryview, np.ndarray]:
    """The bytes and int64 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return memoryview(data if data is not None else b""), offsets


#: Most texts in a block, so that a text's number fits into a byte.
BLOCK_ROWS = 256


def blocks(column, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column's texts in blocks of about `size` bytes and at most BLOCK_ROWS texts."""
    data, offsets = buffer_of(column)
    n, first = len(column), 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        last = min(last, n, first + BLOCK_ROWS)
        lo, hi = int(offsets[first]), int(offsets[last])
        yield Block(bytes(data[lo:hi]), offsets[first : last + 1] - lo, first, last)
        first = last


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of `size` words that lie within a text, and the windows' hashes."""
    n = len(hashes)
    last = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(n) + size <= last)
    key = np.zeros(len(at), U64)
    for k in range(size):
        key = mix(key + hashes[at + k] + U64(k + 1))
    return at, key


def grouped(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum(counts)[:-1]) if len(counts) else []


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift
