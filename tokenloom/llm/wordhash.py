"""Vectorised words and word hashes over Arrow text batches.

A word is a longest run of bytes other than space and ``\\t \\n \\v \\f \\r`` (which is the same on
UTF-8 bytes as on characters). All functions take whole texts; batches are walked in slices of
a few megabytes so that the 8-byte working arrays stay small. A single longer text makes a slice
of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and its n + 1 offsets; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not pa.types.is_large_binary(arr.type):
        arr = arr.cast(pa.large_string() if pa.types.is_string(arr.type) else pa.large_binary())
    if arr.null_count:
        arr = pc.fill_null(arr, pa.scalar("" if pa.types.is_large_string(arr.type) else b"", arr.type))
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def slices(arr: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (or one row)."""
    off = utf8(arr)[1]
    a = 0
    while a < len(arr):
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, b
        a = b


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes at a time."""
    data = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))  # the 8 bytes from each place on
    at, left = start, end - start
    h = left.astype(np.uint64)
    which = None
    while True:
        x = mix((h if which is None else h[which]) * _STEP + (eight[at] & _LOW_BYTES[np.minimum(left, 8)]))
        if which is None:
            h, which = x, np.arange(len(x))
        else:
            h[which] = x
        more = left > 8
        if not more.any():
            return h
        which, at, left = which[more], at[more] + 8, left[more] - 8


@dataclass
class Words:
    """Words of a slice: ``data[start[i]:end[i]]``; row r has the words ``first[r]:first[r + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return span_hashes(self.data, self.start, self.end)

    def chars(self) -> np.ndarray:
        """Code points of each word."""
        lead = np.concatenate(([0], np.cumsum((self.data & 0xC0) != 0x80)))
        return lead[self.end] - lead[self.start]


def words(arr: pa.Array, lower: bool = False) -> Words:
    """Words of each row; ``lower`` maps A-Z to a-z first."""
    data, off = utf8(arr)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    solid = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return Words(data, off, start, end, np.searchsorted(start, off))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k hashes from each place on (``len(h) - k + 1`` of them, possibly none)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= _STEP
        out += h[j : j + n]
    return mix(out)


def sliding(x: np.ndarray, w: int, op=np.minimum) -> np.ndarray:
    """``op`` over each window of ``w`` values."""
    if len(x) < w:
        return x[:0]
    have, out = 1, x
    while have * 2 <= w:
        out = op(out[:-have], out[have:])
        have *= 2
    return op(out[: len(x) - w + 1], out[w - have : w - have + len(x) - w + 1]) if have < w else out


def fits(w: Words, size: int, count: int) -> np.ndarray:
    """Of the first ``count`` word places, those from which ``size`` words fit into their row."""
    last = np.repeat(w.first[1:], np.diff(w.first))[:count]
    return np.arange(count) + size <= last


def ragged(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list array of ``values`` cut at ``first``."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values).cast(kind))
