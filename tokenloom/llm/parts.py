"""Texts as sequences of few distinct parts, for tokenizers that never merge across them.

A part is a word with the one separator before it: nothing (at the start), a single space or a
single line feed. Any other white space makes a row *odd*; odd rows are left to the caller, whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .wordhash import mix, slices, utf8, words

SLICE_BYTES = 1 << 22
_INNER_BYTES = 1 << 20
_GLUE = (b"", b" ", b"\n")


@dataclass
class Parts:
    """Row r has the parts ``which[first[r]:first[r + 1]]``, numbers of distinct parts."""

    first: np.ndarray
    which: np.ndarray
    names: np.ndarray  # 64-bit hashes of the distinct parts, ascending
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    glue: np.ndarray
    odd: np.ndarray

    def texts(self, use: np.ndarray, glue: tuple[bytes, ...] = _GLUE) -> list[bytes]:
        """The chosen distinct parts, with other separators if given."""
        raw = self.data.tobytes()
        return [glue[g] + raw[x:y] for g, x, y in zip(self.glue[use].tolist(), self.start[use].tolist(), self.end[use].tolist())]

    def joined(self, use: np.ndarray, mark: int) -> bytes:
        """The chosen distinct parts in one run of bytes, ``mark`` before each."""
        n = self.end[use] - self.start[use]
        extra = 1 + (self.glue[use] > 0)
        begin = np.cumsum(n + extra) - n
        out = np.full(int((n + extra).sum()), mark, np.uint8)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(begin, n) + inner] = self.data[np.repeat(self.start[use], n) + inner]
        glued = self.glue[use] > 0
        out[(begin - 1)[glued]] = np.array([0, 32, 10], np.uint8)[self.glue[use][glued]]
        return out.tobytes()

    def gather(self, pieces: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, values): rows made of the values of their parts; ``pieces`` holds the values of all
        distinct parts one after another, ``length`` how many each has."""
        begin = np.concatenate(([0], np.cumsum(length)))
        n = length[self.which]
        ends = np.concatenate(([0], np.cumsum(n)))
        at = np.repeat(begin[self.which] - ends[:-1], n) + np.arange(ends[-1])
        return ends[self.first], pieces[at]


def _odd_space(data: np.ndarray) -> np.ndarray:
    """Places of control or non-ASCII white space (of any script, and a little more)."""
    found = (data >= 0x1C) & (data <= 0x1F) | (data == 0xE3) | (data == 0xE1)
    two = np.zeros(len(data), bool)
    two[:-1] = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0)) | (data[:-1] == 0xE2) & ((data[1:] == 0x80) | (data[1:] == 0x81))
    return found | two


def distinct_parts(arr: pa.Array) -> Parts:
    """Parts of each row; null counts as empty."""
    data, off = utf8(arr)
    names, starts, ends, glues, counts = [], [], [], [], []
    odd = np.zeros(len(arr), bool)
    for a, b in slices(arr, _INNER_BYTES):
        w = words(arr.slice(a, b - a))
        n = np.diff(w.first)
        counts.append(n)
        head = np.zeros(len(w.start), bool)
        head[w.first[:-1][n > 0]] = True
        before = w.start - np.where(head, np.repeat(w.offsets[:-1], n), np.concatenate(([0], w.end))[:-1])
        last = w.data[np.maximum(w.start - 1, 0)]
        glue = np.where(head & (before == 0), 0, np.where((before == 1) & ~head & (last == 32), 1, np.where((before == 1) & ~head & (last == 10), 2, 3)))
        bad = np.bincount(w.rows[glue == 3], minlength=b - a) > 0
        tail = np.where(n > 0, w.offsets[1:] - np.concatenate((w.end, [0]))[np.maximum(w.first[1:] - 1, 0)], np.diff(w.offsets))
        bad |= tail > 0
        strange = np.flatnonzero(_odd_space(w.data))
        if len(strange):
            bad |= np.bincount(np.searchsorted(w.offsets, strange, side="right") - 1, minlength=b - a) > 0
        odd[a:b] = bad
        names.append(mix(w.hashes() + glue.astype(np.uint64)))
        starts.append(w.start + off[a])
        ends.append(w.end + off[a])
        glues.append(glue)
    first = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1, np.int64)
    keep = np.repeat(~odd, np.diff(first))
    first = np.concatenate(([0], np.cumsum(np.where(odd, 0, np.diff(first)))))
    name, start, end, glue = (np.concatenate(x)[keep] if x else np.zeros(0, np.int64) for x in (names, starts, ends, glues))
    order = np.argsort(name)
    name = name[order].astype(np.uint64)
    new = np.ones(len(name), bool)
    new[1:] = name[1:] != name[:-1]
    which = np.empty(len(name), np.int64)
    which[order] = np.cumsum(new) - 1
    at = order[new]
    return Parts(first, which, name[new], data, start[at], end[at], glue[at], odd)


class Known:
    """Values of parts met before in this worker, in flat arrays of up to ``room`` parts; a full table
    starts anew."""

    def __init__(self, room: int = 1_000_000):
        self.room = room
        self.clear()

    def clear(self) -> None:
        self.names, self.start, self.length, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def find(self, names: np.ndarray) -> np.ndarray:
        """The place of each (ascending) name, or -1."""
        if not len(self.names):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[at] == names, at, -1)

    def merge(self, names: np.ndarray, known: np.ndarray, new: np.ndarray, values: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, length) of all ``names``, of which ``new`` were just worked out; keeps them."""
        old = np.flatnonzero(known >= 0)
        start, size = np.empty(len(names), np.int64), np.empty(len(names), np.int64)
        start[old], size[old] = self.start[known[old]], self.length[known[old]]
        start[new], size[new] = len(self.values) + np.cumsum(length) - length, length
        pool = np.concatenate((self.values, values))
        ends = np.cumsum(size)
        out = pool[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        if len(self.names) + len(new) > self.room:
            self.clear()
        else:
            at = np.searchsorted(self.names, names[new])
            self.names, self.start = np.insert(self.names, at, names[new]), np.insert(self.start, at, start[new])
            self.length, self.values = np.insert(self.length, at, length), pool
        return out, size
