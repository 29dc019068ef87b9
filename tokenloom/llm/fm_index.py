"""A compressed full-text index of word sequences: BWT in a wavelet matrix, searched in lockstep.

The index holds ``n`` word numbers in ``n * ceil(log2(words))`` bits plus one counter per 64 bits.
Suffixes are ordered by their first ``DEPTH`` words, which is enough for backward search of
patterns up to that length.
"""

from __future__ import annotations

import numpy as np

DEPTH = 128
_LOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        raw = np.packbits(bits, bitorder="little")
        packed[: len(raw)] = raw
        self.words = packed.view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words[:-1]), dtype=np.int64))).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = at >> 6
        return self.before[block] + np.bitwise_count(self.words[block] & _LOW[at & 63])


class FMIndex:
    """Index of ``seq``, whose values are in ``[0, size)``; 0 separates texts."""

    def __init__(self, seq: np.ndarray, size: int):
        n = len(seq)
        rank, reach = seq.astype(np.int64), 1
        while reach < DEPTH:
            key = rank * (int(rank.max()) + 2)
            key[: n - reach] += rank[reach:] + 1
            order = np.argsort(key)
            new = np.ones(n, bool)
            new[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            reach *= 2
            if new.all():
                break
        order = np.argsort(rank, kind="stable")
        bwt = seq[order - 1]  # the text is read as a ring; separators keep patterns apart
        self.n = n
        self.count = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=size)))).astype(np.int32)
        self.levels = []
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bit = (bwt >> shift) & 1
            self.levels.append((shift, Bits(bit), n - int(bit.sum())))
            bwt = np.concatenate((bwt[bit == 0], bwt[bit == 1]))
        every = np.arange(size, dtype=np.int32)
        self.shift = self.count[:-1] - self._walk(every, np.zeros(size, np.int32))

    def _walk(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((c >> shift) & 1, ones + zeros, at - ones)
        return at

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals after putting word ``c`` before the pattern."""
        ends = self._walk(np.concatenate((c, c)), np.concatenate((lo, hi)))
        return ends[: len(c)] + self.shift[c], ends[len(c) :] + self.shift[c]


def repeated_windows(index: FMIndex, seq: np.ndarray, start: np.ndarray, end: np.ndarray, need: np.ndarray, window: int) -> np.ndarray:
    """Mark each place of ``seq`` where a window starts that occurs ``need`` times in the index.

    All texts ``seq[start[k]:end[k]]`` are streamed right to left together. The pattern
    ``seq[i:e]`` grows to the left while it occurs often enough (its length is the matching
    statistic of place i). When word f cannot be added, windows over ``seq[f:e]`` are out; a probe
    of 1, 2, 4, ... words from f finds how far left the pattern's end may be moved at once.
    """
    found = np.zeros(len(seq), bool)
    k = np.flatnonzero(end - start >= window)
    start, e, need = start[k].astype(np.int64), end[k].astype(np.int64), need[k]
    i, saved = e.copy(), e.copy()
    lo, hi = np.zeros(len(k), np.int32), np.full(len(k), index.n, np.int32)
    target, step, probed = np.full(len(k), -1), np.zeros(len(k), np.int64), np.full(len(k), -1)
    live = np.arange(len(k))

    def restart(s: np.ndarray, at: np.ndarray) -> None:
        i[s] = at
        lo[s], hi[s] = 0, index.n

    while len(live):
        low, high = index.extend(seq[i[live] - 1], lo[live], hi[live])
        good = high - low >= need[live]
        probing = target[live] >= 0
        s = live[good]
        lo[s], hi[s] = low[good], high[good]
        i[s] -= 1
        s = live[good & ~probing]
        long = s[e[s] - i[s] >= window]
        found[i[long]] = True
        s = live[good & probing]
        s = s[i[s] == target[s]]
        if len(s):  # these words still occur: look at twice as many, or give up
            step[s] *= 2
            over = target[s] + step[s] >= saved[s]
            restart(s, target[s] + step[s])
            s = s[over]
            probed[s] = target[s]
            e[s] = np.minimum(saved[s] - 1, target[s] + window)
            target[s] = -1
            restart(s, e[s])
        s = live[~good & ~probing]
        if len(s):
            f, length = i[s] - 1, e[s] - i[s] + 1
            plain = (length <= 2) | (probed[s] == f)
            p = s[plain]
            e[p] = np.minimum(e[p] - 1, f[plain] + window)
            restart(p, e[p])
            p = s[~plain]
            target[p], step[p], saved[p] = f[~plain], 1, e[p]
            restart(p, f[~plain] + 1)
        s = live[~good & probing]
        if len(s):
            e[s] = target[s] + step[s] - 1
            target[s] = -1
            restart(s, e[s])
        rest = (e[live] - start[live] >= window) & (i[live] > start[live])
        live = live[rest | (target[live] >= 0)]
    return found
