"""Statistics of whole texts, vectorised over a slice of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .wordhash import Words, fits, grams, mix, span_hashes, words

REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"


#: Each byte counts for one of these.
CLASSES = ("rest", "upper", "lower", "digit", "symbol", "bar", "bang", "stop", "comma", "mark", "line", "wide", "tail")
_CLASS = np.zeros(256, np.int64)
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum()]] = CLASSES.index("mark")
for _name, _bytes in (("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)), ("symbol", SYMBOLS), ("bar", b"|"), ("bang", b"!"), ("stop", b"."), ("comma", b","), ("line", b"\n"), ("wide", range(0xC0, 256)), ("tail", range(0x80, 0xC0))):
    _CLASS[list(_bytes)] = CLASSES.index(_name)


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values[offsets[r]:offsets[r + 1]]``."""
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _keyed(rows: np.ndarray, names: np.ndarray) -> np.ndarray:
    return mix(names + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def distinct(rows: np.ndarray, names: np.ndarray, n: int) -> np.ndarray:
    """Distinct names of each of ``n`` rows."""
    key = _keyed(rows, names)
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    return np.bincount(rows[order[new]], minlength=n)


def duplicate_lines(w: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    breaks = np.flatnonzero(w.data == 10)
    start = np.unique(np.concatenate((w.offsets[:-1], breaks + 1)))
    start = start[start < len(w.data)]
    row = np.searchsorted(w.offsets, start, side="right") - 1
    stop = np.minimum(np.append(start[1:], len(w.data)), w.offsets[row + 1])
    stop = np.where((stop > start) & (w.data[np.maximum(stop - 1, 0)] == 10), stop - 1, stop)
    solid = np.searchsorted(w.start, stop) > np.searchsorted(w.start, start)
    row, start, stop = row[solid], start[solid], stop[solid]
    n = len(w.offsets) - 1
    if not len(row):
        return np.zeros(n, np.int64)
    return np.bincount(row, minlength=n) - distinct(row, span_hashes(w.data, start, stop), n)


def repeated_words(w: Words, h: np.ndarray, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Words covered by ``size``-word windows found twice or more in their row."""
    g = grams(h, size)
    at = np.flatnonzero(fits(w, size, len(g)))
    if not len(at):
        return np.zeros(len(w.first) - 1, np.int64)
    key = _keyed(w.rows[at], g[at])
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(w.first) - 1, np.int64)
    hit = at[twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key]
    step = np.zeros(len(h) + 1, np.int32)
    step[hit] += 1
    step[hit + size] -= 1
    return row_sums(np.cumsum(step[:-1]) > 0, w.first)


def statistics(arr: pa.Array) -> tuple[Words, np.ndarray, dict[str, np.ndarray]]:
    """Words, their hashes and the counts of each row; null counts as empty."""
    w = words(arr)
    h = w.hashes() if len(w.start) else np.zeros(0, np.uint64)
    n = len(arr)
    rows = np.repeat(np.arange(n) * len(CLASSES), np.diff(w.offsets))
    kinds = np.bincount(rows + _CLASS[w.data], minlength=n * len(CLASSES)).reshape(n, -1)
    out = dict(zip(CLASSES, kinds.T))
    out["symbol"] = out["symbol"] + out["bar"]
    return w, h, out | {
        "chars": np.diff(w.offsets) - out["tail"],
        "n_words": np.diff(w.first).astype(np.int64),
        "word_chars": row_sums(w.chars(), w.first) if len(w.start) else np.zeros(n, np.int64),
        "n_dup_lines": duplicate_lines(w),
        "n_repeat_words": repeated_words(w, h),
    }
