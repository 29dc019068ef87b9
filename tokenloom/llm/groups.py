"""Groups of ordered Arrow batches, one at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """One record batch per group; rows arrive ordered by ``keys``, which must not be null."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        change = np.zeros(len(batch), bool)
        for c in keys:
            v = batch[c].to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
            if held and held[-1][c][-1].as_py() != v[0]:
                change[0] = True
        cut = np.flatnonzero(change).tolist()
        last = 0
        for x in cut:
            if x > last:
                held.append(batch.slice(last, x - last))
            if held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, last = [], x
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
