"""Train / valid / test splits by contiguous ranges of a dense row number."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import dense_index

SPLITS = ("train", "valid", "test")
FALLBACK_RATIOS = (0.96, 0.03, 0.01)

Bounds = tuple[float, float] | None


def _normalized(spec: str | Sequence[float]) -> list[float]:
    numbers = [float(x) for x in (re.findall(r"[.0-9]+", spec) if isinstance(spec, str) else spec)]
    if len(numbers) > len(SPLITS) or any(x < 0 for x in numbers):
        raise ValueError(f"a split needs up to {len(SPLITS)} non-negative numbers, got {spec!r}")
    numbers += [0.0] * (len(SPLITS) - len(numbers))
    whole = sum(numbers)
    return [x / whole for x in numbers]


def split_bounds(spec: str | Sequence[float], other: str | Sequence[float] | None = None) -> list[Bounds]:
    """``"960,30,10"`` as cumulative ``(begin, end)`` shares per split; an empty split is None.
    With ``other``, each split is cut to the overlap of both specifications."""

    def ranges(vector):
        ends = [sum(vector[: i + 1]) if i else vector[0] for i in range(len(vector))]
        return list(zip([0.0, *ends[:-1]], ends))

    first = ranges(_normalized(spec))
    second = first if other is None else ranges(_normalized(other))
    both = [(max(a, c), min(b, d)) for (a, b), (c, d) in zip(first, second)]
    return [(b, e) if e > b else None for b, e in both]


def split_ratios(spec: str) -> tuple[float, float, float]:
    """Three integer parts as ratios; anything unreadable falls back to 0.96 / 0.03 / 0.01."""
    try:
        parts = [int(x) for x in spec.split(",")]
        if len(parts) != 3 or not sum(parts):
            return FALLBACK_RATIOS
    except ValueError:
        return FALLBACK_RATIOS
    whole = sum(parts)
    return tuple(p / whole for p in parts)


def range_ends(bounds: Sequence[Bounds], total: Column) -> list[tuple[str, Column, Column]]:
    """(split, first row, end row) per non-empty split, rounded half to even."""
    size = total.cast("double")
    return [
        (name, F.rint(F.lit(b[0]) * size).cast("bigint"), F.rint(F.lit(b[1]) * size).cast("bigint"))
        for name, b in zip(SPLITS, bounds)
        if b is not None
    ]


def split_ranges(counts: DataFrame, bounds: Sequence[Bounds], total: str = "n_rows") -> DataFrame:
    """The row range of each split, per row of ``counts``."""
    parts = [
        F.struct(F.lit(n).alias("split"), b.alias("begin"), e.alias("end"))
        for n, b, e in range_ends(bounds, F.col(total))
    ]
    return counts.select("*", F.inline(F.array(*parts)))


def assign_split(
    df: DataFrame,
    bounds: Sequence[Bounds],
    key: str,
    groups: Sequence[str] = (),
    by: str = "sequence",
    document: str = "doc_id",
    out: str = "split",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Label rows by contiguous ranges of their position in the order of key and ties, per group. Rows
    outside every range keep a null split. ``by="document"`` ranges over whole documents instead."""
    if by == "document":
        docs = df.select(*groups, document).distinct()
        labelled = assign_split(docs, bounds, document, groups, "sequence", out=out)
        return df.join(labelled, [*groups, document])
    numbered = dense_index(df, key, "__row", groups, total="__rows", ties=ties)
    label = F.lit(None).cast("string")
    for name, begin, end in reversed(range_ends(bounds, F.col("__rows"))):
        label = F.when((F.col("__row") >= begin) & (F.col("__row") < end), name).otherwise(label)
    return numbered.withColumn(out, label).drop("__row", "__rows")
