"""Sentence spans for pair and block training: greedy cuts inside each document."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.text import hash_bits
from ..session import materialize
from .order import hash_rank, prefix_sums

LONG_SENTENCE_TOKENS = 512


def has_long_sentence(sizes: Column) -> Column:
    return F.exists(sizes, lambda s: s > LONG_SENTENCE_TOKENS)


def eligible(sizes: Column, min_sentences: int, scan_from: int = 2) -> Column:
    """Enough sentences and none of them too long. Documents with fewer than ``scan_from``
    sentences are not scanned for long ones."""
    return let(
        sizes,
        lambda s: (F.size(s) >= min_sentences) & ~((F.size(s) >= scan_from) & has_long_sentence(s)),
    )


def corpus_profile(df: DataFrame, sizes: str = "sizes", scan_from: int = 2) -> DataFrame:
    """Empty documents, one-sentence documents and documents with a long sentence."""
    n = F.size(sizes)
    long_doc = (n >= scan_from) & has_long_sentence(F.col(sizes))
    return df.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(n == 0).alias("empty_docs"),
        F.count_if(n == 1).alias("one_sentence_docs"),
        F.count_if(long_doc).alias("long_sentence_docs"),
    )


SPANS = "array<struct<start:int,end:int,target:int>>"
_NEVER = (1 << 31) - 1


def cut_spans(sizes: Column, targets: Column, min_sentences: int, min_remaining: int) -> Column:
    """Greedy spans as ``ARRAY<STRUCT<start, end, target>>`` over one document's sentences.

    A span closes when it is as long as its target, holds ``min_sentences`` and leaves at least ``min_remaining``;
    the last sentence always closes one. ``targets`` lists the wanted lengths of the first, second, ... span
    (at least as many as there can be), or the one length of all. A null target is never reached; a null size
    counts as 0. Linear in the sentences: where a span from each sentence ends is found by binary search in
    running sums, for a whole Arrow batch at once.
    """

    @F.arrow_udf(SPANS)
    def cut(sizes: pa.Array, targets: pa.Array) -> pa.Array:
        return batch_spans(sizes, targets, min_sentences, min_remaining)

    return cut(sizes.cast("array<bigint>"), targets.cast("array<bigint>"))


def _flat(lists: pa.Array, missing: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, values): list r is ``values[first[r]:first[r + 1]]``; null lists are empty."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate(([0], np.cumsum(n))), pc.fill_null(lists.flatten(), missing).to_numpy(zero_copy_only=False)


def batch_spans(sizes: pa.Array, targets: pa.Array, min_sentences: int, min_remaining: int) -> pa.Array:
    """``cut_spans`` of a batch of documents."""
    first, size = _flat(sizes, 0)
    turn, wanted = _flat(targets, _NEVER)
    sums = np.concatenate(([0], np.cumsum(size)))
    n, total, least = np.diff(first), len(size), max(1, min_sentences)
    if (np.diff(turn)[n > 0] == 1).all():
        doc = np.repeat(np.arange(len(n)), n)
        target = wanted[turn[doc]] if total else np.zeros(0, np.int64)
        begin = np.arange(total)
        end = np.maximum(np.searchsorted(sums, sums[:-1] + target), begin + least)
        end = np.where(end <= first[doc + 1] - min_remaining, end, first[doc + 1])
        starts = _followed(first[:-1][n > 0], np.concatenate((end, [total])))
        ends, target = end[starts], target[starts]
    else:  # lengths differ from span to span: follow each document
        bounds, wanted, turn = sums.tolist(), wanted.tolist(), turn.tolist()
        found: list[tuple[int, int, int]] = []
        for at, last, t in zip(first[:-1].tolist(), first[1:].tolist(), turn):
            while at < last:
                length = wanted[t]
                end = max(bisect_left(bounds, bounds[at] + length, at, last), at + least)
                end = end if end <= last - min_remaining else last
                found.append((at, end, length))
                at, t = end, t + 1
        starts, ends, target = np.array(found, np.int64).reshape(-1, 3).T
    owner = np.searchsorted(first, starts, side="right") - 1
    fields = [starts - first[owner], ends - first[owner], np.minimum(target, _NEVER)]
    spans = pa.StructArray.from_arrays([pa.array(f.astype(np.int32)) for f in fields], names=["start", "end", "target"])
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(n)))))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spans)


def _followed(starts: np.ndarray, then: np.ndarray) -> np.ndarray:
    """All places reached from ``starts`` by following ``then``, ascending, without the end mark
    ``len(then) - 1``. Steps are doubled each round, so long chains take few rounds. A document ends where the
    next one starts, which is among the starts."""
    met = np.zeros(len(then), bool)
    met[starts] = True
    known = -1
    while known != (known := int(np.count_nonzero(met))):
        met[then[np.flatnonzero(met)]] = True
        then = then[then]
    return np.flatnonzero(met[:-1])


def _number_spans(
    spans: DataFrame, numbers: DataFrame, key: str, epochs: int, max_samples: int | None
) -> DataFrame:
    """Number the spans epoch by epoch in document order and explode them.

    ``spans`` has ``epoch`` when epochs differ (random targets), else one copy serves all of them.
    The sample cap is tested only when an epoch starts, so the last one that starts is complete.
    The folded spans are saved first, as they are read three times.
    """
    differ = "epoch" in spans.columns
    saved = materialize(spans, "spans")
    groups = ["epoch"] if differ else []
    counted = prefix_sums(
        saved.select(key, *groups, F.size("spans").alias("__n")),
        key,
        {"__before": F.col("__n")},
        groups,
        totals={"__rows": "__before"},
    ).drop("__n")
    rows = saved.join(counted, [key, *groups]).join(numbers, key)
    if differ:
        sizes = saved.groupBy("epoch").agg(F.sum(F.size("spans")).alias("n"))  # one row per epoch
        so_far = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
        earlier = sizes.select("epoch", F.coalesce(F.sum("n").over(so_far), F.lit(0).cast("bigint")).alias("__rows_before"))
        rows = rows.join(F.broadcast(earlier), "epoch")
    else:
        rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn(
            "__rows_before", F.col("epoch") * F.col("__rows")
        )
    if max_samples is not None:
        rows = rows.where(F.col("__rows_before") < max_samples)
    return rows.select("*", F.posexplode("spans").alias("cut_no", "span"))


def map_sentences(
    df: DataFrame,
    max_length: int,
    key: str = "doc_id",
    sizes: str = "sizes",
    epochs: int = 1,
    max_samples: int | None = None,
    short_ratio: int = 0,
    min_sentences: int = 2,
    seed: int = 1234,
) -> DataFrame:
    """Sentence-pair spans ``(map_index, start, end, target)`` in corpus-wide sentence numbers.

    With ``short_ratio`` r, about one span in r gets a random shorter target between 2 and
    ``max_length``, drawn from a hash of seed, epoch, document and span number.
    """
    numbers = prefix_sums(df.select(key, F.size(sizes).alias("__s")), key, {"__base": F.col("__s")}).drop("__s")
    kept = df.where(eligible(F.col(sizes), min_sentences)).select(key, sizes)
    if short_ratio:
        kept = kept.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))

    def target(cut_no: Column) -> Column:
        r = hash_bits(seed, F.col("epoch"), F.col(key), cut_no)
        return let(
            r, lambda x: F.when(x % short_ratio == 0, 2 + x % (max_length - 1)).otherwise(F.lit(max_length))
        )

    if short_ratio:  # one target for every span that the sentences can make
        most = F.call_function("div", F.size(sizes), F.lit(max(1, min_sentences)))
        targets = F.transform(F.sequence(F.lit(0), most.cast("int")), target)
    else:
        targets = F.array(F.lit(max_length))
    spans = kept.withColumn("spans", cut_spans(F.col(sizes), targets, min_sentences, 2)).drop(sizes)
    return _number_spans(spans, numbers, key, epochs, max_samples).select(
        (F.col("__rows_before") + F.col("__before") + F.col("cut_no")).alias("map_index"),
        (F.col("__base") + F.col("span.start")).alias("start"),
        (F.col("__base") + F.col("span.end")).alias("end"),
        F.col("span.target").alias("target"),
    )


def map_blocks(
    df: DataFrame,
    max_length: int,
    key: str = "doc_id",
    sizes: str = "sizes",
    title_size: str = "title_size",
    epochs: int = 1,
    max_samples: int | None = None,
    one_sentence_blocks: bool = False,
) -> DataFrame:
    """Block spans ``(map_index, start, end, doc, block_id)``; a block leaves room for the title
    and block numbers restart in each epoch."""
    least = 1 if one_sentence_blocks else 2
    numbers = prefix_sums(
        df.select(key, F.size(sizes).alias("__s")), key, {"__base": F.col("__s"), "__doc": F.lit(1)}
    ).drop("__s")
    kept = df.where(eligible(F.col(sizes), least, scan_from=least)).select(key, sizes, title_size)
    room = F.array(F.lit(max_length) - F.col(title_size))
    spans = kept.select(key, cut_spans(F.col(sizes), room, least, least).alias("spans"))
    return _number_spans(spans, numbers, key, epochs, max_samples).select(
        (F.col("__rows_before") + F.col("__before") + F.col("cut_no")).alias("map_index"),
        (F.col("__base") + F.col("span.start")).alias("start"),
        (F.col("__base") + F.col("span.end")).alias("end"),
        F.col("__doc").alias("doc"),
        (F.col("__before") + F.col("cut_no")).alias("block_id"),
    )


def shuffle_mapping(mapping: DataFrame, seed: int) -> DataFrame:
    """A random permutation of mapping rows, by a hash order of their numbers."""
    return hash_rank(mapping, seed, ["map_index"], "shuffled_no", salt="map")
