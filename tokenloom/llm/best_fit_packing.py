"""Packing of documents into token sequences of bounded length: best-two-fit on the length histogram.

Only lengths matter for a packing, and there are at most ``limit`` of them. So the plan is made on the
histogram: a bin takes the longest piece left, then again and again the longest that fits; if a gap
stays, its smallest piece is exchanged for two unpacked ones that fill the widened gap more tightly.
The same bin is made as often as the counts allow, so the plan is a bounded list of patterns
whatever the number of documents. Pieces are then numbered within their length (window sums over
hash buckets of bounded size, so a length that most pieces have is no hot group) and look up their
place in the plan.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_bpe import word_ids
from .parts import SLICE_BYTES
from .tables import documents, materialize
from .wordhash import slices

LIMIT = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
BUCKET_ROWS = 50_000
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pieces(path: str, limit: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(path)
        tail = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for a, b in slices(batch["text"], SLICE_BYTES):
                part = batch.slice(a, b - a)
                first, ids = coder.texts(part["text"])
                raw = ids.astype("<u4").tobytes()
                n = np.diff(first) + 1
                head = np.where(n % limit == 0, limit, n % limit)
                count = -(-n // limit)
                row = np.repeat(np.arange(b - a), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * limit)
                length = np.where(piece == 0, head[row], limit)
                begin, last = 4 * (first[row] + start), piece == count[row] - 1
                stop = begin + 4 * (length - last)
                crc = [zlib.crc32(tail, zlib.crc32(raw[x:y])) if z else zlib.crc32(raw[x:y]) for x, y, z in zip(begin.tolist(), stop.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def plan_bins(counts: dict[int, int], limit: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-two-fit of ``counts[length]`` pieces: (times, [(length, how many), ...]) patterns."""
    left = {x: k for x, k in counts.items() if k}
    sizes = sorted(left)
    plan = []
    while sizes:
        used: dict[int, int] = {}
        gap = limit
        top = len(sizes) - 1
        while top >= 0 and gap:
            top = min(top, bisect.bisect_right(sizes, gap) - 1)
            if top < 0:
                break
            x = sizes[top]
            k = min(left[x] - used.get(x, 0), gap // x) if used else 1
            used[x] = used.get(x, 0) + k
            gap -= k * x
            if used[x] == left[x] or x > gap:
                top -= 1
        if gap and sum(used.values()) > 1:
            small = min(used)
            pair = _tightest_pair(sizes, left, used, small, gap + small)
            if pair:
                used[small] -= 1
                for x in pair:
                    used[x] = used.get(x, 0) + 1
        used = {x: k for x, k in used.items() if k}
        times = min(left[x] // k for x, k in used.items())
        plan.append((times, sorted(used.items(), reverse=True)))
        for x, k in used.items():
            left[x] -= times * k
            if not left[x]:
                del left[x], sizes[bisect.bisect_left(sizes, x)]
    return plan


def _tightest_pair(sizes: list[int], left: dict[int, int], used: dict[int, int], small: int, room: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum in (small, room]."""
    free = [x for x in sizes if x < room and left[x] > used.get(x, 0)]
    best, pair = small, None
    i, j = 0, len(free) - 1
    while i <= j:
        total = free[i] + free[j]
        if total > room:
            j -= 1
            continue
        if total > best and (i < j or left[free[i]] - used.get(free[i], 0) > 1):
            best, pair = total, (free[j], free[i])
            if best == room:
                break
        i += 1
    return pair


def _placed(plan: list[tuple[int, list[tuple[int, int]]]]):
    """Look up (length, number within length) in the plan."""
    seen: dict[int, int] = {}
    slots, base = [], 0
    for times, items in plan:
        offset = 0
        for x, k in items:
            slots.append((x, seen.get(x, 0), base, k, offset))
            seen[x] = seen.get(x, 0) + times * k
            offset += x * k
        base += times
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 48) + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            slot = table[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            inner = rank - slot[:, 1]
            out = batch.drop_columns(["rank"])
            out = out.append_column("sequence_id", pa.array(slot[:, 2] + inner // slot[:, 3]))
            yield out.append_column("offset", pa.array(slot[:, 4] + inner % slot[:, 3] * length))

    return run


def pack_documents(docs: DataFrame, limit: int = LIMIT, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``limit`` tokens; one row per piece.

    A document is its token ids and ``end_id``; only longer ones are cut, the first piece taking the
    remainder. Null and empty texts are the end id alone. Repeated rows and null ids are packed like
    any other row; extra columns are ignored; an empty table gives an empty result.
    """
    base = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = materialize(base.mapInArrow(_pieces(path or vocabulary_path(), limit, end_id), _PIECES), "pieces")
    counts = dict(pieces.groupBy("length").count().collect())  # at most `limit` rows
    buckets = max(1, sum(counts.values()) // BUCKET_ROWS)
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    inner = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("row", F.row_number().over(inner) - 1).join(sizes, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("row") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(_placed(plan_bins(counts, limit)), _PIECES + ", sequence_id bigint, offset bigint")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
