"""Exact removal of repeated word windows, found with an FM-index per shard.

1. Each window of ``WINDOW`` words is named by its minimiser, the least hash among its k-grams;
   equal windows have equal minimisers. Runs of windows with one minimiser form a piece.
2. Minimisers met once in the corpus are dropped (grouped counts on narrow rows); equal pieces
   are collapsed to one with a count, so copies and shared passages shrink before any text moves.
3. The words of the remaining distinct pieces go to shards by minimiser. A shard is indexed
   (``fm_index``) and its pieces are streamed against it: a window that occurs twice is reported.
   A shard holds whole minimiser groups, up to twice ``SHARD_WORDS`` words. The pieces of a larger group are dealt to
   blocks of about ``SHARD_WORDS``, and each ordered pair of blocks is a shard of its own: one is indexed, the
   other streamed, so no task holds more than two blocks. The work of such a group grows with its square.
4. Reported intervals return to all places of the piece and are merged per text.

A result depends on the text alone, so everything runs once per distinct text; texts are known by
a 64-bit hash and their length, words and pieces by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binding import let_all
from .fm_index import FMIndex, repeated_windows
from .tables import documents, materialize
from .wordhash import fits, grams, mix, ragged, slices, sliding, utf8, words

WINDOW = 35
GRAM = 8
RUN = 64
SHARD_WORDS = 1 << 19
KEY = ["text_key", "n_bytes"]
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _pieces_found(window: int, gram: int):
    """Per text: its runs of windows with one minimiser, and a hash of each run's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                part = batch.slice(a, b - a)
                w = words(part["text"])
                h = w.hashes()
                span = window - gram + 1
                g = grams(h, gram)
                least = sliding(g, span)
                at = np.flatnonzero(fits(w, window, len(least)))
                if not len(at):
                    continue
                row = w.rows[at]
                new = np.ones(len(at), bool)
                new[1:] = (least[at[1:]] != least[at[:-1]]) | (row[1:] != row[:-1])
                begin = np.flatnonzero(new)
                inside = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
                begin = np.flatnonzero(new | (inside % RUN == 0))
                count = np.diff(np.append(begin, len(at)))
                first, row = at[begin], row[begin]
                # A run may hold its minimiser twice: from the first window's leftmost to the last one's rightmost.
                places = np.arange(span)
                left = (g[first[:, None] + places] == least[first][:, None]).argmax(axis=1)
                back = (g[(first + count - 1)[:, None] + places[::-1]] == least[first][:, None]).argmax(axis=1)
                twice = count - 1 + span - 1 - back > left
                up, down = np.full(len(h) + 1, _BASE), np.full(len(h) + 1, _INVERSE)
                up[0] = down[0] = 1
                total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * np.multiply.accumulate(up)[:-1])))
                stop = first + count + window - 1
                name = mix((total[stop] - total[first]) * np.multiply.accumulate(down)[first] + count.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(least[first].view(np.int64)), pa.array(name.view(np.int64)), part["text_key"].take(pa.array(row)), part["n_bytes"].take(pa.array(row)),
                     pa.array((first - w.first[row]).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(twice)],
                    names=["anchor", "piece", *KEY, "place", "n", "twice"],
                )

    return run


def _pieces_cut(window: int):
    """The words of each wanted piece of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                part = batch.slice(a, b - a)
                w = words(part["text"])
                lists = part["pieces"]
                piece = lists.flatten()
                row = np.repeat(np.arange(b - a), np.diff(lists.offsets.to_numpy()))
                first = w.first[row] + piece.field("place").to_numpy()
                last = first + piece.field("n").to_numpy() + window - 2
                raw = w.data.tobytes()
                text = pa.array([raw[x:y] for x, y in zip(w.start[first].tolist(), w.end[last].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [piece.field("anchor"), piece.field("piece"), pa.array(piece.field("count").to_numpy() > 1), piece.field("blocks"), text], names=["anchor", "piece", "many", "blocks", "words"]
                )

    return run


def shard_repeats(texts: pa.Array, many: np.ndarray, window: int, block_words: int, stream: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, from, to) word intervals covered by repeated windows, of one shard's pieces. With ``stream``, those of
    the streamed pieces that occur in the others, which come first."""
    w = words(texts)
    k = len(many)
    ids = np.unique(w.hashes(), return_inverse=True)[1].astype(np.int32) + 1
    size = int(ids.max(initial=0)) + 1
    seq = np.zeros(len(ids) + k, np.int32)
    seq[np.arange(len(ids)) + w.rows] = ids
    start = w.first[:-1] + np.arange(k)
    end = w.first[1:] + np.arange(k)
    found = np.zeros(len(seq), bool)
    if stream is not None:
        x, todo = int(np.argmax(stream)), ~many & stream
        if stream.any() and x:
            index = FMIndex(seq[start[0] : end[x - 1] + 1], size)
            found |= repeated_windows(index, seq, start[todo], end[todo], np.ones(int(todo.sum()), np.int32), window)
    else:
        cuts = [0]
        for p in range(1, k):
            if end[p] - start[cuts[-1]] > block_words:
                cuts.append(p)
        for x, y in itertools.pairwise([*cuts, k]):
            need = np.ones(k, np.int32)
            need[x:y] = 2
            todo = ~many
            index = FMIndex(seq[start[x] : end[y - 1] + 1], size)
            found |= repeated_windows(index, seq, start[todo], end[todo], need[todo], window)
        for p in np.flatnonzero(many & (end - start >= window)):
            found[start[p] : end[p] - window + 1] = True
    edge = np.diff(np.concatenate(([0], found.view(np.int8), [0])))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.searchsorted(start, lo, side="right") - 1
    return piece, lo - start[piece], hi - 1 + window - start[piece]


def _shards_searched(window: int, shard_words: int):
    """Pieces arrive ordered by minimiser and pair of blocks. Whole groups of one block are gathered into
    shards; a pair of blocks of a larger group is a shard of its own, with its indexed pieces first."""

    def search(parts: list[pa.RecordBatch], pair: tuple[int, int, int] | None) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        stream = t["side"].to_numpy() == 1 if pair and pair[1] != pair[2] else None
        piece, lo, hi = shard_repeats(t["words"], t["many"].to_numpy(zero_copy_only=False), window, 4 * shard_words, stream)
        at = pa.array(piece)
        return pa.RecordBatch.from_arrays([t["anchor"].take(at), t["piece"].take(at), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["anchor", "piece", "lo", "hi"])

    def shards(part: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, tuple[int, int, int] | None]]:
        """Stretches of small groups, and pairs of blocks one by one."""
        large, anchor, one, two = part["blocks"].to_numpy() > 1, *(part[c].to_numpy() for c in ("anchor", "one", "two"))
        other = (anchor[1:] != anchor[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        cut = np.flatnonzero((large[1:] != large[:-1]) | large[1:] & other) + 1
        for a, b in itertools.pairwise([0, *cut.tolist(), len(part)]):
            yield part.slice(a, b - a), (int(anchor[a]), int(one[a]), int(two[a])) if large[a] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, pair = 0, None
        for batch in batches:
            for a, b in slices(batch["words"]):
                for part, now in shards(batch.slice(a, b - a)):
                    if held and now != pair:
                        yield search(held, pair)
                        held, n = [], 0
                    pair = now
                    if pair is None and n >= shard_words:
                        anchor, last = part["anchor"].to_numpy(), held[-1]["anchor"][-1].as_py()
                        same = len(anchor) if (anchor == last).all() else int(np.argmax(anchor != last))
                        held.append(part.slice(0, same))
                        n += int(utf8(part["words"])[1][same]) // 4
                        part = part.slice(same)
                        if not len(part):
                            continue
                        yield search(held, None)
                        held, n = [], 0
                    held.append(part)
                    n += int(utf8(part["words"])[1][-1]) // 4  # at most that many words
        if held:
            yield search(held, pair)

    return run


def with_key(docs: DataFrame) -> DataFrame:
    """Add the key of each text; null counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"text_key": F.xxhash64(text), "n_bytes": F.octet_length(text).cast("bigint")})


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row per distinct text, combined before the shuffle."""
    return with_key(docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))).groupBy(KEY).agg(F.first("text").alias("text"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Word intervals to remove: ``(text_key, n_bytes, spans array<struct<lo, hi>>)`` for each distinct
    text in which a window of ``window`` words also starts anywhere else in ``docs.text``."""
    texts = with_key(docs.select("text")).where(F.col("n_bytes") >= 2 * window - 1)
    found = texts.mapInArrow(_pieces_found(window, gram), "anchor bigint, piece bigint, text_key bigint, n_bytes bigint, place int, n int, twice boolean")
    found = materialize(found, "found")
    often = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), F.max("twice").alias("twice")).where("k > 1 or twice").select("anchor")
    # One row per place in a distinct text, with the number of rows that have the text.
    kept = found.join(often, "anchor", "left_semi").groupBy("anchor", "piece", *KEY, "place", "n").agg(F.count(F.lit(1)).alias("k"))
    kept = materialize(kept, "kept")

    chosen = kept.groupBy("anchor", "piece").agg(F.sum("k").alias("count"), F.min(F.struct(*KEY, "place", "n")).alias("at"))
    chosen = materialize(chosen, "chosen")
    held = chosen.groupBy("anchor").agg(F.ceil(F.sum(F.col("at.n") + window - 1) / shard_words).cast("int").alias("blocks")).where("blocks > 1")
    chosen = chosen.join(held, "anchor", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    chosen = chosen.groupBy(F.col("at.text_key").alias("text_key"), F.col("at.n_bytes").alias("n_bytes")).agg(
        F.collect_list(F.struct("anchor", "piece", "count", "blocks", F.col("at.place").alias("place"), F.col("at.n").alias("n"))).alias("pieces")
    )
    pieces = distinct_texts(docs).join(chosen, KEY).select("text", "pieces")
    pieces = pieces.mapInArrow(_pieces_cut(window), "anchor bigint, piece bigint, many boolean, blocks int, words binary")
    block, mate = F.pmod(F.xxhash64("piece"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)

    def pairs(block: Column, mates: Column) -> Column:
        """The pairs in which a piece of a block is indexed (side 0) or streamed (side 1)."""
        indexed = F.transform(mates, lambda m: F.struct(block.alias("one"), m.alias("two"), F.lit(0).alias("side")))
        streamed = F.transform(F.filter(mates, lambda m: m != block), lambda m: F.struct(m.alias("one"), block.alias("two"), F.lit(1).alias("side")))
        return F.concat(indexed, streamed)

    alone = F.array(F.struct(F.lit(0).alias("one"), F.lit(0).alias("two"), F.lit(0).alias("side")))
    pieces = pieces.withColumn("pair", F.explode(F.when(F.col("blocks") == 1, alone).otherwise(let_all(pairs, block=block, mates=mate))))
    pieces = pieces.select("anchor", "piece", "many", "blocks", "words", "pair.*")
    shards = pieces.repartition("anchor", "one", "two").sortWithinPartitions("anchor", "one", "two", "side", "piece")
    hits = shards.mapInArrow(_shards_searched(window, shard_words), "anchor bigint, piece bigint, lo int, hi int")
    places = kept.select("anchor", "piece", *KEY, "place").join(hits, ["anchor", "piece"])
    return places.groupBy(KEY).agg(F.collect_set(F.struct((F.col("place") + F.col("lo")).alias("lo"), (F.col("place") + F.col("hi")).alias("hi"))).alias("spans"))


def _covered(part: pa.RecordBatch, first: np.ndarray) -> np.ndarray:
    """Which words of a slice lie in one of their row's spans."""
    step = np.zeros(int(first[-1]) + 1, np.int64)
    spans = part["spans"]
    flat = spans.flatten()
    if len(flat):
        size = np.zeros(len(spans), np.int64)
        valid = np.asarray(spans.is_valid())
        size[valid] = np.diff(spans.offsets.to_numpy())[valid]
        base = first[:-1][np.repeat(np.arange(len(spans)), size)]
        np.add.at(step, base + flat.field("lo").to_numpy(), 1)
        np.add.at(step, base + flat.field("hi").to_numpy(), -1)
    return np.cumsum(step)[:-1] > 0


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch["text"]):
            part = batch.slice(a, b - a)
            data, off = utf8(part["text"])
            raw, off = data.tobytes(), off.tolist()
            rows = [raw[x:y].split() for x, y in itertools.pairwise(off)]
            first = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
            gone = _covered(part, first)
            digest, removed = [], np.add.reduceat(np.append(gone, False), first[:-1]) * (np.diff(first) > 0)
            for r, x, n in zip(rows, first.tolist(), removed.tolist()):
                kept = itertools.compress(r, ~gone[x : x + len(r)]) if n else r
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([part["text_key"], part["n_bytes"], pa.array(np.diff(first)), pa.array(removed.astype(np.int64)), pa.array(digest)], names=[*KEY, "n_words", "n_removed", "kept_sha256"])


def removal_digest(docs: DataFrame, window: int = WINDOW, **how: int) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: n_words, n_removed and the SHA-256 of the words that stay.

    Null, empty and blank texts have no words. Rows with equal texts repeat each other: all their
    windows go, in every row. Null ids and repeated rows are returned as they are; extra columns are
    ignored; an empty table gives an empty result.
    """
    spans = repeated_spans(docs, window, **how)
    result = distinct_texts(docs).join(spans, KEY, "left").mapInArrow(_digests, "text_key bigint, n_bytes bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    return with_key(docs).select("doc_id", *KEY).join(result, KEY).drop(*KEY)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch["text"]):
            part = batch.slice(a, b - a)
            w = words(part["text"])
            gone = _covered(part, w.first)
            valid, data = part["text"].is_valid().to_pylist(), w.data
            out = []
            for r in range(b - a):
                x, y = int(w.first[r]), int(w.first[r + 1])
                lo, hi = int(w.offsets[r]), int(w.offsets[r + 1])
                if not valid[r]:
                    out.append(None)
                elif not gone[x:y].any():
                    out.append(data[lo:hi].tobytes())
                else:  # each word goes with the white space before it
                    back = np.diff(np.concatenate(([0], gone[x:y].view(np.int8), [0])))
                    kept, at = [], lo
                    for s, t in zip(np.flatnonzero(back == 1).tolist(), np.flatnonzero(back == -1).tolist()):
                        kept.append(data[at : int(w.end[x + s - 1]) if s else lo].tobytes())
                        at = int(w.end[x + t - 1])
                    kept.append(data[at:hi].tobytes())
                    out.append(b"".join(kept).lstrip())
            yield pa.RecordBatch.from_arrays([part["row"], pa.array(out, pa.binary()).cast(pa.string())], names=["row", "text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, **how: int) -> DataFrame:
    """``docs`` with repeated windows cut out of ``text``; other columns and the white space between
    kept words stay. Edge cases as in ``removal_digest``; a null text stays null."""
    spans = repeated_spans(docs, window, **how).select(F.struct(*KEY).alias("key"), F.col("spans").alias("value"))
    others = [c for c in docs.columns if c != "text"]
    whole = F.struct(F.lit(0).alias("n"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("row")
    marked = with_key(docs.select(whole, "text")).select("row", "text", F.struct(*KEY).alias("key")).join(spans, "key", "left")
    marked = marked.select("row", "text", F.col("value").alias("spans"))
    kept = marked.mapInArrow(_cut, T.StructType([marked.schema["row"], T.StructField("text", T.StringType())]))
    back = {c: F.col(f"row.c{i}") for i, c in enumerate(others)} | {"text": F.col("text")}
    return kept.select(*[back[c].alias(c) for c in docs.columns])


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digest(documents(spark, sf_dir))
