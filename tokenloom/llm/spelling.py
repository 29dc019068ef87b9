"""Spelling variants: words one inserted, deleted or replaced character apart, by pairs of trie nodes.

The vocabulary is sorted by ranges, forward and reversed, and the nodes of both tries get numbers as sorted words pass by;
nodes that neighbouring ranges share are named by the first of them. A word ``w`` with the character at ``i``
skipped is the pair (node of ``w[:i]``, node of ``w[i + 1:]``), and with a gap before ``i`` the pair (node of ``w[:i]``, node of
``w[i:]``). Two words differ by a replaced character if a skip of both gives one pair, and by an inserted one
if a gap of the shorter and a skip of the longer do. Nodes have one number, so pairs are exact.

A pair has one gap at most and as many skips as there are characters, so no group grows with the table; its
members are not paired with each other: each takes the count of the rest and the best of the rest. In a run of equal
characters only the first skip meets gaps, so two words meet once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import let
from .groups import runs
from .tables import documents, materialize

RUN = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
SLIP_EVERY = 31
FORM_RATIO = 10
RANGE_WORDS = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RANGE_BITS = 40
_SHARED = 1 << (_RANGE_BITS - 1)


def slipped_words(docs: DataFrame, slip_every: int = SLIP_EVERY, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``(word, n)`` of all runs of letters, lower-cased in A-Z; where the crc32 of ``<doc_id>:<run>`` is a multiple of
    ``slip_every``, the character it points at is deleted. Null ids count as the empty text."""
    found = F.explode(F.regexp_extract_all("text", F.lit(f"{RUN}{{{least_length},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), found.alias("run"))
    rows = rows.withColumn("run", F.translate("run", _UPPER, _LOWER))
    rows = rows.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = F.pmod("h", F.length("run")).cast("int")
    rows = rows.select(F.when(F.col("h") % slip_every == 0, F.overlay("run", F.lit(""), at + 1, F.lit(1))).otherwise(F.col("run")).alias("word"))
    return rows.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    least = min(len(a), len(b))
    if a[:least] == b[:least]:
        return least
    return next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)


def shared_nodes(ends: list[tuple[int, str, str]]) -> dict[int, list[int]]:
    """For ordered ranges ``(range, first word, last word)``: the numbers of the nodes each shares with the range
    before it, from the root down to the longest common prefix."""
    shared: dict[int, list[int]] = {}
    for (before, first, last), (now, start, _) in zip(ends, ends[1:]):
        depth, older = _common(last, start), shared.get(before, [])
        kept = older[: min(depth, _common(first, last)) + 1]
        shared[now] = kept + [(before << _RANGE_BITS) + _SHARED + k for k in range(len(kept), depth + 1)]
    return shared


def _numbered(ends: list[tuple[int, str, str]]):
    """Nodes along each word, for ranges of sorted words."""
    shared = shared_nodes(ends)
    after = {now: shared[next_] for (now, _, _), (next_, _, _) in zip(ends, ends[1:])}
    last_of = {k: last for k, _, last in ends}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["range"]):
            k = t["range"][0].as_py()
            fresh, path, ahead, last, prev = count(k << _RANGE_BITS), list(shared.get(k, [])), after.get(k, []), last_of[k], ""
            depth = len(path) - 1  # of the nodes that the path has so far
            rank = k << _RANGE_BITS
            for a in range(0, len(t), 4096):
                part, nodes = t.slice(a, 4096), []
                for word in part["word"].to_pylist():
                    depth = min(depth, _common(prev, word)) if prev else depth
                    met = min(_common(word, last), len(ahead) - 1)  # shared with the next range
                    del path[depth + 1 :]
                    path += [ahead[d] if d <= met else next(fresh) for d in range(depth + 1, len(word) + 1)]
                    nodes.append(path.copy())
                    prev, depth = word, len(word)
                ranks = pa.array(range(rank + a, rank + a + len(part)), pa.int64())
                yield pa.RecordBatch.from_arrays([part["word"], part["n"], ranks, pa.array(nodes, pa.list_(pa.int64()))], names=["word", "n", "rank", "nodes"])

    return run


def trie_nodes(words: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """``words(word, n)``, distinct -> ``(word, n, rank, nodes)``: rank follows the order of words, ``nodes[k]`` is the number of
    the trie node of the first k characters. Only the ends of the ranges reach the driver."""
    ranges = max(1, -(-words.count() // range_words))
    placed = words.repartitionByRange(ranges, "word").withColumn("range", F.spark_partition_id().cast("bigint"))
    placed = materialize(placed, "sorted-words")  # ranges are fixed from here on
    ends = placed.groupBy("range").agg(F.min("word"), F.max("word")).collect()
    ordered = placed.repartition("range").sortWithinPartitions("range", "word")
    return ordered.mapInArrow(_numbered(sorted(tuple(r) for r in ends)), "word string, n bigint, rank bigint, nodes array<bigint>")


def _pairs(ahead: DataFrame, range_words: int) -> DataFrame:
    """Skips and gaps of all words: ``(a, b, rank, n, gap, head)``; head marks the first skip in a run of equal characters."""
    back = trie_nodes(ahead.select(F.reverse("word").alias("word"), "n"), range_words)
    back = back.select(F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    both = ahead.withColumnRenamed("nodes", "ahead").join(back, "word")

    def parts(w: Column) -> Column:
        long = F.size(w["letters"])

        def at(i: Column) -> Column:
            head = (i == 0) | (F.get(w["letters"], i) != F.get(w["letters"], i - 1))
            skip = F.struct(F.get(w["ahead"], i).alias("a"), F.get(w["back"], long - 1 - i).alias("b"), F.lit(False).alias("gap"), head.alias("head"))
            gap = F.struct(F.get(w["ahead"], i).alias("a"), F.get(w["back"], long - i).alias("b"), F.lit(True).alias("gap"), F.lit(False).alias("head"))
            return F.array(F.when(i < long, skip), gap)

        return F.flatten(F.transform(F.sequence(F.lit(0), long), at))

    word = F.struct(F.split("word", "").alias("letters"), "ahead", "back")
    entries = both.select("rank", "n", F.explode(let(word, parts)).alias("e")).where("e is not null")
    return entries.select("e.a", "e.b", "e.gap", "e.head", "rank", "n")


def near_words(ahead: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """``(rank, n_near, best_n, best)`` of those words of a ``trie_nodes`` table that have near ones; best is the rank of
    the near word of largest n, ties to the first in order."""
    entries = _pairs(ahead, range_words)
    item = F.struct((-F.col("n")).alias("m"), F.col("rank").alias("r"))
    groups = entries.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("members"),
        F.max(F.when(F.col("gap"), F.struct("rank", "n"))).alias("whole"),
        F.sort_array(F.collect_list(F.when(~F.col("gap"), F.struct(item.alias("item"), "head")))).alias("skips"),
    ).where("members > 1")
    heads = F.filter("skips", lambda s: s["head"])
    least = F.get("skips", F.lit(0))["item"]
    second = F.get("skips", F.lit(1))["item"]
    whole = F.col("whole")
    # A skip is near all other skips; a gap and the head skips are near each other.
    own = F.transform("skips", lambda s: F.struct(
        s["item"]["r"].alias("rank"),
        (F.size("skips") - 1 + F.when(s["head"] & whole.isNotNull(), 1).otherwise(0)).alias("near"),
        F.least(F.when(s["item"]["r"] == least["r"], second).otherwise(least), F.when(s["head"] & whole.isNotNull(), F.struct((-whole["n"]).alias("m"), whole["rank"].alias("r")))).alias("best"),
    ))
    gap = F.when(
        whole.isNotNull() & (F.size(heads) > 0),
        F.array(F.struct(whole["rank"].alias("rank"), F.size(heads).alias("near"), F.get(heads, F.lit(0))["item"].alias("best"))),
    ).otherwise(F.array().cast("array<struct<rank:bigint,near:int,best:struct<m:bigint,r:bigint>>>"))
    met = groups.select(F.explode(F.concat(own, gap)).alias("x")).select("x.*").where("near > 0")
    best = met.groupBy("rank").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return best.select("rank", "n_near", (-F.col("best.m")).alias("best_n"), F.col("best.r").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """``(rank, form)`` -> ``(rank, root)`` by pointer jumping; counts grow tenfold per link, so chains are short."""
    at = materialize(links.select("rank", F.col("form").alias("root"), F.lit(True).alias("open")), "roots")
    while at.where("open").limit(1).count():
        step = at.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        moved = at.join(step, "root", "left")
        at = materialize(moved.select("rank", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")), "roots")
    return at.select("rank", "root")


def spelling_variants(counts: DataFrame, ratio: int = FORM_RATIO, least_count: int = LEAST_COUNT, range_words: int = RANGE_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of ``counts(word, n)`` met at least ``least_count`` times.

    A word's form is its near word of largest n (ties: first in code-point order) if that is at least ``ratio`` times its
    own; its root is where forms lead, itself if it has none. Null and rare words are left out; repeated words are added up;
    words of any length are taken whole (a word of L characters makes 2 L + 1 rows). Extra columns are ignored; an
    empty table gives an empty result.
    """
    words = counts.where("word is not null").groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))
    words = materialize(words.where(F.col("n") >= least_count), "words")
    ahead = materialize(trie_nodes(words, range_words), "trie")  # written, as another run may cut other ranges
    near = near_words(ahead, range_words)
    stats = materialize(ahead.select("word", "n", "rank").join(near, "rank", "left"), "stats")
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    stats = stats.select("word", "n", "rank", "n_near", form.alias("form"), F.when(form.isNotNull(), F.col("best_n")).alias("form_n"))
    roots = _roots(stats.where("form is not null"))
    text = stats.select("rank", "word")
    out = stats.join(roots, "rank", "left")
    out = out.join(text.select(F.col("rank").alias("form"), F.col("word").alias("form_word")), "form", "left")
    out = out.join(text.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root", "left")
    return out.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(slipped_words(documents(spark, sf_dir)))


#: crc32 is worked out over the hexadecimal bytes of each distinct document and run; near words meet in what is left after one deletion.
OP12_SQL = rf"""
WITH RECURSIVE crc_table AS (
    SELECT list(c ORDER BY i) AS tab FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
        FROM (SELECT unnest(range(256))::BIGINT AS i))
), found AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(run, '{_UPPER}', '{_LOWER}') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{RUN}{{{LEAST_LENGTH},}}')) AS run FROM documents)
), once AS (
    SELECT doc, run, count(*) AS k, hex(encode(doc || ':' || run)) AS x FROM found GROUP BY doc, run
), hashed AS (
    SELECT run, k, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
        lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1]))) AS h
    FROM once, crc_table
), words AS MATERIALIZED (
    SELECT word, sum(k)::BIGINT AS n FROM (
        SELECT k, CASE WHEN h % {SLIP_EVERY} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}
), less AS MATERIALIZED (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), near AS MATERIALIZED (
    SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(n) AS top, arg_min(other, (-n, other)) AS other FROM near GROUP BY word
), forms AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= {FORM_RATIO} * w.n THEN b.other END AS form, CASE WHEN b.top >= {FORM_RATIO} * w.n THEN b.top END AS form_n
    FROM words w LEFT JOIN best b USING (word)
), chain AS (
    SELECT word, word AS place, 0 AS k FROM forms
    UNION ALL SELECT c.word, f.form, c.k + 1 FROM chain c JOIN forms f ON f.word = c.place WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN (SELECT word, arg_max(place, k) AS root FROM chain GROUP BY word) r ON r.word = f.word"""
