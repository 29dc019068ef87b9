"""Views derived from the driver's tables, as DataFrames and as DuckDB text.

All views are row-local or aggregated with bounded groups, and cover whole tables:

* ``seqs``: documents as token sequences, the source as dataset;
* ``songs``: documents as songs: lines are lyric segments, words are codec frames, two stems;
* ``codes``: embeddings as 4 x 16 code matrices;
* ``wave``: events as sampled tracks (user = track, event type = channel);
* ``names``: audio file names; ``mix``: one mixture entry per source.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codecs import CodecOptions
from ..functions.text import MARKERS
from ..operators.order import dense_index
from ..operators.tokenizer import WordTokenizer, build_vocab, split_words, text_slices, words
from ..plans.encode import to_sequences
from ..session import materialize

ONE = CodecOptions("xcodec", 0, 1)  # songs: one codebook
FOUR = CodecOptions("dac16k")  # codes: four codebooks
FIRST_LAYERS = CodecOptions("xcodec", 0, 4)  # the same matrices in a codec with more codebooks


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table, read in the parts that its files and row groups give. Only one whose rows lie in less than half as
    many parts as there are cores is spread by its first column, as that moves the whole table at each read."""
    df = spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df if 2 * _filled(spark.sparkContext.applicationId, spark, sf, name) >= cores else df.repartition(cores, df.columns[0])


@lru_cache(maxsize=256)
def _filled(app: str, spark: SparkSession, sf: str, name: str) -> int:
    """Read tasks that get a row: a row group goes to one task. Counted from the files' row counts, no column is read."""
    df = spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")
    return df.select(F.spark_partition_id().alias("part")).distinct().count()


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def lengths(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, dataset, n_tokens)`` without looking up any id."""
    return documents(spark, sf).select(
        "doc_id", F.col("source").alias("dataset"), F.size(words(F.col("text"))).alias("n_tokens")
    )


@lru_cache(maxsize=8)
def _tokenizer(app: str, spark: SparkSession, sf: str, markers: bool) -> WordTokenizer:
    return WordTokenizer(build_vocab(documents(spark, sf), "text", reserved=MARKERS if markers else ()))


def tokenizer(spark: SparkSession, sf: str, markers: bool = False) -> WordTokenizer:
    """Word tokenizer over the documents' vocabulary, built once per session and folder."""
    return _tokenizer(spark.sparkContext.applicationId, spark, sf, markers)


@lru_cache(maxsize=16)
def _saved(app: str, spark: SparkSession, sf: str, build) -> DataFrame:
    return materialize(build(spark, sf), build.__name__.strip("_"))


def seqs(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as a stored token table ``(doc_id, dataset, tokens, n_tokens)``, written once per
    session and folder."""
    return _saved(spark.sparkContext.applicationId, spark, sf, tokenized)


def songs(spark: SparkSession, sf: str) -> DataFrame:
    """The songs as a stored table, written once per session and folder."""
    return _saved(spark.sparkContext.applicationId, spark, sf, derived_songs)


def tokenized(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, dataset, tokens, n_tokens)``; plain words, no special tokens."""
    ids = tokenizer(spark, sf).spaced_ids(F.col("text"))
    found = documents(spark, sf).select("doc_id", F.col("source").alias("dataset"), "text", ids.alias("tokens"))
    return found.select("doc_id", "dataset", "tokens", F.when(F.col("text").isNotNull(), F.size("tokens")).alias("n_tokens"))


def line_seqs(spark: SparkSession, sf: str) -> DataFrame:
    """The stored token table with a row per line, ``(dataset, doc_id, seq_no, tokens, n_tokens)``, written once per
    session and folder."""
    return _saved(spark.sparkContext.applicationId, spark, sf, cut_lines)


def cut_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = sizes(spark, sf).withColumnRenamed("sizes", "lengths")
    return to_sequences(seqs(spark, sf).drop("n_tokens").join(lines, "doc_id"))


def sizes(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, sizes)``: words per line of each document."""
    per_line = F.transform(F.split("text", "\n"), lambda line: F.size(words(line)))
    return documents(spark, sf).select("doc_id", per_line.alias("sizes"))


def _frames(texts: pa.Array) -> pa.Array:
    """Words per line, words before each line, and two codes per word of each text."""
    parts = []
    for some in text_slices(texts):
        lines = pc.split_pattern(pc.fill_null(some, ""), "\n")
        found = split_words(lines.values)
        of_lines, lines_at = found.offsets.to_numpy(), lines.offsets.to_numpy()
        words_at = of_lines[lines_at]
        t = np.arange(len(found.values)) - np.repeat(words_at[:-1], np.diff(words_at))
        n = pc.utf8_length(found.values).to_numpy(zero_copy_only=False).astype(np.int64)
        begins = of_lines[:-1] - np.repeat(words_at[:-1], np.diff(lines_at))
        flat = [(np.diff(of_lines), lines_at), (begins, lines_at), ((n * 37 + t * 13) % 1024, words_at), ((n * 59 + t * 29) % 1024, words_at)]
        lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v, pa.int32())) for v, at in flat]
        parts.append(pa.StructArray.from_arrays(lists, ["sizes", "begins", "vocals", "instrumental"], mask=some.is_null()))
    return pa.concat_arrays(parts)


def derived_songs(spark: SparkSession, sf: str) -> DataFrame:
    """One song per document with inlined stems; see the module text."""
    frames = F.arrow_udf(_frames, "sizes array<int>, begins array<int>, vocals array<int>, instrumental array<int>")
    d = documents(spark, sf).select("doc_id", "lang", "source", "text", frames("text").alias("f"))
    d = d.select("*", "f.*", F.size("f.vocals").alias("n"))

    def segment(line: Column, i: Column) -> Column:
        n, b = F.get("sizes", i), F.get("begins", i)
        return F.struct(
            line.alias("line_content"),
            (n / F.lit(50.0)).alias("duration"),
            b.alias("codec_frame_start"),
            (b + n).alias("codec_frame_end"),
        )

    segments = F.transform(F.split("text", "\n"), segment)
    kept = F.greatest(F.col("n") - (F.col("doc_id") % 14).cast("int"), F.lit(0))
    msa = F.when(
        F.col("doc_id") % 3 == 0,
        F.array(
            F.struct(
                F.lit("chorus").alias("label"),
                (F.col("n") / F.lit(200.0)).alias("start"),
                (F.col("n") / F.lit(100.0)).alias("end"),
            )
        ),
    ).otherwise(F.array().cast("array<struct<label:string,start:double,end:double>>"))
    return d.select(
        "doc_id",
        F.col("source").alias("dataset"),
        F.concat_ws(" ", "lang", "source").alias("genres"),
        (F.col("n") / F.when(F.col("doc_id") % 11 == 3, 40.0).otherwise(50.0)).alias("audio_length_in_sec"),
        segments.alias("segments"),
        F.array("vocals").alias("vocals_codec_matrix"),
        F.array(F.slice("instrumental", F.lit(1), kept)).alias("instrumental_codec_matrix"),
        msa.alias("msa"),
    )


def codec_files(spark: SparkSession, sf: str) -> DataFrame:
    """The songs' stems as a table keyed by path; a stem without any frame has no file."""
    both = F.array(
        F.struct(vocal_path().alias("path"), F.col("vocals_codec_matrix").alias("codec")),
        F.struct(inst_path().alias("path"), F.col("instrumental_codec_matrix").alias("codec")),
    )
    return songs(spark, sf).select(F.inline(both)).where(F.size(F.get("codec", F.lit(0))) > 0)


def vocal_path() -> Column:
    return F.concat(F.lit("npy/"), F.col("doc_id").cast("string"), F.lit(".Vocals.npy"))


def inst_path() -> Column:
    return F.concat(F.lit("npy/"), F.col("doc_id").cast("string"), F.lit(".Instrumental.npy"))


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The songs without their matrices, stems given as paths."""
    return (
        songs(spark, sf)
        .withColumn("vocals_codec", vocal_path())
        .withColumn("instrumental_codec", inst_path())
        .drop("vocals_codec_matrix", "instrumental_codec_matrix")
    )


def codes(spark: SparkSession, sf: str, k: int = 4) -> DataFrame:
    """``(vec_id, label, codec)``: each embedding of 64 values as a k x (64 / k) matrix."""
    t = 64 // k
    flat = F.transform(
        "embedding", lambda x: F.floor((x.cast("double") + 1.0) * 512.0).cast("int")
    )
    rows = F.array(*[F.slice("f", i * t + 1, t) for i in range(k)])
    return (
        table(spark, sf, "embeddings")
        .select("vec_id", "label", flat.alias("f"))
        .select("vec_id", "label", rows.alias("codec"))
    )


def wave(spark: SparkSession, sf: str) -> DataFrame:
    """``(track, idx, channel, amp)``: a user's events in id order are its samples."""
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("track"),
        "event_id",
        F.col("event_type").alias("channel"),
        F.when(F.col("event_id") % 2 == 1, -F.col("value")).otherwise(F.col("value")).alias("amp"),
    )
    return dense_index(e, "event_id", "idx", ["track"])


def names(spark: SparkSession, sf: str) -> DataFrame:
    """``(file_no, file)``."""
    kind = F.get(F.array(F.lit(".Vocals.wav"), F.lit(".inst.mp3"), F.lit(".flac")), (F.col("doc_id") % 3).cast("int"))
    song = F.call_function("div", F.col("doc_id"), F.lit(4)).cast("string")
    return documents(spark, sf).select(
        F.col("doc_id").alias("file_no"), F.concat(F.lit("audio/Song"), song, kind).alias("file")
    )


def mix(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(rounds per path, with repeats; token counts per path)."""
    source = documents(spark, sf).select(F.col("source"))
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    rounds = source.select(
        F.get(F.array(F.lit(0.5), F.lit(1.0), F.lit(2.5)), number % 3).alias("rounds"),
        F.concat(F.lit("mmap/"), "source", F.lit(".bin")).alias("path"),
    )
    counts = (
        lengths(spark, sf)
        .groupBy(F.concat(F.lit("mmap/"), "dataset", F.lit(".bin")).alias("path"))
        .agg(F.sum("n_tokens").cast("bigint").alias("n_tokens"))
    )
    return rounds, counts


def lyrics(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, lyrics)``: the language opens the first section, each line starts a new one."""
    text = F.concat(F.lit("["), F.col("lang"), F.lit("]\n"), F.replace(F.col("text"), F.lit("\n"), F.lit(" \n[verse]\n ")))
    return documents(spark, sf).select("doc_id", "lang", "source", text.alias("lyrics"))


def joined(ids: Column | str, sep: str = " ") -> Column:
    """A list as text, so that results compare by value in every engine."""
    c = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(c.cast("array<string>"), sep)


def joined_matrix(matrix: Column | str) -> Column:
    m = F.col(matrix) if isinstance(matrix, str) else matrix
    return F.array_join(F.transform(m, lambda r: joined(r)), "|")


# ---- DuckDB text ----------------------------------------------------------------------------

_WORDS = r"regexp_extract_all({0}, '[^ \n\t\r]+')"
_EMB = "list_transform(embedding, lambda x: cast(floor((cast(x as double) + 1.0) * 512.0) as integer))"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "docw": ((), f"select doc_id, source as dataset, lang, text, {_WORDS.format('text')} as words from documents"),
    "lens": (("docw",), "select doc_id, dataset, cast(len(words) as integer) as n_tokens from docw"),
    "vocab": (
        ("docw",),
        "select word as token, cast(row_number() over (order by n desc, word) as integer) as id from"
        " (select word, count(*) as n from (select unnest(words) as word from docw) group by word"
        " order by n desc, word limit 31999)",
    ),
    "vocab4": (
        ("docw",),
        "select word as token, cast(4 + row_number() over (order by n desc, word) as integer) as id from"
        " (select word, count(*) as n from (select unnest(words) as word from docw) where word not in"
        " ('[start_of_segment]','[end_of_segment]','[start_of_reference]','[end_of_reference]') group by word"
        " order by n desc, word limit 31995)"
        " union all values ('[start_of_segment]', 1), ('[end_of_segment]', 2), ('[start_of_reference]', 3),"
        " ('[end_of_reference]', 4)",
    ),
    "specials": (
        (),
        "values ('<EOD>',32000),('<SOA>',32001),('<EOA>',32002),('<SOI>',32003),('<EOI>',32004),('<SOV>',32005),"
        "('<EOV>',32006),('<s_local>',32007),('<e_local>',32008),('<s_global>',32009),('<e_global>',32010),"
        "('<semantic>',32011),('<acoustic>',32012),('<stage_1>',32013),('<dac_16k>',32014),('<dac_44k>',32015),"
        "('<xcodec>',32016),('<stage_2>',32017),('<semantic_mert>',32018),('<semantic_hubert>',32019),"
        "('<visual>',32020),('<semanticodec>',32021)",
    ),
    "toks": (
        ("docw", "vocab"),
        "select d.doc_id, d.dataset, d.pos, coalesce(v.id, 0) as id from (select doc_id, dataset, unnest(words) as word,"
        " generate_subscripts(words, 1) - 1 as pos from docw) d left join vocab v on v.token = d.word",
    ),
    "flat": (  # every token with its place in the dataset's flat order
        ("toks", "lens"),
        "select t.doc_id, t.dataset, t.pos, t.id, s.start + t.pos as place, s.start, s.n_tokens, s.doc_pos, s.total from toks t"
        " join (select doc_id, dataset, n_tokens, coalesce(sum(n_tokens) over (partition by dataset order by doc_id"
        " rows between unbounded preceding and 1 preceding), 0)::bigint as start,"
        " row_number() over (partition by dataset order by doc_id) - 1 as doc_pos,"
        " (sum(n_tokens) over (partition by dataset))::bigint as total from lens) s using (doc_id, dataset)",
    ),
    "linew": (
        ("docw",),
        "select doc_id, dataset, lang, line, i, n, coalesce(sum(n) over (partition by doc_id order by i rows between"
        " unbounded preceding and 1 preceding), 0)::integer as b from (select doc_id, dataset, lang, line, i,"
        f" cast(len({_WORDS.format('line')}) as integer) as n from (select doc_id, dataset, lang,"
        " unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i"
        " from docw))",
    ),
    "songs": (
        ("docw",),
        "select doc_id, dataset, lang || ' ' || dataset as genres, cast(len(words) as integer) as n,"
        " greatest(len(words) - doc_id % 14, 0)::integer as n_inst,"
        " len(words) / (case when doc_id % 11 = 3 then 40.0::double else 50.0::double end) as seconds, words from docw",
    ),
    "frames": (
        ("songs",),
        "select doc_id, t, 45334 + (length(word) * 37 + t * 13) % 1024 as v, 45334 + (length(word) * 59 + t * 29) % 1024 as u,"
        " t < n_inst as has_inst from (select doc_id, n_inst, unnest(words) as word, generate_subscripts(words, 1) - 1 as t"
        " from songs)",
    ),
    # songs that pass every song-level check of the interleaving encoder
    "good_songs": (
        ("songs",),
        "select *, least(n, n_inst) as T, least(n, n_inst) / seconds as fps from songs where n > 0 and n - n_inst <= 10"
        " and n_inst > 0 and n_inst / seconds between 49 and 51",
    ),
    "codes": (
        (),
        "select vec_id, label, [e[1:16], e[17:32], e[33:48], e[49:64]] as codec from"
        f" (select vec_id, label, {_EMB} as e from embeddings)",
    ),
    "cells": (
        ("codes",),
        "select vec_id, label, k, unnest(row) as code, generate_subscripts(row, 1) - 1 as t from (select vec_id, label,"
        " unnest(codec) as row, generate_subscripts(codec, 1) - 1 as k from codes)",
    ),
    "wave": (
        (),
        "select user_id as track, event_id, row_number() over (partition by user_id order by event_id) - 1 as idx,"
        " event_type as channel, case when event_id % 2 = 1 then -value else value end as amp from events",
    ),
    "names": (
        (),
        "select doc_id as file_no, 'audio/Song' || (doc_id // 4) || ['.Vocals.wav', '.inst.mp3', '.flac'][doc_id % 3 + 1]"
        " as file from documents",
    ),
    "counts": (
        ("lens",),
        "select 'mmap/' || dataset || '.bin' as path, cast(sum(n_tokens) as bigint) as n_tokens from lens group by dataset",
    ),
    "mix": (
        ("counts",),
        "select distinct [0.5::double, 1.0::double, 2.5::double][regexp_extract(source, '(\\d+)$', 1)::integer % 3 + 1] as rounds,"
        " 'mmap/' || source || '.bin' as path, n_tokens from documents join counts on counts.path = 'mmap/' || source || '.bin'",
    ),
    "sizes": (
        ("linew",),
        "select doc_id, list(n order by i) as sizes, cast(count(*) as integer) as n_sent, max(n) as longest from linew"
        " group by doc_id",
    ),
    "lyrics": (
        (),
        "select doc_id, lang, source, '[' || lang || ']' || chr(10) || replace(text, chr(10), ' ' || chr(10) || '[verse]'"
        " || chr(10) || ' ') as lyrics from documents",
    ),
}


def with_views(views: str, body: str) -> str:
    """``body`` behind a WITH clause for ``views`` (blank separated) and what they need."""
    needed: list[str] = []

    def add(name: str) -> None:
        deps, _ = CTES[name]
        for d in deps:
            add(d)
        if name not in needed:
            needed.append(name)

    for v in views.split():
        add(v)
    head = ", ".join(
        f"{n}(token, id) as ({CTES[n][1]})" if n in ("specials", "vocab4") else f"{n} as ({CTES[n][1]})" for n in needed
    )
    if body.lstrip().startswith("with recursive"):
        return f"with recursive {head}, {body.lstrip()[len('with recursive'):]}"
    return f"with {head} {body}"


def sql_list(expr: str) -> str:
    return f"coalesce(array_to_string({expr}, ' '), '')"


def sql_matrix(expr: str) -> str:
    return f"coalesce(array_to_string(list_transform({expr}, lambda r: array_to_string(r, ' ')), '|'), '')"
