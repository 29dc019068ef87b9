"""Validation, joins and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codecs as C
from ..functions import sequences as S
from ..functions.binding import let, let_all
from ..operators import mapping as MP
from ..operators import mixture as MX
from ..operators import tracks as TR
from ..operators import validate as V
from ..operators import wave as W
from ..plans import encode as E
from . import fixtures as X
from .registry import query

# ---- validation ------------------------------------------------------------------------------


def _ragged_manifest(spark, sf):
    """Songs with some keys blanked out and some segment lists emptied."""
    m = X.manifest(spark, sf)
    blank = lambda name, every, at: F.when(F.col("doc_id") % every != at, F.col(name)).alias(name)
    return m.select(
        "doc_id",
        F.when(F.col("doc_id") % 19 != 4, F.col("doc_id")).alias("id"),
        F.col("segments").alias("splitted_lyrics"),
        F.when(F.col("doc_id") % 23 == 6, F.slice("segments", F.lit(1), F.lit(0))).otherwise(F.col("segments")).alias("segments"),
        blank("genres", 29, 3),
        "vocals_codec",
        blank("instrumental_codec", 31, 9),
        "audio_length_in_sec",
        blank("msa", 3, 1),
        F.col("vocals_codec").alias("codec"),
    )


_KEYS = "doc_id % 19 = 4 or doc_id % 29 = 3 or doc_id % 31 = 9"


@query(
    "p01_required_keys",
    f"select doc_id, case when {_KEYS} then 'missing_keys' when doc_id % 23 = 6 then 'no_segments' end as plain,"
    f" case when {_KEYS} or doc_id % 3 = 1 then 'missing_keys' when doc_id % 23 = 6 then 'no_segments' end as icl from documents",
)
def p01(spark, sf):
    segs = F.col("segments")
    return _ragged_manifest(spark, sf).select(
        "doc_id",
        V.first_reason(*V.song_key_checks(segs)).alias("plain"),
        V.first_reason(*V.song_key_checks(segs, icl=True)).alias("icl"),
    )


def _damaged_codes(spark, sf):
    """Code matrices with too large and negative values, a missing row, and an empty one."""
    i = F.col("vec_id")
    hit = lambda value: F.transform(
        "codec", lambda row, k: F.transform(row, lambda x, t: F.when((k == 1) & (t == 3), F.lit(value)).otherwise(x))
    )
    damaged = (
        F.when(i % 9 == 1, hit(1024))
        .when(i % 9 == 2, hit(-1))
        .when(i % 9 == 3, F.slice("codec", F.lit(1), F.lit(3)))
        .when(i % 9 == 4, F.slice("codec", F.lit(1), F.lit(0)))
        .otherwise(F.col("codec"))
    )
    return X.codes(spark, sf).withColumn("codec", damaged)


@query(
    "p02_code_range",
    "select vec_id, [null, 'code_out_of_range', 'code_out_of_range', 'codebook_count', 'empty_codes', null, null, null, null][vec_id % 9 + 1]"
    " as problem, case when vec_id % 9 in (1, 2) then 'code_out_of_range' when vec_id % 9 = 3 then 'codebook_count' when vec_id % 9 = 4"
    " then 'empty_codes' end as other_codec from embeddings",
)
def p02(spark, sf):
    return _damaged_codes(spark, sf).select(
        "vec_id",
        C.codes_problem(F.col("codec"), X.FOUR).alias("problem"),
        C.codes_problem(F.col("codec"), X.FIRST_LAYERS).alias("other_codec"),
    )


@query(
    "p03_first_codebook",
    X.with_views("codes", "select vec_id, codec[(vec_id % 3 + 1)::bigint][1] + 45334 + (vec_id % 3) * 1024 < 46358 as ok from codes"),
)
def p03(spark, sf):
    ids = C.flatten_frames(F.slice(C.offset_codes(F.col("codec"), X.FIRST_LAYERS), (F.col("vec_id") % 3 + 1).cast("int"), F.lit(1)))
    return X.codes(spark, sf).select("vec_id", C.starts_in_first_codebook(ids, X.FIRST_LAYERS).alias("ok"))


@query(
    "p04_flat_segments",
    X.with_views(
        "linew songs",
        "select l.doc_id, l.i::integer as seq_no, l.n / 50.0::double > 0 and l.n / 50.0::double <= s.seconds and l.n >= s.n / s.seconds as ok"
        " from linew l join songs s using (doc_id) where s.n > 0",
    ),
)
def p04(spark, sf):
    s = X.songs(spark, sf).withColumn("T", C.n_frames(F.col("vocals_codec_matrix"))).where(F.col("T") > 0)
    rows = s.select(
        "doc_id", "T", F.col("audio_length_in_sec").alias("sec"), F.posexplode("segments").alias("seq_no", "s")
    )
    fps = V.song_fps(F.col("T"), F.col("sec"))
    return rows.select("doc_id", "seq_no", V.segment_is_valid_flat(F.col("s"), fps, F.col("sec"), F.col("T")).alias("ok"))


@query(
    "p05_interleave_segments",
    X.with_views(
        "linew songs",
        "select l.doc_id, l.i::integer as seq_no, l.n > 0 and l.b + l.n <= s.n_inst and l.n >= s.n_inst / s.seconds as plain,"
        " l.n > 0 and l.b + l.n <= s.n_inst and l.n / 50.0::double >= 1.0 as icl from linew l join songs s using (doc_id) where s.n > 0",
    ),
)
def p05(spark, sf):
    s = X.songs(spark, sf).withColumn("T", C.n_frames(F.col("instrumental_codec_matrix")))
    rows = s.where(F.col("audio_length_in_sec") > 0).select(
        "doc_id", "T", F.col("audio_length_in_sec").alias("sec"), F.posexplode("segments").alias("seq_no", "s")
    )
    fps = V.song_fps(F.col("T"), F.col("sec"))
    return rows.select(
        "doc_id",
        "seq_no",
        V.segment_is_valid(F.col("s"), fps, F.col("T")).alias("plain"),
        V.segment_is_valid(F.col("s"), fps, F.col("T"), icl=True).alias("icl"),
    )


@query(
    "p06_frame_rate",
    X.with_views("songs", "select doc_id, coalesce(n_inst / nullif(seconds, 0) between 49 and 51, false) as ok from songs"),
)
def p06(spark, sf):
    fps = V.song_fps(C.n_frames(F.col("instrumental_codec_matrix")), F.col("audio_length_in_sec"))
    return X.songs(spark, sf).select("doc_id", V.fps_is_valid(fps).alias("ok"))


@query(
    "p07_stem_lengths",
    X.with_views(
        "songs",
        "select doc_id, n - n_inst > 10 as too_far, case when n - n_inst <= 10 then n_inst else n end as vocal_frames, n_inst as inst_frames"
        " from songs",
    ),
)
def p07(spark, sf):
    trimmed, far = V.reconcile_stems(X.songs(spark, sf), "vocals_codec_matrix", "instrumental_codec_matrix")
    return trimmed.select(
        "doc_id",
        far.alias("too_far"),
        C.n_frames(F.col("vocals_codec_matrix")).alias("vocal_frames"),
        C.n_frames(F.col("instrumental_codec_matrix")).alias("inst_frames"),
    )


@query(
    "p08_code_diversity",
    X.with_views("cells", "select vec_id, count(distinct code)::integer as n, count(distinct code) >= 16 as kept from cells where k = 0 group by vec_id"),
)
def p08(spark, sf):
    n = C.code_diversity(F.col("codec"))
    return X.codes(spark, sf).select("vec_id", n.alias("n"), (n >= 16).alias("kept"))


@query(
    "p09_prompt_variation",
    X.with_views("toks", "select doc_id, count(distinct id) >= 0.1 * count(*) as varied from toks group by doc_id"),
)
def p09(spark, sf):
    return X.seqs(spark, sf).where(F.size("tokens") > 0).select("doc_id", V.is_varied(F.col("tokens")).alias("varied"))


@query(
    "p10_drop_empty",
    X.with_views("linew", "select doc_id, count(*) filter (where n > 0)::integer as n_sequences from linew group by doc_id"),
)
def p10(spark, sf):
    cfg = E.EncodeConfig(append_eod=False)
    lines = X.documents(spark, sf).select("doc_id", F.split("text", "\n").alias("lines"))
    ids = lines.withColumn("__all", X.tokenizer(spark, sf).nested_text_ids(F.col("lines")))
    kept = F.filter("__all", lambda x: F.size(x) > 0)
    return E._finish(ids.select("doc_id", kept.alias("parts")), "parts", cfg).select(
        "doc_id", F.size("lengths").alias("n_sequences")
    )


@query(
    "p11_mapping_eligible",
    X.with_views(
        "sizes",
        "select doc_id, n_sent >= 2 and not (n_sent > 1 and longest > 512) as pairs, n_sent >= 1 and longest <= 512 as blocks from sizes",
    ),
)
def p11(spark, sf):
    s = F.col("sizes")
    return X.sizes(spark, sf).select("doc_id", MP.eligible(s, 2).alias("pairs"), MP.eligible(s, 1, 1).alias("blocks"))


@query(
    "p12_block_ids",
    X.with_views(
        "toks",
        "select doc_id, coalesce(string_agg(id::varchar, ' ' order by pos) filter (where not (id >= 10 and id < 500)), '') as kept,"
        " count(*)::integer as same from toks group by doc_id",
    ),
)
def p12(spark, sf):
    return X.seqs(spark, sf).where(F.size("tokens") > 0).select(
        "doc_id",
        X.joined(S.block_ids(F.col("tokens"), 10, 500)).alias("kept"),
        F.size(S.block_ids(F.col("tokens"), 32016, 32016)).alias("same"),
    )


def streams(spark, sf):
    """Generated streams: per song the interleaved codes of its lines between text tokens; some
    spans lose their last id and some streams the final end of audio."""
    trimmed, far = V.reconcile_stems(X.songs(spark, sf), "vocals_codec_matrix", "instrumental_codec_matrix")
    good = trimmed.where(~far & (F.col("__frames") > 0))

    def span(s, v, u):
        cut = [
            C.codes_to_ids(C.slice_frames(m, s["codec_frame_start"], s["codec_frame_end"]), X.ONE) for m in (v, u)
        ]
        short = (F.col("doc_id") % 5 == 1) & (s["codec_frame_end"] - s["codec_frame_start"] > 1)
        ids = let(S.interleave(*cut), lambda x: F.when(short, F.slice(x, F.lit(1), F.size(x) - 1)).otherwise(x))
        return F.concat(C.int_array([7, 8]), S.wrap_audio(ids, X.ONE))

    inside = let(
        F.col("__frames"),
        lambda n: F.filter(
            "segments", lambda s: (s["codec_frame_end"] > s["codec_frame_start"]) & (s["codec_frame_end"] <= n)
        ),
    )
    spans = let_all(
        lambda used, v, u: F.transform(used, lambda s: span(s, v, u)),
        used=F.col("used"),
        v=F.col("vocals_codec_matrix"),
        u=F.col("instrumental_codec_matrix"),
    )
    broken = F.col("doc_id") % 13 == 7
    cut = let(F.flatten(spans), lambda x: F.when(broken, F.slice(x, F.lit(1), F.size(x) - 1)).otherwise(x))
    return good.withColumn("used", inside).where(F.size("used") > 0).select("doc_id", cut.alias("ids"))


STREAM_CTES = (
    "st as (select l.doc_id, l.i, l.b, l.n, l.doc_id % 13 = 7 as broken, l.n - (l.doc_id % 5 = 1 and l.n > 1)::integer as m"
    " from linew l join songs s using (doc_id) where s.n - s.n_inst <= 10 and s.n_inst > 0 and l.n > 0 and l.b + l.n <= s.n_inst)"
)


def _ctes(views: str, more: str, body: str) -> str:
    return X.with_views(views, "select 1").removesuffix("select 1").rstrip() + f", {more} {body}"


@query(
    "p13_paired_audio",
    _ctes("linew songs", STREAM_CTES, "select doc_id, not bool_or(broken) as paired, count(*)::integer as n_starts from st group by doc_id"),
)
def p13(spark, sf):
    ids = F.col("ids")
    return streams(spark, sf).select(
        "doc_id", S.has_paired_audio(ids).alias("paired"), S.count_token(ids, C.SOA).alias("n_starts")
    )


@query(
    "p14_quarantine",
    X.with_views(
        "songs",
        "select coalesce(reason, 'good') as reason, count(*) as n from (select case when n_inst = 0 then 'missing_file' when n - n_inst > 10 then 'stem_length' when not (n_inst / seconds between 49 and 51) then 'frame_rate' end as reason"
        " from songs) group by reason",
    ),
)
def p14(spark, sf):
    m = E.attach_codecs(X.manifest(spark, sf), X.codec_files(spark, sf), ["vocals_codec", "instrumental_codec"])
    v, i = "vocals_codec_matrix", "instrumental_codec_matrix"
    trimmed, far = V.reconcile_stems(m, v, i)
    reason = V.first_reason(
        (V.missing_keys([v, i]), "missing_file"),
        (far, "stem_length"),
        (~V.fps_is_valid(V.song_fps(F.col("__frames"), F.col("audio_length_in_sec"))), "frame_rate"),
    )
    good, bad = V.quarantine(trimmed, reason)
    every = good.select(F.lit("good").alias("reason")).unionByName(bad.select("reason"))
    return every.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---- joins -----------------------------------------------------------------------------------


@query(
    "j01_attach_codecs",
    X.with_views(
        "songs",
        "select doc_id, nullif(n, 0) as vocal_frames, nullif(n_inst, 0) as inst_frames, n_inst = 0 as missing from songs",
    ),
)
def j01(spark, sf):
    m, files = X.manifest(spark, sf), X.codec_files(spark, sf)
    gone = E.missing_files(m, files, "instrumental_codec").select("doc_id", F.lit(True).alias("gone"))
    joined = E.attach_codecs(m, files, ["vocals_codec", "instrumental_codec"])
    frames = lambda c: F.when(F.col(c).isNotNull(), C.n_frames(F.col(c)))
    return joined.join(gone, "doc_id", "left").select(
        "doc_id",
        frames("vocals_codec_matrix").alias("vocal_frames"),
        frames("instrumental_codec_matrix").alias("inst_frames"),
        F.coalesce("gone", F.lit(False)).alias("missing"),
    )


@query(
    "j02_pair_stems",
    X.with_views(
        "names",
        "select key, arg_max(file, file_no) filter (where kind = 'Vocals') as vocals, arg_max(file, file_no) filter (where kind = 'Instrumental')"
        " as instrumental, arg_max(file, file_no) filter (where kind = 'Full') as \"full\", count(*) as n_files from (select *,"
        " regexp_extract(file, '/([^.]*)', 1) as key, case when contains(file, 'Vocals') then 'Vocals' when contains(file, 'inst') then"
        " 'Instrumental' else 'Full' end as kind from names) group by key",
    ),
)
def j02(spark, sf):
    return W.pair_stems(X.names(spark, sf))


@query(
    "j03_mix_tracks",
    X.with_views(
        "wave",
        "select a.track || '_mixed' as track, a.idx, a.amp + b.amp as amp from (select track // 2 as track, idx, amp from wave where track % 2 = 0) a"
        " join (select track // 2 as track, idx, amp from wave where track % 2 = 1) b using (track, idx)",
    ),
)
def j03(spark, sf):
    pair = F.call_function("div", F.col("track"), F.lit(2)).cast("string")
    kind = F.when(F.col("track") % 2 == 0, "_itrack").otherwise("_vtrack")
    stems = X.wave(spark, sf).select(F.concat(pair, kind).alias("track"), "idx", "amp")
    return W.mix_tracks(stems)


@query(
    "j04_data_with_index",
    "select 'mmap/' || doc_id || '.bin' as path from documents where doc_id in (select doc_id from labels)",
)
def j04(spark, sf):
    name = lambda ext: F.concat(F.lit("mmap/"), F.col("doc_id").cast("string"), F.lit(ext)).alias("path")
    data = X.documents(spark, sf).select(name(".bin"))
    index = X.table(spark, sf, "labels").select(name(".idx"))
    return MX.data_with_index(data.unionByName(index))


@query(
    "j05_mixture_counts",
    X.with_views("mix", "select rounds, path, n_tokens, 0::bigint as missing from mix"),
)
def j05(spark, sf):
    found, missing = MX.mixture_table(*X.mix(spark, sf))
    none = missing.groupBy("path").agg(F.count(F.lit(1)).alias("m"))
    return found.join(none, "path", "left").select("rounds", "path", "n_tokens", F.coalesce("m", F.lit(0).cast("bigint")).alias("missing"))


@query(
    "j08_detect_codec",
    X.with_views(
        "toks",
        "select doc_id, case when hi <= 36117 then 'dac16k' when lo >= 36118 and hi <= 45333 then 'dac44k' when lo >= 45334 and hi <= 57621"
        " then 'xcodec' when lo >= 57622 and hi <= 58645 then 'mert' when lo >= 58646 and hi <= 59157 then 'hubert' when lo >= 59158 and"
        " hi <= 75541 then 'semantic/s' when lo >= 75542 and hi <= 83733 then 'semantic/a' when lo >= 59158 then 'semanticodec' end as codec"
        " from (select doc_id, 32022 + min(id) + (doc_id * 5171) % 20000 as lo, 32022 + max(id) + (doc_id * 5171) % 20000 as hi from toks group by doc_id)",
    ),
)
def j08(spark, sf):
    shift = 32022 + (F.col("doc_id") * 5171) % 20000
    low, high = F.array_min("tokens") + shift, F.array_max("tokens") + shift
    return X.seqs(spark, sf).where(F.size("tokens") > 0).select("doc_id", C.detect_codec(low, high).alias("codec"))


# ---- aggregations ----------------------------------------------------------------------------


@query(
    "g01_token_totals",
    X.with_views(
        "lens", "select coalesce(dataset, '<all>') as dataset, sum(n_tokens)::bigint as n_tokens, count(*) as n_sequences from lens group by rollup (dataset)"
    ),
)
def g01(spark, sf):
    return MX.token_totals(X.lengths(spark, sf)).withColumn("dataset", F.coalesce("dataset", F.lit("<all>")))


@query(
    "g04_dataset_counts",
    X.with_views(
        "linew", "select dataset, count(*) as n_sequences, count(distinct doc_id) as n_documents from linew group by dataset"
    ),
)
def g04(spark, sf):
    per_line = X.documents(spark, sf).select("doc_id", F.col("source").alias("dataset"), F.explode(F.split("text", "\n")))
    return MX.dataset_counts(per_line)


@query(
    "g05_corpus_profile",
    X.with_views(
        "sizes",
        "select count(*) as n_docs, count(*) filter (where n_sent = 0) as empty_docs, count(*) filter (where n_sent = 1) as one_sentence_docs,"
        " count(*) filter (where n_sent > 1 and longest > 512) as long_sentence_docs from sizes",
    ),
)
def g05(spark, sf):
    return MP.corpus_profile(X.sizes(spark, sf))


@query(
    "g08_distinct_codes",
    X.with_views(
        "cells", "select label, k::integer as k, count(distinct code) as n_distinct, count(*) as n_codes from cells group by label, k"
    ),
)
def g08(spark, sf):
    cells = X.codes(spark, sf).select("label", F.posexplode("codec").alias("k", "row")).select("label", "k", F.explode("row").alias("code"))
    per_code = cells.groupBy("label", "k", "code").agg(F.count(F.lit(1)).alias("n"))
    return per_code.groupBy("label", "k").agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("n").cast("bigint").alias("n_codes"))


_COARSE = "coarse as (select vec_id, k, t, code // 40 as code from cells)"
_MODE = (
    ", cnt as (select vec_id, k, code, count(*) as n, min(t) as first_t from coarse group by all),"
    " mode as (select vec_id, k, code as mode, n, row_number() over (partition by vec_id, k order by n desc, first_t) as r from cnt)"
)


def _coarse(spark, sf):
    """Codes coarsened so that rows have repeated values and ties."""
    tenth = F.transform("codec", lambda row: F.transform(row, lambda x: F.call_function("div", x, F.lit(40)).cast("int")))
    return X.codes(spark, sf).select("vec_id", tenth.alias("codec"))


@query(
    "g09_row_mode",
    _ctes("cells", _COARSE + _MODE, "select vec_id, k::integer as k, mode::integer as mode, n from mode where r = 1"),
)
def g09(spark, sf):
    return TR.row_modes(_coarse(spark, sf), "vec_id", "codec")


@query(
    "o02_most_frequent",
    _ctes("cells", _COARSE + _MODE, "select vec_id, string_agg(mode::varchar, ' ' order by k) as modes from mode where r = 1 group by vec_id"),
)
def o02(spark, sf):
    return _coarse(spark, sf).select("vec_id", X.joined(F.transform("codec", TR.row_mode)).alias("modes"))


@query(
    "a25_repair_codes",
    _ctes(
        "cells",
        _COARSE + _MODE,
        "select vec_id, array_to_string(list(row order by k), '|') as codec from (select c.vec_id, c.k, string_agg((case when c.code < 0 or c.code > 13"
        " then m.mode else c.code end)::varchar, ' ' order by c.t) as row from coarse c join mode m on m.vec_id = c.vec_id and m.k = c.k and m.r = 1"
        " group by c.vec_id, c.k) group by vec_id",
    ),
)
def a25(spark, sf):
    return _coarse(spark, sf).select("vec_id", X.joined_matrix(TR.repair_codes(F.col("codec"), 13)).alias("codec"))


@query("g10_peak", X.with_views("wave", "select track, max(abs(amp)) as peak from wave group by track"))
def g10(spark, sf):
    return W.peak_amplitude(X.wave(spark, sf))


# Song lines with the bytes of both stems, a report every 50 documents.
_BYTES = "octet_length(encode(to_json({'doc_id': doc_id, 'n': n_tokens})::varchar)) + 2 * (n_tokens + greatest(n_tokens - doc_id % 14, 0))"


@query(
    "g11_interval_bytes",
    _ctes(
        "lens",
        f"sized as (select doc_id, {_BYTES} as b from lens), so_far as (select row_number() over (order by doc_id) as n_docs, sum(b) over (order by doc_id rows unbounded preceding)::bigint as n_bytes from sized)",
        "select n_docs, n_bytes from so_far where n_docs % 50 = 0",
    ),
)
def g11_intervals(spark, sf):
    songs = X.songs(spark, sf).withColumn("n", F.size(F.get("vocals_codec_matrix", F.lit(0))))
    size = MX.document_bytes(F.to_json(F.struct("doc_id", "n")), F.col("vocals_codec_matrix"), F.col("instrumental_codec_matrix"))
    return MX.interval_totals(songs, "doc_id", size, 50)


@query(
    "g11_progress",
    "select count(*) as n_docs, sum(strlen(text))::bigint as n_bytes from documents",
)
def g11(spark, sf):
    watched, seen = MX.with_progress(X.documents(spark, sf), F.octet_length("text"))
    watched.write.format("noop").mode("overwrite").save()
    totals = seen.get
    return spark.createDataFrame([(totals["n_docs"], totals["n_bytes"])], "n_docs bigint, n_bytes bigint")


# ---- sampled audio ---------------------------------------------------------------------------


@query(
    "f28_peak_normalize",
    X.with_views("wave", "select track, idx, amp * (0.95::double / max(abs(amp)) over (partition by track)) as amp from wave"),
)
def f28(spark, sf):
    return W.peak_normalize(X.wave(spark, sf).select("track", "idx", "amp"))


@query(
    "f29_limit_amplitude",
    X.with_views(
        "wave",
        "select track, idx, greatest(least(amp / 50, 0.99), -0.99)::double as clipped,"
        " (amp / 50) * least(0.99::double / max(abs(amp / 50)) over (partition by track), 1.0::double) as scaled from wave",
    ),
)
def f29(spark, sf):
    w = X.wave(spark, sf).select("track", "idx", (F.col("amp") / 50).alias("amp"))
    clipped = W.limit_amplitude(w).withColumnRenamed("amp", "clipped")
    scaled = W.limit_amplitude(w, rescale=True).withColumnRenamed("amp", "scaled")
    return clipped.join(scaled, ["track", "idx"])


@query(
    "f30_mono",
    X.with_views("wave", "select track, idx // 3 as idx, round(avg(amp), 6) as amp from wave group by track, idx // 3"),
)
def f30(spark, sf):
    framed = X.wave(spark, sf).withColumn("idx", F.call_function("div", F.col("idx"), F.lit(3)))
    return W.to_mono(framed).withColumn("amp", F.round("amp", 6))


_CHUNKS = (
    "ch as (select track, idx, idx // 16 as c, count(*) over (partition by track, idx // 16) as n from wave),"
    " kept as (select track, c, row_number() over (partition by track order by c) as segment from (select distinct track, c from ch where n >= {m})),"
    " final as (select ch.track, ch.idx, kept.segment from ch left join kept using (track, c) where kept.segment is not null or"
    " ch.track not in (select track from kept))"
)


@query("a26_chunk_wave", _ctes("wave", _CHUNKS.format(m=10), "select * from final"))
def a26(spark, sf):
    return W.chunk_wave(X.wave(spark, sf).select("track", "idx"), 16, 10)


@query(
    "p15_min_chunk",
    _ctes(
        "wave",
        _CHUNKS.format(m=70).replace("idx // 16", "idx // 100"),
        "select track, segment, count(*) as n from final group by all",
    ),
)
def p15(spark, sf):
    # Tracks with fewer than 70 samples have no chunk that is long enough.
    return W.chunk_wave(X.wave(spark, sf).select("track", "idx"), 100, 70).groupBy("track", "segment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "w02_kept_chunks",
    _ctes("wave", _CHUNKS.format(m=10), "select track, max(segment) as n_kept from final group by track"),
)
def w02(spark, sf):
    cut = W.chunk_wave(X.wave(spark, sf).select("track", "idx"), 16, 10)
    return cut.groupBy("track").agg(F.max("segment").alias("n_kept"))


@query("w03_track_max", X.with_views("wave", "select distinct track, max(abs(amp)) over (partition by track) as peak, count(*) over (partition by track) as n from wave"))
def w03(spark, sf):
    w = X.wave(spark, sf)
    return W.peak_amplitude(w).join(w.groupBy("track").agg(F.count(F.lit(1)).alias("n")), "track")


@query(
    "a27_trim_silence",
    _ctes(
        "wave",
        "quiet as (select track, idx, case when (idx // 24) % 2 = 1 then amp / 1000 else amp end as amp from wave),"
        " fr as (select track, f, sum(amp * amp) as e from (select track, amp, unnest(range(greatest(ceil((idx - 3) / 4.0)::bigint, 0),"
        " (idx + 4) // 4 + 1)) as f from quiet) group by track, f),"
        " good as (select track, f from (select fr.*, max(e) over (partition by fr.track) as top, l.n from fr join (select track, count(*) as n from quiet"
        " group by track) l using (track) where f <= n // 4) where e > top * 0.01)",
        "select q.track, q.idx from quiet q semi join good g on g.track = q.track and g.f = q.idx // 4",
    ),
)
def a27(spark, sf):
    w = X.wave(spark, sf)
    gap = F.call_function("div", F.col("idx"), F.lit(24)) % 2 == 1
    quiet = w.select("track", "idx", F.when(gap, F.col("amp") / 1000).otherwise(F.col("amp")).alias("amp"))
    return W.trim_silence(quiet, frame=8, hop=4).select("track", "idx")


# ---- generated tracks ------------------------------------------------------------------------


def _extracted(skip: bool) -> str:
    return _ctes(
        "linew songs frames",
        STREAM_CTES
        + ", tr as (select st.doc_id, string_agg((f.v - 45334)::varchar, ' ' order by f.t) as vocals, string_agg((f.u - 45334)::varchar, ' ' order by f.t)"
        " as instrumental from st join frames f on f.doc_id = st.doc_id and f.t >= st.b and f.t < st.b + st.m where not broken"
        + (" and st.i > (select min(i) from st x where x.doc_id = st.doc_id)" if skip else "")
        + " group by st.doc_id)",
        "select d.doc_id, case when broken then 'unpaired_audio' end as problem, case when broken then null else coalesce(vocals, '') end as vocals,"
        " case when broken then null else coalesce(instrumental, '') end as instrumental from (select distinct doc_id, broken from st) d left join tr using (doc_id)",
    )


def _tracks(spark, sf, skip):
    got = TR.extract_tracks(streams(spark, sf), "ids", X.ONE, skip)
    return got.select(
        "doc_id", "problem", X.joined_matrix("vocals").alias("vocals"), X.joined_matrix("instrumental").alias("instrumental")
    )


@query("a24_extract_tracks", _extracted(False))
def a24(spark, sf):
    return _tracks(spark, sf, False)


@query("a24_skip_prompt", _extracted(True))
def a24_skip(spark, sf):
    return _tracks(spark, sf, True)


@query(
    "a19_plan_batches",
    X.with_views(
        "songs",
        "select doc_id, piece::integer as piece, b::integer as \"begin\", e::integer as \"end\", w::integer as windows from (select doc_id,"
        " unnest(range(0, (wn + 1) // 2)) as piece, wn, n from (select doc_id, n // 5 // 3 as wn, n from songs)) x, lateral (select piece * 30 as b,"
        " least((piece + 1) * 2, wn) * 15 as e, least((piece + 1) * 2, wn) - piece * 2 as w) union all select doc_id, ((wn + 1) // 2)::integer,"
        " (wn * 15)::integer, n, 0 from (select doc_id, n // 5 // 3 as wn, n from songs) where wn * 15 < n",
    ),
)
def a19(spark, sf):
    s = X.songs(spark, sf).select("doc_id", C.n_frames(F.col("vocals_codec_matrix")).alias("frames"))
    return TR.plan_batches(s, "frames", 2, fps=5, seconds=3).drop("frames")


@query(
    "a35_stage2_prompts",
    X.with_views(
        "cells",
        "select vec_id, (t // 6)::integer as window, '32001 32013 ' || string_agg((code + 45334)::varchar, ' ' order by t) || ' 32017' as prompt"
        " from cells where k = 0 group by vec_id, t // 6".replace(" as window", " as window_no"),
    ),
)
def a35(spark, sf):
    p = TR.stage2_prompts(X.codes(spark, sf), "vec_id", "codec", X.FIRST_LAYERS, 6)
    return p.select("vec_id", F.col("window").alias("window_no"), X.joined("prompt").alias("prompt"))


@query(
    "a35_join_windows",
    X.with_views("cells", "select vec_id, string_agg((code + 45334)::varchar, ' ' order by t) as ids from cells where k = 0 group by vec_id"),
)
def a35_join(spark, sf):
    p = TR.stage2_prompts(X.codes(spark, sf), "vec_id", "codec", X.FIRST_LAYERS, 6)
    inner = p.select("vec_id", "window", F.slice("prompt", F.lit(3), F.size("prompt") - 3).alias("ids"))
    return TR.join_windows(inner, "vec_id").select("vec_id", X.joined("ids").alias("ids"))
