"""Encoders, streaming and blended training data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codecs import EOD
from ..operators import blend as B
from ..operators import pack as P
from ..operators import split as SP
from ..operators.prompts import length_distribution, sample_prompt
from ..plans import encode as E
from ..plans import manifest as MF
from ..plans import training as TR
from ..session import materialize, scratch_path
from ..sources.manifests import SONG_SCHEMA
from ..streaming.encode_stream import encode_stream
from ..streaming.quarantine_stream import quarantine_stream, read_sink
from . import fixtures as X
from .expression_queries import SEGMENT_CTES, SEGMENT_VIEWS, VALID
from .packing_queries import _ctes
from .registry import query
from .source_queries import PACKED

STEMS = ["vocals_codec", "instrumental_codec"]


def _doc(df, *extra):
    return df.select("doc_id", *extra, X.joined("tokens").alias("tokens"), X.joined("lengths").alias("lengths"))


def _text(spark, sf):
    return X.documents(spark, sf).select("doc_id", F.col("source").alias("dataset"), "text")


# ---- text documents --------------------------------------------------------------------------

_SENTENCES = (
    "sents as (select doc_id, dataset, unnest(s) as sent, generate_subscripts(s, 1) as i from (select doc_id, source as dataset,"
    " list_filter(string_split(regexp_replace(text, '([.!?])[ \\t\\n\\r\\f]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: length(x) > 0) as s from documents)),"
    " ids as (select doc_id, dataset, i, string_agg(coalesce(v.id, 0)::varchar, ' ' order by pos) as ids, count(*) as n from (select doc_id, dataset, i,"
    " unnest(w) as token, generate_subscripts(w, 1) as pos from (select *, regexp_extract_all(sent, '[^ \\n\\t\\r]+') as w from sents)) left join vocab v"
    " using (token) group by doc_id, dataset, i),"
    " doc as (select doc_id, dataset, string_agg(ids, ' ' order by i) || ' 32000' as tokens, list(n order by i) as ns from ids group by doc_id, dataset)"
)


@query(
    "a29_encode_documents",
    _ctes(
        "vocab",
        _SENTENCES,
        "select doc_id, tokens, array_to_string(list_transform(ns, lambda x, i: case when i = len(ns) then x + 1 else x end), ' ') as lengths from doc",
    ),
)
def a29(spark, sf):
    cfg = E.EncodeConfig(split_sentences=True)
    return _doc(E.encode_documents(_text(spark, sf), "text", X.tokenizer(spark, sf), cfg))


@query(
    "a21_reassemble",
    _ctes(
        "vocab",
        _SENTENCES,
        "select doc_id, tokens, array_to_string(list_transform(ns, lambda x, i: case when i = len(ns) then x + 1 else x end), ' ') as lengths from doc",
    ),
)
def a21(spark, sf):
    cfg = E.EncodeConfig(split_sentences=True)
    docs = E.encode_documents(_text(spark, sf), "text", X.tokenizer(spark, sf), cfg)
    return _doc(E.reassemble(E.to_sequences(docs)))


@query(
    "f12_encode_ids",
    X.with_views(
        "toks",
        "select doc_id, string_agg(id::varchar, ' ' order by pos) || ' 32000' as tokens, (count(*) + 1)::varchar as lengths from toks group by doc_id",
    ),
)
def f12(spark, sf):
    return _doc(E.encode_ids(X.seqs(spark, sf), "tokens", E.EncodeConfig()))


@query(
    "t01_encode_stream",
    X.with_views(
        "toks",
        "select doc_id, string_agg(id::varchar, ' ' order by pos) || ' 32000' as tokens, (count(*) + 1)::varchar as lengths from toks group by doc_id",
    ),
)
def t01(spark, sf):
    source, sink, state = (scratch_path(spark, n) for n in ("lines", "encoded", "state"))
    _text(spark, sf).write.json(source)
    tok = X.tokenizer(spark, sf)
    encode = lambda df: E.encode_documents(df, "text", tok, E.EncodeConfig())
    encode_stream(spark, source, "doc_id bigint, dataset string, text string", encode, sink, state, max_files=4).awaitTermination()
    return _doc(spark.read.parquet(sink))


# ---- text and codes --------------------------------------------------------------------------

_INSTRUCTION = "Sing this line."


@query(
    "a30_text_codec",
    _ctes(
        "docw vocab frames songs",
        "txt as (select doc_id, string_agg(coalesce(v.id, 0)::varchar, ' ' order by pos) as ids, count(*) as n from (select doc_id, unnest(w) as token,"
        f" generate_subscripts(w, 1) as pos from (select doc_id, regexp_extract_all(lower('{_INSTRUCTION}' || chr(10) || text), '[^ \\n\\t\\r]+') as w from docw))"
        " left join vocab v using (token) group by doc_id), aud as (select doc_id, string_agg(v::varchar, ' ' order by t) as ids, count(*) as n from frames group by doc_id)",
        "select doc_id, case when s.n = 0 then 'empty_codes' end as reason, '32001 32016 ' || aud.ids || ' 32002 ' || txt.ids || ' 32000' as tokens,"
        " (aud.n + txt.n + 4)::varchar as lengths from songs s join txt using (doc_id) left join aud using (doc_id)",
    ),
)
def a30(spark, sf):
    songs = X.songs(spark, sf)
    text = F.array_join(F.transform("segments", lambda s: s["line_content"]), "\n")
    cfg = E.EncodeConfig(X.ONE, instruction=_INSTRUCTION, to_lower=True, order="audiofirst")
    docs = songs.select("doc_id", text.alias("text"), "vocals_codec_matrix")
    return _doc(E.encode_text_codec(docs, "doc_id", "text", "vocals_codec_matrix", X.tokenizer(spark, sf), cfg), "reason")


@query(
    "a30_text_segments",
    _ctes(
        "songs linew frames vocab",
        "seg as (select l.doc_id, l.i, l.b, l.b + l.n as e, l.line from linew l join songs s using (doc_id) where s.n > 0 and l.n > 0 and l.n / 50.0::double <="
        " s.seconds and l.n >= s.n / s.seconds),"
        " txt as (select doc_id, i, string_agg(coalesce(v.id, 0)::varchar, ' ' order by pos) as ids, count(*) as n from (select doc_id, i, unnest(w) as token,"
        f" generate_subscripts(w, 1) as pos from (select doc_id, i, regexp_extract_all('{_INSTRUCTION}' || chr(10) || line, '[^ \\n\\t\\r]+') as w from seg))"
        " left join vocab v using (token) group by doc_id, i),"
        " aud as (select s.doc_id, s.i, string_agg(f.v::varchar, ' ' order by f.t) as ids, count(*) as n from seg s join frames f on f.doc_id = s.doc_id"
        " and f.t >= s.b and f.t < s.e group by s.doc_id, s.i),"
        " doc as (select doc_id, string_agg(txt.ids || ' 32001 32016 ' || aud.ids || ' 32002', ' ' order by i) || ' 32000' as tokens,"
        " list(txt.n + aud.n + 3 order by i) as ns from txt join aud using (doc_id, i) group by doc_id)",
        "select s.doc_id, case when s.n = 0 then 'bad_length' when doc.doc_id is null then 'no_valid_segments' end as reason,"
        " case when s.n > 0 then coalesce(tokens, '') end as tokens, case when s.n > 0 then coalesce(array_to_string(list_transform(ns, lambda x, i: case when i = len(ns)"
        " then x + 1 else x end), ' '), '') end as lengths from songs s left join doc using (doc_id)",
    ),
)
def a30_segments(spark, sf):
    cfg = E.EncodeConfig(X.ONE, instruction=_INSTRUCTION)
    done = E.encode(X.songs(spark, sf), "doc_id", X.tokenizer(spark, sf), cfg, codec="vocals_codec_matrix")
    return _doc(done, "reason")


def _interleaved_sql(text: str, headed: bool) -> str:
    reason = (
        "case when g.n_inst = 0 then 'missing_file' when g.n - g.n_inst > 10 then 'stem_length'"
        " when not (g.n_inst / g.seconds between 49 and 51) then 'frame_rate'"
        + ("" if headed else " when p.doc_id is null then 'no_valid_segments'")
        + " end"
    )
    part = (
        "'1 ' || t.ids || ' 32001 32016 ' || c.ids || ' 32002 2'" if headed else "t.ids || ' 32001 32016 ' || c.ids || ' 32002'"
    )
    extra = 5 if headed else 3
    head = (
        ", hw as (select doc_id, regexp_extract_all('Sing.' || chr(10) || '[Genre] ' || genres || chr(10) || text, '[^ \\n\\t\\r]+') as w from"
        " (select doc_id, lang || ' ' || source as genres, text from documents)),"
        " hd as (select doc_id, string_agg(coalesce(v.id, 0)::varchar, ' ' order by pos) as ids, count(*) as n from (select doc_id, unnest(w) as token,"
        " generate_subscripts(w, 1) as pos from hw) left join vocab4 v using (token) group by doc_id)"
        if headed
        else ""
    )
    tokens = "hd.ids || coalesce(' ' || p.tokens, '') || ' 32000'" if headed else "coalesce(p.tokens || ' 32000', '')"
    ns = "list_concat([hd.n], coalesce(p.ns, []))" if headed else "coalesce(p.ns, [])"
    return _ctes(
        SEGMENT_VIEWS,
        SEGMENT_CTES.format(text=text)
        + ", parts as (select s.doc_id, s.i, "
        + part
        + f" as part, t.n + c.n + {extra} as n from seg s join segtext t using (doc_id, i) join segcode c using (doc_id, i) where {VALID}),"
        " p as (select doc_id, string_agg(part, ' ' order by i) as tokens, list(n order by i) as ns from parts group by doc_id)"
        + head
        + f", fin as (select g.doc_id, {reason} as reason, {tokens} as tokens, {ns} as ns from songs g left join p using (doc_id)"
        + (" left join hd using (doc_id))" if headed else ")"),
        "select doc_id, reason, case when reason is null or reason = 'no_valid_segments' then tokens end as tokens, case when reason is null or reason ="
        " 'no_valid_segments' then array_to_string(list_transform(ns, lambda x, i: case when i = len(ns) then x + 1 else x end), ' ') end as lengths from fin",
    )


def _songs_from_files(spark, sf):
    return E.attach_codecs(X.manifest(spark, sf), X.codec_files(spark, sf), STEMS)


@query("a31_interleave_plain", _interleaved_sql(f"'{_INSTRUCTION}' || chr(10) || line", False))
def a31_plain(spark, sf):
    cfg = E.EncodeConfig(X.ONE, instruction=_INSTRUCTION, interleave=True)
    return _doc(E.encode(_songs_from_files(spark, sf), "doc_id", X.tokenizer(spark, sf, True), cfg), "reason")


@query("a31_interleave_cot", _interleaved_sql("line", True))
def a31_cot(spark, sf):
    cfg = E.EncodeConfig(X.ONE, instruction="Sing.", interleave=True, cot=True)
    return _doc(E.encode(_songs_from_files(spark, sf), "doc_id", X.tokenizer(spark, sf, True), cfg), "reason")


# Song manifests as nested JSON lines; one in nine breaks off in the middle, one in eight has no genres.
def _manifest_rows(spark, sf):
    return X.manifest(spark, sf).select(
        F.col("doc_id").cast("string").alias("id"), "genres", "audio_length_in_sec", "vocals_codec", "instrumental_codec", F.col("vocals_codec").alias("codec"),
        F.struct(F.col("segments").alias("segmented_lyrics")).alias("splitted_lyrics"), "msa",
    )


def _manifest_lines(spark, sf, width=None):
    n = F.col("doc_id")
    rows = _manifest_rows(spark, sf).withColumn("doc_id", F.col("id").cast("bigint"))
    rows = rows.withColumn("id", F.lpad("id", width, "0") if width else F.col("id")).withColumn("genres", F.when(n % 8 != 2, F.col("genres")))
    line = F.to_json(F.struct(*[c for c in rows.columns if c != "doc_id"]))
    return rows.select("doc_id", F.when(n % 9 == 4, F.substring(line, F.lit(1), F.length(line) - 7)).otherwise(line).alias("value"))


_PLAIN = _interleaved_sql(f"'{_INSTRUCTION}' || chr(10) || line", False)
_PLAIN_CTES, _PLAIN_ROWS = _PLAIN[: _PLAIN.rindex("select doc_id, reason, case")], _PLAIN[_PLAIN.rindex("select doc_id, reason, case") :]
_SONG_ROWS = (
    f", judged as (select doc_id, case when doc_id % 8 = 2 then 'missing_keys' else reason end as reason, tokens, lengths from ({_PLAIN_ROWS}) where doc_id % 9 <> 4)"
    " select 'good' as status, doc_id, null as reason, tokens, lengths from judged where reason is null"
    " union all select 'bad', doc_id, reason, null, null from judged where reason is not null"
    " union all select 'bad', null, 'malformed', null, null from documents where doc_id % 9 = 4"
)


# Lines come in two deliveries with a restart between them; documents and rejects go to folders of their own.
@query("t01_quarantine_stream", _PLAIN_CTES.rstrip() + _SONG_ROWS)
def t01_quarantine(spark, sf):
    source, good, bad, state = (scratch_path(spark, n) for n in ("lines", "good", "bad", "state"))
    lines, tok = _manifest_lines(spark, sf), X.tokenizer(spark, sf, True)
    codecs = materialize(X.codec_files(spark, sf), "codec-table")
    cfg = E.EncodeConfig(X.ONE, instruction=_INSTRUCTION, interleave=True)

    def encode(rows):
        return MF.encode_songs(rows, codecs, tok, cfg, part=True)

    for part in (F.col("doc_id") % 3 != 0, F.col("doc_id") % 3 == 0):
        lines.where(part).select("value").write.mode("append").text(source)
        quarantine_stream(spark, source, SONG_SCHEMA, encode, good, bad, state, max_files=8).awaitTermination()
    fine = read_sink(spark, good).select(F.lit("good").alias("status"), "id", F.lit(None).cast("string").alias("reason"), X.joined("tokens").alias("tokens"), X.joined("lengths").alias("lengths"))
    broken = read_sink(spark, bad).select(F.lit("bad").alias("status"), "id", "reason")
    return fine.unionByName(broken, allowMissingColumns=True).withColumn("doc_id", F.col("id").cast("bigint")).drop("id")


_MANIFEST_SAMPLES = (
    ", docs as (select d.source as dataset, lpad(p.doc_id::varchar, 12, '0') as k, string_split(p.tokens, ' ') as ids from"
    f" ({_PLAIN_ROWS}) p join documents d using (doc_id) where p.reason is null and p.doc_id % 9 <> 4 and p.doc_id % 8 <> 2),"
    " each as (select dataset, k, unnest(ids) as id, generate_subscripts(ids, 1) as pos from docs),"
    " flat as (select dataset, id, row_number() over (partition by dataset order by k, pos) - 1 as place, count(*) over (partition by dataset) as total from each) "
    + PACKED.format(L=128)
)


# From nested JSON lines over codec files to packed samples; documents in the order of their ids.
@query("j01_manifest_samples", _PLAIN_CTES.rstrip() + _MANIFEST_SAMPLES)
def j01_samples(spark, sf):
    lines = _manifest_lines(spark, sf, 12).select("value")
    sources = X.documents(spark, sf).select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("id"), F.col("source").alias("dataset"))
    cfg = E.EncodeConfig(X.ONE, instruction=_INSTRUCTION, interleave=True)
    prepared = MF.prepare_manifest(lines, X.codec_files(spark, sf), X.tokenizer(spark, sf, True), cfg, F.lit(""))
    prepared = prepared._replace(documents=prepared.documents.drop("dataset").join(sources, "id"))
    samples = MF.manifest_samples(prepared, P.PackConfig(128, ties=("seq_no",)))
    return samples.select("dataset", "sample", X.joined("tokens").alias("tokens"))


_COT = _interleaved_sql("line", True)
_COT_CTES, _COT_ROWS = _COT[: _COT.rindex("select doc_id, reason, case")], _COT[_COT.rindex("select doc_id, reason, case") :]


# The same songs through the encoders that a configuration can ask for, from nested or flat manifest rows.
@query(
    "x03_encoder_choice",
    _COT_CTES.rstrip()
    + f", cot as ({_COT_ROWS}) select 'text' as encoder, count(*) as n_docs, sum(case when n_tokens > 0 then n_tokens + 1 else 0 end)::bigint as n_tokens from (select len(words) as n_tokens from docw)"
    " union all select 'ids', count(*), sum(case when n_tokens > 0 then n_tokens + 1 else 0 end)::bigint from (select len(words) as n_tokens from docw)"
    " union all select 'file', count(*) filter (where n > 0), (sum(2 * n + 7) filter (where n > 0))::bigint from songs"
    " union all select 'interleaved', count(tokens), (sum(len(string_split(tokens, ' '))))::bigint from cot",
)
def x03(spark, sf):
    codecs, tok = materialize(X.codec_files(spark, sf), "codec-table"), X.tokenizer(spark, sf, True)
    texts = X.documents(spark, sf).select(F.col("doc_id").cast("string").alias("id"), "text", F.concat(F.lit("npy/"), F.col("doc_id").cast("string"), F.lit(".Vocals.npy")).alias("codec"))
    songs = _manifest_rows(spark, sf)
    ids = X.seqs(spark, sf).select(F.col("doc_id").cast("string").alias("id"), F.col("tokens").alias("ids"))
    jobs = {
        "text": (texts, E.EncodeConfig(unit="text")),
        "ids": (ids, E.EncodeConfig(unit="ids")),
        "file": (texts, E.EncodeConfig(X.ONE, unit="file", instruction=_INSTRUCTION)),
        "interleaved": (songs, E.EncodeConfig(X.ONE, instruction="Sing.", interleave=True, cot=True)),
    }
    out = None
    for name, (rows, cfg) in jobs.items():
        done = materialize(MF.encode_songs(rows, codecs, tok, cfg).select("tokens", "reason"), name).where("reason is null")
        part = done.agg(F.lit(E.encoder_name(cfg)).alias("encoder"), F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("tokens")).cast("bigint").alias("n_tokens"))
        out = part if out is None else out.unionByName(part)
    return out


def _prompt_ctes(seed: int, seconds: float, songs: str, step: int, source: str) -> str:
    """The prompt of each row of ``songs(doc_id, n, fr, rate)`` (words, frames of the lyric range, frames a second), drawn from
    the same hashes; ``source(doc_id, pos, id)`` holds the ids to choose from. Ends with ``pm(doc_id, prompt, c)``."""
    xs, cdf = (f"(cast([{', '.join(repr(x) for x in xs)}] as double[]))" for xs in length_distribution(seconds))

    def u(salt: str) -> str:
        return f"(('0x' || substr(md5('{seed}' || {salt} || ':' || doc_id), 1, 15))::bigint / {1 << 60}.0::double)"

    return (
        f"ps as ({songs}), pu as (select *, {u(repr('length'))} as u from ps),"
        f" pi as (select *, len(list_filter({cdf}, lambda c: c <= u)) as i from pu),"
        f" px as (select *, case when i = 0 then {xs}[1] when i >= 100 then {xs}[100] else {xs}[i] + ({xs}[i + 1] - {xs}[i]) * (u - {cdf}[i]) / ({cdf}[i + 1] - {cdf}[i]) end as x from pi),"
        f" pd as (select *, case when trunc(x * rate)::integer > 0 then trunc(x * rate)::integer * {step} else trunc(rate * {step})::integer end as span from px),"
        f" pl as (select *, case when span >= fr * {step} then (fr * {step}) // 2 else span end as m from pd),"
        f" pc as (select *, greatest(fr * {step} - m, 0) as latest, greatest(0, trunc(n / 200.0::double * rate)::integer) * {step} as low,"
        f" least(fr, trunc(n / 100.0::double * rate)::integer) * {step} - m as high from pl),"
        f" pt as (select doc_id, m, t, case when t = 0 and doc_id % 3 = 0 and high > low then low + floor({u(repr('try0'))} * (high - low + 1))::integer"
        f" else floor({u(chr(39) + 'try' + chr(39) + ' || t')} * (latest + 1))::integer end as s from pc, (select unnest(range(6)) as t)),"
        f" pa as (select pt.doc_id, t, count(q.id) as c, count(distinct q.id) as k, coalesce(string_agg(q.id::varchar, ' ' order by q.pos), '') as prompt from pt"
        f" left join {source} q on q.doc_id = pt.doc_id and q.pos >= pt.s and q.pos < pt.s + pt.m group by pt.doc_id, t),"
        " pm as (select doc_id, prompt, c from (select *, row_number() over (partition by doc_id order by case when k >= c * 0.1::double then t else 99 end,"
        " t desc) as best from pa) where best = 1)"
    )


_ICL = (
    _COT.replace(f"where {VALID})", "where s.b >= 0 and s.b < s.e and s.e <= s.T and s.duration >= 1.0)")
    .replace(
        ", fin as (",
        ", duo as (select f.doc_id, 2 * f.t + x.o as pos, case x.o when 0 then f.v else f.u end as id from frames f join good_songs g using (doc_id), (select unnest([0, 1]) as o) x where f.t < g.T), "
        + _prompt_ctes(42, 5.0, "select doc_id, n, n as fr, fps as rate from good_songs", 2, "duo")
        + ", fin as (",
    )
    .replace("hd.ids || coalesce(' ' || p.tokens", "hd.ids || ' 3 32001 32016' || coalesce(' ' || nullif(pm.prompt, ''), '') || ' 32002 4' || coalesce(' ' || p.tokens")
    .replace("list_concat([hd.n],", "list_concat([hd.n + 5 + pm.c],")
    .replace("left join hd using (doc_id))", "left join hd using (doc_id) left join pm using (doc_id))")
)


@query("a31_interleave_icl", _ICL)
def a31_icl(spark, sf):
    cfg = E.EncodeConfig(X.ONE, instruction="Sing.", use_audio_icl=True, cot=True, audio_prompt_seconds=5.0)
    return _doc(E.encode(_songs_from_files(spark, sf), "doc_id", X.tokenizer(spark, sf, True), cfg), "reason")


@query(
    "a23_sample_prompt",
    _ctes(
        "songs frames",
        "voc as (select doc_id, t as pos, v as id from frames), " + _prompt_ctes(1234, 5.0, "select doc_id, n, n as fr, 50.0::double as rate from songs where n_inst > 0", 1, "voc"),
        "select doc_id, prompt from pm",
    ),
)
def a23(spark, sf):
    s = X.songs(spark, sf).where(F.size(F.get("instrumental_codec_matrix", F.lit(0))) > 0)
    prompt = sample_prompt(
        F.col("doc_id"), F.col("segments"), F.col("vocals_codec_matrix"), F.col("instrumental_codec_matrix"), None,
        F.col("msa"), F.lit(50.0), X.ONE, "vocal", 5.0,
    )
    return s.select("doc_id", X.joined(prompt).alias("prompt"))


_ST2 = (
    "win as (select vec_id, t // 8 as w, count(distinct code) filter (where k = 0) as distinct0, string_agg((code + 45334)::varchar, ' ' order by t)"
    " filter (where k = 0) as first, string_agg((code + 45334 + k * 1024)::varchar, ' ' order by t, k) filter (where k > 0) as rest from cells"
    " group by vec_id, t // 8), kept as (select * from win where distinct0 >= 8)"
)


@query(
    "a32_encode_stage2",
    _ctes(
        "cells",
        _ST2,
        "select e.vec_id, coalesce(string_agg('32001 32013 ' || first || ' 32017 ' || rest || ' 32002', ' ' order by w) || ' 32000', '') as tokens,"
        " coalesce(case count(w) when 2 then '36 37' when 1 then '37' end, '') as lengths from embeddings e left join kept using (vec_id) group by e.vec_id",
    ),
)
def a32(spark, sf):
    cfg = E.EncodeConfig(X.FIRST_LAYERS, stage2=True, window_frames=8, min_distinct=8)
    done = E.encode(X.codes(spark, sf), "vec_id", X.tokenizer(spark, sf), cfg, codec="codec")
    return done.select("vec_id", X.joined("tokens").alias("tokens"), X.joined("lengths").alias("lengths"))


# ---- blended training data -------------------------------------------------------------------


def _training(spark, sf, splits=SP.SPLITS):
    seqs = X.seqs(spark, sf)
    closed = seqs.select(
        "dataset", "doc_id", F.concat("tokens", F.array(F.lit(EOD))).alias("tokens"), (F.col("n_tokens") + 1).alias("n_tokens")
    )
    cfg = P.PackConfig(64)
    blend = B.collect_blend(P.tokens_per_epoch(X.lengths(spark, sf), cfg), weight="tokens_per_epoch")
    whole = sum(blend.weights)
    targets = {"train": whole // 64, "valid": whole // 1280, "test": whole // 6400}
    targets = {s: t for s, t in targets.items() if s in splits}
    return TR.build_splits(spark, closed, blend, SP.split_bounds("80,10,10"), targets, cfg)


_A13 = (
    "w as (select dataset, (row_number() over (order by dataset) - 1)::integer as d, sum(n_tokens)::bigint as weight from lens group by dataset),"
    " whole as (select sum(weight)::bigint as whole from w), tg as (select 'train' as split, whole // 64 as target from whole union all"
    " select 'valid', whole // 1280 from whole union all select 'test', whole // 6400 from whole),"
    " req as (select split, d, weight, ceil(target * (weight::double / whole::double) * 1.005::double)::bigint as requested from w, whole, tg),"
    " sz as (select split, sum(requested)::bigint as size from req group by split),"
    " dr as (select split, d, weight, size, unnest(range(0, size * weight // whole + 2)) as k from w, whole, sz),"
    " rk as (select *, row_number() over (partition by split order by (2 * k + 1)::double / weight, d) - 1 as n from dr)"
)


@query(
    "a13_blended_sizes",
    _ctes(
        "lens",
        _A13,
        "select split, d::smallint as dataset_id, count(*) as n_samples, max(k) as last_sample, 65 * count(*) as n_tokens from rk where n < size group by split, d",
    ),
)
def a13(spark, sf):
    parts = None
    for name, df in _training(spark, sf).items():
        part = df.withColumn("split", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("split", "dataset_id").agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.max("dataset_sample_idx").alias("last_sample"),
        F.sum(F.size("tokens")).cast("bigint").alias("n_tokens"),
    )


# The first dataset is listed again with real weights: two datasets with draws of their own over one store.
_REPEATED = (
    "w as (select dataset, (row_number() over (order by dataset) - 1)::integer as d, count(*) over () as n from lens group by dataset),"
    " listed as (select dataset, d, 1.0::double + d / 4.0::double as weight from w union all select dataset, n::integer, 0.5::double from w where d = 0),"
    " sh as (select *, weight / (sum(weight) over ()) as share from listed),"
    " req as (select *, ceil(300.0::double * share * 1.005::double)::bigint as requested from sh), sz as (select sum(requested)::bigint as size from req),"
    " dr as (select d, weight, size, unnest(range(0, ceil(size * share)::bigint + 2)) as k from req, sz),"
    " rk as (select *, row_number() over (order by (2 * k + 1)::double / weight, d) - 1 as n from dr)"
)


@query(
    "a13_repeated_prefix",
    _ctes(
        "lens",
        _REPEATED,
        "select d::smallint as dataset_id, count(*) as n_samples, max(k) as last_sample, 65 * count(*) as n_tokens from rk where n < size group by d",
    ),
)
def a13_repeated(spark, sf):
    seqs, cfg = X.seqs(spark, sf), P.PackConfig(64)
    names = B.collect_blend(P.tokens_per_epoch(X.lengths(spark, sf), cfg), weight="tokens_per_epoch").names
    listed = [x for i, n in enumerate(names) for x in (repr(1 + i / 4), n)] + ["0.5", names[0]]
    samples = TR.build_split(spark, seqs.select("dataset", "doc_id", "n_tokens"), seqs, B.parse_blend(listed), 300, cfg)
    return samples.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("n_samples"), F.max("dataset_sample_idx").alias("last_sample"), F.sum(F.size("tokens")).cast("bigint").alias("n_tokens")
    )


# The whole training table: samples of the train range, over as many epochs as are drawn, in their permuted order.
_TRAIN = (
    ", dr2 as (select d, count(*) as draws from rk where split = 'train' and n < size group by d),"
    " docs as (select dataset, doc_id, n_tokens, row_number() over (partition by dataset order by doc_id) - 1 as r, count(*) over (partition by dataset) as n from lens),"
    " kept as (select dataset, doc_id, n_tokens from docs where r < round_even(0.8::double * n, 0)),"
    " tok2 as (select k.dataset, k.doc_id, t.pos, t.id from kept k join toks t using (doc_id) union all select dataset, doc_id, n_tokens, 32000 from kept),"
    " fl as (select dataset, id, row_number() over (partition by dataset order by doc_id, pos) - 1 as place from tok2),"
    " ep as (select w.d, w.dataset, t.tpe, greatest(q.requested, coalesce(dr2.draws, 0)) as requested from w join (select dataset, sum(n_tokens + 1)::bigint as tpe from kept group by dataset) t"
    " using (dataset) join (select d, requested from req where split = 'train') q using (d) left join dr2 using (d)),"
    " pl as (select *, greatest((requested * 64 + 1 + tpe - 1) // tpe, 1) as epochs from ep),"
    " pn as (select *, (epochs * tpe - 1) // 64 as n_samples, case when epochs > 1 then ((epochs - 1) * tpe - 1) // 64 else 0 end as early from pl),"
    " pf as (select *, case when epochs > 1 and requested - early < trunc(0.8::double * ((tpe - 1) // 64)) then early else n_samples end as first_range from pn),"
    " sm as (select d, dataset, tpe, first_range, unnest(range(0, n_samples)) as sample from pf),"
    " sk as (select d, dataset, tpe, sample, row_number() over (partition by d, sample >= first_range order by {h}, sample) - 1"
    " + case when sample >= first_range then first_range else 0 end as k from sm),"
    " ch as (select rk.n as sample_idx, rk.d, rk.k, sk.dataset, sk.tpe, sk.sample from rk join sk on sk.d = rk.d and sk.k = rk.k where rk.split = 'train' and rk.n < rk.size),"
    " tk as (select ch.sample_idx, ch.d, ch.k, j, f.id from ch, (select unnest(range(65)) as j) x join fl f on f.dataset = ch.dataset and f.place = (ch.sample * 64 + x.j) % ch.tpe),"
    " ps as (select *, count(*) filter (where id = 32000) over before as seg, j - coalesce(max(case when id = 32000 then j + 1 end) over before, 0) as p from tk"
    " window before as (partition by sample_idx order by j rows between unbounded preceding and 1 preceding))"
).replace("{h}", "('0x' || substr(md5('1234sample:' || sample), 1, 15))::bigint")


@query(
    "a13_training_samples",
    _ctes(
        "lens toks",
        _A13 + _TRAIN,
        "select sample_idx, d::smallint as dataset_id, k as dataset_sample_idx, string_agg(id::varchar, ' ' order by j) filter (where j < 64) as input_ids,"
        " string_agg(id::varchar, ' ' order by j) filter (where j > 0) as labels, string_agg(p::varchar, ' ' order by j) filter (where j < 64) as position_ids,"
        " string_agg(seg::varchar, ' ' order by j) filter (where j < 64) as segment_ids from ps group by sample_idx, d, k",
    ),
)
def a13_samples(spark, sf):
    cfg = P.PackConfig(64, reset_position_ids=True, reset_attention_mask=True, eod_mask_loss=True)
    train = P.training_fields(_training(spark, sf, ("train",))["train"], cfg)
    return train.select(
        "sample_idx",
        "dataset_id",
        "dataset_sample_idx",
        *[X.joined(c).alias(c) for c in ("input_ids", "labels", "position_ids", "segment_ids")],
    )
