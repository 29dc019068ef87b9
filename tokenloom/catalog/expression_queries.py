"""Row-local operators: codec arithmetic, token lists, text, training fields."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import codecs as C
from ..functions import sequences as S
from ..functions import text as T
from ..operators import mixture as MX
from ..operators import pack as P
from ..operators import validate as V
from ..operators.prompts import length_distribution, reference_block, sample_length
from ..operators.tokenizer import BatchTokenizer, build_vocab, detokenize, tokenize, tokenize_by_join
from . import fixtures as X
from .registry import query
from .source_queries import PACKED

_J, _M = X.joined, X.joined_matrix

# Documents with special tokens glued between sentences.

def _marked(spark, sf):
    return X.documents(spark, sf).select("doc_id", F.replace(F.col("text"), F.lit(". "), F.lit(".<EOD>")).alias("text"))


_MARKED_TOKS = (
    "w as (select doc_id, regexp_extract_all(replace(replace(text, '. ', '.<EOD>'), '<EOD>', ' <EOD> '), '[^ \\n\\t\\r]+') as w"
    " from documents), t as (select doc_id, pos, token, coalesce(s.id, v.id, 0) as id from (select doc_id, unnest(w) as token,"
    " generate_subscripts(w, 1) - 1 as pos from w) left join vocab v using (token) left join specials s using (token))"
)


def _and_ctes(views: str, more: str, body: str) -> str:
    return X.with_views(views, "select 1").removesuffix("select 1").rstrip() + f", {more} {body}"


@query(
    "f01_tokenize",
    _and_ctes("vocab specials", _MARKED_TOKS, "select doc_id, string_agg(id::varchar, ' ' order by pos) as tokens from t group by doc_id"),
)
def f01(spark, sf):
    return tokenize(_marked(spark, sf), "text", X.tokenizer(spark, sf)).select("doc_id", _J("tokens").alias("tokens"))


# The way for vocabularies that are too large to ship: distinct words are joined.
@query(
    "f01_tokenize_by_join",
    _and_ctes("vocab specials", _MARKED_TOKS, "select doc_id, string_agg(id::varchar, ' ' order by pos) as tokens from t group by doc_id"),
)
def f01_join(spark, sf):
    vocab = build_vocab(X.documents(spark, sf), "text")
    return tokenize_by_join(_marked(spark, sf), "doc_id", "text", vocab, slices=64).select("doc_id", _J("tokens").alias("tokens"))


# A plugged-in model, loaded once per worker: here the lengths of the words behind three reserved ids.
@query(
    "x01_plugged_model",
    X.with_views("docw", "select doc_id, " + X.sql_list("list_transform(words, lambda w: length(w) + 3)") + " as tokens from docw"),
)
def x01(spark, sf):
    def load():
        word = re.compile("[^ \n\t\r]+")
        return lambda texts: [[len(w) + 3 for w in word.findall(t)] for t in texts]

    tok = BatchTokenizer(load, 1 << 20)
    return tokenize(X.documents(spark, sf).select("doc_id", "text"), "text", tok).select("doc_id", _J("tokens").alias("tokens"))


_OPTIONS = (("xcodec", 0, 1, 45334), ("xcodec", 1, 3, 45334), ("dac16k", 0, 4, 32022), ("dac16k", 2, 1, 32022))


# Codecs by name, with some of their codebooks.
@query(
    "x02_codec_options",
    X.with_views(
        "cells",
        " union all ".join(
            f"select vec_id, '{name}/{begin}/{n}' as option, string_agg((code + {base} + k * 1024)::varchar, ' ' order by t, k) as ids"
            f" from cells where k between {begin} and {begin + n - 1} group by vec_id"
            for name, begin, n, base in _OPTIONS
        ),
    ),
)
def x02(spark, sf):
    chosen = [
        F.struct(F.lit(f"{name}/{begin}/{n}").alias("option"), _J(C.codes_to_ids(F.col("codec"), C.CodecOptions(name, begin, n))).alias("ids"))
        for name, begin, n, _ in _OPTIONS
    ]
    return X.codes(spark, sf).select("vec_id", F.inline(F.array(*chosen)))


@query(
    "f01b_detokenize",
    _and_ctes(
        "vocab specials",
        _MARKED_TOKS,
        "select doc_id, string_agg(case when id >= 32000 then ' ' || token || ' ' else (case when pos > 0 and before < 32000 then ' '"
        " else '' end) || (case when id = 0 then '<unk>' else token end) end, '' order by pos) as text from"
        " (select *, lag(id) over (partition by doc_id order by pos) as before from t) group by doc_id",
    ),
)
def f01b(spark, sf):
    tok = X.tokenizer(spark, sf)
    ids = tokenize(_marked(spark, sf), "text", tok).select("doc_id", "tokens")
    return detokenize(ids, "tokens", tok).select("doc_id", "text")


@query("g12_vocabulary", X.with_views("vocab", "select token, id from vocab"))
def g12(spark, sf):
    return build_vocab(X.documents(spark, sf), "text")


_J9 = (
    "select id, count(*) as n, coalesce(max(token) filter (where id > 0), '<unk>') as token from (select d.word as token,"
    " coalesce(v.id, 0) as id from (select unnest(words) as word from docw) d left join vocab v on v.token = d.word) group by id"
)


@query("j09_vocabulary_lookup", X.with_views("docw vocab", _J9))
def j09(spark, sf):
    tok = X.tokenizer(spark, sf)
    ids = X.seqs(spark, sf).select(F.explode("tokens").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return ids.select("id", "n", F.get(tok.pieces(F.array("id")), F.lit(0)).alias("token"))


@query(
    "f02_offset_codes",
    X.with_views(
        "codes",
        f"select vec_id, {X.sql_matrix('list_transform(codec, lambda r, i: list_transform(r, lambda x: x + 45334 + (i - 1) * 1024))')} as all_layers,"
        f" {X.sql_matrix('list_transform(codec[2:3], lambda r, i: list_transform(r, lambda x: x + 45334 + i * 1024))')} as middle,"
        f" {X.sql_matrix('list_transform(codec[1:2], lambda r, i: list_transform(r, lambda x: x + 59158 + (i - 1) * 16384))')} as uneven"
        " from codes",
    ),
)
def f02(spark, sf):
    c = F.col("codec")
    return X.codes(spark, sf).select(
        "vec_id",
        _M(C.offset_codes(c, X.FIRST_LAYERS)).alias("all_layers"),
        _M(C.offset_codes(c, C.CodecOptions("xcodec", 1, 2))).alias("middle"),
        _M(C.offset_codes(c, C.CodecOptions("semanticodec"))).alias("uneven"),
    )


@query("f02b_unoffset_codes", X.with_views("codes", f"select vec_id, {X.sql_matrix('codec')} as codec from codes"))
def f02b(spark, sf):
    ids = C.offset_codes(F.col("codec"), X.FIRST_LAYERS)
    return X.codes(spark, sf).select("vec_id", _M(C.unoffset_codes(ids, X.FIRST_LAYERS)).alias("codec"))


@query(
    "f03_flatten",
    X.with_views("cells", "select vec_id, string_agg(code::varchar, ' ' order by t, k) as flat from cells group by vec_id"),
)
def f03(spark, sf):
    return X.codes(spark, sf).select("vec_id", _J(C.flatten_frames(F.col("codec"))).alias("flat"))


@query(
    "f03b_unflatten",
    X.with_views(
        "codes",
        f"select vec_id, {X.sql_matrix('list_transform(range(1, 9), lambda k: list_transform(range(0, 8), lambda t: e[t * 8 + k]))')} as codec"
        " from (select vec_id, flatten(codec) as e from codes)",
    ),
)
def f03b(spark, sf):
    flat = F.flatten("codec")
    return X.codes(spark, sf).select("vec_id", _M(C.unflatten_frames(flat, 8)).alias("codec"))


@query("f04b_ids_to_codes", X.with_views("codes", f"select vec_id, {X.sql_matrix('codec')} as codec from codes"))
def f04b(spark, sf):
    ids = C.codes_to_ids(F.col("codec"), X.FIRST_LAYERS)
    return X.codes(spark, sf).select("vec_id", _M(C.ids_to_codes(ids, X.FIRST_LAYERS)).alias("codec"))


def _stems(spark, sf):
    """Songs whose stems can be reconciled, with both stems as ids."""
    trimmed, far = V.reconcile_stems(X.songs(spark, sf), "vocals_codec_matrix", "instrumental_codec_matrix")
    return trimmed.where(~far & (F.col("__frames") > 0)).select(
        "doc_id",
        "segments",
        "audio_length_in_sec",
        C.codes_to_ids(F.col("vocals_codec_matrix"), X.ONE).alias("v"),
        C.codes_to_ids(F.col("instrumental_codec_matrix"), X.ONE).alias("u"),
    )


_NEAR = "near as (select * from songs where n - n_inst <= 10 and n_inst > 0)"
_MIXED = (
    _NEAR + ", mixed as (select f.doc_id, f.t * 2 + s.side as p, case when s.side = 0 then f.v else f.u end as id, n.n_inst * 2 as size"
    " from frames f join near n on n.doc_id = f.doc_id and f.t < n.n_inst, (values (0), (1)) as s(side))"
)


@query(
    "f05_interleave",
    _and_ctes("songs frames", _MIXED, "select doc_id, string_agg(id::varchar, ' ' order by p) as ids from mixed group by doc_id"),
)
def f05(spark, sf):
    return _stems(spark, sf).select("doc_id", _J(S.interleave(F.col("v"), F.col("u"))).alias("ids"))


@query(
    "f05b_deinterleave",
    X.with_views(
        "toks",
        "select doc_id, coalesce(string_agg(id::varchar, ' ' order by pos) filter (where pos % 2 = 0 and pos < n // 2 * 2), '') as first,"
        " coalesce(string_agg(id::varchar, ' ' order by pos) filter (where pos % 2 = 1), '') as second from"
        " (select *, count(*) over (partition by doc_id) as n from toks) group by doc_id",
    ),
)
def f05b(spark, sf):
    return X.seqs(spark, sf).select(
        "doc_id",
        _J(S.deinterleave(F.col("tokens"), 0)).alias("first"),
        _J(S.deinterleave(F.col("tokens"), 1)).alias("second"),
    )


@query("f06_instruction", "select doc_id, 'Continue the text.' || chr(10) || text as text from documents")
def f06(spark, sf):
    return X.documents(spark, sf).select("doc_id", T.with_instruction(F.col("text"), "Continue the text.").alias("text"))


_H = "('0x' || substr(md5({0}), 1, 15))::bigint"


@query(
    "f07_instruction_dropout",
    "select doc_id, case when "
    + _H.format("'42instruction:' || doc_id")
    + " / 1152921504606846976.0::double < 0.3 then text else 'Continue the text.' || chr(10) || text end as text, text as never_kept,"
    " 'Continue the text.' || chr(10) || text as always_kept from documents",
)
def f07(spark, sf):
    def dropped(rate):
        return T.instruction_dropout(F.col("text"), "Continue the text.", rate, 42, F.col("doc_id"))

    return X.documents(spark, sf).select(
        "doc_id", dropped(0.3).alias("text"), dropped(1.0).alias("never_kept"), dropped(0.0).alias("always_kept")
    )


@query("f08_lowercase", "select doc_id, lower(text) as text from documents")
def f08(spark, sf):
    return X.documents(spark, sf).select("doc_id", F.lower("text").alias("text"))


_XIDS = "string_agg((code + 45334 + k * 1024)::varchar, ' ' order by t, k)"


@query(
    "f09_wrap_audio",
    X.with_views("cells", f"select vec_id, '32001 32016 ' || {_XIDS} || ' 32002' as ids from cells group by vec_id"),
)
def f09(spark, sf):
    ids = S.wrap_audio(C.codes_to_ids(F.col("codec"), X.FIRST_LAYERS), X.FIRST_LAYERS)
    return X.codes(spark, sf).select("vec_id", _J(ids).alias("ids"))


@query(
    "f10_order",
    X.with_views(
        "cells",
        f"select vec_id, (vec_id % 100) || ' 7 ' || {_XIDS} as text_first, {_XIDS} || ' ' || (vec_id % 100) || ' 7' as audio_first"
        " from cells group by vec_id",
    ),
)
def f10(spark, sf):
    audio = C.codes_to_ids(F.col("codec"), X.FIRST_LAYERS)
    text = F.array((F.col("vec_id") % 100).cast("int"), F.lit(7))
    return X.codes(spark, sf).select(
        "vec_id",
        _J(S.order_text_audio(text, audio, "textfirst")).alias("text_first"),
        _J(S.order_text_audio(text, audio, "audiofirst")).alias("audio_first"),
    )


_DOC_IDS = "(select doc_id, string_agg(id::varchar, ' ' order by pos) as ids, count(*) as n from toks group by doc_id)"


@query(
    "f11_append_eod",
    X.with_views(
        "lens toks",
        "select l.doc_id, case when l.n_tokens = 0 then '' else d.ids || ' 32000' end as tokens,"
        f" (case when l.n_tokens = 0 then 0 else l.n_tokens + 1 end)::integer as n_tokens from lens l left join {_DOC_IDS} d using (doc_id)",
    ),
)
def f11(spark, sf):
    closed = X.seqs(spark, sf).select("doc_id", S.append_eod(F.col("tokens")).alias("t"))
    return closed.select("doc_id", _J("t").alias("tokens"), F.size("t").alias("n_tokens"))


# Segments of songs with their words as ids and their interleaved codes (one codebook).
SEGMENT_VIEWS = "good_songs linew frames vocab4"
SEGMENT_CTES = (
    "seg as (select l.doc_id, l.i, l.b, l.b + l.n as e, l.n / 50.0::double as duration, l.line, g.fps, g.T, g.seconds, g.genres, g.dataset"
    " from linew l join good_songs g using (doc_id)),"
    " segtext as (select doc_id, i, string_agg(coalesce(v.id, 0)::varchar, ' ' order by pos) as ids, count(*) as n from"
    " (select doc_id, i, unnest(w) as token, generate_subscripts(w, 1) as pos from (select doc_id, i, regexp_extract_all({text},"
    " '[^ \\n\\t\\r]+') as w from seg)) left join vocab4 v using (token) group by doc_id, i),"
    " segcode as (select s.doc_id, s.i, string_agg(f.v || ' ' || f.u, ' ' order by f.t) as ids, 2 * count(*) as n from seg s"
    " join frames f on f.doc_id = s.doc_id and f.t >= s.b and f.t < s.e where s.e <= s.T group by s.doc_id, s.i)"
)
VALID = "s.b >= 0 and s.b < s.e and s.e <= s.T and s.e - s.b >= s.fps"


@query(
    "f13_segment_block",
    _and_ctes(
        SEGMENT_VIEWS,
        SEGMENT_CTES.format(text="line"),
        "select s.doc_id, s.i::integer as seq_no, '1 ' || t.ids || ' 32001 32016 ' || c.ids || ' 32002 2' as headed,"
        " t.ids || ' 32001 32016 ' || c.ids || ' 32002' as plain from seg s join segtext t using (doc_id, i) join segcode c using (doc_id, i)"
        f" where {VALID}",
    ),
)
def f13(spark, sf):
    tok = X.tokenizer(spark, sf, markers=True)
    stems, far = V.reconcile_stems(X.songs(spark, sf), "vocals_codec_matrix", "instrumental_codec_matrix")
    fps = V.song_fps(F.col("__frames"), F.col("audio_length_in_sec"))
    good = stems.where(~far & (F.col("__frames") > 0) & V.fps_is_valid(fps)).withColumn("fps", fps)
    segs = good.select("*", F.posexplode("segments").alias("seq_no", "s")).where(
        V.segment_is_valid(F.col("s"), F.col("fps"), F.col("__frames"))
    )

    def ids(m):
        cut = C.slice_frames(F.col(m), F.col("s.codec_frame_start"), F.col("s.codec_frame_end"))
        return C.codes_to_ids(cut, X.ONE)

    audio = S.wrap_audio(S.interleave(ids("vocals_codec_matrix"), ids("instrumental_codec_matrix")), X.ONE)
    segs = segs.withColumn("t", tok.text_ids(F.col("s.line_content"))).withColumn("a", audio)
    start, end = C.int_array([1]), C.int_array([2])
    return segs.select(
        "doc_id", "seq_no", _J(F.concat(start, "t", "a", end)).alias("headed"), _J(F.concat("t", "a")).alias("plain")
    )


@query(
    "f14_header",
    "select doc_id, 'Sing.' || chr(10) || '[Genre] ' || lang || ' ' || source || chr(10) || text as header from documents",
)
def f14(spark, sf):
    lines = F.transform("segments", lambda s: s["line_content"])
    return X.songs(spark, sf).select("doc_id", T.header_text("Sing.", F.col("genres"), lines).alias("header"))


@query(
    "f15_reference_block",
    _and_ctes(
        "songs frames",
        _MIXED,
        "select doc_id, '3 32001 32016 ' || string_agg(id::varchar, ' ' order by p) || ' 32002 4' as ids from mixed group by doc_id",
    ),
)
def f15(spark, sf):
    prompt = S.interleave(F.col("v"), F.col("u"))
    block = reference_block(prompt, C.int_array([3]), C.int_array([4]), X.ONE)
    return _stems(spark, sf).select("doc_id", _J(block).alias("ids"))


@query(
    "f15b_slice_by_time",
    _and_ctes(
        "songs frames",
        _MIXED,
        "select doc_id, coalesce(string_agg(id::varchar, ' ' order by p) filter (where p >= 40 and p < 100), '') as dual,"
        " coalesce(string_agg(id::varchar, ' ' order by p) filter (where p % 2 = 0 and p // 2 >= 20 and p // 2 < 50), '') as single"
        " from mixed group by doc_id",
    ),
)
def f15b(spark, sf):
    start, end = F.lit(0.4), F.lit(1.0)
    return _stems(spark, sf).select(
        "doc_id",
        _J(S.slice_by_time(S.interleave(F.col("v"), F.col("u")), start, end, 2)).alias("dual"),
        _J(S.slice_by_time(F.col("v"), start, end)).alias("single"),
    )


_CB0 = "string_agg((code + 45334)::varchar, ' ' order by t) filter (where k = 0)"
_REST = "string_agg((code + 45334 + k * 1024)::varchar, ' ' order by t, k) filter (where k > 0)"


@query(
    "f16_stage2_record",
    X.with_views(
        "cells",
        f"select vec_id, '32001 32013 ' || {_CB0} || ' 32017 ' || {_REST} || ' 32002' as free,"
        f" '32001 32013 ' || {_CB0} || ' 32017 ' || {_XIDS} || ' 32002' as forced from cells group by vec_id",
    ),
)
def f16(spark, sf):
    forced = C.CodecOptions("xcodec", 0, 4, teacher_forcing=True)
    return X.codes(spark, sf).select(
        "vec_id",
        _J(S.stage2_record(F.col("codec"), X.FIRST_LAYERS)).alias("free"),
        _J(S.stage2_record(F.col("codec"), forced)).alias("forced"),
    )


def _packed_eod(spark, sf):
    """Samples of 64 tokens over documents closed by EOD."""
    cfg = P.PackConfig(64, reset_position_ids=True, reset_attention_mask=True, eod_mask_loss=True)
    closed = X.seqs(spark, sf).select(
        "dataset", "doc_id", S.append_eod(F.col("tokens")).alias("tokens"), (F.col("n_tokens") + (F.col("n_tokens") > 0).cast("int")).alias("n_tokens")
    )
    return P.pack_samples(closed, cfg), cfg


# Packed samples of EOD-closed documents, one row per token with its place j in the sample.
_EOD_FLAT = (
    "eodtok as (select doc_id, dataset, pos, id from toks union all select doc_id, dataset, n_tokens, 32000 from lens where n_tokens > 0),"
    " eodflat as (select dataset, id, row_number() over (partition by dataset order by doc_id, pos) - 1 as place,"
    " count(*) over (partition by dataset) as total from eodtok),"
    " cell as (select dataset, s.sample, place - s.sample * 64 as j, id from eodflat, unnest(case when place % 64 = 0 and place > 0 then"
    " [place // 64, place // 64 - 1] else [place // 64] end) as s(sample) where s.sample < (total - 1) // 64),"
    " inp as (select *, coalesce(sum((id = 32000)::integer) over (partition by dataset, sample order by j rows between unbounded"
    " preceding and 1 preceding), 0) as seg from cell where j < 64),"
    " pos as (select *, j - min(j) over (partition by dataset, sample, seg) as reset from inp)"
)


@query(
    "f17_shift_labels",
    _and_ctes(
        "toks lens",
        _EOD_FLAT,
        "select dataset, sample, string_agg(id::varchar, ' ' order by j) filter (where j < 64) as input_ids,"
        " string_agg(id::varchar, ' ' order by j) filter (where j > 0) as labels from cell group by dataset, sample",
    ),
)
def f17(spark, sf):
    samples, cfg = _packed_eod(spark, sf)
    return samples.select(
        "dataset",
        "sample",
        _J(S.model_inputs(F.col("tokens"))).alias("input_ids"),
        _J(S.model_labels(F.col("tokens"))).alias("labels"),
    )


@query(
    "f18_loss_mask",
    _and_ctes(
        "toks lens",
        _EOD_FLAT,
        "select dataset, sample, string_agg(case when id = 32000 then '0' else '1' end, ' ' order by j) as loss_mask from inp"
        " group by dataset, sample",
    ),
)
def f18(spark, sf):
    samples, cfg = _packed_eod(spark, sf)
    mask = S.loss_mask(S.model_inputs(F.col("tokens")), cfg.eod, True)
    return samples.select("dataset", "sample", _J(mask.cast("array<int>")).alias("loss_mask"))


@query(
    "f19_position_ids",
    _and_ctes(
        "toks lens",
        _EOD_FLAT,
        "select dataset, sample, string_agg(j::varchar, ' ' order by j) as plain, string_agg(reset::varchar, ' ' order by j) as reset"
        " from pos group by dataset, sample",
    ),
)
def f19(spark, sf):
    samples, cfg = _packed_eod(spark, sf)
    inputs = samples.select("dataset", "sample", S.model_inputs(F.col("tokens")).alias("x"))
    return inputs.select(
        "dataset",
        "sample",
        _J(S.position_ids(F.col("x"))).alias("plain"),
        _J(S.position_ids(F.col("x"), True, cfg.eod)).alias("reset"),
    )


@query(
    "f20_segment_ids",
    _and_ctes(
        "toks lens",
        _EOD_FLAT,
        "select dataset, sample, string_agg(seg::varchar, ' ' order by j) as segment_ids from inp group by dataset, sample",
    ),
)
def f20(spark, sf):
    samples, cfg = _packed_eod(spark, sf)
    fields = P.training_fields(samples, cfg)
    return fields.select("dataset", "sample", _J("segment_ids").alias("segment_ids"))


@query(
    "w04_eod_count",
    _and_ctes(
        "toks lens",
        _EOD_FLAT,
        "select dataset, sample, (max(seg) + max((id = 32000 and j = 63)::integer))::integer as n_eod from inp group by dataset, sample",
    ),
)
def w04(spark, sf):
    samples, cfg = _packed_eod(spark, sf)
    return samples.select("dataset", "sample", S.count_token(S.model_inputs(F.col("tokens")), cfg.eod).alias("n_eod"))


@query(
    "f22_to_frames",
    X.with_views(
        "linew songs",
        "select doc_id, l.i::integer as seq_no, trunc((l.n / 50.0::double) * (s.n / s.seconds))::integer as frames,"
        " trunc((l.b / 50.0::double) * 50)::integer as start_frame from linew l join songs s using (doc_id) where s.n > 0",
    ),
)
def f22(spark, sf):
    s = X.songs(spark, sf).where(F.col("audio_length_in_sec") > 0)
    fps = V.song_fps(C.n_frames(F.col("vocals_codec_matrix")), F.col("audio_length_in_sec"))
    return s.select("doc_id", fps.alias("fps"), F.posexplode("segments").alias("seq_no", "s")).select(
        "doc_id",
        "seq_no",
        S.seconds_to_frames(F.col("s.duration"), F.col("fps")).alias("frames"),
        S.seconds_to_frames(F.col("s.codec_frame_start") / F.lit(50.0)).alias("start_frame"),
    )


_KIND = (
    "case when contains(lower(file), 'vocal') then 'Vocals' when contains(lower(file), 'inst') then 'Instrumental' else 'Full' end"
)


@query(
    "f23_classify_track",
    X.with_views("names", f"select file_no, regexp_extract(file, '/([^.]*)', 1) as key, {_KIND} as kind from names"),
)
def f23(spark, sf):
    return X.names(spark, sf).select(
        "file_no", T.track_key(F.col("file")).alias("key"), T.track_type(F.col("file")).alias("kind")
    )


@query(
    "f24_track_name",
    X.with_views(
        "names",
        "select file_no, case when kind = 'Full' then key else key || '.' || kind end as name,"
        " (case when kind = 'Full' then key else key || '.' || kind end) || '.seg' || (file_no % 3 + 1) as segment_name from"
        f" (select file_no, regexp_extract(file, '/([^.]*)', 1) as key, {_KIND} as kind from names)",
    ),
)
def f24(spark, sf):
    key, kind = T.track_key(F.col("file")), T.track_type(F.col("file"))
    return X.names(spark, sf).select(
        "file_no",
        T.track_name(key, kind).alias("name"),
        T.track_name(key, kind, F.col("file_no") % 3 + 1).alias("segment_name"),
    )


_SECTIONS = (
    "sec as (select doc_id, lang, source, list_transform(regexp_extract_all(lyrics, '\\[[\\p{L}\\p{N}_]+\\][^\\[]*'),"
    " lambda x: '[' || regexp_extract(x, '\\[([\\p{L}\\p{N}_]+)\\]', 1) || ']' || chr(10) ||"
    " regexp_replace(regexp_extract(x, '\\][\\s\\S]*$')[2:], '^\\s+|\\s+$', '', 'g') || chr(10) || chr(10)) as sections from lyrics)"
)


@query(
    "f25_split_sections",
    _and_ctes("lyrics", _SECTIONS, "select doc_id, len(sections)::integer as n, array_to_string(sections, '#') as sections from sec"),
)
def f25(spark, sf):
    s = X.lyrics(spark, sf).select("doc_id", T.split_sections(F.col("lyrics")).alias("s"))
    return s.select("doc_id", F.size("s").alias("n"), F.array_join("s", "#").alias("sections"))


_PROMPTS = (
    _SECTIONS + ", pr as (select doc_id, sections, list_concat(['Generate music from the given lyrics segment by segment.' || chr(10) ||"
    " '[Genre] ' || lang || chr(10) || array_to_string(sections, chr(10))], sections) as prompts from sec)"
)


@query(
    "f26_build_prompts",
    _and_ctes("lyrics", _PROMPTS, "select doc_id, len(prompts)::integer as n, array_to_string(prompts, '#') as prompts from pr"),
)
def f26(spark, sf):
    p = X.lyrics(spark, sf).select(
        "doc_id", T.build_prompts(F.concat(F.lit(" "), "lang", F.lit("\n")), T.split_sections(F.col("lyrics"))).alias("p")
    )
    return p.select("doc_id", F.size("p").alias("n"), F.array_join("p", "#").alias("prompts"))


@query(
    "o03_limit_sections",
    _and_ctes(
        "lyrics", _PROMPTS, "select doc_id, array_to_string(prompts[1:least(3, len(sections))], '#') as prompts from pr"
    ),
)
def o03(spark, sf):
    sections = T.split_sections(F.col("lyrics"))
    p = X.lyrics(spark, sf).select("doc_id", sections.alias("s"), T.build_prompts(F.col("lang"), sections).alias("p"))
    return p.select("doc_id", F.array_join(T.limit_sections(F.col("p"), F.col("s"), 2), "#").alias("prompts"))


@query(
    "f27_tail_tokens",
    X.with_views(
        "toks lens",
        "select l.doc_id, coalesce(string_agg(t.id::varchar, ' ' order by t.pos) filter (where t.pos >= l.n_tokens - 100), '') as tail,"
        " coalesce(string_agg(t.id::varchar, ' ' order by t.pos) filter (where t.pos >= l.n_tokens - 384), '') as context"
        " from lens l left join toks t using (doc_id) group by l.doc_id",
    ),
)
def f27(spark, sf):
    return X.seqs(spark, sf).select(
        "doc_id",
        _J(S.keep_last(F.col("tokens"), 100)).alias("tail"),
        _J(S.tail_tokens(F.col("tokens"), 15999)).alias("context"),
    )


@query(
    "f32_billions",
    X.with_views(
        "counts",
        "select path, format('{:.3f}B', n_tokens * 1000.0::double / 1e9) as text, round(n_tokens * 1000.0::double / 1e9, 3) as parsed from counts",
    ),
)
def f32(spark, sf):
    _, counts = X.mix(spark, sf)
    text = MX.format_billions(F.col("n_tokens") * 1000)
    return counts.select("path", text.alias("text"), F.round(MX.parse_billions(text) / 1e9, 3).alias("parsed"))


def _cdf(name: str, low: int, high: int) -> str:
    """Grid, cumulative probabilities and one draw per document for a prompt length range."""
    x = f"{low} + i * {high - low} / 99.0::double"
    return (
        f"{name}grid as (select i, {x} as x, exp(-pow({x} - 30, 2) / 6.0::double) as p from range(100) as r(i)),"
        f" {name}cdf as (select i, x, sum(p) over (order by i) / (select sum(p) from {name}grid) as c from {name}grid),"
        f" {name}drawn as (select doc_id, u, (select count(*) from {name}cdf where c <= u) as i from"
        f" (select doc_id, {_H.format("'7length:' || doc_id")} / 1152921504606846976.0::double as u from documents)),"
        f" {name}len as (select a.doc_id, round(case when a.i = 0 then {low}.0 when a.i >= 100 then {high}.0"
        " else lo.x + (hi.x - lo.x) * (a.u - lo.c) / (hi.c - lo.c) end, 6) as seconds"
        f" from {name}drawn a left join {name}cdf lo on lo.i = a.i - 1 left join {name}cdf hi on hi.i = a.i)"
    )


@query(
    "a22_prompt_length",
    f"with {_cdf('l', 20, 40)}, {_cdf('s', 1, 5)} select doc_id, llen.seconds as long_seconds, slen.seconds as short_seconds"
    " from llen join slen using (doc_id)",
)
def a22(spark, sf):
    u = T.hash_uniform(7, F.col("doc_id"), salt="length")
    return X.documents(spark, sf).select(
        "doc_id",
        F.round(sample_length(u, 30.0), 6).alias("long_seconds"),
        F.round(sample_length(u, 5.0), 6).alias("short_seconds"),
    )


@query(
    "w05_length_cdf",
    f"with {_cdf('l', 20, 40)} select lcdf.i, round(c, 9) as cdf, count(ldrawn.doc_id) as n_draws from lcdf"
    " left join ldrawn on ldrawn.i = lcdf.i group by all",
)
def w05(spark, sf):
    _, cdf = length_distribution(30.0)
    grid = C.double_array(cdf)
    u = T.hash_uniform(7, F.col("doc_id"), salt="length")
    draws = X.documents(spark, sf).select(F.size(F.filter(grid, lambda c: c <= u)).alias("i"))
    n = draws.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    points = spark.range(len(cdf)).select(F.col("id").alias("i"), F.round(F.get(grid, F.col("id").cast("int")), 9).alias("cdf"))
    return points.join(n, "i", "left").select("i", "cdf", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_draws"))


@query(
    "a18_window_codes",
    X.with_views(
        "cells",
        "select vec_id, (t // 5)::integer as window_no, string_agg(code::varchar, ' ' order by k, t) as codes from cells where t < 15"
        " group by vec_id, t // 5",
    ),
)
def a18(spark, sf):
    w = X.codes(spark, sf).select("vec_id", F.posexplode(C.window_codes(F.col("codec"), 5)).alias("window_no", "w"))
    return w.select("vec_id", "window_no", _J(F.flatten("w")).alias("codes"))


@query(
    "a20_segment_codes",
    X.with_views(
        "linew frames",
        "select l.doc_id, l.i::integer as seq_no, coalesce(string_agg((f.v - 45334)::varchar, ' ' order by f.t), '') as codes from linew l"
        " left join frames f on f.doc_id = l.doc_id and f.t >= l.b and f.t < l.b + l.n group by l.doc_id, l.i",
    ),
)
def a20(spark, sf):
    s = X.songs(spark, sf).select("doc_id", "vocals_codec_matrix", F.posexplode("segments").alias("seq_no", "s"))
    cut = C.slice_frames(F.col("vocals_codec_matrix"), F.col("s.codec_frame_start"), F.col("s.codec_frame_end"))
    return s.select("doc_id", "seq_no", _M(cut).alias("codes"))


@query(
    "a28_split_sentences",
    "select doc_id, len(s)::integer as n, array_to_string(s, '#') as sentences, true as rejoins from (select doc_id, list_filter(string_split("
    "regexp_replace(text, '([.!?])[ \\t\\n\\r\\f]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: length(x) > 0) as s from documents)",
)
def a28(spark, sf):
    s = X.documents(spark, sf).select(
        "doc_id",
        T.split_sentences(F.col("text")).alias("s"),
        (F.array_join(T.split_sentences(F.col("text"), keep_newlines=True), "") == F.col("text")).alias("rejoins"),
    )
    return s.select("doc_id", F.size("s").alias("n"), F.array_join("s", "#").alias("sentences"), "rejoins")


@query(
    "a33_add_bos",
    X.with_views(
        "flat",
        f"select dataset, sample, (case when tokens like '1 %' then '32000 ' else '1 ' end) || tokens as tokens from ({PACKED.format(L=128)})",
    ),
)
def a33(spark, sf):
    packed = P.pack_samples(X.seqs(spark, sf), P.PackConfig(128, bos=1))
    return packed.select("dataset", "sample", _J("tokens").alias("tokens"))
