"""Encoders: manifest rows and codec matrices to documents of token ids.

An encoder is row-local. One input row becomes one document ``(tokens, lengths)`` with the
length of every sequence in it; the only shuffle is the join that fetches codec matrices by path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sequences as S
from ..functions import text as X
from ..functions.binding import let, let_all
from ..functions.codecs import (
    CodecOptions,
    code_diversity,
    codes_problem,
    codes_to_ids,
    n_frames,
    slice_frames,
    window_codes,
)
from ..operators import validate as V
from ..operators.prompts import reference_block, sample_prompt
from ..operators.tokenizer import Tokenizer

STAGE2_WINDOW = 300
PATH_BITS = 22
CODES = T.ArrayType(T.ArrayType(T.IntegerType()))
#: What one document is encoded from: lyric segments with codes, a whole text with a whole codec file, a text, or ids.
UNITS = ("segments", "file", "text", "ids")


@dataclass(frozen=True)
class EncodeConfig:
    codec: CodecOptions = field(default_factory=CodecOptions)
    instruction: str = X.LYRICS_INSTRUCTION
    instruction_dropout: float = 0.0
    to_lower: bool = False
    order: str = "textfirst"
    append_eod: bool = True
    cot: bool = False
    use_audio_icl: bool = False
    audio_prompt_mode: str = "dual"
    audio_prompt_seconds: float = 30.0
    stage2: bool = False
    interleave: bool = False
    window_frames: int = STAGE2_WINDOW
    min_distinct: int = V.MIN_DISTINCT_CODES
    split_sentences: bool = False
    keep_newlines: bool = False
    seed: int = 42
    unit: str = "segments"


def attach_codecs(manifest: DataFrame, codecs: DataFrame, columns: list[str]) -> DataFrame:
    """Replace codec paths by their matrices (columns ``<name>_matrix``); a missing file leaves a
    null. Filter the manifest before calling: the matrices make up nearly all bytes.

    Matrices of several columns are gathered for the paths that rows name together, so the rows themselves, with their
    texts, move once however many columns there are. ``manifest`` is read twice then: save one that is costly to compute."""
    matrix, matrix_type = F.col("codec"), codecs.schema["codec"].dataType
    if matrix_type == CODES:  # codes that fit into 16 bits move as such
        codes = F.flatten(matrix)
        fits = F.coalesce((F.array_min(codes) >= -(1 << 15)) & (F.array_max(codes) < 1 << 15), F.lit(False))
        moved = [F.when(fits, matrix.try_cast("array<array<smallint>>")), F.when(~fits, matrix)]
    else:
        moved = [matrix]
    many = len(columns) > 1
    found = manifest.select(*[F.col(c).alias(f"__at_{c}") for c in columns]).distinct() if many else manifest
    for name in columns:
        at = f"__at_{name}" if many else name
        found = found.join(codecs.select(F.col("path").alias(at), *[m.alias(f"__m{i}_{name}") for i, m in enumerate(moved)]), at, "left")
    if many:
        same = [F.col(c).eqNullSafe(F.col(f"__at_{c}")) for c in columns]
        found = manifest.join(found, same, "left")
    matrices = [F.coalesce(*[F.col(f"__m{i}_{c}").cast(matrix_type) for i in range(len(moved))]).alias(f"{c}_matrix") for c in columns]
    return found.select(*manifest.columns, *matrices)


def named_codecs(manifest: DataFrame, codecs: DataFrame, columns: list[str]) -> DataFrame:
    """``codecs`` without most of the files that no row of ``manifest`` names: for a small part of a manifest against the
    files of all of it, which would be shuffled whole for each part. Paths are compared by ``PATH_BITS`` bits of a hash, so
    the set that is sent to the scan has a bound; the few files that are kept by chance find no row in the join."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << PATH_BITS))
    paths = manifest.select(F.explode(F.array(*columns)).alias("path")).where("path is not null")
    named = paths.select(place("path").alias("__place")).distinct()
    return codecs.join(F.broadcast(named), place(codecs["path"]) == F.col("__place"), "left_semi")


def missing_files(manifest: DataFrame, codecs: DataFrame, column: str) -> DataFrame:
    return manifest.join(codecs.select(F.col("path").alias(column)), column, "left_anti")


def _finish(df: DataFrame, parts: str, cfg: EncodeConfig) -> DataFrame:
    """Join the sequences of a document and close it."""

    def close(p: Column) -> Column:
        lengths, tokens = F.transform(p, lambda x: F.size(x)), F.flatten(p)
        if cfg.append_eod:
            lengths, tokens = let(lengths, S.bump_last), let(tokens, S.append_eod)
        return F.struct(tokens.alias("tokens"), lengths.alias("lengths"))

    return df.withColumn("__doc", let(F.col(parts), close)).select(
        *[c for c in df.columns if c not in (parts, "tokens", "lengths")], F.col("__doc.tokens").alias("tokens"), F.col("__doc.lengths").alias("lengths")
    )


def to_sequences(documents: DataFrame, dataset: str = "dataset", key: str = "doc_id") -> DataFrame:
    """Documents as store rows, one per sequence: ``(dataset, doc_id, seq_no, tokens, n_tokens)``.

    The sequences of an Arrow batch are new offsets over the same tokens, so the work is linear in them.
    A document without lengths gives no row; lengths that do not add up to the tokens stop the job.
    """
    narrow = documents.select(dataset, key, "tokens", "lengths")
    fields = [*narrow.schema.fields[:2], T.StructField("seq_no", T.IntegerType()), narrow.schema["tokens"]]
    schema = T.StructType([*fields, T.StructField("n_tokens", T.IntegerType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, held = (pc.fill_null(pc.list_value_length(batch[c]), 0).to_numpy() for c in ("lengths", "tokens"))
            sizes = batch["lengths"].flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            last = np.cumsum(count)
            if np.any(ends[last] - ends[last - count] != np.where(count > 0, held, 0)):
                raise ValueError("lengths of a document do not add up to its tokens")
            used = batch["tokens"].filter(pa.array(count > 0)).flatten()
            row = np.repeat(np.arange(len(count)), count)
            number = np.arange(len(sizes)) - np.repeat(last - count, count)
            yield pa.RecordBatch.from_arrays(
                [*(batch[i].take(pa.array(row)) for i in (0, 1)), pa.array(number, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), used), pa.array(sizes, pa.int32())],
                names=schema.names,
            )

    return narrow.mapInArrow(cut, schema)


def reassemble(sequences: DataFrame, dataset: str = "dataset", key: str = "doc_id") -> DataFrame:
    """Inverse of :func:`to_sequences`: a document is one row again, as it was before."""
    parts = F.sort_array(F.collect_list(F.struct("seq_no", "tokens", "n_tokens")))
    return (
        sequences.groupBy(dataset, key)
        .agg(parts.alias("p"))
        .select(dataset, key, F.flatten("p.tokens").alias("tokens"), F.col("p.n_tokens").alias("lengths"))
    )


def encode_documents(df: DataFrame, text: str, tokenizer: Tokenizer, cfg: EncodeConfig) -> DataFrame:
    """Text documents: sentences, token ids, per-sentence lengths; empty sentences are dropped."""
    sentences = X.split_sentences(F.col(text), cfg.split_sentences, cfg.keep_newlines)
    ids = df.withColumn("__all", tokenizer.nested_text_ids(sentences))
    kept = ids.withColumn("__parts", F.filter("__all", lambda s: F.size(s) > 0)).drop("__all")
    return _finish(kept, "__parts", cfg)


def encode_ids(df: DataFrame, ids: str, cfg: EncodeConfig) -> DataFrame:
    """Already tokenised documents: one sequence each, empty ones stay empty."""
    parts = F.when(F.size(ids) > 0, F.array(F.col(ids))).otherwise(F.array().cast("array<array<int>>"))
    return _finish(df.withColumn("__parts", parts), "__parts", cfg)


def _instructed(text: Column, cfg: EncodeConfig, *keys: Column) -> Column:
    full = X.instruction_dropout(text, cfg.instruction, cfg.instruction_dropout, cfg.seed, *keys)
    return F.lower(full) if cfg.to_lower else full


def encode_text_codec(
    df: DataFrame, key: str, text: str, codec: str, tokenizer: Tokenizer, cfg: EncodeConfig
) -> DataFrame:
    """One text and one whole codec matrix per document. Bad matrices keep a ``reason`` and no
    tokens, see :func:`~tokenloom.operators.validate.quarantine`."""
    checked = df.withColumn("reason", codes_problem(F.col(codec), cfg.codec))
    ids = checked.withColumn("__text", tokenizer.text_ids(_instructed(F.col(text), cfg, F.col(key))))
    audio = S.wrap_audio(codes_to_ids(F.col(codec), cfg.codec), cfg.codec)
    parts = F.when(F.col("reason").isNull(), F.array(S.order_text_audio(F.col("__text"), audio, cfg.order)))
    return _finish(ids.withColumn("__parts", parts).drop("__text"), "__parts", cfg)


def encode_text_segments(
    df: DataFrame,
    key: str,
    tokenizer: Tokenizer,
    cfg: EncodeConfig,
    segments: str = "segments",
    seconds: str = "audio_length_in_sec",
    codec: str = "codec_matrix",
) -> DataFrame:
    """Segmented text + codec documents: one sequence per valid segment."""
    frames = n_frames(F.col(codec))
    fps = V.song_fps(F.col("__frames"), F.col(seconds))
    base = df.withColumn("__frames", frames).withColumn("__fps", fps)
    base = base.withColumn(
        "reason",
        V.first_reason(
            (F.col(seconds) <= 0, "bad_length"), (codes_problem(F.col(codec), cfg.codec).isNotNull(), "bad_codes")
        ),
    )
    valid = let_all(
        lambda fps, sec, n: F.filter(F.col(segments), lambda s: V.segment_is_valid_flat(s, fps, sec, n)),
        fps=F.col("__fps"),
        sec=F.col(seconds),
        n=F.col("__frames"),
    )
    base = base.withColumn("__valid", F.when(F.col("reason").isNull(), valid))
    texts = F.transform(
        "__valid", lambda s, i: _instructed(s["line_content"], cfg, F.col(key), i)
    )
    base = base.withColumn("__text", tokenizer.nested_text_ids(texts))

    def record(s: Column, t: Column, matrix: Column) -> Column:
        codes = slice_frames(matrix, s["codec_frame_start"], s["codec_frame_end"])
        return S.order_text_audio(t, S.wrap_audio(codes_to_ids(codes, cfg.codec), cfg.codec), cfg.order)

    parts = let(F.col(codec), lambda m: F.zip_with("__valid", "__text", lambda s, t: record(s, t, m)))
    done = _finish(base.withColumn("__parts", parts), "__parts", cfg)
    empty = F.col("reason").isNull() & (F.size("__valid") == 0)
    return done.withColumn("reason", F.when(empty, "no_valid_segments").otherwise(F.col("reason"))).drop(
        "__frames", "__fps", "__valid", "__text"
    )


def encode_interleaved(
    df: DataFrame,
    key: str,
    tokenizer: Tokenizer,
    cfg: EncodeConfig,
    segments: str = "segments",
    seconds: str = "audio_length_in_sec",
    genres: str = "genres",
    vocals: str = "vocals_codec_matrix",
    instrumental: str = "instrumental_codec_matrix",
    mixture: str | None = None,
    sections: str = "msa",
) -> DataFrame:
    """Songs with two stems: token-level interleaving, plain, with a lyric header (``cot``), or
    with a header and an audio prompt (``use_audio_icl``).

    Rows that fail a song-level check carry the ``reason`` and null tokens.
    """
    icl, headed = cfg.use_audio_icl, cfg.cot or cfg.use_audio_icl
    stems = [vocals, instrumental] + ([mixture] if icl and cfg.audio_prompt_mode == "mixture" else [])
    required = [key, genres, seconds, segments] + ([sections] if icl else [])
    trimmed, too_far = V.reconcile_stems(df, *stems)
    base = trimmed.withColumn("__fps", V.song_fps(F.col("__frames"), F.col(seconds)))
    base = base.withColumn(
        "reason",
        V.first_reason(
            (V.missing_keys(required), "missing_keys"),
            (F.size(segments) <= 0, "no_segments"),
            (V.missing_keys(stems), "missing_file"),
            (too_far, "stem_length"),
            ((F.col(seconds) <= 0) | (F.col("__frames") <= 0), "bad_length"),
            (~V.fps_is_valid(F.col("__fps")), "frame_rate"),
            (
                codes_problem(F.col(vocals), cfg.codec).isNotNull()
                | codes_problem(F.col(instrumental), cfg.codec).isNotNull(),
                "bad_codes",
            ),
        ),
    )
    valid = let_all(
        lambda fps, n: F.filter(F.col(segments), lambda s: V.segment_is_valid(s, fps, n, icl)),
        fps=F.col("__fps"),
        n=F.col("__frames"),
    )
    base = base.withColumn("__valid", F.when(F.col("reason").isNull(), valid))

    # All texts of a document go through the tokenizer in one call: lines, then header, then markers.
    lines = F.transform(
        "__valid",
        lambda s, i: s["line_content"] if headed else _instructed(s["line_content"], cfg, F.col(key), i),
    )
    head = X.header_text(
        cfg.instruction,
        F.col(genres),
        F.transform(F.col(segments), lambda s: F.coalesce(s["line_content"], F.lit(""))),
    )
    extra = F.array(head, *[F.lit(m) for m in X.MARKERS]) if headed else F.array().cast("array<string>")
    base = base.withColumn(
        "__ids", tokenizer.nested_text_ids(F.when(F.col("reason").isNull(), F.concat(lines, extra)))
    )
    n = F.size("__valid")
    mark = {m: F.get("__ids", n + 1 + i) for i, m in enumerate(X.MARKERS)}

    def record(s: Column, i: Column, texts: Column, stem_a: Column, stem_b: Column) -> Column:
        text = F.get(texts, i)
        v, w = (
            codes_to_ids(slice_frames(m, s["codec_frame_start"], s["codec_frame_end"]), cfg.codec)
            for m in (stem_a, stem_b)
        )
        audio = S.wrap_audio(S.interleave(v, w), cfg.codec)
        if headed:
            return F.concat(mark[X.START_OF_SEGMENT], text, audio, mark[X.END_OF_SEGMENT])
        return F.concat(text, audio)

    parts = let_all(
        lambda texts, stem_a, stem_b: F.transform("__valid", lambda s, i: record(s, i, texts, stem_a, stem_b)),
        texts=F.col("__ids"),
        stem_a=F.col(vocals),
        stem_b=F.col(instrumental),
    )
    if headed:
        header = F.get("__ids", n)
        if icl:
            prompt = sample_prompt(
                F.col(key), F.col(segments), F.col(vocals), F.col(instrumental),
                F.col(mixture) if mixture else None, F.col(sections), F.col("__fps"),
                cfg.codec, cfg.audio_prompt_mode, cfg.audio_prompt_seconds, cfg.seed,
            )
            base = base.withColumn("__prompt", F.when(F.col("reason").isNull(), prompt)).withColumn(
                "reason",
                F.when(F.col("reason").isNull() & F.col("__prompt").isNull(), "no_prompt").otherwise(F.col("reason")),
            )
            header = F.concat(
                header,
                reference_block(
                    F.col("__prompt"), mark[X.START_OF_REFERENCE], mark[X.END_OF_REFERENCE], cfg.codec
                ),
            )
        parts = F.concat(F.array(header), parts)
    base = base.withColumn("__parts", F.when(F.col("reason").isNull(), parts))
    done = _finish(base, "__parts", cfg)
    if not headed:
        empty = F.col("reason").isNull() & (F.size("__valid") == 0)
        done = done.withColumn("reason", F.when(empty, "no_valid_segments").otherwise(F.col("reason")))
    return done.drop("__frames", "__far", "__fps", "__valid", "__ids", "__prompt")


def encode_stage2(df: DataFrame, codec: str, cfg: EncodeConfig) -> DataFrame:
    """Fixed windows of codes with enough variation, as stage-two records."""
    layers = F.slice(codec, cfg.codec.quantizer_begin + 1, cfg.codec.n_quantizer)
    base = df.withColumn("__w", window_codes(layers, cfg.window_frames))
    local = CodecOptions(
        cfg.codec.codec, cfg.codec.quantizer_begin, cfg.codec.n_quantizer, cfg.codec.teacher_forcing
    )
    varied = F.filter("__w", lambda w: code_diversity(w) >= cfg.min_distinct)
    base = base.withColumn("__w", varied)
    # Windows hold the selected codebooks only, so pad the layers before them for the offsets.
    pad = F.array_repeat(F.array().cast("array<int>"), cfg.codec.quantizer_begin)
    parts = F.transform("__w", lambda w: S.stage2_record(F.concat(pad, w), local))
    return _finish(base.withColumn("__parts", parts).drop("__w"), "__parts", cfg)


def encoder_name(cfg: EncodeConfig) -> str:
    """The encoder a configuration asks for. Windows of codes for stage two come first; then, for songs in segments,
    interleaved stems, which audio prompts need together with a lyric header; then the unit that is encoded."""
    if cfg.stage2:
        return "stage2"
    if cfg.unit not in UNITS:
        raise ValueError(f"unknown unit {cfg.unit!r}")
    if cfg.unit == "segments" and (cfg.interleave or (cfg.use_audio_icl and cfg.cot)):
        return "interleaved"
    return cfg.unit


def encode(df: DataFrame, key: str, tokenizer: Tokenizer, cfg: EncodeConfig, **columns: str) -> DataFrame:
    """Encode by the configuration (see ``encoder_name``); ``columns`` names columns of ``df`` that are not called as
    the encoder expects."""
    kind = encoder_name(cfg)
    named = {k: v for k, v in columns.items() if v is not None}
    if kind == "stage2":
        return encode_stage2(df, named.get("codec", "codec_matrix"), cfg)
    if kind == "interleaved":
        return encode_interleaved(df, key, tokenizer, cfg, **named)
    if kind == "text":
        return encode_documents(df, named.get("text", "text"), tokenizer, cfg)
    if kind == "ids":
        return encode_ids(df, named.get("ids", "ids"), cfg)
    if kind == "file":
        return encode_text_codec(df, key, named.get("text", "text"), named.get("codec", "codec_matrix"), tokenizer, cfg)
    return encode_text_segments(df, key, tokenizer, cfg, **named)
