"""From manifest lines to packed training samples, in one plan."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import pack as P
from ..operators import validate as V
from ..operators.tokenizer import Tokenizer
from ..session import materialize
from ..sources.manifests import FLAT_SCHEMA, SONG_SCHEMA, parse_manifest
from .encode import EncodeConfig, attach_codecs, encode, encoder_name, named_codecs, to_sequences


class Prepared(NamedTuple):
    """``documents`` has ``(id, dataset, tokens, lengths)``, ``rejected`` has ``(id, reason, line)``; both are read from saved tables."""

    documents: DataFrame
    rejected: DataFrame


def manifest_schema(cfg: EncodeConfig) -> str:
    """The columns that a manifest has for the encoder of ``cfg``."""
    kind = encoder_name(cfg)
    if kind == "ids":
        return "id string, ids array<int>"
    return FLAT_SCHEMA if kind in ("text", "file") else SONG_SCHEMA


def encode_songs(rows: DataFrame, codecs: DataFrame, tokenizer: Tokenizer, cfg: EncodeConfig, part: bool = False) -> DataFrame:
    """Parsed manifest rows to ``(id, ..., tokens, lengths, reason)``; further columns of ``rows`` are kept.

    Rows without a key or a column that the encoder needs get the reason ``missing_keys``, songs without lyrics
    ``no_segments``, rows whose codec file is missing or fails a check that of the encoder. ``codecs`` is ``(path, codec)``,
    as ``read_codec`` gives it. Matrices move once, and only to rows that passed the checks that need none. With ``part``,
    rows are a small part of what ``codecs`` holds files for (a micro-batch), and files that no row names stay where they are.
    """
    kind = encoder_name(cfg)
    lyrics, paths = "splitted_lyrics.segmented_lyrics", ["codec"]
    if kind == "interleaved":
        checks = V.song_key_checks(F.col(lyrics), cfg.use_audio_icl)
        paths = ["vocals_codec", "instrumental_codec"] + (["codec"] if cfg.use_audio_icl and cfg.audio_prompt_mode == "mixture" else [])
    elif kind == "segments":
        checks = [(V.missing_keys(["id", "splitted_lyrics", "audio_length_in_sec", "codec"]), "missing_keys"), (F.size(lyrics) <= 0, "no_segments")]
    else:
        needed = {"text": ["id", "text"], "ids": ["id", "ids"], "file": ["id", "text", "codec"], "stage2": ["id", "codec"]}[kind]
        checks = [(V.missing_keys(needed), "missing_keys")]
        paths = paths if "codec" in needed else []
    usable, unusable = V.quarantine(rows, V.first_reason(*checks))
    if kind in ("interleaved", "segments"):
        usable = usable.withColumn("segments", F.col(lyrics))
    if part and paths:
        codecs = named_codecs(usable, codecs, paths)
    found = attach_codecs(usable, codecs, paths)
    done = encode(found, "id", tokenizer, cfg, mixture="codec_matrix" if len(paths) == 3 else None)
    reason = F.col("reason") if "reason" in done.columns else F.lit(None).cast("string")
    if paths == ["codec"]:
        reason = F.when(F.col("codec_matrix").isNull(), "missing_file").otherwise(reason)
    carried = [c for c in rows.columns if c not in ("tokens", "lengths", "reason")]
    done = done.select(*carried, "tokens", "lengths", reason.alias("reason"))
    return done.unionByName(unusable.select(*carried, "reason"), allowMissingColumns=True)


def prepare_manifest(
    lines: DataFrame, codecs: DataFrame, tokenizer: Tokenizer, cfg: EncodeConfig, dataset: Column, value: str = "value"
) -> Prepared:
    """JSON lines (``manifest_schema``) to documents and rejects; lines that are no JSON are rejected as ``malformed``.
    ``dataset`` is computed from the manifest's columns."""
    rows, malformed = parse_manifest(lines, manifest_schema(cfg), value, save=True)
    done = encode_songs(rows.withColumn("dataset", dataset), codecs, tokenizer, cfg)
    done = materialize(done.select("id", "dataset", "tokens", "lengths", "reason"), "encoded")
    none = F.lit(None).cast("string")
    rejected = done.where("reason is not null").select("id", "reason", none.alias("line"))
    rejected = rejected.unionByName(malformed.select(none.alias("id"), F.lit("malformed").alias("reason"), "line"))
    return Prepared(done.where("reason is null").drop("reason"), rejected)


def manifest_samples(prepared: Prepared, cfg: P.PackConfig, num_samples: Column | int | None = None) -> DataFrame:
    """Packed samples of the prepared documents; every segment is a sequence of its own, in the order of its document.
    ``cfg.key`` orders documents: their ids, as text."""
    sequences = to_sequences(prepared.documents.where(F.size("tokens") > 0), "dataset", "id")
    stored = materialize(sequences.withColumnsRenamed({"dataset": cfg.dataset, "id": cfg.key}), "sequences")
    return P.pack_samples(stored, cfg, num_samples)
