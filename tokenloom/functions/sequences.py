"""Expressions over flat token lists (``ARRAY<INT>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .codecs import EOA, EOD, SOA, STAGE_1, STAGE_2, CodecOptions, flatten_frames, int_array, offset_codes

FRAMES_PER_SECOND = 50
CONTEXT_TOKENS = 16384


def interleave(a: Column, b: Column) -> Column:
    """a0, b0, a1, b1, ... for two lists of equal length."""
    return F.flatten(F.zip_with(a, b, lambda x, y: F.array(x, y)))


def trim_even(ids: Column, ways: int = 2) -> Column:
    return let(ids, lambda x: F.slice(x, F.lit(1), F.size(x) - F.size(x) % ways))


def deinterleave(ids: Column, track: int, ways: int = 2) -> Column:
    """Every ``ways``-th token from ``track`` on, after dropping an incomplete last round."""
    return F.filter(trim_even(ids, ways), lambda _, i: i % ways == track)


def wrap_audio(ids: Column, opts: CodecOptions) -> Column:
    """``SOA, separator(s), ids, EOA``."""
    return F.concat(int_array([SOA, *opts.spec.separator_ids]), ids, int_array([EOA]))


def order_text_audio(text_ids: Column, audio_ids: Column, order: str) -> Column:
    """Text before audio for ``textfirst``; any other order puts the audio first."""
    return F.concat(text_ids, audio_ids) if order == "textfirst" else F.concat(audio_ids, text_ids)


def append_eod(ids: Column, eod: int = EOD) -> Column:
    """Close a document; an empty document stays empty."""
    return F.when(F.size(ids) > 0, F.concat(ids, int_array([eod]))).otherwise(ids)


def bump_last(lengths: Column) -> Column:
    """Add one to the last sequence length (the end-of-document token belongs to it)."""
    return F.transform(lengths, lambda n, i: F.when(i == F.size(lengths) - 1, n + 1).otherwise(n))


def sub_sequence(ids: Column, offset: Column, length: Column) -> Column:
    """``length`` tokens from 0-based ``offset``; a null length means the rest."""
    rest = F.greatest(F.size(ids) - offset, F.lit(0))
    return F.slice(ids, offset + 1, F.coalesce(length, rest).cast("int"))


def seconds_to_frames(seconds: Column, fps: Column | float = FRAMES_PER_SECOND) -> Column:
    """Frame number of a time, truncated toward zero."""
    return (seconds * fps).cast("int")


def slice_by_time(ids: Column, start_s: Column, end_s: Column, stems: int = 1) -> Column:
    """Ids between two times; interleaved stems carry ``stems`` ids per frame."""
    first = seconds_to_frames(start_s, FRAMES_PER_SECOND * stems)
    last = F.least(seconds_to_frames(end_s, FRAMES_PER_SECOND * stems), F.size(ids))
    return F.slice(ids, first + 1, F.greatest(last - first, F.lit(0)))


def stage2_record(window: Column, opts: CodecOptions) -> Column:
    """``SOA stage_1 codebook0 stage_2 rest EOA``; with teacher forcing ``rest`` is every
    codebook of the window, else all but the first."""

    def record(ids: Column) -> Column:
        first = F.get(ids, F.lit(0))
        rest = ids if opts.teacher_forcing else F.slice(ids, F.lit(2), F.size(ids))
        return F.concat(
            int_array([SOA, STAGE_1]), first, int_array([STAGE_2]), flatten_frames(rest), int_array([EOA])
        )

    return let(offset_codes(window, opts), record)


def tail_tokens(ids: Column, max_new_tokens: int) -> Column:
    """Last tokens that leave room for ``max_new_tokens`` in the model context."""
    keep = CONTEXT_TOKENS - max_new_tokens - 1
    return keep_last(ids, keep)


def keep_last(ids: Column, n: int) -> Column:
    size = F.size(ids)
    return F.slice(ids, F.greatest(size - n, F.lit(0)) + 1, F.lit(n))


def block_ids(ids: Column, start: int, end: int) -> Column:
    """Drop ids in ``[start, end)``; an empty range drops nothing."""
    return F.filter(ids, lambda v: ~((v >= start) & (v < end)))


def count_token(ids: Column, token: int) -> Column:
    return F.size(F.filter(ids, lambda v: v == token))


def has_paired_audio(ids: Column) -> Column:
    """Start and end of audio occur equally often."""
    return count_token(ids, SOA) == count_token(ids, EOA)


# ---- training sample fields ----------------------------------------------------------------


def model_inputs(sample: Column) -> Column:
    return F.slice(sample, F.lit(1), F.greatest(F.size(sample) - 1, F.lit(0)))


def model_labels(sample: Column) -> Column:
    return F.slice(sample, F.lit(2), F.greatest(F.size(sample) - 1, F.lit(0)))


def loss_mask(inputs: Column, eod: int = EOD, mask_eod: bool = True) -> Column:
    """1.0 per token, 0.0 on end-of-document inputs when ``mask_eod``."""
    return F.transform(
        inputs,
        lambda v: F.when((v == eod) & F.lit(mask_eod), F.lit(0.0)).otherwise(F.lit(1.0)).cast("float"),
    )


def _document_spans(inputs: Column, eod: int) -> Column:
    """(start, end) of the documents inside a sample: a new one begins after each EOD."""

    def spans(x: Column) -> Column:
        after_eod = F.transform(x, lambda v, i: F.when((v == eod) & (i + 1 < F.size(x)), i + 1))
        starts = F.concat(int_array([0]), F.array_compact(after_eod))
        return let(
            starts,
            lambda st: F.transform(
                st, lambda s, j: F.struct(s.alias("start"), F.coalesce(F.get(st, j + 1), F.size(x)).alias("end"))
            ),
        )

    return let(inputs, spans)


def position_ids(inputs: Column, reset: bool = False, eod: int = EOD) -> Column:
    """0..L-1, restarting after each EOD when ``reset``."""
    empty = F.array().cast("array<int>")
    if not reset:
        ids = F.sequence(F.lit(0), F.size(inputs) - 1)
    else:
        ids = F.flatten(
            F.transform(
                _document_spans(inputs, eod), lambda d: F.sequence(F.lit(0), d["end"] - d["start"] - 1)
            )
        )
    return F.when(F.size(inputs) > 0, ids).otherwise(empty)


def segment_ids(inputs: Column, eod: int = EOD) -> Column:
    """Per token, how many EODs come strictly before it. Attention from i to j is blocked when
    ``j > i`` or the segments differ; storing L ids replaces an L x L mask."""
    ids = F.flatten(
        F.transform(
            _document_spans(inputs, eod), lambda d, j: F.array_repeat(j, d["end"] - d["start"])
        )
    )
    return F.when(F.size(inputs) > 0, ids).otherwise(F.array().cast("array<int>"))


def attention_mask(segments: Column, reset: bool = True) -> Column:
    """Explicit L x L mask (1 = blocked), for looking at single samples."""
    return F.transform(
        segments,
        lambda si, i: F.transform(
            segments,
            lambda sj, j: F.when((j > i) | (F.lit(reset) & (si != sj)), 1).otherwise(0),
        ),
    )


def add_bos(sample: Column, bos: int, eod: int = EOD) -> Column:
    """Prepend BOS, or EOD when the sample already starts with BOS."""
    first = F.when(F.get(sample, F.lit(0)) == bos, F.lit(eod)).otherwise(F.lit(bos))
    return F.concat(F.array(first), sample)
