"""Audio prompts for in-context training: length draw, span choice, reference block."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..functions.binding import let, let_all
from ..functions.codecs import CodecOptions, codes_to_ids, double_array, n_frames, slice_frames
from ..functions.text import hash_uniform
from .validate import is_varied

# ---- fixed values: the prompt length distribution ------------------------------------------
PROMPT_MEAN, PROMPT_VARIANCE, PROMPT_POINTS = 30.0, 3.0, 100
LONG_PROMPT_RANGE, SHORT_PROMPT_RANGE, LONG_PROMPT_FROM = (20.0, 40.0), (1.0, 5.0), 30
PROMPT_TRIES = 6
PROMPT_MODES = ("dual", "mixture", "inst", "vocal")
# ---- end of fixed values -------------------------------------------------------------------


SECTIONS = "array<struct<label:string,start:double,end:double>>"


def length_distribution(prompt_seconds: float) -> tuple[list[float], list[float]]:
    """(seconds, cumulative probability) at 100 evenly spaced points of a normal distribution."""
    if prompt_seconds <= 0:
        raise ValueError("audio prompt length must be positive")
    low, high = LONG_PROMPT_RANGE if prompt_seconds >= LONG_PROMPT_FROM else SHORT_PROMPT_RANGE
    xs = [low + (high - low) * i / (PROMPT_POINTS - 1) for i in range(PROMPT_POINTS)]
    pdf = [math.exp(-((x - PROMPT_MEAN) ** 2) / (2 * PROMPT_VARIANCE)) for x in xs]
    whole = math.fsum(pdf)
    cdf = [math.fsum(pdf[: i + 1]) / whole for i in range(PROMPT_POINTS)]
    return xs, cdf


def sample_length(u: Column, prompt_seconds: float = 30.0) -> Column:
    """Inverse-CDF draw of a prompt length: linear between the points, clamped at both ends."""
    xs, cdf = length_distribution(prompt_seconds)
    x, c = double_array(xs), double_array(cdf)

    def between(u: Column, i: Column) -> Column:
        x0, x1, c0, c1 = (F.get(a, j) for a, j in ((x, i - 1), (x, i), (c, i - 1), (c, i)))
        return (
            F.when(i == 0, F.lit(xs[0]))
            .when(i >= PROMPT_POINTS, F.lit(xs[-1]))
            .otherwise(x0 + (x1 - x0) * (u - c0) / (c1 - c0))
        )

    return let(u, lambda v: let(F.size(F.filter(c, lambda p: p <= v)), lambda i: between(v, i)))


def reference_block(prompt_ids: Column, start_marker: Column, end_marker: Column, opts: CodecOptions) -> Column:
    """``[start_of_reference] SOA sep prompt EOA [end_of_reference]`` as ids."""
    return F.concat(start_marker, S.wrap_audio(prompt_ids, opts), end_marker)


def _pick_int(low: Column, high: Column, seed: int, *keys: Column, salt: str) -> Column:
    """A uniform integer in ``[low, high]``."""
    span = F.greatest(high - low + 1, F.lit(1))
    return (low + F.floor(hash_uniform(seed, *keys, salt=salt) * span)).cast("int")


def sample_prompt(
    key: Column,
    segments: Column,
    vocals: Column,
    instrumental: Column,
    mixture: Column | None,
    sections: Column,
    fps: Column,
    opts: CodecOptions,
    mode: str = "dual",
    prompt_seconds: float = 30.0,
    seed: int = 1234,
) -> Column:
    """Audio prompt ids of one song, or null when its lyric range is unusable.

    The length is drawn per song: one second when the draw is empty, half the lyric range when it
    does not fit. The first try starts inside a random chorus that is long enough, later tries
    anywhere; the first varied try wins, else the last one. All tries are slices of one array,
    so nothing is exploded.
    """
    if mode not in PROMPT_MODES:
        raise ValueError(f"unknown audio prompt mode {mode!r}")
    step = 2 if mode == "dual" else 1

    def whole_range(segs: Column, voc: Column, inst: Column, mix: Column, secs: Column, rate: Column) -> Column:
        """Bind the song's columns, then its lyric range."""
        first = F.coalesce(F.get(segs, F.lit(0))["codec_frame_start"], F.lit(0))
        last = F.coalesce(F.get(segs, F.size(segs) - 1)["codec_frame_end"], n_frames(voc))

        def from_range(first: Column, last: Column, total: Column) -> Column:
            def ids(m: Column) -> Column:
                return codes_to_ids(slice_frames(m, first, last), opts)

            stems = {"mixture": mix, "inst": inst, "vocal": voc}
            source = S.interleave(ids(voc), ids(inst)) if mode == "dual" else ids(stems[mode])
            frames = last - first
            drawn = (sample_length(hash_uniform(seed, key, salt="length"), prompt_seconds) * rate).cast("int") * step
            span = let(drawn, lambda n: F.when(n <= 0, (rate * step).cast("int")).otherwise(n))
            span = let(span, lambda n: F.when(n >= frames * step, _half(frames * step)).otherwise(n))

            def pick(source: Column, length: Column) -> Column:
                latest = F.greatest(frames * step - length, F.lit(0))
                anywhere = [_pick_int(F.lit(0), latest, seed, key, salt=f"try{i}") for i in range(PROMPT_TRIES)]
                inside = let(
                    _chorus_range(secs, rate, first, frames, total, step, length, seed, key),
                    lambda c: F.when(c["high"] > c["low"], _pick_int(c["low"], c["high"], seed, key, salt="try0")),
                )
                starts = F.array(F.coalesce(inside, anywhere[0]), *anywhere[1:])
                tries = F.transform(starts, lambda s: F.slice(source, s + 1, length))
                return let(
                    tries,
                    lambda t: F.coalesce(F.get(F.filter(t, is_varied), F.lit(0)), F.get(t, F.lit(PROMPT_TRIES - 1))),
                )

            usable = (first >= 0) & (first < last) & (first < total)
            return F.when(usable, let_all(pick, source=source, length=span))

        return let_all(from_range, first=first, last=last, total=n_frames(voc))

    return let_all(
        whole_range,
        segs=segments,
        voc=vocals,
        inst=instrumental,
        mix=vocals if mixture is None else mixture,
        secs=F.coalesce(sections, F.array().cast(SECTIONS)),
        rate=fps,
    )


def _half(n: Column) -> Column:
    return F.call_function("div", n, F.lit(2)).cast("int")


def _chorus_range(
    sections: Column,
    fps: Column,
    first: Column,
    frames: Column,
    total: Column,
    step: int,
    length: Column,
    seed: int,
    key: Column,
) -> Column:
    """Lowest and highest start inside a random chorus, relative to the lyric range; null without
    a chorus."""
    chorus = F.filter(sections, lambda s: s["label"] == "chorus")

    def bounds(c: Column) -> Column:
        low = F.greatest(F.lit(0), (F.coalesce(c["start"], F.lit(0.0)) * fps).cast("int") - first)
        high = F.least(frames, F.coalesce((c["end"] * fps).cast("int"), total) - first)
        return F.struct((low * step).alias("low"), (high * step - length).alias("high"))

    return let(
        chorus,
        lambda cs: let(
            F.get(cs, F.floor(hash_uniform(seed, key, salt="chorus") * F.size(cs)).cast("int")),
            lambda c: F.when(c.isNotNull(), bounds(c)),
        ),
    )
