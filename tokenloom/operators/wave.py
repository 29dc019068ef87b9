"""Sampled audio as a long table ``(track, idx, amp)``.

Per-track maxima are aggregated first and joined back, so a track that owns most of the samples
is reduced by partial aggregation and never lands in one window.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import track_key, track_type
from ..session import materialize
from .order import dense_index

MAX_AMPLITUDE = 0.95
AMPLITUDE_LIMIT = 0.99
TOP_DB = 20.0
FRAME_LENGTH = 2048
HOP_LENGTH = 512


def peak_amplitude(df: DataFrame, track: str = "track", amp: str = "amp") -> DataFrame:
    return df.groupBy(track).agg(F.max(F.abs(amp)).alias("peak"))


def _with_peak(df: DataFrame, track: str, amp: str) -> DataFrame:
    return df.join(peak_amplitude(df, track, amp), track)


def peak_normalize(
    df: DataFrame, max_amplitude: float = MAX_AMPLITUDE, track: str = "track", amp: str = "amp"
) -> DataFrame:
    """Scale each track so its peak is ``max_amplitude``; silent tracks stay as they are."""
    scaled = F.when(F.col("peak") > 0, F.col(amp) * (F.lit(max_amplitude) / F.col("peak"))).otherwise(F.col(amp))
    return _with_peak(df, track, amp).withColumn(amp, scaled).drop("peak")


def limit_amplitude(
    df: DataFrame, rescale: bool = False, track: str = "track", amp: str = "amp"
) -> DataFrame:
    """Clip to +-0.99, or scale the whole track down until it fits."""
    if not rescale:
        return df.withColumn(amp, F.greatest(F.least(F.col(amp), F.lit(AMPLITUDE_LIMIT)), F.lit(-AMPLITUDE_LIMIT)))
    factor = F.when(F.col("peak") > 0, F.least(F.lit(AMPLITUDE_LIMIT) / F.col("peak"), F.lit(1.0))).otherwise(F.lit(1.0))
    return _with_peak(df, track, amp).withColumn(amp, F.col(amp) * factor).drop("peak")


def to_mono(df: DataFrame, track: str = "track", idx: str = "idx", amp: str = "amp") -> DataFrame:
    """Mean over the channels present at each sample."""
    return df.groupBy(track, idx).agg(F.avg(amp).alias(amp))


def chunk_wave(
    df: DataFrame, chunk: int, min_length: int, track: str = "track", idx: str = "idx"
) -> DataFrame:
    """Cut tracks into chunks of ``chunk`` samples and drop chunks shorter than ``min_length``.
    Adds ``segment``, the 1-based number among the kept chunks; a track without any kept chunk
    stays whole with a null segment."""
    cut = df.withColumn("__chunk", F.call_function("div", F.col(idx), F.lit(chunk)).cast("bigint"))
    sizes = cut.groupBy(track, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    kept = dense_index(sizes.where(F.col("__n") >= min_length), "__chunk", "__no", [track], total="__kept")
    any_kept = kept.groupBy(track).agg(F.max("__kept").alias("__any"))
    plan = (
        sizes.join(kept.select(track, "__chunk", "__no"), [track, "__chunk"], "left")
        .join(any_kept, track, "left")
        .where(F.col("__no").isNotNull() | F.col("__any").isNull())
        .select(track, "__chunk", (F.col("__no") + 1).alias("segment"))
    )
    return cut.join(plan, [track, "__chunk"]).drop("__chunk")


def trim_silence(
    df: DataFrame,
    top_db: float = TOP_DB,
    frame: int = FRAME_LENGTH,
    hop: int = HOP_LENGTH,
    track: str = "track",
    idx: str = "idx",
    amp: str = "amp",
) -> DataFrame:
    """Keep the hop-sized stretches whose frame is within ``top_db`` of the loudest frame.

    Frame t is centred on sample t * hop with zero padding. Samples are gathered once, in blocks that no
    frame divides; a block's energy is added to the few frames that cover it, and the blocks that stay are
    unfolded again. A sample number must be unique in its track.
    """
    half = frame // 2
    step = math.gcd(half, hop)
    block = F.call_function("div", F.col(idx), F.lit(step)).cast("bigint")
    blocks = df.groupBy(track, block.alias("__b")).agg(
        F.sum(F.col(amp) * F.col(amp)).alias("__e"), F.max(idx).alias("__last"), F.collect_list(F.struct(*df.columns)).alias("__rows")
    )
    blocks = materialize(blocks, "wave-blocks")
    begin = F.col("__b") * step
    first = F.greatest(F.ceil((begin + step - half) / F.lit(float(hop))).cast("bigint"), F.lit(0).cast("bigint"))
    last = F.call_function("div", begin + half, F.lit(hop))
    frames = blocks.select(track, "__e", F.explode(F.sequence(first, last)).alias("__f")).groupBy(track, "__f").agg(F.sum("__e").alias("__e"))
    if half < hop:  # else a frame behind the end covers no more than the one before it
        ends = blocks.groupBy(track).agg(F.max("__last").alias("__last"))
        frames = frames.join(ends, track).where(F.col("__f") <= F.call_function("div", F.col("__last") + 1, F.lit(hop)))
    loudest = frames.groupBy(track).agg(F.max("__e").alias("__max"))
    loud = (F.col("__max") > 0) & (F.col("__e") > F.col("__max") * F.lit(10.0 ** (-top_db / 10.0)))
    audible = frames.join(loudest, track).where(loud).select(track, "__f")
    kept = blocks.withColumn("__f", F.call_function("div", begin, F.lit(hop))).join(audible, [track, "__f"], "left_semi")
    return kept.select(F.inline("__rows")).select(*df.columns)


def pair_stems(files: DataFrame, name: str = "file", order: str = "file_no") -> DataFrame:
    """One row per base key with its vocal, instrumental and full file; the last one of a type
    wins and ``n_files`` tells how many there were."""
    typed = files.select(
        track_key(F.col(name)).alias("key"), track_type(F.col(name)).alias("kind"), name, order
    )
    pick = lambda kind: F.max_by(F.when(F.col("kind") == kind, F.col(name)), F.when(F.col("kind") == kind, F.col(order)))
    return typed.groupBy("key").agg(
        pick("Vocals").alias("vocals"),
        pick("Instrumental").alias("instrumental"),
        pick("Full").alias("full"),
        F.count(F.lit(1)).alias("n_files"),
    )


def mix_tracks(df: DataFrame, track: str = "track", idx: str = "idx", amp: str = "amp") -> DataFrame:
    """Add each ``_itrack`` to the ``_vtrack`` of the same name, sample by sample; tracks
    without a partner are left out. The result is named ``_mixed``."""
    name = F.col(track)
    inst = df.where(name.contains("_itrack")).select(
        F.replace(name, F.lit("_itrack"), F.lit("_mixed")).alias(track), idx, F.col(amp).alias("__i")
    )
    vocal = df.where(name.contains("_vtrack")).select(
        F.replace(name, F.lit("_vtrack"), F.lit("_mixed")).alias(track), idx, F.col(amp).alias("__v")
    )
    return inst.join(vocal, [track, idx]).select(track, idx, (F.col("__i") + F.col("__v")).alias(amp))
