"""Row checks that name a reason, and the good / quarantined split of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let, let_all
from ..functions.codecs import n_frames, slice_frames

# ---- fixed values: limits of the checks ----------------------------------------------------
MIN_FPS, MAX_FPS = 49.0, 51.0
MAX_STEM_DIFFERENCE = 10
MIN_DISTINCT_CODES = 25
MIN_PROMPT_VARIATION = 0.1
MIN_ICL_SECONDS = 1.0
SONG_KEYS = ("splitted_lyrics", "vocals_codec", "instrumental_codec", "audio_length_in_sec", "genres", "id")
ICL_KEYS = ("msa", "codec")
# ---- end of fixed values -------------------------------------------------------------------


def first_reason(*checks: tuple[Column, str]) -> Column:
    """The reason of the first failing check, or null. A check that is null counts as failing."""
    return F.coalesce(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(reason)) for bad, reason in checks])


def quarantine(df: DataFrame, reason: Column, out: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their reason)."""
    tagged = df.withColumn(out, reason)
    return tagged.where(F.col(out).isNull()).drop(out), tagged.where(F.col(out).isNotNull())


def missing_keys(keys: Sequence[str]) -> Column:
    """True when any required column is null."""
    bad = F.lit(False)
    for key in keys:
        bad = bad | F.col(key).isNull()
    return bad


def song_key_checks(segments: Column, icl: bool = False) -> list[tuple[Column, str]]:
    keys = [*SONG_KEYS, *(ICL_KEYS if icl else ())]
    return [(missing_keys(keys), "missing_keys"), (F.size(segments) <= 0, "no_segments")]


def segment_is_valid_flat(seg: Column, fps: Column, song_seconds: Column, frames: Column) -> Column:
    """Checks of the plain text + codec encoder."""
    start, end = seg["codec_frame_start"], seg["codec_frame_end"]
    ok = (
        (seg["duration"] > 0)
        & (seg["duration"] <= song_seconds)
        & (start >= 0)
        & (start < end)
        & (end <= frames)
        & ((end - start) >= fps)
    )
    return F.coalesce(ok, F.lit(False))


def segment_is_valid(seg: Column, fps: Column, frames: Column, icl: bool = False) -> Column:
    """Checks of the interleaving encoder: all fields present, frames inside the song, and at
    least one second long (by duration for in-context prompts, by frames otherwise)."""
    start, end = seg["codec_frame_start"], seg["codec_frame_end"]
    long_enough = (seg["duration"] >= MIN_ICL_SECONDS) if icl else ((end - start) >= fps)
    ok = (
        seg["duration"].isNotNull()
        & seg["line_content"].isNotNull()
        & (start >= 0)
        & (start < end)
        & (end <= frames)
        & long_enough
    )
    return F.coalesce(ok, F.lit(False))


def song_fps(frames: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, frames / seconds)


def fps_is_valid(fps: Column) -> Column:
    return F.coalesce(fps.between(MIN_FPS, MAX_FPS), F.lit(False))


def reconcile_stems(df: DataFrame, *matrices: str) -> tuple[DataFrame, Column]:
    """Trim codec matrices of one song to the shortest. They are taken in the given order: each must lie
    within ten frames of what the ones before it were trimmed to.
    Returns the trimmed frame and the check that lengths were too far apart."""
    # Lengths stay separate from the trimmed matrices, so that filters on them, pushed down to the
    # scan, cost no more than a look at array sizes.
    frames, far = n_frames(F.col(matrices[0])), F.lit(False)
    for m in matrices[1:]:
        far = far | (F.abs(frames - n_frames(F.col(m))) > MAX_STEM_DIFFERENCE)
        frames = F.least(frames, n_frames(F.col(m)))

    def cut(m: Column, frames: Column, far: Column) -> Column:
        return F.when(far, m).otherwise(slice_frames(m, F.lit(0), frames))

    trimmed = {m: let_all(cut, m=F.col(m), frames=frames, far=far).alias(m) for m in matrices}
    out = df.select(*[trimmed.get(c, F.col(c)) for c in df.columns], frames.alias("__frames"), far.alias("__far"))
    return out, F.col("__far")


def is_varied(ids: Column) -> Column:
    """Distinct ids make up at least a tenth of a prompt."""
    return let(ids, lambda x: F.size(F.array_distinct(x)) >= F.size(x) * F.lit(MIN_PROMPT_VARIATION))
