"""Generated token streams back to codec tracks, stage-two prompts, and repair of bad codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..functions.binding import let
from ..functions.codecs import EOA, SOA, STAGE_1, STAGE_2, CodecOptions, ids_to_codes, int_array

WINDOW_SECONDS = 6
MAX_CODE = 1023


def _positions(ids: Column, token: int) -> Column:
    return F.array_compact(F.transform(ids, lambda v, i: F.when(v == token, i)))


def audio_spans(ids: Column, opts: CodecOptions, skip_prompt: bool = False) -> Column:
    """Ids between each start and end of audio, without the leading separator. The first span
    is left out when it was the audio prompt."""
    return let(ids, lambda x: _audio_spans(x, opts, skip_prompt))


def _audio_spans(ids: Column, opts: CodecOptions, skip_prompt: bool) -> Column:
    separator = opts.spec.separator_ids[0]
    bounds = F.arrays_zip(_positions(ids, SOA).alias("s"), _positions(ids, EOA).alias("e"))
    spans = F.transform(bounds, lambda b: F.slice(ids, b["s"] + 2, F.greatest(b["e"] - b["s"] - 1, F.lit(0))))
    spans = F.transform(
        spans,
        lambda x: F.when(F.get(x, F.lit(0)) == separator, F.slice(x, F.lit(2), F.size(x))).otherwise(x),
    )
    return F.filter(spans, lambda _, i: i > 0) if skip_prompt else spans


def extract_tracks(
    df: DataFrame, ids: str, opts: CodecOptions, skip_prompt: bool = False
) -> DataFrame:
    """Vocal and instrumental code matrices of a stream, all spans joined in order. ``problem``
    is set (and the tracks null) when starts and ends of audio do not pair up."""
    paired = S.has_paired_audio(F.col(ids))
    out = df.withColumn("problem", F.when(~paired, "unpaired_audio")).withColumn(
        "__spans", F.when(paired, audio_spans(F.col(ids), opts, skip_prompt))
    )

    def track(t: int) -> Column:
        per_span = F.transform(
            F.col("__spans"), lambda span: ids_to_codes(S.deinterleave(span, t), opts)
        )

        def joined(spans: Column) -> Column:
            def layer(k: int) -> Column:
                return F.flatten(F.transform(spans, lambda m: F.get(m, F.lit(k))))

            return F.array(*[layer(k) for k in range(opts.n_quantizer)])

        return let(per_span, joined)

    return (
        out.withColumn("vocals", F.when(paired, track(0)))
        .withColumn("instrumental", F.when(paired, track(1)))
        .drop("__spans")
    )


def plan_batches(
    df: DataFrame, frames: str, batch: int, fps: int = 50, seconds: int = WINDOW_SECONDS
) -> DataFrame:
    """Stage-two batches of whole windows: ``(piece, begin, end, windows)`` per track, at most
    ``batch`` windows each, plus a remainder piece with 0 windows."""
    window = fps * seconds
    whole = F.call_function("div", F.call_function("div", F.col(frames), F.lit(fps)), F.lit(seconds)).cast("int")
    pieces = F.ceil(whole / F.lit(float(batch))).cast("int")
    full = F.transform(
        F.sequence(F.lit(0), pieces - 1),
        lambda p: F.struct(
            p.alias("piece"),
            (p * batch * window).alias("begin"),
            F.least((p + 1) * batch, whole).alias("w"),
        ),
    )
    full = F.transform(
        full,
        lambda p: F.struct(
            p["piece"].alias("piece"),
            p["begin"].alias("begin"),
            (p["w"] * window).alias("end"),
            (p["w"] - p["piece"] * batch).alias("windows"),
        ),
    )
    kind = "array<struct<piece:int,begin:int,end:int,windows:int>>"
    full = F.when(whole > 0, full.cast(kind)).otherwise(F.array().cast(kind))
    rest = F.array(
        F.struct(
            pieces.alias("piece"),
            (whole * window).alias("begin"),
            F.col(frames).cast("int").alias("end"),
            F.lit(0).alias("windows"),
        )
    ).cast(kind)
    plan = F.when(whole * window < F.col(frames), F.concat(full, rest)).otherwise(full)
    return df.select("*", F.inline(plan))


def stage2_prompts(
    df: DataFrame, key: str, codes: str, opts: CodecOptions, window: int = 300
) -> DataFrame:
    """One prompt per window of codebook 0: ``SOA stage_1 ids stage_2``; the remainder of the
    track is a row of its own."""
    row = F.get(F.col(codes), F.lit(0))
    n = F.ceil(F.size(row) / F.lit(float(window))).cast("int")
    windows = F.when(
        n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda w: F.slice(row, w * window + 1, window))
    )
    base = opts.bases[0]
    return df.select(key, F.posexplode(windows).alias("window", "__codes")).select(
        key,
        "window",
        F.concat(
            int_array([SOA, STAGE_1]), F.transform("__codes", lambda x: x + base), int_array([STAGE_2])
        ).alias("prompt"),
    )


def join_windows(df: DataFrame, key: str, window: str = "window", ids: str = "ids") -> DataFrame:
    """Window outputs of each track joined in order; a track is one row of the result, as it was
    one row before it was cut."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(window).alias("w"), F.col(ids).alias("ids"))))
    return df.groupBy(key).agg(F.flatten(parts["ids"]).alias(ids))


def row_modes(df: DataFrame, key: str, codes: str) -> DataFrame:
    """Most frequent code per track and codebook row; on ties the one seen first."""
    values = df.select(key, F.posexplode(codes).alias("k", "__row")).select(
        key, "k", F.posexplode("__row").alias("t", "code")
    )
    counts = values.groupBy(key, "k", "code").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"))
    best = F.max_by(F.struct("code", "n"), F.struct(F.col("n"), -F.col("first_t")))
    return counts.groupBy(key, "k").agg(best.alias("b")).select(key, "k", F.col("b.code").alias("mode"), F.col("b.n").alias("n"))


def row_mode(row: Column) -> Column:
    """Most frequent value of one array, ties to the value seen first, without a shuffle: runs
    of the sorted array are counted in one pass."""
    empty = F.array().cast("array<int>")
    state = F.struct(
        F.lit(None).cast("int").alias("v"), F.lit(0).alias("n"), F.lit(0).alias("best"), empty.alias("top")
    )

    def step(acc: Column, x: Column) -> Column:
        n = F.when(acc["v"] == x, acc["n"] + 1).otherwise(F.lit(1))
        top = (
            F.when(n > acc["best"], F.array(x)).when(n == acc["best"], F.concat(acc["top"], F.array(x))).otherwise(acc["top"])
        )
        return F.struct(
            x.alias("v"), n.alias("n"), F.greatest(n, acc["best"]).alias("best"), top.alias("top")
        )

    def pick(r: Column) -> Column:
        top = F.aggregate(F.sort_array(r), state, step, lambda acc: acc["top"])
        return F.get(r, (F.array_min(F.transform(top, lambda v: F.array_position(r, v))) - 1).cast("int"))

    return let(row, pick)


def repair_codes(codes: Column, max_code: int = MAX_CODE) -> Column:
    """Replace codes outside ``0..max_code`` by the most frequent code of the original row (which
    may itself be out of range). Rows without bad codes are passed through untouched."""

    def bad(x: Column) -> Column:
        return (x < 0) | (x > max_code)

    def fix(row: Column) -> Column:
        return let(row_mode(row), lambda m: F.transform(row, lambda x: F.when(bad(x), m).otherwise(x)))

    return F.transform(codes, lambda row: F.when(F.exists(row, bad), fix(row)).otherwise(row))
