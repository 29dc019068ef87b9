"""In-context prompts against a plain loop that draws from the same hashes."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tokenloom.functions.codecs import CodecOptions
from tokenloom.functions.text import MARKERS
from tokenloom.operators import prompts as PR
from tokenloom.operators.tokenizer import WordTokenizer
from tokenloom.plans import encode as E

SEED, ONE = 11, CodecOptions("xcodec", 0, 1)


def _u(key, salt):
    return int(hashlib.md5(f"{SEED}{salt}:{key}".encode()).hexdigest()[:15], 16) / float(1 << 60)


def _length(u, seconds):
    xs, cdf = PR.length_distribution(seconds)
    i = sum(c <= u for c in cdf)
    if i == 0:
        return xs[0]
    if i >= 100:
        return xs[-1]
    return xs[i - 1] + (xs[i] - xs[i - 1]) * (u - cdf[i - 1]) / (cdf[i] - cdf[i - 1])


def _expected(key, first, last, ids, step, msa, fps, seconds):
    frames = last - first
    n = int(_length(_u(key, "length"), seconds) * fps) * step or int(fps * step)
    if n >= frames * step:
        n = frames * step // 2
    latest = max(frames * step - n, 0)
    pick = lambda lo, hi, salt: lo + math.floor(_u(key, salt) * max(hi - lo + 1, 1))
    starts = [pick(0, latest, f"try{i}") for i in range(6)]
    chorus = [s for s in msa if s[0] == "chorus"]
    if chorus:
        _, b, e = chorus[math.floor(_u(key, "chorus") * len(chorus))]
        lo = max(0, int(b * fps) - first) * step
        hi = min(frames, int(e * fps) - first) * step - n
        if hi > lo:
            starts[0] = pick(lo, hi, "try0")
    tries = [ids[s : s + n] for s in starts]
    return next((t for t in tries if len(set(t)) >= 0.1 * len(t)), tries[-1])


def _songs():
    out = []
    for i in range(30):
        T = 120 + 37 * i
        voc = [(t * t) % (3 if i % 4 == 0 and t > 40 else 900) for t in range(T)]
        inst = [(t * 7 + i) % 1000 for t in range(T)]
        segs = [("one", 1.4, 5 + i, 75), ("two words", 1.1, 75, T - i)]
        msa = [("verse", 0.0, 1.0)] + ([("chorus", 1.0 * (j + 1), 8.0 + j) for j in range(i % 3)])
        out.append((i, "pop", T / 50.0, segs, [voc], [inst], msa))
    return out


SCHEMA = (
    "doc_id long, genres string, audio_length_in_sec double, segments array<struct<line_content:string,duration:double,codec_frame_start:int,codec_frame_end:int>>,"
    " vocals_codec_matrix array<array<int>>, instrumental_codec_matrix array<array<int>>, msa array<struct<label:string,start:double,end:double>>"
)


@pytest.mark.parametrize("mode,seconds", [("vocal", 5.0), ("dual", 5.0), ("inst", 30.0), ("mixture", 5.0)])
def test_prompt_matches_a_loop(spark, mode, seconds):
    songs = _songs()
    df = spark.createDataFrame(songs, SCHEMA)
    got = df.select(
        "doc_id",
        PR.sample_prompt(
            F.col("doc_id"), F.col("segments"), F.col("vocals_codec_matrix"), F.col("instrumental_codec_matrix"), F.col("instrumental_codec_matrix"),
            F.col("msa"), F.lit(50.0), ONE, mode, seconds, SEED,
        ).alias("p"),
    )
    rows = {r.doc_id: r.p for r in got.collect()}
    for i, _, _, segs, (voc,), (inst,), msa in songs:
        first, last = segs[0][2], segs[-1][3]
        v, w = ([45334 + x for x in m[first:last]] for m in (voc, inst))
        ids = {"vocal": v, "inst": w, "mixture": w, "dual": [x for p in zip(v, w) for x in p]}[mode]
        assert rows[i] == _expected(i, first, last, ids, 2 if mode == "dual" else 1, msa, 50.0, seconds)


def test_icl_documents_hold_header_prompt_and_segments(spark):
    vocab = spark.createDataFrame([(m, i) for i, m in enumerate(MARKERS, 1)] + [("one", 5), ("pop", 6)], "token string, id int")
    cfg = E.EncodeConfig(ONE, instruction="one", use_audio_icl=True, cot=True, audio_prompt_seconds=5.0, seed=SEED)
    docs = E.encode(spark.createDataFrame(_songs(), SCHEMA), "doc_id", WordTokenizer(vocab), cfg).collect()
    for r, song in zip(sorted(docs, key=lambda r: r.doc_id), _songs()):
        assert r.reason is None and sum(r.lengths) == len(r.tokens) and r.tokens[-1] == 32000
        head = r.tokens[: r.lengths[0]]
        assert head[:3] == [5, 0, 6] and head[-1] == 4 and head.index(3) == 6
        assert head[7:9] == [32001, 32016] and head[-2] == 32002
        body = r.tokens[r.lengths[0] : sum(r.lengths[:2])]
        assert body[:2] == [1, 5] and body[-1] == 2


def test_unusable_lyric_range_is_reported(spark):
    song = list(_songs()[0])
    song[3] = [("x", 2.0, 60, 10), ("y", 2.0, 0, 55)]
    song[3][-1] = ("y", 2.0, 0, 50)
    vocab = spark.createDataFrame([("x", 5)], "token string, id int")
    cfg = E.EncodeConfig(ONE, use_audio_icl=True, cot=True)
    r = E.encode(spark.createDataFrame([tuple(song)], SCHEMA), "doc_id", WordTokenizer(vocab), cfg).first()
    assert (r.reason, r.tokens) == ("no_prompt", None)


def test_draws_stay_in_range(spark):
    u = spark.range(2000).select((F.col("id") / 1999.0).alias("u"))
    r = u.select(PR.sample_length(F.col("u")).alias("x")).agg(F.min("x"), F.max("x"), F.avg("x")).first()
    assert r[0] == 20.0 and r[1] == 40.0 and abs(r[2] - 30) < 0.2


def test_the_encoder_follows_the_configuration():
    name = lambda **kw: E.encoder_name(E.EncodeConfig(**kw))
    assert name() == name(use_audio_icl=True) == name(cot=True) == "segments"  # prompts need a header, a header needs interleaving
    assert name(interleave=True) == name(use_audio_icl=True, cot=True) == name(interleave=True, cot=True) == "interleaved"
    assert name(stage2=True, interleave=True) == "stage2"
    assert [name(unit=u) for u in E.UNITS] == list(E.UNITS)
    with pytest.raises(ValueError):
        name(unit="word")
