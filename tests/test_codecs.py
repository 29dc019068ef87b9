import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import codecs as C
from tokenloom.functions import sequences as S

CASES = [("xcodec", 0, 8), ("xcodec", 1, 7), ("dac16k", 0, 4), ("dac44k", 0, 9), ("semanticodec", 0, 2), ("semanticodec", 1, 1), ("hubert", 0, 1)]


def _matrices(opts, n=20, seed=0):
    rng = np.random.default_rng(seed)
    return [
        np.stack([rng.integers(0, opts.spec.sizes[k], t) for k in range(opts.spec.num_codebooks)])
        for t in rng.integers(1, 30, n)
    ]


@pytest.mark.parametrize("codec,begin,n", CASES)
def test_ids_match_numpy_and_round_trip(spark, codec, begin, n):
    opts = C.CodecOptions(codec, begin, n)
    mats = _matrices(opts)
    df = spark.createDataFrame([(i, m.tolist()) for i, m in enumerate(mats)], "i int, m array<array<int>>")
    ids = C.codes_to_ids(F.col("m"), opts)
    rows = df.select("i", ids.alias("ids"), C.ids_to_codes(ids, opts).alias("back"), C.flatten_frames(C.offset_codes(F.col("m"), opts)).alias("two")).collect()
    for r in rows:
        part = mats[r.i][begin : begin + n]
        bases = opts.spec.global_offset + np.cumsum([0, *opts.spec.sizes])[begin : begin + n]
        want = (part + bases[:, None]).T.reshape(-1).tolist()
        assert r.ids == want == r.two
        assert np.array_equal(np.array(r.back), part)


def test_id_ranges_and_alias():
    assert C.get_codec("xcodec_16k") is C.CODECS["xcodec"]
    assert {n: c.id_range for n, c in C.CODECS.items()} == {
        "dac16k": (32022, 36117), "dac44k": (36118, 45333), "xcodec": (45334, 57621), "mert": (57622, 58645),
        "hubert": (58646, 59157), "semantic/s": (59158, 75541), "semantic/a": (75542, 83733), "semanticodec": (59158, 83733),
    }


def test_problems_are_named(spark):
    opts = C.CodecOptions("dac16k")
    good = [[1, 2]] * 4
    rows = [
        (good, None), ([[1, 2]] * 3, "codebook_count"), ([[1, 2], [1], [1, 2], [1, 2]], "ragged_codes"),
        ([[1, 1024]] + [[1, 2]] * 3, "code_out_of_range"), ([[-1, 2]] + [[1, 2]] * 3, "code_out_of_range"),
        ([], "empty_codes"), ([[], [], [], []], "empty_codes"), (None, "empty_codes"),
    ]
    df = spark.createDataFrame(rows, "m array<array<int>>, want string")
    for r in df.select("want", C.codes_problem(F.col("m"), opts).alias("got")).collect():
        assert r.got == r.want
    second = C.CodecOptions("semanticodec", 0, 1)
    got = spark.createDataFrame([([[1, 2]],)], "m array<array<int>>").select(C.codes_problem(F.col("m"), second)).first()[0]
    assert got == "codec_range"  # one layer alone is attributed to another codec


def test_training_fields_by_hand(spark):
    e = 32000
    df = spark.createDataFrame([([5, 6, e, 7, e],), ([e, e, 1],), ([],)], "x array<int>")
    rows = df.select(
        S.position_ids(F.col("x"), True).alias("p"), S.segment_ids(F.col("x")).alias("s"), S.loss_mask(F.col("x")).alias("m"), S.position_ids(F.col("x")).alias("q")
    ).collect()
    assert (rows[0].p, rows[0].s, rows[0].m, rows[0].q) == ([0, 1, 2, 0, 1], [0, 0, 0, 1, 1], [1.0, 1.0, 0.0, 1.0, 0.0], [0, 1, 2, 3, 4])
    assert (rows[1].p, rows[1].s) == ([0, 0, 0], [0, 1, 2])
    assert (rows[2].p, rows[2].s, rows[2].m) == ([], [], [])
    mask = df.limit(1).select(S.attention_mask(S.segment_ids(F.array(F.lit(1), F.lit(e), F.lit(2))))).first()[0]
    assert mask == [[0, 1, 1], [0, 0, 1], [1, 1, 0]]


def test_tail_and_bos(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "x array<int>")
    r = df.select(
        S.keep_last(F.col("x"), 2).alias("a"), S.keep_last(F.col("x"), 9).alias("b"), S.add_bos(F.col("x"), 1).alias("c"), S.add_bos(F.col("x"), 8).alias("d"),
        S.sub_sequence(F.col("x"), F.lit(1), F.lit(None)).alias("e"), S.tail_tokens(F.col("x"), 16381).alias("f"),
    ).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == ([2, 3], [1, 2, 3], [32000, 1, 2, 3], [8, 1, 2, 3], [2, 3], [2, 3])


def test_problems_by_least_and_greatest_codes(spark):
    """The reasons that a look at each code gives, also for rows that are null, empty, or hold nulls."""
    rows = [None, [], [None], [1, None], [-1], [1024], [1023, 0], [None, 2000], [5, 6]]
    cases = [[r] for r in rows] + [[a, b] for a in rows for b in rows] + [[a, b] * 6 for a in rows for b in rows] + [None, []]
    seen = set()
    for opts in (C.CodecOptions("xcodec", 0, 1), C.CodecOptions("xcodec", 1, 2), C.CodecOptions("xcodec", 0, 2)):

        sizes, m, k = C.int_array(opts.spec.sizes), F.col("m"), F.size("m")
        bad = F.exists(F.transform(m, lambda row, i: F.exists(row, lambda x: (x < 0) | (x >= F.get(sizes, i)))), lambda b: b)
        ids = C.codes_to_ids(m, opts)
        found = C.detect_codec(F.array_min(ids), F.array_max(ids))
        want = (
            F.when(m.isNull() | (F.coalesce(k, F.lit(0)) <= 0) | (C.n_frames(m) <= 0), "empty_codes")
            .when(~k.isin(12, opts.n_quantizer) | (k < opts.quantizer_begin + opts.n_quantizer), "codebook_count")
            .when(F.exists(m, lambda row: F.size(row) != C.n_frames(m)), "ragged_codes")
            .when(bad, "code_out_of_range")
            .when(F.coalesce(found != F.lit("xcodec"), F.lit(True)), "codec_range")
        )
        df = spark.createDataFrame([(i, m) for i, m in enumerate(cases)], "i int, m array<array<int>>")
        got = df.select("m", C.codes_problem(m, opts).alias("got"), want.alias("want")).collect()
        assert [r for r in got if r["got"] != r["want"]] == []
        seen |= {r["got"] for r in got}
    assert seen == {None, "empty_codes", "codebook_count", "ragged_codes", "code_out_of_range", "codec_range"}
