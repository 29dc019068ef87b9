"""Inputs at the edges that used to lose rows without an error."""

import io

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tokenloom.operators import blend as B
from tokenloom.operators import tokenizer as T
from tokenloom.operators import validate as V
from tokenloom.sources.codec_files import decode_npy


def test_real_weights_keep_their_ratio(spark):
    blend = B.collect_blend(spark.createDataFrame([("a", 0.5), ("b", 3.9), ("c", 0.0)], "dataset string, weight double"))
    assert blend.weights == (5, 39, 0)
    assert B.whole_weights(["30", "70"]) == (30, 70) and B.whole_weights([10**17, 1]) == (10**17, 1)
    drawn = dict(B.blend_schedule(spark, blend, 88).groupBy("dataset_id").count().collect())
    assert drawn == {0: 10, 1: 78}
    for bad in ([None], ["x"], [-1]):
        with pytest.raises(ValueError):
            B.whole_weights(bad)


def test_missing_sample_is_an_error(spark):
    schedule = spark.createDataFrame([(0, 0, 0), (1, 0, 1)], "sample_idx bigint, dataset_id smallint, dataset_sample_idx bigint")
    samples = spark.createDataFrame([(0, 0, "x")], "dataset_id int, sample bigint, tokens string")
    assert B.lookup_blended(schedule.limit(1), samples).count() == 1
    with pytest.raises(PySparkException, match="no sample for draw 0/1"):
        B.lookup_blended(schedule, samples).collect()


def test_codec_files_are_judged_as_stored(spark):
    def npy(x):
        buffer = io.BytesIO()
        np.save(buffer, x)
        return bytearray(buffer.getvalue())

    arrays = {"good": np.array([[1, 2]]), "wide": np.array([[2**33]]), "real": np.array([[0.2, 5.9]]), "flat": np.array([1, 2])}
    df = spark.createDataFrame([(k, npy(v)) for k, v in arrays.items()] + [("junk", bytearray(b"x"))], "path string, content binary")
    assert {r.path: r.codec for r in decode_npy(df).collect()} == {"good": [[1, 2]], "wide": None, "real": None, "flat": None, "junk": None}


def test_specials_win_over_corpus_words(spark):
    df = spark.createDataFrame([(1, "a <EOD> b <EOD> <EOD>")], "k long, text string")
    vocab = T.build_vocab(df, "text")
    assert "<EOD>" not in {r.token for r in vocab.collect()}
    shadow = vocab.unionByName(spark.createDataFrame([("<EOD>", 1)], "token string, id int"))
    eod = T.SPECIAL_TOKENS["<EOD>"]
    for v in (vocab, shadow):
        ids = T.tokenize(df, "text", T.WordTokenizer(v)).first().tokens
        assert [ids[1], ids[3], ids[4]] == [eod] * 3 and len(ids) == 5


def test_stems_are_compared_one_after_another(spark):
    def stems(*n):
        return tuple([[0] * k] for k in n)

    df = spark.createDataFrame([(1, *stems(110, 100, 95)), (2, *stems(100, 100, 80)), (3, *stems(111, 100, 100))], "k int, v array<array<int>>, i array<array<int>>, m array<array<int>>")
    out, far = V.reconcile_stems(df, "v", "i", "m")
    got = {r.k: (r.far, r.n) for r in out.select("k", far.alias("far"), F.transform(F.array("v", "i", "m"), lambda x: F.size(x[0])).alias("n")).collect()}
    assert got == {1: (False, [95, 95, 95]), 2: (True, [100, 100, 80]), 3: (True, [111, 100, 100])}
