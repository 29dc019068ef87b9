import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.functions.codecs import SPECIAL_TOKENS
from tokenloom.operators import mixture as MX
from tokenloom.operators import split as SP
from tokenloom.operators import tokenizer as TK

TEXTS = ["a b a", "b<SOA>c <xcodec><EOA> a", "<EOD>", "", "  zz\n\ta  ", "a<EOD", "<EOA> <EOA>b"]


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "token string, id int")


def _loop(text, vocab):
    """Cut at the leftmost special token, again and again."""
    ids = []
    while True:
        hits = {t: text.index(t) for t in SPECIAL_TOKENS if t in text}
        if not hits:
            return ids + [vocab.get(w, 0) for w in text.split()]
        first = min(hits, key=hits.get)
        ids += [vocab.get(w, 0) for w in text[: hits[first]].split()] + [SPECIAL_TOKENS[first]]
        text = text[hits[first] + len(first) :]


def test_tokenize_cuts_specials_first(spark, vocab):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i long, t string")
    tok = TK.WordTokenizer(vocab)
    words = {"a": 1, "b": 2, "c": 3}
    got = {r.i: r.tokens for r in TK.tokenize(df, "t", tok).collect()}
    joined = {r.i: r.tokens for r in TK.tokenize_by_join(df, "i", "t", vocab).collect()}
    assert got == joined == {i: _loop(t, words) for i, t in enumerate(TEXTS)}
    nested = df.agg(F.sort_array(F.collect_list(F.struct("i", "t"))).alias("x")).select(tok.nested_text_ids(F.col("x.t")).alias("n")).first().n
    assert nested == [got[i] for i in range(len(TEXTS))]


def test_detokenize_pads_specials(spark, vocab):
    df = spark.createDataFrame([([1, 2, 32001, 3, 99],), ([32000, 32000],), ([],)], "ids array<int>")
    got = [r.text for r in TK.detokenize(df, "ids", TK.WordTokenizer(vocab)).collect()]
    assert got == ["a b <SOA> c <unk>", " <EOD>  <EOD> ", ""]


def test_batch_tokenizer_plugs_in(spark):
    tok = TK.BatchTokenizer(lambda: lambda texts: [[len(w) for w in t.split()] for t in texts], 100)
    df = spark.createDataFrame([("one three", ["x", "yy z"])], "t string, n array<string>")
    r = df.select(tok.text_ids(F.col("t")).alias("a"), tok.nested_text_ids(F.col("n")).alias("b")).first()
    assert (r.a, r.b) == ([3, 5], [[1], [2, 1]])


def test_vocab_order_and_reserved(spark):
    df = spark.createDataFrame([("b a b c a [m]",)], "t string")
    rows = TK.build_vocab(df, "t", size=4, reserved=("[m]",)).collect()
    assert {r.token: r.id for r in rows} == {"[m]": 1, "a": 2, "b": 3}


def test_sections_prompts_and_strip(spark):
    lyrics = "intro [verse]\n one\n\n[chorus]  two[bridge][été] last\n"
    df = spark.createDataFrame([(lyrics,)], "l string")
    s = T.split_sections(F.col("l"))
    r = df.select(s.alias("s"), T.build_prompts(F.lit(" pop \n"), s).alias("p"), T.limit_sections(T.build_prompts(F.lit("x"), s), s, 1).alias("n")).first()
    assert r.s == ["[verse]\none\n\n", "[chorus]\ntwo\n\n", "[bridge]\n\n\n", "[été]\nlast\n\n"]
    assert r.p[0].startswith(T.LYRICS_INSTRUCTION + "\n[Genre] pop\n[verse]\none") and len(r.p) == 5
    assert len(r.n) == 2


def test_sentences(spark):
    df = spark.createDataFrame([("One. Two!\n\nThree?x four",)], "t string")
    r = df.select(
        T.split_sentences(F.col("t")).alias("a"), T.split_sentences(F.col("t"), keep_newlines=True).alias("b"), T.split_sentences(F.col("t"), False).alias("c")
    ).first()
    assert r.a == ["One.", "Two!", "Three?x four"] and "".join(r.b) == "One. Two!\n\nThree?x four" and len(r.c) == 1


def test_sentences_of_a_long_text(spark):
    """No sentence ends where a text passes a million characters."""
    text = "One. " + "word " * 220_000 + "end. Two."
    r = spark.createDataFrame([(text,)], "t string").select(T.split_sentences(F.col("t")).alias("a"), T.split_sentences(F.col("t"), keep_newlines=True).alias("b")).first()
    assert r.a == ["One.", text[5:-5], "Two."] and "".join(r.b) == text and len(r.b) == 3


def test_names(spark):
    files = ["d/My Song.Vocals.WAV", "x.inst.mp3", "a/b.c/full", "Vocal_take.flac"]
    df = spark.createDataFrame([(f,) for f in files], "f string")
    f = F.col("f")
    rows = df.select(T.track_key(f), T.track_type(f), T.extension(f), T.without_extension(f)).collect()
    assert [tuple(r) for r in rows] == [
        ("My Song", "Vocals", ".wav", "d/My Song.Vocals"), ("x", "Instrumental", ".mp3", "x.inst"),
        ("full", "Full", "", "a/b.c/full"), ("Vocal_take", "Vocals", ".flac", "Vocal_take"),
    ]


def test_dropout_rates(spark):
    df = spark.range(4000).withColumn("t", F.lit("x"))
    n = df.where(T.instruction_dropout(F.col("t"), "I", 0.25, 3, F.col("id")) == "x").count()
    assert abs(n / 4000 - 0.25) < 0.03


def test_split_bounds():
    assert SP.split_bounds("960,30,10")[0] == (0.0, 0.96)
    assert SP.split_bounds("1") == [(0.0, 1.0), None, None]
    assert SP.split_bounds([0.99, 0.01, 0.0], [0.98, 0.02, 0.0]) == [(0.0, 0.98), (0.99, 1.0), None]
    assert SP.split_ratios("8,1,1") == (0.8, 0.1, 0.1) and SP.split_ratios("oops") == SP.FALLBACK_RATIOS
    with pytest.raises(ValueError):
        SP.split_bounds("1,2,3,4")


def test_split_covers_every_row_once(spark):
    df = spark.range(1003).withColumn("g", F.when(F.col("id") % 10 < 8, "hot").otherwise("cold"))
    rows = SP.assign_split(df, SP.split_bounds("7,2,1"), "id", ["g"]).groupBy("g", "split").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).collect()
    assert sum(r.n for r in rows) == 1003
    for g in ("hot", "cold"):
        spans = sorted((r.a, r.b) for r in rows if r.g == g)
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_billions_and_missing_counts(spark):
    df = spark.createDataFrame([(806001459,)], "n long")
    r = df.select(MX.format_billions(F.col("n")).alias("t"), MX.parse_billions(MX.format_billions(F.col("n"))).cast("long").alias("p")).first()
    assert (r.t, r.p) == ("0.806B", 806000000)
    rounds = spark.createDataFrame([(1.0, "a.bin"), (1.0, "a.bin"), (2.5, "b.bin")], "rounds double, path string")
    counts = spark.createDataFrame([("a.bin", 10)], "path string, n_tokens long")
    found, missing = MX.mixture_table(rounds, counts)
    assert found.count() == 1 and [r.path for r in missing.collect()] == ["b.bin"]


def test_models_get_bounded_pieces_of_a_batch():
    import pyarrow as pa

    seen = []

    def model(texts):
        seen.append(sum(len(t) for t in texts))
        return [[len(t)] * 3 for t in texts]

    texts = ["x" * (1 + i % 7 * 100_000) for i in range(40)] + [""] * 5
    got = TK._encoded(model, pa.array(texts))
    assert got.to_pylist() == [[len(t)] * 3 for t in texts]
    assert len(seen) > 5 and max(seen) < TK.MODEL_BYTES + 700_001
    assert TK._encoded(model, pa.array([], pa.string())).to_pylist() == [] and TK._encoded(model, pa.array(["a", ""]).slice(1)).to_pylist() == [[0] * 3]


def test_join_keeps_the_words_of_a_text_together(spark, vocab):
    df = spark.createDataFrame([(i, "a b zz " * i) for i in range(50)], "i long, t string")
    out = TK.tokenize_by_join(df, "i", "t", vocab, slices=3)
    assert {r.i: r.tokens for r in out.collect()} == {i: [1, 2, 0] * i for i in range(50)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and plan.count("Generate explode") <= 1


def test_words_split_at_the_four_blanks_only(spark):
    df = spark.createDataFrame([(1, " a b\t\tc\r\nd\x0be "), (2, None), (3, "")], "i int, t string")
    got = {r.i: r.w for r in df.select("i", TK.words(F.col("t")).alias("w")).collect()}
    assert got == {1: ["a b", "c", "d\x0be"], 2: None, 3: []}


def test_words_of_a_batch_by_byte_masks(spark, vocab, capsys):
    odd = [None, "", " ", "a", " a", "a ", "a\tb\r\nc", "é\u00a0ü  漢字\x0bx", "\n\n", "last", None, "x" * 50 + " y"]
    want = [re.findall(r"[^ \n\t\r]+", t or "") for t in odd]
    for texts in (pa.array(odd), pa.array(["skipped", *odd, "cut off"]).slice(1, len(odd)), pa.array(odd, pa.large_string())):
        assert TK.split_words(texts).to_pylist() == want
    assert TK.split_words(pa.array([], pa.string())).to_pylist() == [] == TK.split_words(pa.array([None], pa.string())).to_pylist()[0]
    plain = TK.WordTokenizer(vocab)
    docs = spark.createDataFrame([(t, [t, "b a"]) for t in odd], "t string, ts array<string>")
    got = docs.select(plain.text_ids(F.col("t")), plain.nested_text_ids(F.col("ts"))).collect()
    assert [tuple(r) for r in got] == [([{"a": 1, "b": 2, "c": 3}.get(x, 0) for x in w], [[{"a": 1, "b": 2, "c": 3}.get(x, 0) for x in w], [2, 1]]) for w in want]
    # Words are counted and looked up where the texts are: no row per word, no list of words between JVM and Python.
    TK.build_vocab(docs, "t").explain("extended")
    docs.select(plain.text_ids(F.col("t")).alias("i")).explain()
    plan = capsys.readouterr().out
    assert "array_remove" not in plan and "split(" not in plan


def test_words_are_added_up_within_bounds(monkeypatch):
    texts = [f"w{i % 7} w{i} w{i % 3}\n" for i in range(200)]
    want = Counter(w for t in texts for w in t.split())
    for limit, size in ((1 << 20, 1 << 20), (16, 40), (500, 64)):
        monkeypatch.setattr(TK, "COUNTED_WORDS", limit)
        monkeypatch.setattr(TK, "SPLIT_BYTES", size)
        parts = list(TK._count_words(pa.RecordBatch.from_arrays([pa.array(texts[i : i + 50])], names=["t"]) for i in range(0, 200, 50)))
        got = Counter()
        for b in parts:
            for word, n in zip(b["token"].to_pylist(), b["n"].to_pylist()):
                got[word] += n
        assert got == want
        assert sum(b.num_rows for b in parts) == len(want) or limit < 1 << 20
    assert list(TK._count_words(iter([]))) == []
