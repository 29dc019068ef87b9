import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions.codecs import CodecOptions
from tokenloom.operators import tracks as TR
from tokenloom.operators import wave as W
from tokenloom.operators.mixture import parse_count_logs
from tokenloom.plans import encode as E
from tokenloom.plans import training as TN
from tokenloom.operators import blend as B
from tokenloom.operators import pack as P
from tokenloom.sources import codec_files as C
from tokenloom.sources import manifests as M
from tokenloom.sources import store as ST
from tokenloom.sources.files import write_files
from tokenloom.streaming.encode_stream import encode_stream
from tokenloom.operators.tokenizer import WordTokenizer


def test_npy_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    a = np.arange(8, dtype=np.int16).reshape(2, 4)
    np.save(tmp_path / "sub" / "a.npy", a)
    (tmp_path / "bad.npy").write_bytes(b"nothing")
    (tmp_path / "note.txt").write_text("x")
    got = {r.path.rsplit("/", 1)[1]: r.codec for r in C.read_codec(spark, str(tmp_path)).collect()}
    assert got == {"a.npy": a.tolist(), "bad.npy": None}
    listed = M.list_files(spark, str(tmp_path), [".NPY"]).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in listed) == ["a.npy", "bad.npy"]


def test_npy_forms(spark, tmp_path):
    a = np.arange(-6, 6).reshape(3, 4)
    forms = {
        "f.npy": np.asfortranarray(a), "b.npy": a.astype(">i8"), "u.npy": np.abs(a).astype(np.uint64), "e.npy": np.zeros((0, 5), np.int16), "t.npy": np.zeros((4, 0), np.int8),
        "r.npy": a.astype(np.int64) * 2**40, "c.npy": a.astype(float), "s.npy": a.reshape(3, 2, 2), "o.npy": np.array(["x"]), "z.npy": np.array(5),
    }
    for name, x in forms.items():
        np.save(tmp_path / name, x)
    (tmp_path / "cut.npy").write_bytes((tmp_path / "b.npy").read_bytes()[:-1])
    (tmp_path / "none.npy").write_bytes(b"")
    got = {r.path.rsplit("/", 1)[1]: (r.codec, r.problem) for r in C.read_codec(spark, str(tmp_path)).collect()}
    fine = {n: (forms[n].tolist(), None) for n in ("f.npy", "b.npy", "u.npy", "e.npy", "t.npy")}
    wrong = {"r.npy": "range", "c.npy": "type", "s.npy": "shape", "o.npy": "type", "z.npy": "shape", "cut.npy": "unreadable"}
    assert got == fine | {n: (None, p) for n, p in wrong.items()}


def test_files_round_trip(spark, tmp_path):
    rows = [(f"d{k % 3}/{k}.npy", [[k, k + 1], [5, 6]]) for k in range(20)] + [("none.npy", None), ("wide.npy", [[]])]
    df = spark.createDataFrame(rows, "name string, m array<array<int>>")
    out = write_files(df.select("name", C.encode_npy(F.col("m"), "int32").alias("content")), str(tmp_path / "f")).collect()
    assert sorted(r.path for r in out) == sorted(f"{tmp_path}/f/{n}" for n, _ in rows)
    got = {r.path.split("/f/")[1]: (r.codec, r.problem) for r in C.read_codec(spark, str(tmp_path / "f")).collect()}
    assert got == {n: (m, None) for n, m in rows if m is not None}  # empty files are passed over
    assert not [p for p in (tmp_path / "f").rglob("*.part")]
    for wrong in ([[1 << 20]], [[1, 2], [3]]):
        with pytest.raises(Exception, match="fit|differ"):
            spark.createDataFrame([(wrong,)], "m array<array<int>>").select(C.encode_npy(F.col("m"))).collect()


def test_point_reads(spark, tmp_path):
    rows = [(n, k, [k, k + 1]) for n in ("a b", "x=1/y", "c%20d") for k in range(0, 400, 2)]
    path = str(tmp_path / "store")
    ST.write_sequences(spark.createDataFrame(rows, "dataset string, doc_id long, tokens array<int>"), path, cluster="doc_id", files=30)
    asked = spark.createDataFrame([("a b", 10), ("a b", 11), ("x=1/y", 398), ("c%20d", 0), ("unknown", 4), (None, 4), ("a b", None)], "dataset string, doc_id long")
    files = ST.read_requested(spark, path, asked)
    assert 3 <= len(files.inputFiles()) <= 4 and len(ST.read_sequences(spark, path).inputFiles()) >= 30
    requests = asked.withColumns({"offset": F.lit(0), "length": F.lit(1)})
    got = sorted(((r.dataset, r.doc_id, r.tokens) for r in ST.take_sequences(files, requests).collect()), key=repr)
    assert got == sorted([("a b", 10, [10]), ("a b", 11, None), ("x=1/y", 398, [398]), ("c%20d", 0, [0]), ("unknown", 4, None), (None, 4, None), ("a b", None, None)], key=repr)
    assert ST.read_requested(spark, path, asked.where("dataset = 'unknown'")).count() == 0
    assert ST.read_requested(spark, path, spark.createDataFrame(rows, "dataset string, doc_id long, t array<int>")).count() == len(rows)


def test_manifest_modes(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"id":"a","n":1}\n{"id":"b","n"\n\n{"id":"c"}\n')
    path, schema = str(tmp_path / "m.jsonl"), "id string, n int"
    good, bad = M.read_manifest(spark, path, schema, "quarantine")
    assert [tuple(r) for r in good.collect()] == [("a", 1), ("c", None)]
    assert [r.line for r in bad.collect()] == ['{"id":"b","n"']
    assert M.read_manifest(spark, path, schema, "skip").count() == 2
    with pytest.raises(Exception):
        M.read_manifest(spark, path, schema).collect()


def test_store_keeps_number_like_names(spark, tmp_path):
    df = spark.createDataFrame([("007", 1, [1, 2]), ("7", 2, [3])], "dataset string, doc_id long, tokens array<int>")
    ST.write_sequences(df, str(tmp_path / "s"))
    back = ST.read_sequences(spark, str(tmp_path / "s"))
    assert sorted((r.dataset, r.n_tokens, r.mode) for r in back.collect()) == [("007", 2, 0), ("7", 1, 0)]
    assert ST.read_sequences(spark, str(tmp_path / "s"), ["007"]).count() == 1
    assert ST.slice_sequences(back, "doc_id", 2, 9).count() == 1
    with pytest.raises(TypeError):
        ST.append_stores([df, df.withColumn("doc_id", F.col("doc_id").cast("int"))])
    assert ST.narrowest_type(65499) == "uint16" and ST.narrowest_type(65500) == "int32" == ST.narrowest_type(None)


def test_count_logs(spark, tmp_path):
    (tmp_path / "count_a.log").write_text("x\nCounting tokens in  ./a.bin\nTotal number of tokens:  12\n")
    (tmp_path / "other.log").write_text("Counting tokens in  ./b.bin\nTotal number of tokens:  3\n")
    from tokenloom.operators.mixture import parse_count_logs

    rows = parse_count_logs(ST.read_count_logs(spark, str(tmp_path))).collect()
    assert [tuple(r) for r in rows] == [("./a.bin", 12)]
    (tmp_path / "count_b.log").write_text("Counting tokens in  ./b.bin\n 10%")
    (tmp_path / "count_c.log").write_text("")
    (tmp_path / "count_d.log").write_text("Total number of tokens:  7\n")
    logs = ST.read_count_logs(spark, str(tmp_path))
    good, bad = parse_count_logs(logs, on_error="quarantine", file="file")
    assert [tuple(r) for r in good.collect()] == [("count_a.log", "./a.bin", 12)]
    assert sorted(tuple(r) for r in bad.collect()) == [("count_b.log", "no token total"), ("count_c.log", "no path"), ("count_d.log", "no path")]
    with pytest.raises(Exception, match="a token-count log has no"):
        parse_count_logs(logs).collect()


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "token string, id int")
    tok, cfg = WordTokenizer(vocab), E.EncodeConfig()
    encode = lambda df: E.encode_documents(df, "text", tok, cfg)
    schema, src = "doc_id long, text string", tmp_path / "in"
    src.mkdir()
    run = lambda: encode_stream(spark, str(src), schema, encode, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    (src / "1.json").write_text('{"doc_id":1,"text":"a b"}\n{"doc_id":2,"text":""}\n')
    run()
    (src / "2.json").write_text('{"doc_id":3,"text":"b zz"}\n')
    run()
    run()
    key = lambda df: sorted((r.doc_id, r.tokens, r.lengths) for r in df.collect())
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(encode(spark.read.schema(schema).json(str(src)))) == [
        (1, [1, 2, 32000], [3]), (2, [], []), (3, [2, 0, 32000], [3]),
    ]


def test_wave_fallback_and_chunks(spark):
    rows = [("long", i) for i in range(10)] + [("short", i) for i in range(2)]
    df = spark.createDataFrame(rows, "track string, idx long")
    got = sorted((r.track, r.idx, r.segment) for r in W.chunk_wave(df, 4, 3).collect() if r.track == "long")
    assert got == [("long", i, i // 4 + 1) for i in range(8)]
    assert sorted((r.idx, r.segment) for r in W.chunk_wave(df, 4, 3).collect() if r.track == "short") == [(0, None), (1, None)]


def test_trim_silence_by_loop(spark):
    rng = np.random.default_rng(5)
    amp = rng.normal(size=200) * np.where((np.arange(200) // 30) % 2, 0.001, 1.0)
    padded = np.concatenate([np.zeros(8), amp, np.zeros(8)])
    energy = np.array([np.sum(padded[t * 5 : t * 5 + 16] ** 2) for t in range(200 // 5 + 1)])
    keep = {i for i in range(200) if energy[i // 5] > energy.max() * 0.01}
    df = spark.createDataFrame([("x", i, float(a)) for i, a in enumerate(amp)], "track string, idx long, amp double")
    assert {r.idx for r in W.trim_silence(df, frame=16, hop=5).collect()} == keep


def test_repair_and_mode(spark):
    rows = [([[5, 9, 9, 5, 2000], [1, 2, 3, 4, 4]],), ([[-1, -1, 7, 7, -1]],)]
    df = spark.createDataFrame(rows, "c array<array<int>>")
    got = [r.c for r in df.select(TR.repair_codes(F.col("c")).alias("c")).collect()]
    assert got == [[[5, 9, 9, 5, 5], [1, 2, 3, 4, 4]], [[-1, -1, 7, 7, -1]]]


def test_tracks_by_hand(spark):
    o = CodecOptions("xcodec", 0, 1)
    ids = [9, 32001, 32016, 45334, 45335, 45336, 32002, 3, 32001, 45340, 45341, 32002]
    df = spark.createDataFrame([(ids,), (ids + [32001],)], "x array<int>")
    rows = TR.extract_tracks(df, "x", o).collect()
    assert (rows[0].vocals, rows[0].instrumental, rows[0].problem) == ([[0, 6]], [[1, 7]], None)
    assert (rows[1].vocals, rows[1].problem) == (None, "unpaired_audio")


def test_batches_and_windows(spark):
    df = spark.createDataFrame([("a", 950), ("b", 1200), ("c", 10)], "t string, n int")
    rows = TR.plan_batches(df, "n", 2).collect()
    assert [(r.t, r.piece, r.begin, r.end, r.windows) for r in rows] == [
        ("a", 0, 0, 600, 2), ("a", 1, 600, 900, 1), ("a", 2, 900, 950, 0), ("b", 0, 0, 600, 2), ("b", 1, 600, 1200, 2), ("c", 0, 0, 10, 0),
    ]


def _seqs(spark):
    rows = [(n, i, [100 * j + i] * (i % 7 + 1), i % 7 + 1) for j, (n, c) in enumerate({"a": 60, "b": 20}.items()) for i in range(c)]
    return spark.createDataFrame(rows, "dataset string, doc_id long, tokens array<int>, n_tokens int")


@pytest.mark.parametrize("mode", ["balanced", "exact"])
@pytest.mark.parametrize("shuffle", [True, False])
def test_training_splits(spark, mode, shuffle):
    seqs, cfg, blend = _seqs(spark), P.PackConfig(8), B.Blend(("a", "b"), (3, 1))
    splits = TN.build_splits(spark, seqs, blend, [(0.0, 0.8), (0.8, 1.0), None], {"train": 40, "valid": 9}, cfg, mode, shuffle)
    assert list(splits) == ["train", "valid"]
    for name, target in (("train", 40), ("valid", 9)):
        rows = sorted(splits[name].collect())
        sizes = [B.request_size(target, s) for s in blend.shares]
        assert [r.sample_idx for r in rows] == list(range(sum(sizes)))
        assert all(len(r.tokens) == 9 for r in rows)
        for d, (ds, c) in enumerate((("a", 60), ("b", 20))):
            ks = sorted(r.dataset_sample_idx for r in rows if r.dataset_id == d)
            assert ks == list(range(len(ks)))
            docs = {x for r in rows if r.dataset_id == d for x in r.doc_ids}
            assert all((x < 0.8 * c) == (name == "train") for x in docs)


def test_empty_split_of_a_drawn_dataset_is_reported(spark):
    blend = B.Blend(("a", "b"), (3, 1))
    with pytest.raises(ValueError, match="without tokens"):
        TN.build_splits(spark, _seqs(spark), blend, [(0.0, 0.99), None, (0.99, 1.0)], {"test": 9}, P.PackConfig(8))


def test_unknown_requests_stay(spark):
    requests = spark.createDataFrame([(3, 1, 2), (999, 0, None)], "doc_id long, offset int, length int")
    store = _seqs(spark).where("dataset = 'a'")
    got = {r.doc_id: r.tokens for r in ST.take_sequences(store, requests).collect()}
    assert got == {3: [3, 3], 999: None}
    with pytest.raises(ValueError, match="without dataset"):
        ST.take_sequences(_seqs(spark), requests)


def test_repeated_and_single_prefixes(spark):
    seqs, cfg = _seqs(spark), P.PackConfig(8)
    lengths = seqs.select("dataset", "doc_id", "n_tokens")
    rows = TN.build_split(spark, lengths, seqs, B.parse_blend("0.5 a 1 b 0.25 a"), 20, cfg).collect()
    counts = {d: sorted(r.dataset_sample_idx for r in rows if r.dataset_id == d) for d in range(3)}
    assert {d: len(v) for d, v in counts.items()} == {0: 6, 1: 12, 2: 3} and all(v == list(range(len(v))) for v in counts.values())
    first, third = ({r.dataset_sample_idx: r.tokens for r in rows if r.dataset_id == d} for d in (0, 2))
    assert all(x < 100 for t in [*first.values(), *third.values()] for x in t)  # both draw from a
    alone = TN.build_split(spark, lengths, seqs, B.parse_blend("b"), 7, cfg, shuffle=False).collect()
    assert sorted((r.sample_idx, r.dataset_sample_idx) for r in alone) == [(k, k) for k in range(7)]


def test_one_blend_per_split(spark):
    seqs, cfg = _seqs(spark), P.PackConfig(8)
    out = TN.build_splits(spark, seqs, {"train": B.Blend(("a",), (1,)), "test": B.Blend(("b",), (1,))}, [], {"train": 5, "test": 4}, cfg)
    assert {n: len({r.dataset_id for r in d.collect()}) for n, d in out.items()} == {"train": 1, "test": 1}


def test_tables_are_read_in_their_parts(spark, tmp_path):
    """A table in a few files with many row groups is not moved at each read; one part only is spread."""
    from tokenloom.catalog import fixtures as X

    spark.range(4000).selectExpr("id as doc_id", "repeat('x', 500) as text").repartition(1).write.parquet(f"{tmp_path}/one.parquet")
    spark.range(4000).selectExpr("id as doc_id", "repeat('x', 500) as text").repartition(3).write.parquet(f"{tmp_path}/three.parquet")
    moved = {n: "RepartitionByExpression" in X.table(spark, str(tmp_path), n)._jdf.queryExecution().optimizedPlan().toString() for n in ("one", "three")}
    assert moved == {"one": True, "three": False}


def test_appended_stores_are_read_twice(spark, tmp_path):
    """Once to number the documents and once for the result, whatever the stores are derived from."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    store = spark.range(10).selectExpr("id as doc_id", "'a' as dataset").mapInArrow(count, "doc_id bigint, dataset string")
    got = ST.append_stores([store, store]).collect()
    assert sorted(r.new_id for r in got) == list(range(20)) and seen.value == 40


def test_saved_tables_are_packed(spark):
    from tokenloom.session import materialize

    saved = materialize(spark.range(1000), "packed")
    assert saved.count() == 1000 and all(".zstd." in f for f in saved.inputFiles())
