import json

from pyspark.sql import functions as F

from tokenloom.functions.codecs import CodecOptions
from tokenloom.operators import mixture as MX
from tokenloom.operators.pack import PackConfig
from tokenloom.operators.tokenizer import WordTokenizer
from tokenloom.plans import encode as E
from tokenloom.plans import manifest as MF
from tokenloom.sources.manifests import parse_manifest
from tokenloom.streaming.quarantine_stream import quarantine_stream, read_sink

ONE = CodecOptions("xcodec", 0, 1)


def _song(k, **other):
    segment = {"line_content": "one two", "duration": 2.0, "codec_frame_start": 0, "codec_frame_end": 100}
    song = {"id": f"s{k}", "genres": "pop", "audio_length_in_sec": 2.0, "vocals_codec": f"{k}.v.npy", "instrumental_codec": f"{k}.i.npy", "codec": f"{k}.v.npy",
            "splitted_lyrics": {"segmented_lyrics": [segment]}, "msa": []}
    return json.dumps({k: v for k, v in (song | other).items() if v is not None})


def _inputs(spark):
    lines = [_song(1), _song(2), _song(3, genres=None), _song(4, splitted_lyrics={"segmented_lyrics": []}), _song(5)[:-9], _song(6), "", _song(7, audio_length_in_sec=4.0)]
    matrix = [[t % 900 for t in range(100)]]
    codecs = [(f"{k}.{s}.npy", matrix) for k in (1, 2, 3, 4, 5, 7) for s in "vi"] + [("6.v.npy", matrix)]
    vocab = WordTokenizer(spark.createDataFrame([("one", 5), ("two", 6)], "token string, id int"))
    return spark.createDataFrame([(x,) for x in lines], "value string"), spark.createDataFrame(codecs, "path string, codec array<array<int>>"), vocab


WRONG = {"s3": "missing_keys", "s4": "no_segments", "s6": "missing_file", "s7": "frame_rate"}


def test_manifest_to_samples(spark):
    lines, codecs, tok = _inputs(spark)
    cfg = E.EncodeConfig(ONE, instruction="one", interleave=True)
    prepared = MF.prepare_manifest(lines, codecs, tok, cfg, F.concat(F.lit("set "), "genres"))
    docs = {r.id: r for r in prepared.documents.collect()}
    assert set(docs) == {"s1", "s2"} and {r.dataset for r in docs.values()} == {"set pop"}
    rejected = {(r.id, r.reason, r.line is not None) for r in prepared.rejected.collect()}
    assert rejected == {(k, v, False) for k, v in WRONG.items()} | {(None, "malformed", True)}
    samples = MF.manifest_samples(prepared, PackConfig(32, ties=("seq_no",))).collect()
    stream = [t for k in ("s1", "s2") for t in docs[k].tokens]
    assert sorted((r.sample, r.tokens) for r in samples) == [(i, stream[32 * i : 32 * i + 33]) for i in range((len(stream) - 1) // 32)]


def test_manifest_lines_are_parsed_once(spark, capsys):
    lines, codecs, tok = _inputs(spark)
    prepared = MF.prepare_manifest(lines, codecs, tok, E.EncodeConfig(ONE, instruction="one", interleave=True), F.lit("set"))
    assert [r.line for r in prepared.rejected.where("line is not null").collect()] == [_song(5)[:-9]]
    capsys.readouterr()
    prepared.rejected.explain()
    rows, bad = parse_manifest(lines, MF.manifest_schema(E.EncodeConfig()), save=True)
    rows.explain()
    bad.explain()
    plans = capsys.readouterr().out
    assert "Physical Plan" in plans and "from_json" not in plans
    again, worse = parse_manifest(lines, MF.manifest_schema(E.EncodeConfig()))
    assert sorted(map(str, rows.collect())) == sorted(map(str, again.collect())) and bad.collect() == worse.collect()


def test_streams_keep_rejects_apart_and_resume(spark, tmp_path):
    lines, codecs, tok = _inputs(spark)
    cfg = E.EncodeConfig(ONE, instruction="one", interleave=True)
    source, good, bad, state = (str(tmp_path / n) for n in ("in", "good", "bad", "state"))
    encode = lambda rows: MF.encode_songs(rows, codecs, tok, cfg)
    rows = [r.value for r in lines.collect()]
    for part in (rows[:3], rows[3:], []):
        if part:
            spark.createDataFrame([(x,) for x in part], "value string").coalesce(1).write.mode("append").text(source)
        quarantine_stream(spark, source, MF.manifest_schema(cfg), encode, good, bad, state).awaitTermination()
    assert sorted((r.id, r.batch_id) for r in read_sink(spark, good).collect()) == [("s1", 0), ("s2", 0)]
    assert {(r.id, r.reason) for r in read_sink(spark, bad).collect()} == set(WRONG.items()) | {(None, "malformed")}


def test_progress_is_told_per_interval(spark):
    said = []
    df = spark.range(0, 250, 1, 5).withColumn("n", F.lit(1 << 20).cast("bigint"))
    with MX.ProgressLog(spark, 100, said.append) as log:
        assert log.watch(df, F.col("n")).count() == 250
    assert [x.split(" (")[0] for x in said] == ["Processed 100 documents", "Processed 200 documents"]
    assert all("docs/s" in x and "MB/s" in x for x in said) and log.bytes.value == 250 << 20
    totals = MX.interval_totals(df, "id", F.col("n"), 100).orderBy("n_docs").collect()
    assert [tuple(r) for r in totals] == [(100, 100 << 20), (200, 200 << 20)]


def test_document_bytes(spark):
    df = spark.createDataFrame([("é", [[1, 2], [3, 4]], None)], "line string, a array<array<int>>, b array<array<int>>")
    assert df.select(MX.document_bytes(F.col("line"), F.col("a"), F.col("b"))).first()[0] == 2 + 8


def test_stream_encodes_a_batch_once(spark, tmp_path):
    """Two sinks are written from each batch; joins and encoding are done for one of them only."""
    from tokenloom.streaming.quarantine_stream import quarantine_stream, read_sink

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    spark.range(20).selectExpr("to_json(struct(cast(id as string) as id)) as value").write.text(f"{tmp_path}/lines")
    encode = lambda rows: rows.mapInArrow(count, "id string").selectExpr("id", "if(id % 4 = 0, 'fourth', null) as reason")
    good, bad = f"{tmp_path}/good", f"{tmp_path}/bad"
    quarantine_stream(spark, f"{tmp_path}/lines", "id string", encode, good, bad, f"{tmp_path}/state").awaitTermination()
    assert (read_sink(spark, good).count(), read_sink(spark, bad).count(), seen.value) == (15, 5, 20)


def test_a_part_moves_only_the_files_it_names(spark):
    from tokenloom.plans.encode import named_codecs

    codecs = spark.range(1000).selectExpr("concat('npy/', id) as path", "array(array(cast(id as int))) as codec")
    rows = spark.range(10).selectExpr("concat('npy/', id) as a", "if(id < 5, concat('npy/', id + 500), null) as b")
    got = {r.path for r in named_codecs(rows, codecs, ["a", "b"]).collect()}
    assert got >= {f"npy/{i}" for i in [*range(10), *range(500, 505)]} and len(got) < 30


def test_rows_move_once_to_their_matrices(spark, capsys):
    """Also rows that name no file, a missing one, the same files as others, or codes beyond 16 bits."""
    files = {"a": [[1, 2], [3, 4]], "b": [[70_000, -70_000]], "c": [[5, None]], "d": [], "e": [[-40_000], [1]], "f": [None, [1]], "g": None}
    names = [*files, "absent", None]
    rows = [(i, v, w, f"text {i}") for i, (v, w) in enumerate([(v, w) for v in names for w in names] + [("a", "b")] * 3 + [(None, None)] * 2)]
    manifest = spark.createDataFrame(rows, "id int, v string, w string, lyrics string")
    codecs = spark.createDataFrame(list(files.items()), "path string, codec array<array<int>>")
    for columns in (["v", "w"], ["v"], []):
        got = E.attach_codecs(manifest, codecs, columns)
        assert got.columns == [*manifest.columns, *(f"{c}_matrix" for c in columns)] and all(got.schema[f"{c}_matrix"].dataType == codecs.schema["codec"].dataType for c in columns)
        where = {"v": 1, "w": 2}
        assert sorted(tuple(r) for r in got.select("id", *[F.to_json(f"{c}_matrix") for c in columns]).collect()) == sorted(
            (r[0], *(None if files.get(r[where[c]]) is None else json.dumps(files[r[where[c]]], separators=(",", ":")) for c in columns)) for r in rows
        )
    capsys.readouterr()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        E.attach_codecs(manifest, codecs, ["v", "w"]).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moves = [p for p in capsys.readouterr().out.split("\n\n") if ") Exchange\n" in p and "lyrics" in p]
    assert len(moves) == 1
