import uuid

import __spark_entry__ as entry
import corpus_pipeline
from tokenloom import session


def test_stages(spark, data_dir):
    docs = corpus_pipeline.documents(spark, data_dir)
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, data_dir), name)
        assert docs.columns == corpus_pipeline.COLUMNS and 0 < docs.count() <= n
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data_dir)
    assert packed.select("doc_id").distinct().count() == n


def row_keys(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_rules_null_and_repeated_ids(spark, data_dir):
    good = "the quick brown fox jumps over one lazy dog near that quiet river bank"
    rows = [(None, good), (1, good), (1, "too short"), (2, "a b"), (None, None)]
    assert row_keys(corpus_pipeline.quality_rules(spark, table_of(spark, rows), data_dir)) == sorted([(None, good), (1, good)], key=repr)


def test_classifier_null_and_repeated_ids(spark, data_dir):
    docs = corpus_pipeline.documents(spark, data_dir).where("text is not null")
    every = {r.text for r in docs.select("text").collect()}
    kept = {r.text for r in corpus_pipeline.quality_classifier(spark, docs, data_dir).select("text").collect()}
    good, bad = min(kept), min(every - kept)
    rows = [(None, good), (None, bad), (1, good), (1, bad)]
    assert row_keys(corpus_pipeline.quality_classifier(spark, table_of(spark, rows), data_dir)) == sorted([(None, good), (1, good)], key=repr)


def test_one_row_of_each_component(spark, data_dir):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(3, a), (3, a), (None, a), (2, a + " end"), (2, a + " end"), (3, b), (2, b + " end"), (2, b + " end"), (None, c), (None, c), (9, ""), (9, ""), (None, None)]
    got = row_keys(corpus_pipeline.near_duplicates(spark, table_of(spark, rows), data_dir))
    assert got == sorted([(2, a + " end"), (2, b + " end"), (None, c), (9, ""), (9, ""), (None, None)], key=repr)


def test_tables_go_when_they_are_read(spark, data_dir, tmp_path, monkeypatch):
    """After stage 3 its narrow tables are left, of the whole run no stage's result but the last."""
    monkeypatch.setattr(session, "scratch_path", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    left = lambda: {p.name.rpartition("-")[0] for p in tmp_path.iterdir()}
    kept = corpus_pipeline.near_duplicates(spark, corpus_pipeline.documents(spark, data_dir), data_dir)
    assert {"signatures", "classes"} <= left() <= {"signatures", "classes", "links", "roots"} and kept.count()
    got = corpus_pipeline.run(spark, data_dir)
    assert left() & {name for name, _ in corpus_pipeline.STAGES} == {"packing"} and got.count()


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and sorted(int(x[2:].split("_")[0]) for x in names if x.startswith("op")) == list(range(1, 11))
