import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import pack as P
from tokenloom.operators import split as SP
from tokenloom.plans import encode as E
from tokenloom.sources import store as ST


def _brute(docs, L, epochs=1):
    """Samples of one dataset by laying all tokens end to end."""
    flat = [t for _ in range(epochs) for d in docs for t in d]
    n = max((len(flat) - 1) // L, 0) if flat else 0
    return [flat[i * L : i * L + L + 1] for i in range(n)]


def _frame(spark, sets):
    rows = [(name, i, d, len(d)) for name, docs in sets.items() for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "dataset string, doc_id long, tokens array<int>, n_tokens int")


def _packed(df, cfg, n=None):
    out = {}
    for r in P.pack_samples(df, cfg, n).orderBy("dataset", "sample").collect():
        out.setdefault(r.dataset, []).append(r.tokens)
    return out


def test_hand_made(spark):
    df = _frame(spark, {"a": [[10, 11, 12], [20, 21, 22, 23, 24, 25], [30]]})
    assert _packed(df, P.PackConfig(4)) == {"a": [[10, 11, 12, 20, 21], [21, 22, 23, 24, 25]]}
    assert _packed(df, P.PackConfig(100)) == {}


@pytest.mark.parametrize("L", [2, 3, 7, 64])
def test_matches_brute_force(spark, L):
    rng = random.Random(L)
    # The hot dataset holds most documents; empty and very long documents occur.
    sets = {
        name: [[rng.randrange(1000) for _ in range(rng.choice([0, 0, 1, 2, 5, 9, 200]))] for _ in range(n)]
        for name, n in {"hot": 60, "b": 9, "c": 2}.items()
    }
    got = _packed(_frame(spark, sets), P.PackConfig(L))
    assert got == {n: b for n, d in sets.items() if (b := _brute(d, L))}


def test_epochs_cover_the_request(spark):
    sets = {"a": [[1, 2, 3], [4, 5]], "b": [[7] * 40]}
    got = _packed(_frame(spark, sets), P.PackConfig(4), 7)
    assert got["a"] == _brute(sets["a"], 4, 6)  # 7 * 4 + 1 tokens need six passes of five
    assert got["b"] == _brute(sets["b"], 4, 1)


def test_shuffled_documents_keep_all_tokens(spark):
    sets = {"a": [[i] * 3 for i in range(1, 30)]}
    cfg = P.PackConfig(5, shuffle_documents=True)
    index = P.tile_epochs(_frame(spark, sets).drop("tokens"), cfg, F.lit(40)).collect()
    starts = sorted((r.start, r.doc_pos) for r in index)
    assert starts == [(3 * i, i) for i in range(len(index))]
    one, two = (_packed(_frame(spark, sets).repartition(n), cfg, F.lit(40)) for n in (1, 5))
    assert one == two and one["a"] != _brute(sets["a"], 5, 3)


def test_sample_index_by_simulation(spark):
    sizes = [3, 0, 6, 1, 8]
    df = _frame(spark, {"a": [[1] * s for s in sizes]})
    cfg = P.PackConfig(4)
    got = sorted((r.sample, r.doc_pos, r.offset) for r in P.sample_index(P.tile_epochs(df.drop("tokens"), cfg), cfg).collect())
    want, flat = [], [(d, o) for d, s in enumerate(sizes) for o in range(s)]
    for i in range((len(flat) - 1) // 4 + 1):
        want.append((i, *flat[i * 4]))
    assert got == want


def test_epoch_plan(spark):
    df = spark.createDataFrame([("a", 100), ("b", 101)], "dataset string, tokens_per_epoch long")
    plan = {r.dataset: r for r in P.epoch_plan(df, P.PackConfig(10), 12).collect()}
    for name, tpe in (("a", 100), ("b", 101)):
        epochs = next(e for e in range(1, 9) if e * tpe >= 12 * 10 + 1)
        before = ((epochs - 1) * tpe - 1) // 10
        assert plan[name].epochs == epochs and plan[name].n_samples == (epochs * tpe - 1) // 10
        assert plan[name].separate_final_epoch == (12 - before < int(0.8 * ((tpe - 1) // 10)))


def test_plan_shuffles_tokens_by_document_and_sample_only(spark):
    df = _frame(spark, {"a": [[1, 2, 3]] * 5})
    plan = P.pack_samples(df, P.PackConfig(2))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def _by_sequence(spark, docs):
    """Documents ``{(dataset, doc): [sequence, ...]}`` as a store with a row per sequence."""
    rows = [(d, i, sum(qs, []), [len(q) for q in qs]) for (d, i), qs in docs.items()]
    return E.to_sequences(spark.createDataFrame(rows, "dataset string, doc_id long, tokens array<int>, lengths array<int>").repartition(3))


def test_several_sequences_per_document(spark):
    store = _by_sequence(spark, {("a", 0): [[1, 2, 3], [4, 5]], ("a", 1): [[6, 7]]})
    assert _packed(store, P.PackConfig(2, ties=("seq_no",))) == {"a": [[1, 2, 3], [3, 4, 5], [5, 6, 7]]}
    with pytest.raises(Exception, match="not unique"):
        P.pack_samples(store, P.PackConfig(2)).collect()
    with pytest.raises(Exception, match="not unique"):
        P.pack_samples(store.unionByName(store), P.PackConfig(2, ties=("seq_no",))).collect()


@pytest.mark.parametrize("L", [3, 16])
def test_sequences_match_brute_force(spark, L):
    rng = random.Random(L)
    docs = {
        (name, i): [[rng.randrange(900) for _ in range(rng.choice([0, 1, 4, 30]))] for _ in range(rng.choice([1, 2, 7]))]
        for name, n in (("hot", 40), ("b", 5)) for i in range(n)
    }
    store = _by_sequence(spark, docs)
    cfg = P.PackConfig(L, ties=("seq_no",))
    assert _packed(store, cfg) == {n: b for n in ("hot", "b") if (b := _brute([q for (d, _), qs in docs.items() if d == n for q in qs], L))}
    shuffled = P.PackConfig(L, ties=("seq_no",), shuffle_documents=True)
    one, two = (_packed(store.repartition(n), shuffled, F.lit(60)) for n in (1, 4))
    assert one == two
    labels = SP.assign_split(store, SP.split_bounds("70,20,10"), "doc_id", ["dataset"], ties=["seq_no"]).where("dataset = 'hot'")
    got = [r.split for r in labels.orderBy("doc_id", "seq_no").collect()]
    assert got == sorted(got, key=SP.SPLITS.index) and abs(got.count("train") - 0.7 * len(got)) <= 1


def test_sequences_in_stores(spark):
    one = _by_sequence(spark, {("a", 0): [[1], [2, 3]], ("b", 0): [[4]]})
    two = _by_sequence(spark, {("a", 0): [[5], [6]], ("a", 9): [[7]]})
    got = ST.append_stores([one, two])
    ids = {(r.store_no, r.dataset, r.doc_id, r.seq_no): r.new_id for r in got.collect()}
    assert ids == {(0, "a", 0, 0): 0, (0, "a", 0, 1): 0, (0, "b", 0, 0): 1, (1, "a", 0, 0): 2, (1, "a", 0, 1): 2, (1, "a", 9, 0): 3}
    ask = spark.createDataFrame([("a", 0, 1, 1, None), ("b", 0, 0, 0, 5), ("b", 7, 0, 0, 1)], "dataset string, doc_id long, seq_no int, offset int, length int")
    assert {(r.dataset, r.doc_id): r.tokens for r in ST.take_sequences(one, ask).collect()} == {("a", 0): [3], ("b", 0): [4], ("b", 7): None}
    with pytest.raises(ValueError, match="dataset"):
        ST.take_sequences(one, ask.drop("dataset"))


def test_documents_with_very_many_sequences(spark):
    n = 80_000
    doc = spark.range(1).select(F.lit("a").alias("dataset"), F.col("id").alias("doc_id"), F.sequence(F.lit(0), F.lit(2 * n - 1)).alias("tokens"), F.array_repeat(F.lit(2), n).alias("lengths"))
    got = E.to_sequences(doc).agg(F.count(F.lit(1)).alias("n"), F.max("seq_no").alias("last"), F.count_if(F.col("tokens")[0] == 2 * F.col("seq_no")).alias("right")).first()
    assert tuple(got) == (n, n - 1, n)
    odd = spark.createDataFrame([("a", 1, [1, 2], [1])], "dataset string, doc_id long, tokens array<int>, lengths array<int>")
    with pytest.raises(Exception, match="add up"):
        E.to_sequences(odd).collect()
    none = spark.createDataFrame([("a", 1, None, None), ("a", 2, [], []), ("b", 3, [9], [0, 1])], "dataset string, doc_id long, tokens array<int>, lengths array<int>")
    assert sorted((r.doc_id, r.seq_no, r.tokens) for r in E.to_sequences(none).collect()) == [(3, 0, []), (3, 1, [9])]
