import random
import time

import pyarrow as pa
import pytest

from tokenloom.operators import mapping as M


def _docs(seed):
    rng = random.Random(seed)
    return [[rng.choice([1, 3, 9, 40, 600 if rng.random() < 0.05 else 5]) for _ in range(rng.randrange(0, 25))] for _ in range(60)]


def _spans(sizes, target, least, remaining):
    out, first, length = [], 0, 0
    for i, s in enumerate(sizes):
        length += s
        left = len(sizes) - i - 1
        if (length >= target and left >= remaining and i + 1 - first >= least) or left == 0:
            out.append((first, i + 1))
            first, length = i + 1, 0
    return out


def _frame(spark, docs):
    return spark.createDataFrame([(i, d, d[0] if d else 0) for i, d in enumerate(docs)], "doc_id long, sizes array<int>, title_size int")


@pytest.mark.parametrize("cap", [None, 30, 200])
def test_pairs_match_a_loop(spark, cap):
    docs, want, base = _docs(1), [], 0
    bases = []
    for d in docs:
        bases.append(base)
        base += len(d)
    for _ in range(3):
        if cap is not None and len(want) >= cap:
            break
        for b, d in zip(bases, docs):
            if len(d) >= 2 and max(d) <= 512:
                want += [(b + s, b + e, 30) for s, e in _spans(d, 30, 2, 2)]
    got = M.map_sentences(_frame(spark, docs), 30, epochs=3, max_samples=cap).orderBy("map_index").collect()
    assert [tuple(r) for r in got] == [(i, *w) for i, w in enumerate(want)]


@pytest.mark.parametrize("one", [False, True])
def test_blocks_match_a_loop(spark, one):
    docs, least = _docs(2), 1 if one else 2
    want, base, block = [], 0, 0
    for n, d in enumerate(docs):
        if len(d) >= least and max(d, default=0) <= 512:
            for s, e in _spans(d, 50 - d[0], least, least):
                want.append((block, base + s, base + e, n, block))
                block += 1
        base += len(d)
    got = M.map_blocks(_frame(spark, docs), 50, one_sentence_blocks=one).orderBy("map_index").collect()
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("least,remaining", [(2, 2), (1, 1), (3, 0), (1, 4)])
def test_spans_match_a_loop(least, remaining):
    rng = random.Random(least)
    docs = [[rng.choice([0, 0, 1, 7, 30]) for _ in range(rng.randrange(0, 40))] for _ in range(200)] + [[1] * 3000, []]
    for wanted in ([rng.randrange(-3, 60) for _ in docs], [12] * len(docs)):
        got = M.batch_spans(pa.array(docs, pa.list_(pa.int64())), pa.array([[w] for w in wanted], pa.list_(pa.int64())), least, remaining).to_pylist()
        assert [[(s["start"], s["end"]) for s in d] for d in got] == [_spans(d, w, least, remaining) for d, w in zip(docs, wanted)]
    many = [[rng.randrange(1, 50) for _ in range(len(d) + 1)] for d in docs]
    got = M.batch_spans(pa.array(docs, pa.list_(pa.int64())), pa.array(many, pa.list_(pa.int64())), least, remaining).to_pylist()
    for d, w, g in zip(docs, many, got):
        want, first, length = [], 0, 0
        for i, s in enumerate(d):
            length, left = length + s, len(d) - i - 1
            if (length >= w[len(want)] and left >= remaining and i + 1 - first >= least) or left == 0:
                want.append((first, i + 1, w[len(want)]))
                first, length = i + 1, 0
        assert [(s["start"], s["end"], s["target"]) for s in g] == want


def test_nulls_count_as_nothing():
    sizes = pa.array([None, [], [5, None, 5, 5, 5]], pa.list_(pa.int64()))
    got = M.batch_spans(sizes, pa.array([[4], [4], [10]], pa.list_(pa.int64())), 1, 1).to_pylist()
    assert got == [[], [], [{"start": 0, "end": 3, "target": 10}, {"start": 3, "end": 5, "target": 10}]]
    never = M.batch_spans(sizes, pa.array([[4], [4], [None]], pa.list_(pa.int64())), 1, 1).to_pylist()
    assert [(s["start"], s["end"]) for s in never[2]] == [(0, 5)]


@pytest.mark.parametrize("short", [0, 3])
def test_long_documents_take_linear_time(spark, short):
    rng = random.Random(4)
    df = _frame(spark, [[rng.randrange(1, 60) for _ in range(80_000)], [5, 5, 5, 5]])
    M.map_sentences(_frame(spark, [[5] * 9]), 100, short_ratio=short).count()
    began = time.perf_counter()
    rows = M.map_sentences(df, 100, short_ratio=short).count()
    assert rows > 10_000 and time.perf_counter() - began < 15  # the fold took 52 s


def test_shuffle_is_a_permutation(spark):
    mapped = M.map_sentences(_frame(spark, _docs(3)), 30)
    places = [r.shuffled_no for r in M.shuffle_mapping(mapped, 1).orderBy("map_index").collect()]
    assert sorted(places) == list(range(len(places))) != places
