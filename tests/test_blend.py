import random

import numpy as np
import pytest

from tokenloom.operators import blend as B


def _blend(*weights):
    return B.Blend(tuple(f"d{i:03d}" for i in range(len(weights))), tuple(weights))


def _rows(df):
    return [tuple(r) for r in df.orderBy("sample_idx").collect()]


def _greedy(blend, size):
    drawn, out = [0] * len(blend.weights), []
    for n in range(size):
        errors = [w * max(float(n), 1.0) - c for w, c in zip(blend.shares, drawn)]
        d = max(range(len(errors)), key=lambda i: (errors[i], -i))
        out.append((n, d, drawn[d]))
        drawn[d] += 1
    return out


WEIGHTS = [(1, 1), (3, 7), (1, 1, 1), (5, 0, 2), (12345, 678, 90, 1), tuple(random.Random(3).randrange(1, 99) for _ in range(70))]


@pytest.mark.parametrize("weights", WEIGHTS)
def test_balanced_equals_a_sort(spark, weights):
    blend, size = _blend(*weights), 333
    from fractions import Fraction

    draws = [(Fraction(2 * k + 1, 2 * w), d, k) for d, w in enumerate(weights) if w for k in range(size)]
    want = [(i, d, k) for i, (_, d, k) in enumerate(sorted(draws)[:size])]
    assert _rows(B.balanced_schedule(spark, blend, size)) == want


def test_balanced_with_weights_beyond_64_bits(spark):
    big, small = _blend(3 * 10**17 + 1, 7 * 10**17), _blend(3, 7)
    assert [r[1] for r in _rows(B.balanced_schedule(spark, big, 200))] == [r[1] for r in _rows(B.balanced_schedule(spark, small, 200))]


@pytest.mark.parametrize("weights", WEIGHTS)
def test_exact_equals_the_loop(spark, weights):
    blend = _blend(*weights)
    assert _rows(B.exact_schedule(spark, blend, 1000, chunk=90)) == _greedy(blend, 1000)


def test_exact_repairs_wrong_guesses(spark):
    blend = _blend(5, 3, 1)
    wrong = lambda shares, begins: np.stack([begins, 0 * begins, 0 * begins], axis=1).astype(float)
    assert _rows(B.exact_schedule(spark, blend, 400, chunk=90, guess=wrong)) == _greedy(blend, 400)


def test_requests_and_fitting(spark):
    rows = B.blend_requests(spark, _blend(30, 70), {"train": 1000, "valid": 7}).collect()
    assert {(r.dataset_id, r.split): r.requested for r in rows} == {
        (0, "train"): 302, (1, "train"): 704, (0, "valid"): 3, (1, "valid"): 5,
    }
    assert B.fit_weights([2, 6, 2], 2) == [0.2, 0.6]
    assert B.fit_weights([1, 1], 3) == [0.5, 0.5, 0.0]
    assert B.fit_weights([0, 0], 1) == [1.0]


def test_achieved_ratios(spark):
    blend = _blend(1, 3)
    got = {r.dataset_id: (r.n, r.achieved) for r in B.achieved_ratios(B.balanced_schedule(spark, blend, 80), blend, 80).collect()}
    assert got == {0: (20, 0.25), 1: (60, 0.75)}


@pytest.mark.parametrize("weights", ["0.1 a 0.2 b 0.7 c", "1e-20 a 1 b", "0.1234567890123456789 a 3 b 1e18 c 999999999999999999 d", "1 a 1 a 0 b", "2.5e-7 a 1e-7 b 3e12 c"])
def test_balanced_with_real_weights(spark, weights):
    from fractions import Fraction

    blend, size = B.parse_blend(weights), 400
    exact = [Fraction(w) for w in weights.split()[::2]]
    draws = [(Fraction(2 * k + 1) / w, d, k) for d, w in enumerate(exact) if w for k in range(size)]
    assert _rows(B.balanced_schedule(spark, blend, size)) == [(i, d, k) for i, (_, d, k) in enumerate(sorted(draws)[:size])]


def test_wide_quotients():
    rng = random.Random(5)
    for bits in (40, 59, 70, 100, 119):
        weights = [rng.randrange(1 << (bits - 8), 1 << bits) for _ in range(9)] + [6 << (bits - 4), 3 << (bits - 4)]
        w = np.array(weights, dtype=np.int64 if bits < 60 else object)
        d = np.array([rng.randrange(len(weights)) for _ in range(500)])
        k = np.array([rng.randrange(1 << 30) * weights[x] // max(weights) for x in d])
        want = [
            int(a) + sum(((2 * int(a) + 1) * v - (0 if o < x else 1)) // weights[x] // 2 + ((((2 * int(a) + 1) * v - (0 if o < x else 1)) // weights[x]) % 2) for o, v in enumerate(weights) if o != x)
            for a, x in zip(k, d.tolist())
        ]
        assert B._places(k, d, w).tolist() == want


def test_fractions_are_as_fast_as_integers():
    import time

    rng = np.random.default_rng(1)
    shares, seconds = rng.random(400), []
    for weights in (rng.integers(1, 10**6, 400).tolist(), B.whole_weights([repr(x) for x in (shares / shares.sum()).tolist()])):
        d, k = np.repeat(np.arange(400), 50), np.tile(np.arange(50), 400)
        began = time.perf_counter()
        B._places(k, d, np.array(weights, dtype=np.int64 if max(weights) < 1 << 60 else object))
        seconds.append(time.perf_counter() - began)
    assert seconds[1] < 3 * seconds[0] + 0.2


def test_parsing(spark):
    rows = [("x", "0.30  p/a 70 p/b  "), ("y", " p/a "), ("z", None), ("w", " "), ("v", "1 a 3 a")]
    got = {tuple(r) for r in B.blend_entries(spark.createDataFrame(rows, "split string, blend string"), by=["split"]).collect()}
    assert got == {("x", 0, "p/a", 0.3, 0.3 / 70.3, False), ("x", 1, "p/b", 70.0, 70 / 70.3, False), ("y", 0, "p/a", 1.0, 1.0, True), ("v", 0, "a", 1.0, 0.25, False), ("v", 1, "a", 3.0, 0.75, False)}
    lists = spark.createDataFrame([(["30", " a", "70", "b "],)], "blend array<string>")
    entries = B.blend_entries(lists)
    assert [tuple(r)[:2] for r in entries.collect()] == [(0, "a"), (1, "b")]
    requests = {tuple(r) for r in B.entry_requests(entries, {"train": 1000, "valid": 7}).collect()}
    assert requests == {(0, "a", "train", 302), (1, "b", "train", 704), (0, "a", "valid", 3), (1, "b", "valid", 5)}
    one = B.blend_entries(spark.createDataFrame([("a",)], "blend string"))
    assert [tuple(r) for r in B.entry_requests(one, {"train": 1000}).collect()] == [(0, "a", "train", 1000)]
    assert [tuple(r)[3] for r in B.blend_requests(spark, B.parse_blend("a"), {"train": 1000}).collect()] == [1000]
    for wrong in ("1 a 2", "x a 1 b", "-1 a 2 b", "0 a 0 b", "nan a 1 b"):
        with pytest.raises(Exception, match="blend"):
            B.blend_entries(spark.createDataFrame([(wrong,)], "blend string")).collect()
    for wrong in ("1 a 2", "x a 1 b", "-1 a 2 b", "0 a 0 b", ""):
        with pytest.raises(ValueError):
            B.parse_blend(wrong)


def test_lookups_broadcast_no_samples(spark):
    """Samples exploded from a few rows look small to Spark; broadcast, they fill the driver."""
    schedule = B.blend_schedule(spark, _blend(3, 7), 20)
    few = spark.createDataFrame([(0, 9), (1, 20)], "dataset_id int, n bigint")
    samples = few.selectExpr("dataset_id", "explode(sequence(0L, n)) as sample")
    for missing in ("error", "skip"):
        found = B.lookup_blended(schedule, samples, missing=missing)
        assert sorted(found.columns) == ["dataset_id", "dataset_sample_idx", "sample_idx"] and found.count() == 20
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_blended_lookup_takes_the_whole_schedule(spark, data_dir):
    from tokenloom.catalog import packing_queries as Q

    blend, length = Q._blend(spark, data_dir), Q.L
    drawn = B.blend_schedule(spark, blend, sum(w // length for w in blend.weights)).collect()
    want = sorted(tuple(r) for r in drawn if r.dataset_sample_idx < (blend.weights[r.dataset_id] - 1) // length)
    assert sorted(tuple(r)[:3] for r in Q.j07(spark, data_dir).collect()) == want
