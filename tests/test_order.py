import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import order as O
from tokenloom.operators.order import bucket_shifts, dense_index, hash_rank, prefix_sums


def _expected(rows):
    out, seen = {}, {}
    for g, k, v in sorted(rows):
        out[g, k] = seen.get(g, 0)
        seen[g] = seen.get(g, 0) + v
    return out, seen


@pytest.mark.parametrize("shifts", [(16,), (3,), (2, 5, 9), None])
def test_prefix_sums_match_a_loop(spark, shifts):
    rng = random.Random(1)
    keys = rng.sample(range(1 << 14), 400)
    # One group owns two thirds of the rows.
    rows = [("hot" if i % 3 else f"g{i % 5}", k, rng.randrange(50)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "g string, k long, v int")
    got = prefix_sums(df, "k", {"p": F.col("v")}, ["g"], {"t": "p"}, shifts=shifts).collect()
    want, totals = _expected(rows)
    assert {(r.g, r.k): r.p for r in got} == want
    assert all(r.t == totals[r.g] for r in got)


def test_no_window_spans_the_table(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    plan = dense_index(df, "id", groups=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_global_index_has_one_node_table_only(spark):
    plan = dense_index(spark.range(1000), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1  # the bucket totals


def test_null_keys_stop_the_job(spark):
    df = spark.createDataFrame([(1,), (None,), (1 << 50,)], "k long")
    with pytest.raises(Exception, match="null"):
        dense_index(df, "k").collect()


def test_repeated_keys_stop_the_job(spark):
    for keys, kind in (([1, 2, 2], "long"), (["a", "b", "b"], "string"), ([-5, 1 << 60, 1 << 60], "long")):
        df = spark.createDataFrame([(k,) for k in keys], f"k {kind}")
        with pytest.raises(Exception, match="not unique"):
            dense_index(df, "k").collect()


def test_levels_follow_the_keys(spark):
    dense = spark.range(70_000)
    assert bucket_shifts(dense, "id") == (16,)
    assert bucket_shifts(dense.select((F.col("id") * 5000).alias("id")), "id") is None  # 13 rows a leaf
    assert bucket_shifts(spark.range(0, 1 << 33, 1 << 10), "id") == (16, 28)
    assert bucket_shifts(dense.select(F.col("id").cast("string").alias("id")), "id") is None
    assert bucket_shifts(dense.select((F.col("id") - 1).alias("id")), "id") is None


@pytest.mark.parametrize("kind", ["string", "long", "date", "struct"])
def test_any_key(spark, kind):
    rng = random.Random(kind)
    keys = list({rng.randrange(-(1 << 62), 1 << 62) for _ in range(500)})
    if kind == "date":
        keys = rng.sample(range(-20_000, 20_000), 500)
    rows = [("hot" if i % 3 else f"g{i % 5}", k, rng.randrange(50)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "g string, n long, v int").repartition(7)
    make = {"string": F.format_string("%020d", F.col("n") + (1 << 62)), "long": F.col("n"), "date": F.date_add(F.lit("1970-01-01").cast("date"), F.col("n").cast("int")),
            "struct": F.struct(F.expr("n div 1000000000000000000").alias("a"), F.lit("x").alias("b"), "n")}
    order = (lambda k: (int(k / 10**18), k)) if kind == "struct" else (lambda k: k)
    got = prefix_sums(df.withColumn("k", make[kind]), "k", {"p": F.col("v")}, ["g"], {"t": "p"}).collect()
    want, totals = _expected([(g, order(k), v) for g, k, v in rows])
    assert {(r.g, order(r.n)): r.p for r in got} == want
    assert all(r.t == totals[r.g] for r in got)


def test_ties_order_equal_keys(spark):
    rows = [(k % 3, f"t{k:03d}", k) for k in range(60)]
    got = dense_index(spark.createDataFrame(rows, "k int, t string, v int").withColumn("k", F.col("k").cast("string")), "k", ties=["t"]).collect()
    assert [(r.k, r.t) for r in sorted(got, key=lambda r: r.row_no)] == sorted((str(k), t) for k, t, _ in rows)


def test_null_groups_stop_the_job(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k long, g string")
    with pytest.raises(Exception, match="null"):
        dense_index(df, "k", groups=["g"]).collect()


def test_hash_rank_is_a_stable_permutation(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 2)
    one = {(r.g, r.id): r.n for r in hash_rank(df, 5, ["id"], "n", ["g"]).collect()}
    two = {(r.g, r.id): r.n for r in hash_rank(df.repartition(7), 5, ["id"], "n", ["g"]).collect()}
    other = {(r.g, r.id): r.n for r in hash_rank(df, 6, ["id"], "n", ["g"]).collect()}
    assert one == two != other
    for g in (0, 1):
        assert sorted(n for (h, _), n in one.items() if h == g) == list(range(250))


def test_hash_leaves_follow_the_rows(spark):
    """A leaf per row would make as many nodes as rows, all of a group in one window."""
    assert [O.hash_shift(n) for n in (0, 8191, 8192, 1 << 20, 1 << 33, 1 << 40)] == [60, 60, 59, 52, 40, 40]
    df = spark.range(20_000).withColumn("g", F.col("id") % 2)
    got = O.hash_rank(df, 5, ["id"], "place", ["g"]).toPandas()
    assert all(sorted(p["place"]) == list(range(10_000)) for _, p in got.groupby("g"))
    plan = df.withColumn("h", F.shiftright(O.hash_bits(5, F.col("id")), O.hash_shift(20_000))).select("g", "h").distinct()
    assert plan.count() <= 8
