"""Near-duplicate vectors by sorted projection passes.

In each pass a vector's hash is the concatenated signs of ``CODE_BITS`` random projections, and the vectors
of each label are ordered lexicographically by it. Each vector is compared with the next ``WINDOW``
ones of that order. Only ids and hashes are ordered; vectors are fetched for blocks of ``WINDOW`` neighbours, a task
comparing one block with itself and the next one. Pairs are verified by cosine in double precision and
united across passes.

Windows alone would cut off dense places, where more than ``WINDOW`` vectors share their leading bits. Such
a run is finished exactly: every two of its blocks further apart meet in a task of their own. The number of leading
bits follows the largest label, so that a run holds about ``RUN`` vectors; the number of passes follows the bits, so
that a pair at the threshold shares them in some pass with probability ``RECALL``. So at least that share of
pairs is found; windows that reach beyond a run find more. The work of a run that is dense in
every projection grows with its square, as do its links.

``AT_ONCE`` passes are worked on together: vectors lie in shuffle files about twice for each of these, not for all.

Equal vectors are one node with a count, so copies never meet each other. Nodes are known by a
64-bit hash of label and components.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import dense_index
from .components import components
from .groups import runs
from .tables import materialize, table

THRESHOLD = 0.93
RUN = 64
WINDOW = 256
RECALL = 0.99
CODE_BITS = 60
AT_ONCE = 8
SEED = 7
ORDER = ["pass", "label", "dim"]
GROUP = [*ORDER, "one", "two"]
_EMIT = 1 << 16


def passes_needed(threshold: float, bits: int, recall: float = RECALL) -> int:
    """Passes after which a pair at the threshold has met with this probability."""
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet))) if meet < 1 else 1


def _matrix(col: pa.ListArray) -> np.ndarray:
    flat = col.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(col), -1)


def _hashed(passes: range):
    """The hash of each vector in each of these passes: the first projection's sign is the highest bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = 1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in planes:
                    planes[dim] = np.concatenate([np.random.default_rng([SEED, dim, p]).standard_normal((dim, CODE_BITS)) for p in passes], axis=1)
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x = _matrix(part["embedding"])
                sign = (x / np.abs(x).max(axis=1, keepdims=True) @ planes[dim] > 0).reshape(len(part), len(passes), CODE_BITS)
                for k, p in enumerate(passes):
                    yield pa.RecordBatch.from_arrays(
                        [part["node"], pa.array(np.full(len(part), p, np.int32)), part["label"], part["dim"], pa.array(sign[:, k] @ weight)],
                        names=["node", "pass", "label", "dim", "code"],
                    )

    return run


def _compared(threshold: float, window: int):
    """Blocks (side 0) meet their mates (side 1), which come later in the order; a block meets itself along with the next one."""

    def pairs(t: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        node, side, at, lead = (t[c].to_numpy() for c in ("node", "side", "at", "lead"))
        x = _matrix(t["embedding"])
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        reach = (at[b] - at[a][:, None] <= window) | (lead[b] == lead[a][:, None])
        i, j = np.nonzero((x[a] @ x[b].T >= threshold) & reach)
        u, v = [node[a[i]]], [node[b[j]]]
        if t["two"][0].as_py() == t["one"][0].as_py() + 1:
            i, j = np.nonzero(np.triu(x[a] @ x[a].T >= threshold, 1))
            u, v = [*u, node[a[i]]], [*v, node[a[j]]]
        return np.concatenate(u), np.concatenate(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            u, v = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

        for group in runs(batches, GROUP):
            held.append(pairs(group))
            if sum(len(u) for u, _ in held) >= _EMIT or len(held) >= _EMIT:
                yield flush()
        if held:
            yield flush()

    return run


def _pass_links(nodes: DataFrame, passes: range, bits: int, threshold: float, window: int) -> DataFrame:
    """Distinct pairs that some of these passes find."""
    coded = nodes.mapInArrow(_hashed(passes), "node bigint, pass int, label int, dim int, code bigint")
    ranked = dense_index(coded, "code", "at", ORDER, ties=("node",))
    ranked = ranked.select("node", *ORDER, "at", F.shiftright("code", CODE_BITS - bits).alias("lead"), F.floor(F.col("at") / window).alias("block"))
    ranked = materialize(ranked, "ranked")
    key = ["node", *ORDER, "at", "lead"]
    own = F.struct(F.col("block").alias("one"), (F.col("block") + 1).alias("two"), F.lit(0).alias("side"))
    last = F.struct((F.col("block") - 1).alias("one"), F.col("block").alias("two"), F.lit(1).alias("side"))
    near = ranked.select(*key, F.explode(F.array(own, last)).alias("x")).where("x.one >= 0")
    # Runs that reach beyond two neighbouring blocks.
    wide = ranked.groupBy(*ORDER, "lead").agg(F.min("block").alias("first"), F.max("block").alias("final")).where("final > first + 1")
    far = ranked.join(wide, [*ORDER, "lead"]).withColumn("mate", F.explode(F.sequence("first", "final"))).where("abs(mate - block) > 1")
    meet = F.struct(F.least("block", "mate").alias("one"), F.greatest("block", "mate").alias("two"), (F.col("block") > F.col("mate")).cast("int").alias("side"))
    rows = near.unionByName(far.select(*key, meet.alias("x"))).select(*key, "x.*")
    rows = rows.join(nodes.select("node", "embedding"), "node").repartition(*GROUP).sortWithinPartitions(*GROUP)
    return rows.mapInArrow(_compared(threshold, window), "u bigint, v bigint").distinct()


def embedding_links(nodes: DataFrame, threshold: float = THRESHOLD, run: int = RUN, window: int = WINDOW) -> DataFrame:
    """Distinct pairs (u < v) found among ``nodes(node, label, dim, embedding)``, all valid vectors."""
    sizes = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()
    bits = min(CODE_BITS, max(0, round(math.log2(max(1, (sizes[0] or 1) / run)))))
    passes = passes_needed(threshold, bits)
    parts = [range(p, min(p + AT_ONCE, passes)) for p in range(0, passes, AT_ONCE)]
    found = [materialize(_pass_links(nodes, part, bits, threshold, window), "links") for part in parts]
    return functools.reduce(DataFrame.unionByName, found).distinct()


def embedding_near_dedup(vectors: DataFrame, threshold: float = THRESHOLD, run: int = RUN, window: int = WINDOW) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding, label)``: n_links, component_id and kept.

    Vectors that are null, empty, zero or hold null or non-finite components, and those without a
    label, link with nothing. Only vectors of one length are compared. Repeated rows count as copies. A row with a
    null id can be linked, but names a component only if nothing else does. Extra columns are ignored; an empty
    table gives an empty result.
    """
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    base = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast(f"array<{kind}>"), F.col("label").cast("int"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("embedding", lambda x: x != 0)
    plus = F.transform("embedding", lambda x: x + F.lit(0.0).cast(kind))  # no negative zeros
    rows = materialize(base.select("vec_id", "label", F.when(usable, plus).alias("embedding")), "vectors").withColumn("node", F.when(F.col("embedding").isNotNull(), F.xxhash64("label", "embedding")))
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("k"), F.min("vec_id").alias("least")
    ).withColumn("dim", F.size("embedding"))
    nodes = materialize(nodes, "nodes")
    links = materialize(embedding_links(nodes.select("node", "label", "dim", "embedding"), threshold, run, window), "links")
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.join(nodes.select(F.col("node").alias("v"), "k"), "v").groupBy(F.col("u").alias("node")).agg(F.sum("k").alias("near"))
    roots = components(links, "roots").withColumnRenamed("id", "node")
    named = nodes.select("node", "k", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").join(near, "node", "left").select("node", "component_id", (F.col("k") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    out = rows.select("vec_id", "node").join(named, "node", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dedup(table(spark, sf_dir, "embeddings"))
