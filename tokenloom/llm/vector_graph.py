"""Approximate nearest neighbours by largest inner product: a robust-pruned directed graph per shard.

Equal vectors are one node. Nodes are dealt to shards by the hash of their vector; a shard holds
about ``SHARD_VALUES`` components (and up to 32,768 nodes), whatever the size of the table. Within a shard nodes are inserted in
batches: a greedy beam search of the graph so far (and the batch itself) proposes neighbours, relaxed distance
pruning keeps those that no kept neighbour is ``ALPHA`` times nearer to, and reverse edges are added and pruned
again when a node has more than ``DEGREE``. Inner products become distances by one more component,
``sqrt(M*M - |x|*|x|)`` with M the largest norm of the shard, which is 0 in queries.

The index is a table with one row per node, written to the shared folder. Each block of queries
is searched in each shard by a beam search; what it meets is scored in double precision on the
original vectors, and the best of all shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .groups import runs
from .tables import materialize, table

SHARD_VALUES = 1 << 20
QUERY_VALUES = 1 << 22
DEGREE = 40
BUILD_BEAM = 56
SEARCH_BEAM = 160
ALPHA = 1.2
NEAREST = 20
QUERY_EVERY = 20
_BATCH = 1024
_EXPANDED = 4
_EXACT = 512  # so many first nodes are linked by comparing them all


def beam_search(x: np.ndarray, edges: np.ndarray, entries: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, squared distances) of the ``beam`` nearest met from ``entries``; -1 and inf where fewer are met."""
    n, rows = len(x), len(q)
    square = (x * x).sum(1)
    seen = np.zeros((rows, n + 1), bool)
    seen[:, n] = seen[:, entries] = True  # column n stands for missing edges
    first = np.broadcast_to(entries, (rows, len(entries)))
    dist = square[entries][None, :] - 2 * (q @ x[entries].T)
    node, dist, done = _best(first, dist, np.zeros(first.shape, bool), beam)
    live = np.arange(rows)
    while len(live):
        waiting = np.where(done[live], np.inf, dist[live])
        width = min(_EXPANDED, beam)
        at = np.argpartition(waiting, width - 1, axis=1)[:, :width]
        open_ = np.isfinite(np.take_along_axis(waiting, at, 1))
        some = open_.any(1)
        live, at, open_ = live[some], at[some], open_[some]
        if not len(live):
            break
        done[live[:, None], at] = True
        next_ = edges[node[live[:, None], at]]
        next_ = np.where(open_[:, :, None] & (next_ >= 0), next_, n).reshape(len(live), -1)
        next_.sort(axis=1)
        fresh = ~seen[live[:, None], next_]
        fresh[:, 1:] &= next_[:, 1:] != next_[:, :-1]
        seen[live[:, None], next_] = True
        r, c = np.nonzero(fresh)
        found = np.full(next_.shape, np.inf, np.float32)
        met = next_[r, c]
        found[r, c] = square[met] - 2 * np.einsum("ij,ij->i", x[met], q[live[r]])
        merged = _best(
            np.concatenate((node[live], next_), 1), np.concatenate((dist[live], found), 1), np.concatenate((done[live], ~fresh), 1), beam
        )
        node[live], dist[live], done[live] = merged
    return node, np.where(node >= 0, dist + (q * q).sum(1)[:, None], np.inf)


def _best(node: np.ndarray, dist: np.ndarray, done: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``beam`` nearest of each row, in no order; filled up with node -1."""
    if node.shape[1] > beam:
        at = np.argpartition(dist, beam - 1, axis=1)[:, :beam]
        node, dist, done = (np.take_along_axis(a, at, 1) for a in (node, dist, done))
    gap = ((0, 0), (0, beam - node.shape[1]))
    node = np.pad(np.where(np.isfinite(dist), node, -1), gap, constant_values=-1)
    return node.astype(np.int32), np.pad(dist, gap, constant_values=np.inf).astype(np.float32), np.pad(done, gap, constant_values=True)


def robust_prune(x: np.ndarray, p: np.ndarray, found: np.ndarray, degree: int, alpha: float = ALPHA) -> np.ndarray:
    """Edges of nodes ``p`` chosen from ``found`` (-1: none): nearest first, leaving out what a chosen
    one is ``alpha`` times nearer to than p is."""
    out = np.full((len(p), degree), -1, np.int32)
    for a in range(0, len(p), 256):
        own, c = p[a : a + 256], found[a : a + 256]
        y = x[c]
        dist = ((y - x[own][:, None, :]) ** 2).sum(2)
        dist[(c < 0) | (c == own[:, None])] = np.inf
        order = np.argsort(dist, axis=1, kind="stable")
        c, dist, y = np.take_along_axis(c, order, 1), np.take_along_axis(dist, order, 1), np.take_along_axis(y, order[:, :, None], 1)
        square = (y * y).sum(2)
        between = (square[:, :, None] + square[:, None, :] - 2 * (y @ y.transpose(0, 2, 1))) * np.float32(alpha * alpha)
        alive = np.isfinite(dist)
        alive[:, 1:] &= c[:, 1:] != c[:, :-1]
        held, row = np.zeros(len(own), int), np.arange(len(own))
        for k in range(c.shape[1]):
            take = alive[:, k] & (held < degree)
            if not take.any():
                continue
            out[a + row[take], held[take]] = c[take, k]
            held += take
            alive[:, k + 1 :] &= ~take[:, None] | (between[:, k, k + 1 :] > dist[:, k + 1 :])
    return out


def _add_reverse(x: np.ndarray, edges: np.ndarray, p: np.ndarray) -> None:
    """Let the new neighbours of nodes ``p`` point back to them; a node that gets many takes them in several turns."""
    degree = edges.shape[1]
    r, c = np.nonzero(edges[p] >= 0)
    to, back = edges[p][r, c], p[r]
    order = np.argsort(to, kind="stable")
    to, back = to[order], back[order]
    while len(to):
        new = np.concatenate(([True], to[1:] != to[:-1]))
        begin = np.flatnonzero(new)
        turn = np.arange(len(to)) - begin[np.cumsum(new) - 1]
        now = turn < degree
        nodes = to[begin]
        given = np.full((len(nodes), degree), -1, np.int32)
        given[(np.cumsum(new) - 1)[now], turn[now]] = back[now]
        both = np.concatenate((edges[nodes], given), 1)
        room = (both >= 0).sum(1) <= degree
        if room.any():
            packed = np.take_along_axis(both[room], np.argsort(both[room] < 0, axis=1, kind="stable"), 1)[:, :degree]
            edges[nodes[room]] = packed
        if not room.all():
            edges[nodes[~room]] = robust_prune(x, nodes[~room], both[~room], degree)
        to, back = to[~now], back[~now]


def _reached(edges: np.ndarray, at: np.ndarray, met: np.ndarray) -> None:
    """Mark what can be reached from the nodes ``at``."""
    met[at] = True
    while len(at):
        at = np.unique(edges[at])
        at = at[at >= 0]
        at = at[~met[at]]
        met[at] = True


def _spread(x: np.ndarray, many: int) -> np.ndarray:
    """``many`` rows of ``x`` in farthest-first order, from the one nearest to the mean."""
    square = (x * x).sum(1)
    mean = x.mean(0)
    chosen = [int(np.argmin(square - 2 * (x @ mean)))]
    dist = np.full(len(x), np.inf, np.float32)
    while len(chosen) < many:
        p = chosen[-1]
        dist = np.minimum(dist, square + square[p] - 2 * (x @ x[p]))
        dist[p] = -1
        chosen.append(int(dist.argmax()))
    return np.array(chosen)


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(edges, entries) over the rows of ``x``: -1 where a node has fewer edges.

    Entries are farthest-first rows, one for ``degree`` nodes, so tight clusters with more nodes than a node has edges have an
    entry of their own. Every node can be reached: nodes cut off from all entries become entries too.
    """
    n = len(x)
    heads = _spread(x, max(1, min(n // degree, _EXACT)))
    rest = np.ones(n, bool)
    rest[heads] = False
    order = np.concatenate((heads, np.flatnonzero(rest)))  # entries are inserted first
    x, entries = x[order], np.arange(len(heads))
    edges = np.full((n, degree), -1, np.int32)
    done = min(n, _EXACT)
    head = x[:done]
    square = (head * head).sum(1)
    dist = square[:, None] + square[None, :] - 2 * (head @ head.T)
    np.fill_diagonal(dist, np.inf)
    near = np.argsort(dist, axis=1, kind="stable")[:, : min(done - 1, 2 * beam)].astype(np.int32)
    edges[:done] = robust_prune(x, np.arange(done), near, degree)
    _add_reverse(x, edges, np.arange(done))
    while done < n:
        p = np.arange(done, min(n, done + min(done, _BATCH)))
        near = beam_search(x[:done], edges[:done], entries, x[p], beam)[0]
        y = x[p]
        dist = (y * y).sum(1)[None, :] - 2 * (y @ y.T)
        np.fill_diagonal(dist, np.inf)
        mates = p[np.argpartition(dist, min(beam // 4, len(p) - 1), axis=1)[:, : beam // 4]]
        edges[p] = robust_prune(x, p, np.concatenate((near, mates.astype(np.int32)), 1), degree)
        _add_reverse(x, edges, p)
        done += len(p)
    met, more = np.zeros(n, bool), []
    _reached(edges, entries, met)
    while not met.all():
        more.append(int(np.argmin(met)))
        _reached(edges, np.array(more[-1:]), met)
    out = np.empty_like(edges)
    out[order] = np.where(edges >= 0, order[edges], -1)
    return out, order[np.concatenate((entries, np.array(more, int)))]


def _scaled(v: np.ndarray) -> np.ndarray:
    """Shard vectors as float32 with norms up to 1 and the extra component that turns products into distances."""
    y = v / np.abs(v).max()
    norm = np.sqrt((y * y).sum(1))
    y, norm = y / norm.max(), norm / norm.max()
    return np.concatenate((y, np.sqrt(np.maximum(1 - norm * norm, 0))[:, None]), 1).astype(np.float32)


def _matrix(col: pa.ListArray, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dim)


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(values))


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in runs(batches, ["dim", "shard"]):
        edges, entries = build_graph(_scaled(_matrix(t["embedding"], t["dim"][0].as_py())))
        first = np.zeros(len(t), bool)
        first[entries] = True
        columns = [t["dim"], t["shard"], pa.array(np.arange(len(t), dtype=np.int32)), pa.array(first), _lists(edges[edges >= 0], (edges >= 0).sum(1)), t["vec_ids"], t["embedding"]]
        whole = pa.RecordBatch.from_arrays(columns, names=["dim", "shard", "at", "entry", "edges", "vec_ids", "embedding"])
        for a in range(0, len(whole), 4096):
            yield whole.slice(a, 4096)


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding, dim)`` of the rows that take part, in double precision."""
    base = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    base = base.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
    plus = F.transform("embedding", lambda x: x + F.lit(0.0))  # no negative zeros
    return base.select("vec_id", plus.alias("embedding"), F.size("embedding").alias("dim"))


def graph_index(rows: DataFrame, nearest: int = NEAREST, shard_values: int = SHARD_VALUES) -> DataFrame:
    """One row per distinct vector of ``usable_vectors``: shard, place, edges, and the smallest ``nearest`` + 1 ids
    that have it, which are all that an answer of ``nearest`` rows without the query's own can name."""
    keyed = rows.withColumn("key", F.xxhash64("embedding"))
    turn = F.row_number().over(Window.partitionBy("dim", "key", "embedding").orderBy("vec_id"))
    few = keyed.withColumn("turn", turn).where(F.col("turn") <= nearest + 1)  # cut per task before the shuffle
    nodes = materialize(few.groupBy("dim", "key", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("vec_ids")), "nodes")
    shards = nodes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) * F.greatest("dim", F.lit(32)) / F.lit(shard_values)).cast("int").alias("shards"))
    dealt = nodes.join(shards, "dim").withColumn("shard", F.pmod("key", "shards").cast("int"))
    dealt = dealt.select("dim", "shard", "key", "vec_ids", "embedding").repartition("dim", "shard").sortWithinPartitions("dim", "shard", "key", "embedding")
    built = dealt.mapInArrow(_built, "dim int, shard int, at int, entry boolean, edges array<int>, vec_ids array<bigint>, embedding array<double>")
    return materialize(built, "graph")


def _searched(nearest: int, beam: int):
    def shard_arrays(t: pa.RecordBatch, dim: int):
        v = _matrix(t["embedding"], dim)
        edges = np.full((len(t), DEGREE), -1, np.int32)
        size = np.diff(t["edges"].offsets.to_numpy())
        edges[np.arange(DEGREE)[None, :] < size[:, None]] = t["edges"].flatten().to_numpy()
        ids, many = t["vec_ids"].flatten().to_numpy(), np.diff(t["vec_ids"].offsets.to_numpy())
        return v, _scaled(v), edges, np.flatnonzero(t["entry"].to_numpy(zero_copy_only=False)), ids, many

    def answers(shard, q_id: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
        v, x, edges, entries, ids, many = shard
        unit = q / np.abs(q).max(1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
        unit = np.concatenate((unit, np.zeros((len(q), 1))), 1).astype(np.float32)
        met = beam_search(x, edges, entries, unit, beam)[0]
        r, c = np.nonzero(met >= 0)
        node = met[r, c]
        score = (v[node] * q[r]).sum(1)
        own = (v[node] == q[r]).all(1)
        # one row per id of a node; of the query's own vector one row of its id is left out
        n = many[node]
        begin = np.cumsum(many) - many
        at = np.repeat(begin[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        r, score, own, vec = np.repeat(r, n), np.repeat(score, n), np.repeat(own, n), ids[at]
        self_ = own & (vec == q_id[r])
        self_[1:] &= ~(self_[:-1] & (r[1:] == r[:-1]) & (vec[1:] == vec[:-1]))
        r, score, vec = r[~self_], score[~self_], vec[~self_]
        order = np.lexsort((vec, -score, r))
        r, score, vec = r[order], score[order], vec[order]
        new = np.concatenate(([True], r[1:] != r[:-1])) if len(r) else np.zeros(0, bool)
        rank = np.arange(len(r)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(r) else np.zeros(0, int)
        keep = rank < nearest
        return r[keep], vec[keep], score[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["dim", "shard", "block"]):
            dim = t["dim"][0].as_py()
            cut = int(np.count_nonzero(t["at"].to_numpy() >= 0))  # nodes lie before queries
            if cut in (0, len(t)):
                continue
            t = t.take(pa.array(np.argsort(t["at"].to_numpy() < 0, kind="stable")))
            shard, asked = shard_arrays(t.slice(0, cut), dim), t.slice(cut)
            for a in range(0, len(asked), _BATCH):
                part = asked.slice(a, _BATCH)
                q_id, key = part["query_id"].to_numpy(), part["query_key"].to_numpy()
                r, vec, score = answers(shard, q_id, _matrix(part["embedding"], dim))
                yield pa.RecordBatch.from_arrays([pa.array(q_id[r]), pa.array(key[r]), pa.array(vec), pa.array(score)], names=["query_id", "query_key", "vec_id", "score"])

    return run


def graph_search(index: DataFrame, queries: DataFrame, nearest: int = NEAREST, beam: int = SEARCH_BEAM, query_values: int = QUERY_VALUES) -> DataFrame:
    """The ``nearest`` rows found for each of ``queries(vec_id, embedding, dim)``, of which it is not one itself:
    ``(query_id, rank, vec_id, score)``.

    A task holds one shard and one block of queries, both of bounded size. Rows of the index are repeated once per block
    and queries once per shard of their length.
    """
    asked = queries.groupBy(F.col("vec_id").alias("query_id"), "embedding", "dim").agg(F.count(F.lit(1)).alias("copies"))
    asked = materialize(asked.withColumn("query_key", F.xxhash64("embedding")), "queries")
    blocks = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) * F.greatest("dim", F.lit(32)) / F.lit(query_values)).cast("int").alias("blocks"))
    shards = index.select("dim", "shard").distinct()
    left = index.join(blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = asked.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("query_id", "query_key"), "blocks").cast("int")).join(shards, "dim")
    none = F.lit(None)
    left = left.select("dim", "shard", "block", "at", "entry", "edges", "vec_ids", "embedding", none.cast("bigint").alias("query_id"), none.cast("bigint").alias("query_key"))
    right = right.select(
        "dim", "shard", "block", F.lit(-1).alias("at"), F.lit(False).alias("entry"), none.cast("array<int>").alias("edges"), none.cast("array<bigint>").alias("vec_ids"),
        "embedding", "query_id", "query_key",
    )
    key = ["dim", "shard", "block"]
    cells = left.unionByName(right).repartition(*key).sortWithinPartitions(*key, "at")
    found = cells.mapInArrow(_searched(nearest, beam), "query_id bigint, query_key bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    best = best.join(asked.select("query_id", "query_key", "copies"), ["query_id", "query_key"])
    best = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return best.select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, query_every: int = QUERY_EVERY, nearest: int = NEAREST) -> DataFrame:
    """The nearest rows of ``vectors(vec_id, embedding)`` to each row whose vec_id is divisible by ``query_every``.

    Rows without an id and vectors that are null, empty, zero or hold null or non-finite components take no part.
    Only vectors of one length are compared. A repeated row is a query and a candidate of its own: its copies are found,
    itself is not. Ties go to the smaller vec_id. Extra columns are ignored; an empty table gives an empty result.
    """
    rows = usable_vectors(vectors)
    return graph_search(graph_index(rows, nearest), rows.where(F.col("vec_id") % query_every == 0), nearest)


def op13_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
