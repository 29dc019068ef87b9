"""Product codes of vectors by Lloyd rounds over partition-local cover trees.

Components become integers ``floor(1024 * x)`` and vectors are cut into ``PARTS`` consecutive parts with a codebook
each. Rows of a task are taken in chunks; a chunk has one cover tree per part over its distinct values. A point
joins the tree in farthest-first order, so points of a level are apart by more than its scale and every point
lies within that scale of its ancestor there. Points of a subtree stand together in tree order, so running sums give
the weight and the sum of any subtree.

In a round a node goes to its nearest codebook entry with all its subtree when that entry stays nearer than
any other for every point within the node's radius (triangle inequality); other nodes descend, down to single points,
which are compared exactly, ties to the lower index. Tasks send one sum per entry they used, so a
round shuffles and brings to the driver no more than codebooks, whatever the number of vectors. All arithmetic on
components is in integers (held exactly in doubles where numpy multiplies matrices).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import materialize, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
CHUNK_ROWS = 1024
EXACT = 1 << 53
_SLACK = 1e-9  # above the rounding of square roots and radii


@dataclass
class CoverTree:
    """``points`` in tree order, each with its number of rows; node k has the point ``first[k]`` at its centre, its
    subtree is ``first[k]:last[k]``, and its children are ``below[child[k]:child[k + 1]]``."""

    points: np.ndarray
    weight: np.ndarray
    first: np.ndarray
    last: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    below: np.ndarray


def _levels(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, level, parent) of farthest-first insertion; the parent is the nearest point of an earlier level."""
    n = len(x)
    square = (x * x).sum(1)
    order, level, parent = np.zeros(n, int), np.zeros(n, int), np.full(n, -1)
    near = square + square[0] - 2 * (x @ x[0])
    owner, held = np.zeros(n, int), np.zeros(n, int)
    top = np.sqrt(near.max()) if n > 1 else 0.0
    now = 0
    for k in range(1, n):
        p = int(near.argmax())
        at = int(np.floor(np.log2(top / np.sqrt(near[p])) + _SLACK)) + 1
        if at > now:  # owners so far are the points of earlier levels
            now, held = at, owner.copy()
        order[k], level[p], parent[p] = p, now, held[p]
        dist = square + square[p] - 2 * (x @ x[p])
        closer = dist < near
        near[closer], owner[closer] = dist[closer], p
    return order, level, parent


def build_tree(x: np.ndarray, weight: np.ndarray) -> CoverTree:
    """The tree over distinct integer points ``x`` (held in doubles)."""
    n = len(x)
    order, level, parent = _levels(x)
    size = np.ones(n, int)
    children: list[list[int]] = [[] for _ in range(n)]  # in order of insertion, so by level
    for p in order[1:].tolist():
        children[parent[p]].append(p)
    for p in order[:0:-1].tolist():
        size[parent[p]] += size[p]
    # A point stands first in its range; children of the last level follow it, those of the first level come last.
    place = np.zeros(n, int)
    for p in order.tolist():
        at = place[p] + 1
        for c in reversed(children[p]):
            place[c] = at
            at += size[c]
    first, last, kids, node_of = [], [], [], {}
    for p in order.tolist():  # one node per point and level at which children leave it, and one for the point alone
        groups: list[list[int]] = []
        for c in children[p]:
            if groups and level[groups[-1][-1]] == level[c]:
                groups[-1].append(c)
            else:
                groups.append([c])
        end = place[p] + size[p]
        node_of[p] = len(first)
        for g in groups:
            first.append(place[p])
            last.append(end)
            kids.append(g)
            end -= int(size[g].sum())
        first.append(place[p])
        last.append(place[p] + 1)
        kids.append([])
    below, child = [], [0]
    for k, g in enumerate(kids):
        below += [node_of[c] for c in g] + ([k + 1] if g else [])
        child.append(len(below))
    first_, last_ = np.array(first), np.array(last)
    back = np.empty(n, int)
    back[place] = np.arange(n)
    y = x[back]
    span = last_ - first_
    owner = np.repeat(np.arange(len(span)), span)
    other = np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span) + np.repeat(first_, span)
    radius = np.zeros(len(span))
    for a in range(0, len(owner), 1 << 16):
        o, p = owner[a : a + (1 << 16)], other[a : a + (1 << 16)]
        np.maximum.at(radius, o, ((y[p] - y[first_[o]]) ** 2).sum(1))
    return CoverTree(y, weight[back], first_, last_, np.sqrt(radius), np.array(child), np.array(below, int))


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (x @ c.T)


def assigned_nodes(tree: CoverTree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, entries): disjoint subtrees that cover all points, each with the nearest entry of all its points."""
    at, nodes, entries = np.zeros(1, int), [], []
    while len(at):
        d = _distances(tree.points[tree.first[at]], book)
        e = d.argmin(1)
        one = np.sqrt(d[np.arange(len(at)), e])
        d[np.arange(len(at)), e] = np.inf
        two = np.sqrt(d.min(1))
        sure = (two - one > 2 * tree.radius[at] * (1 + _SLACK) + _SLACK * (1 + one)) | (tree.last[at] - tree.first[at] == 1)
        nodes.append(at[sure])
        entries.append(e[sure])
        at = at[~sure]
        n = tree.child[at + 1] - tree.child[at]
        at = tree.below[np.repeat(tree.child[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    return np.concatenate(nodes), np.concatenate(entries)


def _edges(dim: int) -> list[int]:
    return [dim * p // PARTS for p in range(PARTS + 1)]


_TREE = ("points", "weight", "first", "last", "radius", "child", "below", "row")
_CHUNK_TYPE = ", ".join(f"{name} array<binary>" for name in _TREE)


def _chunks(dim: int, size: int):
    """Rows in chunks of ``size``, each with the trees of its parts."""
    edge = _edges(dim)

    def packed(vec_id: pa.Array, label: pa.Array, flat: np.ndarray) -> pa.RecordBatch:
        q = np.floor(flat.reshape(-1, dim) * SCALE)
        most = np.abs(q).max(initial=0.0)
        if not 8 * most * most * max(1, dim) < EXACT:
            raise ValueError(f"a component of {most / SCALE} is too large for exact integer distances")
        columns: dict[str, list[bytes]] = {name: [] for name in _TREE}
        for p in range(PARTS):
            x, row, weight = np.unique(q[:, edge[p] : edge[p + 1]].astype(np.int64), axis=0, return_inverse=True, return_counts=True)
            tree = build_tree(x.astype(float), weight)
            order = np.lexsort(tree.points.T[::-1]) if edge[p + 1] > edge[p] else np.arange(len(x))
            values = [tree.points.astype(np.int32), *(getattr(tree, name) for name in _TREE[1:-1]), order[row.reshape(-1)]]
            for name, v in zip(_TREE, values):
                columns[name].append((v.astype(np.int32) if v.dtype.kind == "i" else v).tobytes())
        made = [pa.array([columns[name]], pa.list_(pa.binary())) for name in _TREE]
        ids, labels = (pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in (vec_id, label))
        return pa.RecordBatch.from_arrays([ids, labels, *made], names=["vec_id", "label", *_TREE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def full(rest: bool) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            end = len(t) if rest else len(t) // size * size
            for a in range(0, end, size):
                s = t.slice(a, min(size, end - a)).to_batches()[0]
                yield packed(s["vec_id"], s["label"], s["embedding"].flatten().to_numpy(zero_copy_only=False))
            held.extend(t.slice(end).to_batches())

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= size:
                yield from full(False)
        if any(map(len, held)):
            yield from full(True)

    return run


def _trees(row: dict, width: list[int]) -> Iterator[tuple[CoverTree, np.ndarray]]:
    for p in range(PARTS):
        i = {name: np.frombuffer(row[name][p], np.float64 if name == "radius" else np.int32) for name in _TREE}
        n = len(i["weight"])
        yield CoverTree(i["points"].reshape(n, width[p]).astype(float), *(i[name] for name in _TREE[1:-1])), i["row"]


def _rows_of(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[dict]:
    for batch in batches:  # one row is one chunk of vectors
        for k in range(len(batch)):
            yield {name: batch[name][k].as_py() for name in names} | {"at": batch.slice(k, 1)}


def _summed(books: list[np.ndarray], width: list[int]):
    """Weight and sum of the points of each entry, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for row in _rows_of(batches, _TREE):
            for p, (tree, _) in enumerate(_trees(row, width)):
                w = tree.weight.astype(np.int64)
                weight = np.concatenate(([0], np.cumsum(w)))
                sums = np.concatenate((np.zeros((1, width[p]), np.int64), np.cumsum(tree.points.astype(np.int64) * w[:, None], axis=0)))
                node, e = assigned_nodes(tree, books[p])
                np.add.at(many[p], e, weight[tree.last[node]] - weight[tree.first[node]])
                np.add.at(total[p], e, sums[tree.last[node]] - sums[tree.first[node]])
        for p in range(PARTS):
            e = np.flatnonzero(many[p])
            if len(e):
                sums_ = pa.ListArray.from_arrays(pa.array(np.arange(len(e) + 1) * width[p], pa.int32()), pa.array(total[p][e].reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(e), p, np.int32)), pa.array(e.astype(np.int32)), pa.array(many[p][e]), sums_], names=["part", "entry", "n", "sums"])

    return run


def _coded(books: list[np.ndarray], width: list[int]):
    """Codes and errors of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches, _TREE):
            codes, error = [], 0
            for p, (tree, at) in enumerate(_trees(row, width)):
                node, e = assigned_nodes(tree, books[p])
                code, span = np.empty(len(tree.points), np.int64), tree.last[node] - tree.first[node]
                code[np.repeat(tree.first[node] - (np.cumsum(span) - span), span) + np.arange(span.sum())] = np.repeat(e, span)
                off = ((tree.points - books[p][code]) ** 2).sum(1).astype(np.int64)
                codes.append(code[at])
                error = error + off[at]
            text = np.stack(codes, 1).astype(np.uint8).tobytes().hex()
            names = [text[k : k + 2 * PARTS] for k in range(0, len(text), 2 * PARTS)]
            yield pa.RecordBatch.from_arrays([row["at"]["vec_id"].flatten(), row["at"]["label"].flatten(), pa.array(names), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return run


def _updated(books: list[np.ndarray], chunks: DataFrame, width: list[int]) -> list[np.ndarray]:
    """The codebooks after one round: per part at most ``entries`` sums reach the driver."""
    sums = chunks.mapInArrow(_summed(books, width), "part int, entry int, n bigint, sums array<bigint>")
    weights = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"))
    places = sums.select("part", "entry", F.posexplode("sums").alias("place", "s")).groupBy("part", "entry", "place").agg(F.sum("s").alias("s"))
    means = places.join(weights, ["part", "entry"]).select("part", "entry", "place", "s", "n")
    out = [b.copy() for b in books]
    for r in means.collect():
        out[r.part][r.entry, r.place] = r.s // r.n
    return out


def usable_vectors(vectors: DataFrame) -> DataFrame:
    base = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("embedding").cast("array<double>"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return base.where(F.coalesce(fine, F.lit(False)) & (F.size("embedding") > 0))


def vector_codes(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` per kept row of ``vectors(vec_id, embedding, label)``.

    Kept are vectors that are not null or empty, hold no null or non-finite component and have the length of the
    kept vector of the smallest vec_id. Parts are equal if the number of parts divides that length, else as equal as
    can be. Codebooks start from the smallest vec_ids: null ids last, repeated ids in order of their
    components, repeated rows count each. With fewer rows than entries the codebooks are as short. Rows
    without a label count as one label. A component beyond what exact integer distances allow (about 4,000 at 64 components)
    stops the job. Extra columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    kept = usable_vectors(vectors)
    heads = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries)
    start = [np.array(r.embedding) for r in heads.collect()]  # 256 rows at most
    dim = len(start[0]) if start else PARTS
    if any(len(v) != dim for v in start):
        heads = kept.where(F.size("embedding") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries)
        start = [np.array(r.embedding) for r in heads.collect()]
    edge = _edges(dim)
    width = [b - a for a, b in zip(edge, edge[1:])]
    q = np.floor(np.array(start).reshape(len(start), dim) * SCALE)
    books = [q[:, a:b] for a, b in zip(edge, edge[1:])]
    chunks = kept.where(F.size("embedding") == dim).mapInArrow(_chunks(dim, chunk_rows), f"vec_id array<bigint>, label array<bigint>, {_CHUNK_TYPE}")
    chunks = materialize(chunks, "cover-trees")
    for _ in range(rounds if start else 0):
        books = _updated(books, chunks, width)
    digest = hashlib.sha256(",".join(str(int(v)) for b in books for v in b.reshape(-1)).encode()).hexdigest()
    coded = materialize(chunks.mapInArrow(_coded(books, width), "vec_id bigint, label bigint, code string, error bigint"), "codes")
    by_label = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    out = coded.join(by_label.withColumnRenamed("label", "name"), F.col("label").eqNullSafe(F.col("name")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same rounds as DuckDB text; distances are exact in doubles, as they are integers."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT rid, p, CAST(key % {entries} AS INTEGER) AS e, (key - key % {entries}) / {entries} AS d FROM (
            SELECT x.rid, x.p, min(({entries} * (list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, c.v) + list_dot_product(c.v, c.v)) + c.e)::HUGEINT) AS key
            FROM parts x JOIN c{k} c ON c.p = x.p GROUP BY x.rid, x.p))""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(u.v, c.v) AS v FROM c{k} c LEFT JOIN (
            SELECT p, e, list(m ORDER BY i) AS v FROM (SELECT a.p, a.e, r.i, floor(sum(x.v[r.i]) / count(*)) AS m
            FROM a{k} a JOIN parts x ON x.rid = a.rid AND x.p = a.p, (SELECT unnest(range(1, 1 + len(v))) AS i FROM (SELECT v FROM parts LIMIT 1)) r
            GROUP BY a.p, a.e, r.i) GROUP BY p, e) u ON u.p = c.p AND u.e = c.e)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid,
           list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
    FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT rid, p, q[p * (len(q) // {parts}) + 1 : (p + 1) * (len(q) // {parts})] AS v FROM kept, (SELECT unnest(range({parts})) AS p) t
), c0 AS (SELECT p, rid - 1 AS e, v FROM parts WHERE rid <= {entries}),
{", ".join(steps)},
sums AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid),
book AS (SELECT sha256(string_agg(s, ',' ORDER BY p, e)) AS h FROM (SELECT p, e, array_to_string(list_transform(v, lambda x: x::BIGINT::VARCHAR), ',') AS s FROM c{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM kept JOIN sums ON kept.rid = sums.rid, book"""


OP11_SQL = _sql()
