"""Vector codes, spelling variants and graph search against brute force."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tokenloom.llm import spelling, vector_codes, vector_graph
from tokenloom.llm.tables import table

VECTORS = "vec_id long, embedding array<double>, label int, row int, part string, key long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "p", 1) for r in rows], VECTORS)


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def brute_codes(rows, entries, rounds):
    kept = [r for r in rows if usable(r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    q = np.array([[math.floor(1024 * x) for x in r[1]] for r in kept])
    cut = [len(q[0]) * p // 4 for p in range(5)]
    code, error, books = [], np.zeros(len(q), int), []
    for a, b in itertools.pairwise(cut):
        x = q[:, a:b]
        book = x[:entries].copy()
        for k in range(rounds + 1):
            d = ((x[:, None, :] - book[None]) ** 2).sum(2)
            e = d.argmin(1)
            if k < rounds:
                for i in set(e.tolist()):
                    book[i] = x[e == i].sum(0) // (e == i).sum()
        code.append(e)
        error += d[np.arange(len(x)), e]
        books += book.reshape(-1).tolist()
    label = Counter()
    for r, x in zip(kept, error.tolist()):
        label[r[2]] += x
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{c[k]:02x}" for c in code), int(error[k]), label[r[2]], digest) for k, r in enumerate(kept)), key=repr)


@pytest.mark.parametrize("dim,entries,chunk", [(16, 8, 50), (10, 256, 1000), (3, 4, 16)])
def test_codes(spark, dim, entries, chunk):
    rng = np.random.default_rng(dim)
    centers = rng.standard_normal((12, dim))
    rows = [(k * 7 % 400, np.round(centers[k % 12] + 0.01 * rng.standard_normal(dim), 3).tolist(), k % 3 or None) for k in range(400)]
    rows += [(401, rows[5][1], 1)] * 60 + [(3, rows[9][1], 2), (None, rows[1][1], 2), (3, [0.0] * dim, None)]  # copies, repeated and null ids
    rows += [(500, None, 1), (501, [], 1), (502, [None] * dim, 1), (503, [float("nan")] * dim, 1), (504, [float("inf")] * dim, 1), (505, [1.0] * (dim + 1), 1)]
    got = vector_codes.vector_codes(frame(spark, rows), entries, 4, chunk).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_codes(rows, entries, 4)


def test_codes_of_few_and_no_rows(spark):
    rows = [(1, [0.5, -0.25, 0.0, 1.0], None)]
    assert [tuple(r) for r in vector_codes.vector_codes(frame(spark, rows)).collect()] == brute_codes(rows, 256, 4)
    assert vector_codes.vector_codes(frame(spark, rows).where("false")).count() == 0
    other = [(1, [0.5, 1.0], 1), (2, [1.0, 2.0, 3.0, 4.0], 1), (3, [1.0, 0.5], 1)]
    assert sorted((tuple(r) for r in vector_codes.vector_codes(frame(spark, other)).collect()), key=repr) == brute_codes(other, 256, 4)
    with pytest.raises(Exception, match="too large"):
        vector_codes.vector_codes(frame(spark, [(1, [1e200] * 4, 1)])).collect()


def test_cover_tree():
    rng = np.random.default_rng(3)
    tight = np.unique(np.round(rng.standard_normal((6, 1, 5)) * 4000 + rng.standard_normal((6, 80, 5)) * 30).reshape(-1, 5), axis=0)
    grid = np.array(list(itertools.product(range(5), repeat=3)), float)
    for x in (tight, grid, grid[:1], np.zeros((1, 0))):
        tree = vector_codes.build_tree(x, np.ones(len(x), np.int64))
        assert sorted(map(tuple, tree.points)) == sorted(map(tuple, x))
        for k, (a, b) in enumerate(zip(tree.first, tree.last)):
            d = np.sqrt(((tree.points[a:b] - tree.points[a]) ** 2).sum(1))
            assert d.max() <= tree.radius[k] + 1e-9
            below = tree.below[tree.child[k] : tree.child[k + 1]]
            if b - a > 1:  # children share the range out
                assert sorted(i for c in below for i in range(tree.first[c], tree.last[c])) == list(range(a, b))
        for book in (x[:3], x[:: max(1, len(x) // 7)], np.concatenate((x[:2], x[:2]))):
            node, entry = vector_codes.assigned_nodes(tree, book)
            want = ((tree.points[:, None] - book[None]) ** 2).sum(2).argmin(1)
            got = np.full(len(x), -1)
            for k, e in zip(node, entry):
                assert (got[tree.first[k] : tree.last[k]] == -1).all()
                got[tree.first[k] : tree.last[k]] = e
            assert (got == want).all()
    tree = vector_codes.build_tree(tight, np.ones(len(tight), np.int64))
    assert len(vector_codes.assigned_nodes(tree, tight[::80])[0]) < len(tight) / 4  # whole subtrees


def brute_words(docs):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n):
    best = {}
    for w in n:
        around = [v for v in n if near(w, v)]
        top = min(around, key=lambda v: (-n[v], v), default=None)
        best[w] = (len(around), top if top and n[top] >= 10 * n[w] else None)
    out = []
    for w in n:
        root = w
        while best[root][1]:
            root = best[root][1]
        form = best[w][1]
        out.append((w, form, root, n[w], best[w][0], n[form] if form else None))
    return sorted(out)


@pytest.mark.parametrize("ranges", [3, 40, 50_000])
def test_variants(spark, ranges):
    rng = np.random.default_rng(ranges)
    base = ["banaana", "baanana", "bananas", "banana", "été-Ærøskøbing", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "letters", "letter", "lettersx", "leXters", "ÿÿÿÿÿÿÿ"]
    base += ["abcdefg" + s for s in ("", "h", "hi", "hij", "x", "hx")] + ["".join(rng.choice(list("ab"), 8)) for _ in range(60)]
    n = {w: int(10 ** rng.integers(0, 4) * rng.integers(1, 4)) for w in base if re.fullmatch("[a-zA-Zà-ÿÀ-Þ]+", w)}
    rows = [(w, k) for w, k in n.items()] + [(None, 4), ("onlyonce", 1), ("twohalves", 1), ("twohalves", 1)]
    got = spelling.spelling_variants(spark.createDataFrame([(*r, 1, [0]) for r in rows], "word string, n long, rank long, nodes array<int>"), range_words=ranges)
    want = {w: k for w, k in n.items() if k >= 2} | {"twohalves": 2}
    assert sorted((tuple(r) for r in got.collect())) == brute_variants(want)


def test_variants_of_documents(spark):
    words = ["wonderful", "Wonderful", "wunderful", "wonderfull", "wonderfu", "SPARKLING", "sparklyng", "Éclatante", "éclatante", "short", "x" * 20_000, "x" * 19_999]
    docs = [(k % 9 or None, " ".join(words[(k * j) % len(words)] for j in range(30)) + "\n12wonderful3 wonderful×wonderful") for k in range(60)]
    docs += [(1, None), (2, ""), (3, "..."), (4, "wonderful")]
    got = spelling.spelling_variants(spelling.slipped_words(spark.createDataFrame([(*d, 1, "r") for d in docs], "doc_id long, text string, n long, run string")))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(brute_variants(brute_words(docs)), key=repr)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(spelling.slipped_words(empty)).count() == 0


def test_trie_nodes_are_prefixes(spark):
    words = sorted({"".join(p) for k in range(1, 6) for p in itertools.product("ab", repeat=k)})
    rows = spelling.trie_nodes(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), 5).collect()
    number = {}
    for r in rows:
        for k, node in enumerate(r.nodes):
            assert number.setdefault(r.word[:k], node) == node
    assert len(set(number.values())) == len(number)
    assert [r.word for r in sorted(rows, key=lambda r: r.rank)] == words


def brute_nearest(rows, every, nearest):
    fine = [(k, i, np.array(v)) for k, (i, v, _) in enumerate(rows) if i is not None and usable(v) and any(v)]
    out = []
    for k, i, v in fine:
        if i % every == 0:
            found = sorted((-float((v * u).sum()), j) for h, j, u in fine if h != k and len(u) == len(v))[:nearest]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found, 1)]
    return sorted(out)


def test_search_of_small_and_odd_tables(spark):
    rng = np.random.default_rng(5)
    rows = [(k, np.round(rng.standard_normal(6) * 10.0 ** rng.integers(-2, 3), 2).tolist(), 0) for k in range(150)]
    rows += [(200, rows[0][1], 0)] * 30 + [(20, rows[20][1], 1)] * 3 + [(40, rows[3][1], 0), (41, [-0.0, *rows[3][1][1:]], 0), (None, rows[3][1], 0)]
    rows += [(300, None, 0), (320, [], 0), (340, [0.0] * 6, 0), (360, [None] * 6, 0), (380, [float("nan")] * 6, 0), (400, [float("inf")] * 6, 0)]
    rows += [(420, [1.0, 2.0], 0), (421, [2.0, 1.0], 0), (440, [1.0], 0)]
    got = vector_graph.nearest_neighbours(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute_nearest(rows, 20, 20)  # beams wider than the shards
    assert vector_graph.nearest_neighbours(frame(spark, rows).where("false")).count() == 0
    index = vector_graph.graph_index(vector_graph.usable_vectors(frame(spark, rows)), shard_values=32 * 40)
    assert index.select("dim", "shard").distinct().count() > 3
    asked = vector_graph.usable_vectors(frame(spark, rows)).where("vec_id % 20 = 0")
    assert sorted(tuple(r) for r in vector_graph.graph_search(index, asked, query_values=32 * 5).collect()) == brute_nearest(rows, 20, 20)


def test_search_recall(spark, data_dir):
    got = vector_graph.op13_graph_search(spark, data_dir).collect()
    rows = [(r.vec_id, r.embedding, 0) for r in table(spark, data_dir, "embeddings").collect()]
    want = brute_nearest(rows, 20, 20)
    assert {r[:2] for r in want} == {(r.query_id, r.rank) for r in got}
    assert len({(r[0], r[2]) for r in want} & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(want)
    score = {(r[0], r[2]): r[3] for r in want}
    assert all(abs(r.score - score[r.query_id, r.vec_id]) < 1e-12 for r in got if (r.query_id, r.vec_id) in score)


def test_graph_of_clusters_is_connected():
    rng = np.random.default_rng(6)
    x = vector_graph._scaled(np.concatenate([rng.standard_normal(24) * 5 + 0.05 * rng.standard_normal((300, 24)) for _ in range(8)]))
    edges, entries = vector_graph.build_graph(x, 16, 32)
    met = np.zeros(len(x), bool)
    vector_graph._reached(edges, entries, met)
    assert met.all() and edges.shape == (2400, 16)
    q = x[::20]
    exact = np.argsort(((q[:, None] - x[None]) ** 2).sum(2), axis=1)[:, :20]
    found = vector_graph.beam_search(x, edges, entries, q, 96)[0]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(exact, found)]) >= 0.9
