"""Archives, vectors and chats against brute force."""

import hashlib
import io
import itertools
import math

import numpy as np
import pytest

from tokenloom.llm import chat_format as cf
from tokenloom.llm import embedding_dedup, warc
from tokenloom.llm.components import components
from tokenloom.llm.tables import scratch_path


def test_archive_round_trip():
    pages = [(k, f"http://x/{k}", (f"<html>page {k} " + "same words again " * 40).encode()) for k in range(300)]
    records = [warc.record_bytes(i, u, p, hashlib.sha256(p).hexdigest(), None, False) for i, u, p in pages]
    data = warc.archive_bytes(records)
    assert data[:4] == warc.DICTIONARY_MAGIC.to_bytes(4, "little")
    back = list(warc.read_archive(io.BytesIO(data)))
    assert [(r["page_id"], r["url"], r["payload"]) for r in back] == pages
    few = warc.archive_bytes(records[:2])
    assert [r["page_id"] for r in warc.read_archive(io.BytesIO(few))] == [0, 1]
    for page in (0, -1, 2**63 - 1, -(2**63), None):
        assert warc.page_of(warc.record_id(page)) == page


def test_warc_edges(spark):
    big = "payload é " * 30
    rows = [(7, "http://a", big), (3, None, big), (3, "http://c", big), (None, "http://d e\r\nf", big), (9, "http://e", "tiny"), (8, "http://f", "tiny"), (10, "", None), (11, "u", "")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    manifest = warc.write_warc(pages, scratch_path(spark, "warc"), 500)
    out = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_warc(manifest).collect()}
    n = len(big.encode())
    assert out == {(7, n, "revisit", 3), (3, n, "response", None), (None, n, "revisit", 3), (9, 4, "response", None), (8, 4, "response", None), (10, 0, "response", None), (11, 0, "response", None)}
    assert warc.read_warc(manifest).count() == len(rows)
    assert warc.read_warc(warc.write_warc(pages.where("false"), scratch_path(spark, "warc"))).count() == 0


def brute(rows, threshold=0.93):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = {k: set() for k in range(len(rows))}
    for a, b in itertools.combinations(range(len(rows)), 2):
        (_, x, p), (_, y, q) = rows[a], rows[b]
        if p is not None and p == q and usable(x) and usable(y) and len(x) == len(y):
            x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = []
    for a in links:
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        out.append((rows[a][0], len(links[a]), min(ids) if ids else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [256, 4])
def test_vectors(spark, window):
    rng = np.random.default_rng(1)
    rows = []
    for label in (0, 1):
        for _ in range(8):
            center = rng.standard_normal(16)
            rows += [(len(rows), (center + 0.05 * rng.standard_normal(16)).tolist(), label) for _ in range(6)]
    rows += [(100, rows[0][1], 0), (101, rows[0][1], 0), (101, rows[0][1], 0), (102, rows[0][1], None), (103, None, 0), (104, [], 0), (105, [0.0] * 16, 0), (None, rows[0][1], 0)]
    rows += [(106, [None, *rows[0][1][1:]], 0), (107, [float("nan"), *rows[0][1][1:]], 0), (108, rows[0][1][:8], 0), (109, [float("inf"), *rows[0][1][1:]], 0)]
    df = spark.createDataFrame([(*r, 0, "n") for r in rows], "vec_id long, embedding array<double>, label int, node int, pass string")
    got = embedding_dedup.embedding_near_dedup(df, run=4, window=window).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == brute(rows)
    assert embedding_dedup.embedding_near_dedup(df.where("false")).count() == 0


def test_recall_on_the_table(spark, data_dir):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 64))
    pairs = x + 0.37 * rng.standard_normal((400, 64))  # cosines around the threshold
    rows = [(k, v.tolist(), 0) for k, v in enumerate(np.concatenate((x, pairs)))]
    want = brute(rows)
    got = embedding_dedup.embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), run=8).collect()
    assert sum(r.n_links for r in got) >= 0.9 * sum(w[1] for w in want) > 0
    exact = {w[0]: w[1] for w in want}
    assert all(r.n_links <= exact[r.vec_id] for r in got)


def test_cosine_in_double_precision(spark):
    """As floats this pair would reach the threshold; very long and very short vectors neither overflow nor vanish."""
    x = 0.93 - 1e-10
    rows = [(1, [1.0, 0.0], 0), (2, [x, math.sqrt(1 - x * x)], 0), (3, [1e300, 1e300], 1), (4, [1e-300, 1.001e-300], 1)]
    got = embedding_dedup.embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False)]


def test_one_pass_compares_ordered_neighbours_and_dense_runs(spark):
    """One pass: all pairs at most ``window`` places apart in the order of the hashes or, however far apart, with equal leading bits."""
    rng = np.random.default_rng(5)
    x = np.concatenate((rng.standard_normal((60, 8)), rng.standard_normal(8) + 0.02 * rng.standard_normal((40, 8))))
    nodes = spark.createDataFrame([(k, 0, 8, v.tolist()) for k, v in enumerate(x)], "node long, label int, dim int, embedding array<double>")
    plane = np.random.default_rng([embedding_dedup.SEED, 8, 0]).standard_normal((8, embedding_dedup.CODE_BITS))
    signs = [tuple(s) for s in (x @ plane > 0).tolist()]
    order = sorted(range(100), key=lambda k: (signs[k], k))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = set()
    for i, j in itertools.combinations(range(100), 2):
        a, b = order[i], order[j]
        if (j - i <= 3 or signs[a][:2] == signs[b][:2]) and unit[a] @ unit[b] >= 0.5:
            want.add((min(a, b), max(a, b)))
    got = embedding_dedup._pass_links(nodes, range(1), 2, 0.5, 3).collect()
    assert len(got) == len(want) and {(r.u, r.v) for r in got} == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 3)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def cheapest(given):
    best = None
    for roles in itertools.product(range(3), repeat=len(given)):
        state, cost = cf.START, 0
        for g, x in zip(given, roles):
            c, _, _ = cf.step(g, state, x)
            cost, state = cost + c, x
        if best is None or cost < best:
            best = cost
    return best


def test_repairs_are_cheapest_and_legal():
    for n in range(1, 6):
        for given in map(bytes, itertools.product(range(4), repeat=n)):
            total, states = cf.cuts([np.array(cf.summary(given)).reshape(4, 4)])
            roles = cf.repair(given, states[0], states[1])
            state, cost, path = cf.START, 0, []
            for g, x in zip(given, roles):
                c, merged, empty = cf.step(g, state, x)
                cost, state = cost + c, x
                path += [*empty, *([] if merged else [x])]
            assert cost == total == cheapest(given)
            assert all(b in cf.LEGAL[a] for a, b in itertools.pairwise([cf.START, *path]))
            halves = [np.array(cf.summary(given[:1])).reshape(4, 4), np.array(cf.summary(given[1:])).reshape(4, 4)]
            assert cf.cuts(halves)[0] == total


def test_crowded_turns(spark, monkeypatch):
    """Most rows share a turn number, a null one or no conversation; chunks are cut by rows, here of four."""
    monkeypatch.setattr(cf, "CHUNK_BITS", 2)
    rng = np.random.default_rng(2)
    names = ["user", "assistant", "system", "tool", None]
    rows = [(None if k % 3 else k % 4, (5, None, 0)[k % 7 % 3], names[int(rng.integers(5))], f"t{k % 50}") for k in range(600)] + [(None, 5, "user", "same")] * 90
    out = cf.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)).collect()
    assert len(out) == len(rows)
    for conv in (None, 0, 1, 2, 3):
        mine = [r for r in rows if r[0] == conv]
        code = {r: k for k, r in enumerate(cf.ROLES)}
        given = [code.get(r[2], 3) for r in sorted(mine, key=lambda r: (r[1] is None, r[1] or 0, code.get(r[2], 3), r[3]))]
        cost = np.array([cf.NEVER] * 3 + [0])
        for g in given:
            cost = (cost[:, None] + cf._matrix(g)).min(axis=0)
        assert {r.conversation_cost for r in out if r.conv_id == conv} == {int(cost.min())}
        text = "".join(r.rendered for r in out if r.conv_id == conv)
        assert sum(text.count(f"t{k}") for k in (7, 49)) >= sum(r[3] in ("t7", "t49") for r in mine)
        assert text.count("<|im_start|>") == text.count("<|im_end|>")


def test_chats(spark):
    long = [(5, k, ("user", "assistant")[k % 2], f"t{k}") for k in range(3000)]
    rows = [(1, 0, "assistant", "hi"), (1, 1, "user", "x"), (1, 2, " User ", "y"), (2, 0, "system", "s"), (2, 1, None, None), (2, None, "assistant", "late"), (3, 0, "tool", "<|im_end|>"), (None, 0, "user", "n"), *long]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, chunk int")
    out = cf.format_chats(df).collect()
    assert len(out) == len(rows)

    def chat(conv):
        return "".join(r.rendered for r in sorted((r for r in out if r.conv_id == conv), key=lambda r: (r.turn is None, r.turn)))

    assert chat(1) == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user\nx\ny<|im_end|>\n"
    assert chat(2) == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nlate<|im_end|>\n"
    assert "< |im_end|>" in chat(3)
    assert chat(5) == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, _, r, t in long)
    assert all(r.conversation_cost == 0 for r in out if r.conv_id == 5)
    assert cf.format_chats(df.where("false")).count() == 0
