"""Chat formatting with minimum-cost repair of the turn order.

A legal chat is an optional system turn, then user and assistant turns in alternation, starting with
the user. Each given turn gets a role; it opens a message, or is merged into the one before it, and
empty messages may be put before it. Dynamic programming over the automaton's states finds the
repair of least total cost; ties go to the first of system, user, assistant.

One step is a min-plus matrix over the states, so a conversation is cut into chunks of
``1 << CHUNK_BITS`` rows, by row numbers that are worked out over sampled ranges: repeated turn numbers, null
ones and rows without conv_id fill chunks like any others. Chunks are summarised apart, and so are as many chunks;
the summaries of a conversation (one small row per million turns) fix the states between them, those the states at
every cut, and chunks are then repaired apart. The cost is that of the whole sequence, and no conversation
has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import dense_index
from .groups import runs
from .tables import materialize, table

ROLES = ("system", "user", "assistant")
START = 3  # states 0-2: the last message has that role
LEGAL = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
MERGE, INSERT = 2, 3
#: Cost of changing a role; any other or missing role is a guess at cost 1.
RELABEL = {0: (0, 4, 6), 1: (6, 0, 4), 2: (6, 4, 0), 3: (2, 1, 1)}
CHUNK_BITS = 10
NEVER = 1 << 40
OPEN, CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"  # fixed markers of the ChatML layout


def _inserted(state: int, role: int) -> tuple[int, ...] | None:
    """The shortest run of empty messages after which ``role`` may follow ``state``."""
    paths = [(state, ())]
    for _ in range(4):
        for s, done in paths:
            if role in LEGAL[s]:
                return done
        paths = [(x, (*done, x)) for s, done in paths for x in LEGAL[s] if x]
    return None


@lru_cache(None)
def step(given: int, state: int, role: int) -> tuple[int, bool, tuple[int, ...]]:
    """(cost, merged, empty messages put before) for a given turn that becomes ``role``."""
    empty = _inserted(state, role)
    cost = NEVER if empty is None else INSERT * len(empty)
    if state == role and MERGE < cost:
        return MERGE + RELABEL[given][role], True, ()
    return (NEVER if empty is None else cost + RELABEL[given][role]), False, empty or ()


@lru_cache(None)
def _matrix(given: int) -> np.ndarray:
    return np.array([[step(given, s, x)[0] if x < 3 else NEVER for x in range(4)] for s in range(4)], np.int64)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), NEVER)


@lru_cache(10_000)  # keys and values are up to a kilobyte
def summary(given: bytes) -> tuple[int, ...]:
    """Least costs from each state to each state over these turns, row by row."""
    m = np.where(np.eye(4, dtype=bool), 0, NEVER)
    for g in given:
        m = product(m, _matrix(g))
    return tuple(m.ravel().tolist())


@lru_cache(10_000)
def repair(given: bytes, entry: int, leave: int) -> bytes:
    """Roles of the cheapest way from state ``entry`` to state ``leave``."""
    cost = [[NEVER] * 4]
    cost[0][entry] = 0
    for g in given:
        m = _matrix(g)
        cost.append([min(cost[-1][s] + int(m[s][x]) for s in range(4)) for x in range(4)])
    roles, at = [], leave
    for k in range(len(given) - 1, -1, -1):
        roles.append(at)
        m = _matrix(given[k])
        at = min(range(4), key=lambda s: (cost[k][s] + int(m[s][at]), s))
    return bytes(roles[::-1])


def cuts(summaries: list[np.ndarray], entry: int = START, leave: int | None = None) -> tuple[int, list[int]]:
    """(cost, states): the state before each chunk and after the last one, which may be given."""
    first = np.full(4, NEVER)
    first[entry] = 0
    cost = [first]
    for m in summaries:
        cost.append((cost[-1][:, None] + m).min(axis=0))
    at = int(cost[-1][:3].argmin()) if leave is None else leave
    total, states = int(cost[-1][at]), [at]
    for k in range(len(summaries) - 1, -1, -1):
        at = int((cost[k] + summaries[k][:, at]).argmin())
        states.append(at)
    return total, states[::-1]


KEYS = ["conv", "chunk"]


def _joined(key: list[str], of_group):
    """One summary per group of ordered rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            conv, at, m = zip(*rows)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(conv), pa.array(at, pa.int64()), pa.array(m, pa.list_(pa.int64()))], names=["conv", key[1], "m"])

        for group in runs(batches, key):
            rows.append((group["conv"][0].as_py(), group[key[1]][0].as_py(), of_group(group)))
            if len(rows) >= 5000:
                yield out()
        if rows:
            yield out()

    return run


def _of_turns(group: pa.RecordBatch) -> tuple[int, ...]:
    return summary(group["given"].to_numpy().astype(np.uint8).tobytes())


def _of_chunks(group: pa.RecordBatch) -> tuple[int, ...]:
    m = np.where(np.eye(4, dtype=bool), 0, NEVER)
    for x in group["m"].flatten().to_numpy().reshape(-1, 4, 4):
        m = product(m, x)
    return tuple(m.ravel().tolist())


_STATES = "entry int, leave int, last boolean, cost bigint"


def _outer_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, parts in zip(batch["conv"].to_pylist(), batch["parts"].to_pylist()):
            total, states = cuts([np.array(p["m"]).reshape(4, 4) for p in parts])
            rows += [{"conv": conv, "part": p["part"], "entry": a, "leave": b, "last": k == len(parts) - 1, "cost": total} for k, (p, a, b) in enumerate(zip(parts, states, states[1:]))]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("conv", pa.string()), ("part", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32()), ("last", pa.bool_()), ("cost", pa.int64())]))


def _inner_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States at the cuts of up to ``1 << CHUNK_BITS`` chunks between two that are known."""
    for group in runs(batches, ["conv", "part"]):
        n = len(group)
        _, states = cuts(list(group["m"].flatten().to_numpy().reshape(-1, 4, 4)), group["entry"][0].as_py(), group["leave"][0].as_py())
        last = np.zeros(n, bool)
        last[-1] = group["last"][0].as_py()
        columns = [group["conv"], group["chunk"], pa.array(states[:-1], pa.int32()), pa.array(states[1:], pa.int32()), pa.array(last), group["cost"]]
        yield pa.RecordBatch.from_arrays(columns, names=["conv", "chunk", "entry", "leave", "last", "cost"])


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in runs(batches, KEYS):
        given, texts = group["given"].to_numpy().astype(np.uint8).tobytes(), group["text"].to_pylist()
        state, roles = group["entry"][0].as_py(), repair(given, group["entry"][0].as_py(), group["leave"][0].as_py())
        actions, counts, parts = [], [], []
        for g, x, text in zip(given, roles, texts):
            _, merged, empty = step(g, state, x)
            actions.append(("relabel_" if g != x else "") + ("merge" if merged else "") or "keep")
            counts.append(len(empty))
            part = "\n" if merged else ("" if state == START else CLOSE) + "".join(OPEN.format(ROLES[e]) + CLOSE for e in empty) + OPEN.format(ROLES[x])
            parts.append(part + (text or "").replace("<|", "< |"))
            state = x
        if group["last"][0].as_py():
            parts[-1] += CLOSE
        yield pa.RecordBatch.from_arrays(
            [group["conv_id"], group["turn"], pa.array([a.removesuffix("_") for a in actions]), pa.array([ROLES[x] for x in roles]), pa.array(counts, pa.int32()), group["cost"], pa.array(parts)],
            names=["conv_id", "turn", "action", "new_role", "n_inserted", "conversation_cost", "rendered"],
        )


def format_chats(turns: DataFrame) -> DataFrame:
    """Repair and render ``turns(conv_id, turn, role, text)``; one row per turn.

    ``rendered`` is the turn's part of the chat: joined in the order of turn, given role and text, the
    parts of a conversation make its text. Roles are trimmed and lower-cased; missing and unknown ones
    may become any role. Null texts are empty, null turns come last, rows without conv_id form one
    conversation, equal turn numbers are ordered by role and text, and repeated rows are turns of their
    own. ``<|`` in a text becomes ``< |``, so that no text holds a marker. Extra columns are ignored; an empty
    table gives an empty result.
    """
    role = F.lower(F.trim("role"))
    given = F.coalesce(*[F.when(role == r, F.lit(k)) for k, r in enumerate(ROLES)], F.lit(3))
    order = F.coalesce(F.col("turn").cast("bigint"), F.lit(2**63 - 1))
    rows = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        order.alias("place"), given.alias("given"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "turns")  # row numbers are fixed from here on; they only tell repeated rows apart
    rows = rows.select("conv_id", "turn", "conv", F.struct("place", "given", "text", "row").alias("order"))
    numbered = dense_index(rows, "order", "no", ["conv"])
    rows = materialize(numbered.select("conv_id", "turn", "conv", "no", F.shiftright("no", CHUNK_BITS).alias("chunk"), "order.given", "order.text"), "numbered")
    narrow = rows.select(*KEYS, "no", "given").repartition(*KEYS).sortWithinPartitions(*KEYS, "no")
    parts = narrow.mapInArrow(_joined(KEYS, _of_turns), "conv string, chunk bigint, m array<bigint>")
    parts = materialize(parts.withColumn("part", F.shiftright("chunk", CHUNK_BITS)), "summaries")
    outer_key = ["conv", "part"]
    outer = parts.repartition(*outer_key).sortWithinPartitions(*outer_key, "chunk").mapInArrow(_joined(outer_key, _of_chunks), "conv string, part bigint, m array<bigint>")
    outer = outer.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "m"))).alias("parts")).mapInArrow(_outer_states, f"conv string, part bigint, {_STATES}")
    inner = parts.join(outer, outer_key).repartition(*outer_key).sortWithinPartitions(*outer_key, "chunk")
    states = inner.mapInArrow(_inner_states, f"conv string, chunk bigint, {_STATES}")
    whole = rows.join(states, KEYS).repartition(*KEYS).sortWithinPartitions(*KEYS, "no")
    return whole.mapInArrow(_rendered, "conv_id bigint, turn bigint, action string, new_role string, n_inserted int, conversation_cost bigint, rendered string")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = format_chats(table(spark, sf_dir, "conversations"))
    return out.withColumns({"rendered_crc32": F.crc32(F.col("rendered").cast("binary")), "rendered_chars": F.length("rendered")})
