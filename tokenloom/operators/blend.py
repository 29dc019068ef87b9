"""Blending datasets by weight: requests, the draw schedule, and lookups into the samples."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import let
from ..session import materialize

# Fixed values of the blend format.
MAX_DATASETS = 32767  # dataset numbers are 16-bit
REQUEST_MARGIN = 1.005  # ask for half a percent more than the target

MIN_CHUNK = 4096
MAX_CHUNK = 65_536
RUNS_AT_ONCE = 64
MAX_DRAWS_AT_ONCE = 1 << 22
MAX_WEIGHT = 1 << 120  # of scaled weights; two 64-bit words hold a remainder


@dataclass(frozen=True)
class Blend:
    """Datasets with integer weights, numbered by position. A name may occur more than once: each place is a
    dataset of its own. The ``single`` dataset of a blend without weights is asked for no margin."""

    names: tuple[str, ...]
    weights: tuple[int, ...]
    single: bool = False

    @property
    def shares(self) -> list[float]:
        """Weights normalised to sum to one."""
        whole = float(sum(self.weights))
        return [float(w) / whole for w in self.weights]


def collect_blend(weights: DataFrame, name: str = "dataset", weight: str = "weight") -> Blend:
    """A weight table as plan-time configuration; there are fewer than 32,767 datasets. Real-valued
    weights are scaled to the smallest integers with the same ratios."""
    rows = weights.select(name, F.col(weight).cast("string")).orderBy(name).limit(MAX_DATASETS + 1).collect()
    if len(rows) >= MAX_DATASETS:
        raise ValueError(f"a blend takes fewer than {MAX_DATASETS} datasets")
    return Blend(tuple(r[0] for r in rows), whole_weights([r[1] for r in rows]))


def whole_weights(weights: Sequence[str | float]) -> tuple[int, ...]:
    """Integers in the exact ratios of decimal weights; whole numbers stay as they are."""
    try:
        exact = [Fraction(str(w)) for w in weights]
    except ValueError as e:
        raise ValueError(f"a weight is missing or no number: {e}") from e
    if any(w < 0 for w in exact):
        raise ValueError("weights must not be negative")
    scale = math.lcm(*[w.denominator for w in exact])
    whole = [int(w * scale) for w in exact]
    shrink = math.gcd(*whole) if scale > 1 else 1
    return tuple(w // max(1, shrink) for w in whole)


def blend_frame(spark: SparkSession, blend: Blend) -> DataFrame:
    """The blend as a table ``(dataset_id, dataset, weight, share)``; real weights can scale to integers of
    more than 64 bits, so weights are decimals."""
    rows = [(i, n, Decimal(w), s) for i, (n, w, s) in enumerate(zip(blend.names, blend.weights, blend.shares))]
    return spark.createDataFrame(rows, "dataset_id int, dataset string, weight decimal(38,0), share double")


def blend_entries(blends: DataFrame, text: str = "blend", by: Sequence[str] = ()) -> DataFrame:
    """The entries of blend lists: ``(*by, dataset_id, dataset, weight, share, single)``, one row per dataset and place.

    ``text`` is a list ``[weight, prefix, weight, prefix, ...]`` or the same separated by white space, as
    ``mixture_string`` writes it. A lone prefix is a single dataset with share 1. Shares are weights divided by
    their sum. Rows of ``by`` name the blends (a split, for one). An odd list, a weight that is no number
    or negative, weights that sum to nothing, or too many datasets stop the job; null or blank blends have no entries.
    """
    given = F.col(text)
    if blends.schema[text].dataType.typeName() == "string":
        given = F.filter(F.split(given, r"\s+"), lambda x: x != "")
    parts = blends.select(*by, F.transform(given, lambda x: F.trim(x)).alias("__parts")).where(F.size("__parts") > 0)
    one = F.size("__parts") == 1

    def entry(p: Column, i: Column) -> Column:
        return F.struct(F.get(p, i + 1).alias("dataset"), F.get(p, i).try_cast("double").alias("weight"))

    whole = F.array(F.struct(F.get("__parts", F.lit(0)).alias("dataset"), F.lit(1.0).alias("weight")))
    pairs = let(F.col("__parts"), lambda p: F.transform(F.sequence(F.lit(0), F.size(p) - 1, F.lit(2)), lambda i: entry(p, i)))
    listed = parts.select(*by, one.alias("single"), F.when(one, whole).otherwise(pairs).alias("__entries"), F.size("__parts").alias("__n"))
    bad = F.exists("__entries", lambda e: e["weight"].isNull() | F.isnan(e["weight"]) | (e["weight"] < 0) | (e["weight"] == float("inf")))
    total = F.aggregate("__entries", F.lit(0.0), lambda acc, e: acc + e["weight"])
    problem = (
        F.when(~F.col("single") & (F.col("__n") % 2 == 1), "a blend lists weights and prefixes in turn")
        .when(F.size("__entries") >= MAX_DATASETS, f"a blend takes fewer than {MAX_DATASETS} datasets")
        .when(bad, "a weight of the blend is missing, negative or no number")
        .when(total <= 0, "the weights of the blend sum to nothing")
    )
    checked = listed.select(*by, "single", total.alias("__total"), F.when(problem.isNotNull(), F.raise_error(problem).cast("int")).alias("__stop"), "__entries")
    rows = checked.select(*by, "single", "__total", "__stop", F.posexplode("__entries").alias("dataset_id", "__e"))
    return rows.select(
        *by, (F.col("dataset_id") + F.coalesce("__stop", F.lit(0))).alias("dataset_id"), F.col("__e.dataset").alias("dataset"), F.col("__e.weight").alias("weight"),
        (F.col("__e.weight") / F.col("__total")).alias("share"), "single",
    )


def entry_requests(entries: DataFrame, targets: Mapping[str, int]) -> DataFrame:
    """``(dataset_id, dataset, split, requested)`` of ``blend_entries`` for each split; a single dataset
    is asked for the target itself, others for their share and a margin."""
    splits = F.array(*[F.struct(F.lit(s).alias("split"), F.lit(n).cast("bigint").alias("target")) for s, n in targets.items()])
    each = entries.withColumn("__t", F.explode(splits))
    share = F.ceil(F.col("__t.target").cast("double") * F.col("share") * F.lit(REQUEST_MARGIN)).cast("bigint")
    requested = F.when(F.col("single"), F.col("__t.target")).otherwise(share)
    return each.select("dataset_id", "dataset", F.col("__t.split").alias("split"), requested.alias("requested"))


def parse_blend(blend: str | Sequence[str]) -> Blend:
    """A blend list as plan-time configuration; the weights keep their exact decimal ratios."""
    parts = [str(p).strip() for p in (blend.split() if isinstance(blend, str) else blend)]
    if len(parts) == 1:
        return Blend((parts[0],), (1,), True)
    if not parts or len(parts) % 2:
        raise ValueError("a blend lists weights and prefixes in turn, or one prefix")
    if len(parts) // 2 >= MAX_DATASETS:
        raise ValueError(f"a blend takes fewer than {MAX_DATASETS} datasets")
    weights = whole_weights(parts[::2])
    if not sum(weights):
        raise ValueError("the weights of the blend sum to nothing")
    return Blend(tuple(parts[1::2]), weights)


def fit_weights(weights: Sequence[float], n_datasets: int) -> list[float]:
    """Normalise, then fit to the datasets present: surplus weights are cut off, missing ones
    share what is left of 1. A sum of zero or less gives the single weight 1."""
    whole = sum(weights)
    fitted = [w / whole for w in weights] if whole > 0 else [1.0]
    if len(fitted) > n_datasets:
        return fitted[:n_datasets]
    missing = n_datasets - len(fitted)
    rest = 1.0 - sum(fitted)
    return fitted + [rest / missing] * missing if missing else fitted


def request_size(target: int, share: float) -> int:
    """Samples to ask of one dataset for a blend of ``target`` samples."""
    return int(math.ceil(target * share * REQUEST_MARGIN))


def blend_requests(spark: SparkSession, blend: Blend, targets: Mapping[str, int]) -> DataFrame:
    """``(dataset_id, dataset, split, requested)`` for each dataset and split."""
    return entry_requests(blend_frame(spark, blend).withColumn("single", F.lit(blend.single)), targets)


def _quotients(odd: np.ndarray, w: int, own: np.ndarray, words: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Floor of ``odd * w / own`` and whether something remains, exact, in 64-bit words.

    The quotient is estimated in doubles, where it is off by one at most, as draws stay below
    2**45. The remainder of the estimate is then smaller than two ``own``, so products that wrap round still
    give it exactly: in one word for weights below 2**60, in two (``words``) beyond.
    """
    guess = np.floor(odd * float(w) / own).astype(np.int64)
    if words is None:
        rest = odd * np.int64(w) - guess * own
        step = np.floor_divide(rest, own)
        return guess + step, rest != step * own
    high, low = words
    rest = _minus(_times(odd, np.array([w >> 64]), np.array([w & _WORD], np.uint64)), _times(guess, high, low))
    for _ in range(2):  # the estimate is off by one at most
        less = rest[0] < 0
        guess = guess - less
        rest = _plus(rest, (np.where(less, high, 0), np.where(less, low, np.uint64(0))))
    for _ in range(2):
        over = (rest[0] > high) | (rest[0] == high) & (rest[1] >= low)
        guess = guess + over
        rest = _minus(rest, (np.where(over, high, 0), np.where(over, low, np.uint64(0))))
    return guess, (rest[0] != 0) | (rest[1] != 0)


_UNSURE = 2.0**-48  # relative; far above the rounding of two products
_WORD = (1 << 64) - 1
_HALF = np.uint64((1 << 32) - 1)
_32 = np.uint64(32)


def _words(weights: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(high signed, low unsigned) words of the weights of datasets ``d``."""
    whole = [int(w) for w in weights]
    return np.array([w >> 64 for w in whole], np.int64)[d], np.array([w & _WORD for w in whole], np.uint64)[d]


def _times(a: np.ndarray, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a * (high, low)`` modulo 2**128, for ``a`` in [0, 2**63)."""
    u = a.astype(np.uint64)
    a1, a0, b1, b0 = u >> _32, u & _HALF, low >> _32, low & _HALF
    bottom, cross = a0 * b0, a1 * b0
    middle = cross + (bottom >> _32)
    other = a0 * b1 + (middle & _HALF)
    return (a1 * b1 + (middle >> _32) + (other >> _32)).astype(np.int64) + a * high.astype(np.int64), u * low


def _plus(x, y):
    low = x[1] + y[1]
    return x[0] + y[0] + (low < x[1]), low


def _minus(x, y):
    return x[0] - y[0] - (x[1] < y[1]), x[1] - y[1]


def _places(k: np.ndarray, d: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Place of draw ``k`` of dataset ``d`` when all draws are ordered by ``(k + 1/2) / weight``,
    ties to the lower dataset number: its own number plus the draws of every other dataset that
    come before it. Exact, in integers of 64 bits."""
    odd, place = 2 * k + 1, k.copy()
    wide = weights.dtype == object
    words = _words(weights, d) if wide else None
    own = weights.astype(np.float64)[d] if wide else weights[d]
    turn = odd / own
    for other, w in enumerate(weights.tolist()):
        if w == 0:
            continue
        # How many half steps of the other dataset fit before this draw. Doubles settle all that are not next to
        # a whole number; those are worked out exactly.
        steps = turn * float(w)
        whole = np.floor(steps)
        before = (whole.astype(np.int64) + 1) // 2
        close = np.flatnonzero(np.abs(steps - np.rint(steps)) <= steps * _UNSURE)
        if len(close):
            q, rest = _quotients(odd[close], w, own[close], words and (words[0][close], words[1][close]))
            before[close] = (q + ((other < d[close]) | rest)) // 2  # a draw at the same time comes before if its dataset does
        place += np.where(other == d, 0, before)
    return place


def balanced_schedule(spark: SparkSession, blend: Blend, size: int) -> DataFrame:
    """``size`` draws as ``(sample_idx, dataset_id, dataset_sample_idx)`` with the same mix as the
    exact schedule. Each row's place has a closed form: no sort, no shuffle, no state."""
    # A dataset whose first draw comes after all others are drawn ``size`` times has none, and precedes none.
    heavy = max(blend.weights)
    drawn = [w if w * 2 * (size + 1) > heavy else 0 for w in blend.weights]
    weights = [w // math.gcd(*drawn) for w in drawn]
    whole = sum(weights)
    if max(weights) >= MAX_WEIGHT or size >= 1 << 45:
        raise ValueError("the weights of a blend have too many digits, or its size is above 2**45")
    counts = [size * w // whole + 2 if w else 0 for w in weights]
    ends = np.cumsum(counts)
    kind = np.int64 if max(weights) < 1 << 60 else object

    def draws(batches):
        w = np.array(weights, dtype=kind)
        for pdf in batches:
            ids = pdf["id"].to_numpy()
            d = np.searchsorted(ends, ids, side="right")
            k = ids - (ends[d] - np.array(counts, dtype=np.int64)[d])
            place = _places(k, d, w)
            keep = place < size
            yield pd.DataFrame(
                {"sample_idx": place[keep], "dataset_id": d[keep].astype(np.int16), "dataset_sample_idx": k[keep]}
            )

    return spark.range(int(ends[-1])).mapInPandas(
        draws, "sample_idx bigint, dataset_id smallint, dataset_sample_idx bigint"
    )


def _replay(
    shares: np.ndarray, begins: np.ndarray, drawn: np.ndarray, steps: int, record: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest-deficit draws of several independent runs, one step of all runs at a time.

    Run ``r`` starts at step ``begins[r]`` with counts ``drawn[r]``. Returns the datasets chosen,
    their draw numbers (both runs x steps, empty unless ``record``) and the final counts.
    """
    drawn, runs = drawn.copy(), np.arange(len(begins))
    kept = steps if record else 0
    chosen = np.empty((len(begins), kept), dtype=np.int16)
    numbers = np.empty((len(begins), kept), dtype=np.int64)
    for s in range(steps):
        at = np.maximum(begins + s, 1).astype(np.float64)
        d = np.argmax(shares * at[:, None] - drawn, axis=1)
        if record:
            chosen[:, s] = d
            numbers[:, s] = drawn[runs, d]
        drawn[runs, d] += 1.0
    return chosen, numbers, drawn


def _warm_start(shares: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A guess at the counts reached by each step in ``begins``: rounded shares some steps
    earlier, then a replay up to there."""
    lead = min(8 * len(shares) + 200, int(begins[begins > 0].min(initial=1 << 40)))
    at = np.maximum(begins - lead, 0)
    exact = shares * at[:, None]
    drawn = np.floor(exact + 1e-9)
    order = np.argsort(drawn - exact, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    drawn += rank < (at - drawn.sum(axis=1))[:, None]
    drawn = _replay(shares, at, drawn, lead)[2]
    drawn[begins == 0] = 0.0
    return drawn


def exact_schedule(
    spark: SparkSession, blend: Blend, size: int, chunk: int | None = None, guess=_warm_start
) -> DataFrame:
    """The greedy schedule: at step n draw from the dataset with the largest
    ``share * max(n, 1) - drawn``, ties to the lowest number.

    The recurrence is sequential, so it is cut into chunks that start from guessed counts and
    run in parallel. Counts at both ends of each chunk are a table: a chunk that does not start where the one
    before it ends runs again from there, until none is left, so the result is exact whatever
    the guesses were. No counts reach the driver.
    """
    shares = np.array(blend.shares, dtype=np.float64)
    chunk = chunk or min(MAX_CHUNK, max(MIN_CHUNK, size // 256))
    n_chunks = max(1, -(-size // chunk))
    together = max(1, min(RUNS_AT_ONCE, MAX_DRAWS_AT_ONCE // chunk))

    def groups(batches):
        for pdf in batches:
            for at in range(0, len(pdf), together):
                part = pdf.iloc[at : at + together]
                begins = part["chunk"].to_numpy() * chunk
                known = [s is not None for s in part["start"]]
                starts = np.stack(part["start"].to_list()) if all(known) else guess(shares, begins)
                yield part["chunk"].to_numpy(), begins, starts

    def ends(batches):
        for chunks, begins, starts in groups(batches):
            final = _replay(shares, begins, starts, chunk)[2]
            yield pd.DataFrame({"chunk": chunks, "start": list(starts), "end": list(final)})

    def run(chunks: DataFrame) -> DataFrame:
        return chunks.mapInPandas(ends, "chunk bigint, start array<double>, end array<double>")

    # As many rows at a time as run together; their counts stay small in a worker.
    tasks = min(-(-n_chunks // together), 4 * spark.sparkContext.defaultParallelism)
    first = spark.range(0, n_chunks, 1, tasks).select(F.col("id").alias("chunk"), F.lit(None).cast("array<double>").alias("start"))
    states = materialize(run(first), "blend-states")
    while True:
        reached = states.select((F.col("chunk") + 1).alias("chunk"), F.col("end").alias("reached"))
        wrong = states.join(reached, "chunk").where(F.col("start") != F.col("reached")).select("chunk", F.col("reached").alias("start"))
        wrong = materialize(wrong, "blend-redo")
        if wrong.isEmpty():
            break
        kept = states.join(wrong.select("chunk"), "chunk", "left_anti")
        states = materialize(kept.unionByName(run(wrong.repartition("chunk"))), "blend-states")

    def draws(batches):
        for _, begins, starts in groups(batches):
            chosen, numbers, _ = _replay(shares, begins, starts, chunk, record=True)
            for r, begin in enumerate(begins):
                n = min(chunk, size - begin)
                yield pd.DataFrame(
                    {
                        "sample_idx": begin + np.arange(n, dtype=np.int64),
                        "dataset_id": chosen[r, :n],
                        "dataset_sample_idx": numbers[r, :n],
                    }
                )

    return states.select("chunk", "start").repartition(tasks, "chunk").mapInPandas(
        draws, "sample_idx bigint, dataset_id smallint, dataset_sample_idx bigint"
    )


def blend_schedule(spark: SparkSession, blend: Blend, size: int, mode: str = "balanced") -> DataFrame:
    if mode == "balanced":
        return balanced_schedule(spark, blend, size)
    if mode == "exact":
        return exact_schedule(spark, blend, size)
    raise ValueError(f"unknown blend mode {mode!r}")


def lookup_blended(
    schedule: DataFrame, samples: DataFrame, dataset_id: str = "dataset_id", sample: str = "sample", missing: str = "error"
) -> DataFrame:
    """Attach to each scheduled draw the sample it names. A draw without a sample stops the job, or is left
    out with ``missing="skip"``.

    Samples are merged and never broadcast: Spark would judge their size by the few rows they are derived from."""
    if missing not in ("error", "skip"):
        raise ValueError(f"missing is error or skip, not {missing!r}")
    keyed = samples.withColumnsRenamed({dataset_id: "dataset_id", sample: "dataset_sample_idx"})
    keyed = keyed.withColumn("__found", F.lit(True)).hint("merge")
    if missing == "skip":
        return schedule.join(keyed, ["dataset_id", "dataset_sample_idx"]).drop("__found")
    joined = schedule.join(keyed, ["dataset_id", "dataset_sample_idx"], "left")
    draw = F.concat_ws("/", F.col("dataset_id").cast("string"), F.col("dataset_sample_idx").cast("string"))
    problem = F.raise_error(F.concat(F.lit("no sample for draw "), draw)).cast(joined.schema["dataset_id"].dataType)
    checked = F.when(F.col("__found"), F.col("dataset_id")).otherwise(problem)
    return joined.withColumn("dataset_id", checked).drop("__found")


def achieved_ratios(schedule: DataFrame, blend: Blend, size: int) -> DataFrame:
    """Requested against achieved share per dataset."""
    spark = schedule.sparkSession
    wanted = blend_frame(spark, blend).select("dataset_id", "dataset", "share")
    counts = schedule.groupBy(F.col("dataset_id").cast("int").alias("dataset_id")).agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, "dataset_id", "left").select(
        "dataset_id",
        "dataset",
        "share",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        (F.coalesce("n", F.lit(0)) / float(size)).alias("achieved"),
    )
