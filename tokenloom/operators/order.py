"""Global order without a global sort: distributed prefix sums and dense numbering.

Spark tables have no implicit order, so every operator that depends on order takes an explicit
unique key. A running sum over that key is computed in a tree:

* leaf buckets hold rows that are next to each other in key order;
* a node table holds one pre-aggregated row per bucket and is summed the same way, in as many
  levels as its size needs.

What a bucket is follows the key. Keys that fill an interval of the integers are cut by their high bits: a unique
key bounds a leaf to ``2 ** shifts[0]`` rows, also inside a group (dataset, track) that owns most of the
rows. One aggregate over the key alone tells whether that is so and how many levels are needed.
All other keys (hashes, strings, sparse 64-bit integers, composite keys) are sorted by ranges that Spark samples;
a row's range is saved with it, so that it stays the same whatever is computed again. Ranges follow the
number of rows and not the values of keys, hold parts of a large group or many small ones, and sorting them may spill.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import hash_bits
from ..session import materialize

# At most 65,536 keys per leaf and 4,096 narrow nodes per window above, for keys below 2**28 and 2**40.
LEAF_SHIFT = 16
FAN_OUT = 12
# Mean rows of a leaf below which integer keys count as sparse.
LEAST_LEAF_ROWS = 64
# Hash keys have 60 uniform bits. A leaf has 8,192 rows of one group in the mean, so nodes stay few; at most 2**20
# leaves, so 10**11 rows make 95,000 per leaf.
HASH_BITS, HASH_LEAF_BITS, MAX_LEAF_BITS = 60, 13, 20
_INTEGERS = ("byte", "short", "integer", "long")


def bucket_shifts(df: DataFrame, key: str) -> tuple[int, ...] | None:
    """Bits to cut by at each level for an integer key that fills its interval, or None. Reads the key only."""
    if df.schema[key].dataType.typeName() not in _INTEGERS:
        return None
    low, high, rows = df.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    if low is None or low < 0:
        return None
    if high >> LEAF_SHIFT and rows / ((high >> LEAF_SHIFT) + 1) < LEAST_LEAF_ROWS:
        return None
    shifts = [LEAF_SHIFT]
    while high >> shifts[-1] >= 1 << FAN_OUT:
        shifts.append(shifts[-1] + FAN_OUT)
    return tuple(shifts)


def prefix_sums(
    df: DataFrame,
    key: str,
    sums: Mapping[str, Column],
    groups: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
    ties: Sequence[str] = (),
    shifts: Sequence[int] | None = None,
) -> DataFrame:
    """Add, per row, the sum of each ``sums`` column over all rows of its group with a smaller
    key. ``totals`` maps names of new columns to names in ``sums`` and adds the group totals.

    ``key`` may have any type that has an order; it must be unique within its group, or unique together with
    ``ties``, which order equal keys. Keys and group columns must not be null; all of it is
    checked at run time. Pass a narrow frame. ``shifts`` states how to cut a non-negative integer key by its bits;
    without it the key is looked at first.
    """
    groups, totals = list(groups), dict(totals or {})
    names = list(sums)
    value = {n: f"__v_{n}" for n in names}

    def checked(name: str, problem: str) -> Column:
        kind = df.schema[name].dataType
        return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(F.raise_error(F.lit(f"{name} {problem}")).cast(kind))

    shifts = shifts or bucket_shifts(df, key)
    # Work on checked copies of the groups: rows must not get lost in the joins below.
    copies = {f"__g{i}": checked(g, "is null") for i, g in enumerate(groups)}
    groups = list(copies)
    rows = df.withColumns({"__k": checked(key, "is null"), **copies, **{value[n]: c.cast("bigint") for n, c in sums.items()}})
    if shifts is None:
        sorted_ = rows.repartitionByRange(*groups, "__k", *ties)
        rows = materialize(sorted_.withColumn("__b0", F.spark_partition_id().cast("bigint")), "sorted-ranges")
        shifts = (0,)
    else:
        rows = rows.withColumn("__b0", F.shiftright(F.col("__k").cast("bigint"), shifts[0]))
    rows = rows.drop("__k")

    def before(over: list[str], order: list[str], name: str) -> Column:
        w = Window.partitionBy(*over).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(name).over(w), F.lit(0).cast("bigint"))

    # Node levels, finest first: one row per bucket with its totals.
    levels = [rows.groupBy(*groups, "__b0").agg(*[F.sum(value[n]).alias(value[n]) for n in names])]
    for low, high in zip(shifts, shifts[1:]):
        i = len(levels)
        levels[-1] = levels[-1].withColumn(f"__b{i}", F.shiftright(F.col(f"__b{i - 1}"), high - low))
        levels.append(
            levels[-1].groupBy(*groups, f"__b{i}").agg(*[F.sum(value[n]).alias(value[n]) for n in names])
        )

    # Top level: running sums over the whole group, then push the offsets down level by level.
    top = len(levels) - 1
    everything = Window.partitionBy(*groups)
    offsets = levels[top].select(
        *groups,
        f"__b{top}",
        *[before(groups, [f"__b{top}"], value[n]).alias(f"__o_{n}") for n in names],
        *[F.sum(value[src]).over(everything).alias(f"__t_{t}") for t, src in totals.items()],
    )
    for i in range(top - 1, -1, -1):
        inner = levels[i].select(
            *groups,
            f"__b{i}",
            f"__b{i + 1}",
            *[before([*groups, f"__b{i + 1}"], [f"__b{i}"], value[n]).alias(f"__i_{n}") for n in names],
        )
        offsets = inner.join(offsets, [*groups, f"__b{i + 1}"]).select(
            *groups,
            f"__b{i}",
            *[(F.col(f"__i_{n}") + F.col(f"__o_{n}")).alias(f"__o_{n}") for n in names],
            *[f"__t_{t}" for t in totals],
        )

    # Equal keys would have no order among themselves: results could differ from run to run.
    identity = F.struct(key, *ties)
    repeated = F.lag(identity).over(Window.partitionBy(*groups, "__b0").orderBy(key, *ties)).eqNullSafe(identity)
    problem = F.raise_error(F.concat(F.lit(f"{', '.join([key, *ties])} is not unique: "), F.to_json(identity))).cast("bigint")

    def inner_sum(name: str) -> Column:
        return F.when(repeated, problem).otherwise(before([*groups, "__b0"], [key, *ties], name))

    local = rows.select(
        *[F.col(c) for c in df.columns],
        *groups,
        "__b0",
        *[inner_sum(value[n]).alias(f"__i_{n}") for n in names],
    )
    return local.join(offsets, [*groups, "__b0"]).select(
        *df.columns,
        *[(F.col(f"__i_{n}") + F.col(f"__o_{n}")).alias(n) for n in names],
        *[F.col(f"__t_{t}").alias(t) for t in totals],
    )


def dense_index(
    df: DataFrame,
    key: str,
    name: str = "row_no",
    groups: Sequence[str] = (),
    total: str | None = None,
    **kwargs,
) -> DataFrame:
    """Number rows 0, 1, 2, ... in key order within each group."""
    return prefix_sums(df, key, {name: F.lit(1)}, groups, {total: name} if total else None, **kwargs)


def hash_shift(rows: int) -> int:
    """How many low bits of a hash the rows of one leaf differ in."""
    return HASH_BITS - min(MAX_LEAF_BITS, (rows >> HASH_LEAF_BITS).bit_length())


def hash_prefix_sums(
    df: DataFrame,
    seed: int,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    groups: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
    salt: str = "",
) -> DataFrame:
    """Prefix sums in a pseudo-random order fixed by ``seed`` and the unique ``keys``. Rows are counted first, for
    as many leaves as they need: with a leaf for every row the nodes would be as many again, in one window per group."""
    shift = hash_shift(df.count())
    hashed = df.withColumn("__h", hash_bits(seed, *[F.col(k) for k in keys], salt=salt))
    return prefix_sums(
        hashed, "__h", sums, groups, totals, ties=keys, shifts=(shift,)
    ).drop("__h")


def hash_rank(
    df: DataFrame,
    seed: int,
    keys: Sequence[str],
    name: str = "shuffled_no",
    groups: Sequence[str] = (),
    salt: str = "",
) -> DataFrame:
    """A random permutation: every row gets a distinct number 0, 1, 2, ... within its group."""
    return hash_prefix_sums(df, seed, keys, {name: F.lit(1)}, groups, salt=salt)
