"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before the shuffle) and an equi-join back, so a node with
very many neighbours is neither gathered in one place nor paired with itself. Each round's edges
are written to the shared folder and reread, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialize


def _print(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(u, v)`` links -> one ``(id, root)`` row per linked node; root is the smallest id of its
    component. Null ends and loops are ignored; repeated links do no harm. Empty in, empty out."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialize(edges.where("u is not null and v is not null and u <> v").distinct(), name)
    before = _print(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        small = small.select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct()
        edges = materialize(small, name)
        after = _print(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)
