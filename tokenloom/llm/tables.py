"""Small helpers of the operators in this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, materialize, scratch_path, ship_package

__all__ = ["discard", "documents", "held_remainder", "materialize", "scratch_path", "ship_package", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def held_remainder(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null ids count as the empty text (crc32 0)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod
