"""Encode manifests as they arrive, with codec files and two sinks: documents, and rows that could not be encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import materialize
from ..sources.manifests import parse_manifest

BATCH = "batch_id"


def quarantine_stream(
    spark: SparkSession,
    source: str,
    schema: str,
    encode: Callable[[DataFrame], DataFrame],
    good: str,
    bad: str,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Read new JSON-lines files below ``source`` and append to two Parquet folders: ``good`` gets the encoded
    documents, ``bad`` the malformed lines (reason ``malformed``, with the line) and the rows that ``encode`` gives a ``reason``.

    ``encode`` may join stored tables, such as codec matrices by path; it sees one micro-batch at a time as an
    ordinary table. Each batch writes folders of its own number and replaces what an earlier try of it
    left there, so a batch that is repeated after a failure is stored once. Processes what is there and stops; a
    rerun with the same checkpoint goes on with the files that came in since. Read the folders with ``read_sink``."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def store(batch: DataFrame, number: int) -> None:
        rows, malformed = parse_manifest(batch, schema, save=True)
        # Both folders read the encoded rows: they are saved once, so that joins and encoding are not done for each.
        done = materialize(encode(rows), "encoded-batch")
        fine = F.col("reason").isNull()
        done.where(fine).drop("reason").write.mode("overwrite").parquet(f"{good}/{BATCH}={number}")
        kept = [c for c in done.columns if c not in ("tokens", "lengths")]
        broken = done.where(~fine).select(*kept, F.lit(None).cast("string").alias("line"))
        lines = malformed.select(F.lit("malformed").alias("reason"), "line")
        broken.unionByName(lines, allowMissingColumns=True).write.mode("overwrite").parquet(f"{bad}/{BATCH}={number}")

    return (
        reader.text(source)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """All rows a sink of ``quarantine_stream`` holds, with the batch they came in."""
    return spark.read.parquet(path)
