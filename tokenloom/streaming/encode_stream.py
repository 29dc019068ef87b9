"""Encode manifests as they arrive. Checkpoints replace skipping files that were done before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def encode_stream(
    spark: SparkSession,
    source: str,
    schema: str,
    encode: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Read new JSON-lines files below ``source``, apply a row-local encoder, append Parquet to
    ``sink``. Processes what is there and stops; a rerun with the same checkpoint goes on with
    the files that came in since, each exactly once."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        encode(reader.json(source))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )
