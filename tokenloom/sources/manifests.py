"""JSON-lines manifests and file listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import has_extension
from ..operators.order import dense_index
from ..session import materialize

CORRUPT = "_corrupt"

SEGMENT = "struct<line_content:string,duration:double,codec_frame_start:int,codec_frame_end:int>"
SECTION = "struct<label:string,start:double,end:double>"
SONG_SCHEMA = (
    "id string, genres string, audio_length_in_sec double, vocals_codec string, instrumental_codec string,"
    f" codec string, splitted_lyrics struct<segmented_lyrics:array<{SEGMENT}>>, msa array<{SECTION}>"
)
FLAT_SCHEMA = "id string, text string, codec string"


def read_manifest(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, on_error: str = "fail"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Read a manifest (glob, plain or ``.gz``) with an explicit schema.

    ``on_error="fail"`` stops at a malformed line; ``"skip"`` drops it; ``"quarantine"`` returns
    ``(good rows, malformed lines)``.
    """
    if on_error == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if on_error == "skip":
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return parse_manifest(spark.read.text(path), schema)


def parse_manifest(
    lines: DataFrame, schema: str | T.StructType, col: str = "value", save: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split JSON lines into parsed good rows and malformed lines. With ``save``, lines are parsed once and what they hold is
    saved; without it, every plan that reads rows or malformed lines parses them, some more than once."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = lines.where(F.length(F.trim(col)) > 0).select(
        F.from_json(col, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"),
        *([] if save else [F.col(col).alias("line")]),
    )
    if save:  # a malformed line is the record that could not be read
        parsed = materialize(parsed, "manifest").withColumn("line", F.col(f"r.{CORRUPT}"))
    bad = F.col(f"r.{CORRUPT}").isNotNull()
    good = parsed.where(~bad).select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in fields.fields])
    return good, parsed.where(bad).select("line")


def list_files(spark: SparkSession, path: str, extensions: Sequence[str]) -> DataFrame:
    """Files below ``path`` with one of the extensions (any case); contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return filter_files(files.select("path", "length"), "path", extensions)


def filter_files(files: DataFrame, name: str, extensions: Sequence[str]) -> DataFrame:
    return files.where(has_extension(F.col(name), extensions))


def assign_partition(
    df: DataFrame, key: str, partitions: int, mode: str = "round_robin", out: str = "partition"
) -> DataFrame:
    """Spread manifest lines over partitions by line number: dealt out in turn, or in sequential
    blocks of ``ceil(N / P)`` lines."""
    numbered = dense_index(df, key, "__line", total="__lines")
    if mode == "round_robin":
        number = F.pmod("__line", F.lit(partitions))
    else:
        block = F.call_function("div", F.col("__lines") + partitions - 1, F.lit(partitions))
        number = F.call_function("div", F.col("__line"), block)
    return numbered.withColumn(out, number.cast("int")).drop("__line", "__lines")
