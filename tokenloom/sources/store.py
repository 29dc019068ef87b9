"""Token-sequence stores: Parquet partitioned by dataset, with stored lengths."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sequences import sub_sequence
from ..operators.order import dense_index, prefix_sums
from ..session import materialize

# ---- fixed values: bytes per token of each stored type -------------------------------------
TYPE_BYTES = {
    "uint8": 1,
    "int8": 1,
    "int16": 2,
    "int32": 4,
    "int64": 8,
    "float64": 8,
    "float32": 4,
    "uint16": 2,
}
NARROW_CARDINALITY = 65500
# ---- end of fixed values -------------------------------------------------------------------
RANGES = "_ranges"  # folder of a clustered store's file ranges; readers skip such names
MAX_FILES = 1 << 20
IDENTITY = ("dataset", "doc_id", "seq_no")  # what names a stored sequence


def narrowest_type(cardinality: int | None) -> str:
    return "uint16" if cardinality is not None and cardinality < NARROW_CARDINALITY else "int32"


def write_sequences(
    df: DataFrame, path: str, dataset: str = "dataset", tokens: str = "tokens", mode: str = "errorifexists",
    cluster: str | None = None, files: int | None = None,
) -> None:
    """Write sequences partitioned by dataset. The rebalance hint gathers each dataset's rows into
    well-sized files and lets adaptive execution split a dataset that holds most of the rows.

    With ``cluster``, a key column, rows are sorted by dataset and key over ``files`` ranges, and the lowest and
    highest key of each file are saved beside them, for ``read_requested``."""
    stored = df
    if "n_tokens" not in df.columns:
        stored = stored.withColumn("n_tokens", F.size(tokens))
    if "mode" not in df.columns:
        stored = stored.withColumn("mode", F.lit(0).cast("tinyint"))
    if cluster is None:
        stored = stored.hint("rebalance", dataset)
    else:
        many = [files] if files else []
        stored = stored.repartitionByRange(*many, dataset, cluster).sortWithinPartitions(dataset, cluster)
    stored.write.mode(mode).partitionBy(dataset).parquet(path)
    if cluster is not None:
        spark = df.sparkSession
        keys = read_sequences(spark, path, dataset=dataset).select(dataset, cluster, F.input_file_name().alias("file"))
        ranges = keys.groupBy(dataset, "file").agg(F.min(cluster).alias("lowest"), F.max(cluster).alias("highest"))
        ranges.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RANGES}")


def read_requested(
    spark: SparkSession, path: str, requests: DataFrame, key: str = "doc_id", dataset: str = "dataset"
) -> DataFrame:
    """Those files of a clustered store that can hold a row with the ``(dataset, key)`` of a request.

    The ranges of the files (one row per file, as many as the driver lists anyway) go to the tasks that hold the
    requests; only the numbers of the files that are met come back. Beyond ``MAX_FILES`` files, or where most are
    met, the store is opened whole."""
    whole = read_sequences(spark, path, dataset=dataset)
    ranges = spark.read.parquet(f"{path.rstrip('/')}/{RANGES}")
    if ranges.count() > MAX_FILES:
        return whole
    rows = ranges.select(dataset, "lowest", "highest", "file").collect()
    by_dataset: dict[str, list[int]] = {}
    for i, r in enumerate(rows):
        by_dataset.setdefault(str(r[0]), []).append(i)
    spans = {d: (np.array(at), np.array([rows[i][1] for i in at]), np.array([rows[i][2] for i in at])) for d, at in by_dataset.items()}

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(len(rows), bool)
        for batch in batches:
            names = batch["dataset"].dictionary_encode()
            which, keys = names.indices.to_numpy(zero_copy_only=False), batch["key"].to_numpy(zero_copy_only=False)
            for d, name in enumerate(names.dictionary.to_pylist()):
                if name in spans:
                    at, lowest, highest = spans[name]
                    wanted = np.unique(keys[which == d])
                    met[at[np.searchsorted(wanted, highest, side="right") > np.searchsorted(wanted, lowest)]] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(met))], names=["file"])

    wanted = requests.select(F.col(dataset).cast("string").alias("dataset"), F.col(key).alias("key")).where("dataset is not null and key is not null")
    numbers = [r[0] for r in wanted.mapInArrow(meet, "file bigint").distinct().collect()]
    if 2 * len(numbers) > len(rows):
        return whole
    if not numbers:
        return whole.where("false")
    # The listed files only: the others are neither opened nor listed.
    return spark.read.schema(whole.schema).option("basePath", path).parquet(*[unquote(rows[i].file) for i in sorted(numbers)])


def read_sequences(
    spark: SparkSession, path: str, datasets: Sequence[str] | None = None, dataset: str = "dataset"
) -> DataFrame:
    """Open a store; a dataset list prunes partitions."""
    found = spark.read.parquet(path).schema
    # Dataset names are text even when they look like numbers.
    fixed = T.StructType([T.StructField(f.name, T.StringType() if f.name == dataset else f.dataType) for f in found])
    df = spark.read.schema(fixed).parquet(path)
    return df if datasets is None else df.where(F.col(dataset).isin(list(datasets)))


def take_sequences(
    store: DataFrame, requests: DataFrame, keys: Sequence[str] | None = None, tokens: str = "tokens"
) -> DataFrame:
    """Random access: each row of ``requests`` with ``offset`` and ``length`` returns a part of one
    sequence; a null length reads to the end. A request for an unknown sequence returns null tokens.

    ``keys`` name a sequence of the store; by default those of ``dataset, doc_id, seq_no`` that the store has. A
    dataset or sequence number that requests do not have is taken from the store if all of it has the same one.
    """
    if keys is None:
        keys = [c for c in IDENTITY if c in store.columns]
        for absent in [c for c in keys if c not in requests.columns]:
            values = store.select(absent).distinct().limit(2).collect()
            if len(values) > 1:
                raise ValueError(f"requests do not say which sequence they mean, without {absent}")
            only = F.lit(values[0][0] if values else None)
            requests = requests.withColumn(absent, only.cast(store.schema[absent].dataType))
    keys = list(keys)
    hit = requests.join(store.select(*keys, tokens), keys, "left")
    return hit.withColumn(tokens, sub_sequence(F.col(tokens), F.col("offset"), F.col("length")))


def slice_sequences(store: DataFrame, key: str, begin: int, end: int) -> DataFrame:
    """A contiguous range of sequences, pushed down to the scan."""
    return store.where((F.col(key) >= begin) & (F.col(key) < end))


def with_pointers(
    lengths: DataFrame,
    key: str = "doc_id",
    n_tokens: str = "n_tokens",
    cardinality: int | None = None,
    groups: Sequence[str] = ("dataset",),
    out: str = "pointer",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Byte offset of each sequence inside its dataset, in the order of key and ties."""
    size = TYPE_BYTES[narrowest_type(cardinality)]
    return prefix_sums(lengths, key, {out: F.col(n_tokens).cast("bigint") * size}, groups, ties=ties)


def append_stores(stores: Sequence[DataFrame], key: str = "doc_id", out: str = "new_id") -> DataFrame:
    """Concatenate stores in order; documents are renumbered behind those of earlier stores, in order of
    key, then dataset where there is one. All sequences of a document get its number; a null key or
    dataset stops the job."""
    types = [dict(s.dtypes) for s in stores]
    if any(t != types[0] for t in types):
        raise TypeError("stores must have the same columns and types")
    parts = None
    for i, store in enumerate(stores):
        part = store.withColumn("store_no", F.lit(i))
        parts = part if parts is None else parts.unionByName(part)
    ties = [c for c in ("dataset",) if c in parts.columns]
    # Numbering reads the documents several times; the stores are read once for them and once for the result.
    documents = materialize(parts.select("store_no", key, *ties).distinct(), "append-documents")
    numbered = dense_index(documents, key, "__local", ["store_no"], ties=ties)
    counts = documents.groupBy("store_no").agg(F.count(F.lit(1)).alias("__n"))  # one row per store
    earlier = Window.orderBy("store_no").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("store_no", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    renumbered = numbered.join(F.broadcast(before), "store_no").select(
        "store_no", key, *ties, (F.col("__local") + F.col("__before")).alias(out)
    )
    missing = F.raise_error(F.lit(f"{', '.join([key, *ties])} holds nulls")).cast("bigint")
    return parts.join(renumbered, ["store_no", key, *ties], "left").withColumn(out, F.coalesce(out, missing))


def write_samples(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Packed samples (or any index table) as Parquet; reading it back replaces a rebuild."""
    df.write.mode(mode).parquet(path)


def write_stats(totals: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Token counts per dataset as JSON; one row per dataset."""
    totals.write.mode(mode).json(path)


def read_count_logs(spark: SparkSession, path: str) -> DataFrame:
    """Whole log files whose names begin like ``count*.log``, one row per file. There is one log per dataset, so
    their names fit the driver, which adds the empty ones that a scan passes over."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "count*.log*").load(path)
    logs = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("content").cast("string").alias("value"))
    names = sorted({unquote(f.rsplit("/", 1)[1]) for f in files.inputFiles()})
    found = spark.createDataFrame([(n,) for n in names], "file string").where(F.col("file").rlike(r"^count.*.log"))
    return found.join(logs, "file", "left").select("file", F.coalesce("value", F.lit("")).alias("value"))
