"""Token counts, mixture weights and training-length planning."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import without_extension
from .order import dense_index, prefix_sums

# What a token-count log says.
COUNT_PATH = r"Counting tokens in\s+(.*)"
COUNT_TOTAL = r"Total number of tokens:\s+(\d+)"
# End of fixed values.
BILLION = 1_000_000_000


def token_totals(sequences: DataFrame, dataset: str = "dataset", n_tokens: str = "n_tokens") -> DataFrame:
    """Tokens per dataset plus a grand total (null dataset). Reads only the stored lengths."""
    return sequences.rollup(dataset).agg(
        F.sum(n_tokens).cast("bigint").alias("n_tokens"), F.count(F.lit(1)).alias("n_sequences")
    )


def dataset_counts(sequences: DataFrame, dataset: str = "dataset", document: str = "doc_id") -> DataFrame:
    """Sequences and documents per dataset, counted in two additive steps."""
    per_doc = sequences.groupBy(dataset, document).agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy(dataset).agg(
        F.sum("n").cast("bigint").alias("n_sequences"), F.count(F.lit(1)).alias("n_documents")
    )


def parse_count_logs(logs: DataFrame, text: str = "value", on_error: str = "fail", file: str | None = None) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Path and token total of each token-count log (one whole log per row).

    A log without one of them stops the job. ``on_error="quarantine"`` returns ``(good rows, bad logs with their
    problem)`` instead, where ``file`` names a column to carry along.
    """
    carried = [file] if file else []
    found = logs.select(
        *carried,
        F.regexp_extract(text, COUNT_PATH, 1).alias("path"),
        F.regexp_extract(text, COUNT_TOTAL, 1).try_cast("bigint").alias("n_tokens"),
    )
    problem = F.when(F.col("path").isNull() | (F.col("path") == ""), "no path").when(F.col("n_tokens").isNull(), "no token total")
    if on_error == "quarantine":
        judged = found.withColumn("problem", problem)
        return judged.where("problem is null").drop("problem"), judged.where("problem is not null").select(*carried, "problem")
    if on_error != "fail":
        raise ValueError(f"on_error is fail or quarantine, not {on_error!r}")
    stop = F.raise_error(F.concat(F.lit("a token-count log has "), problem)).cast("string")
    return found.withColumn("path", F.when(problem.isNotNull(), stop).otherwise(F.col("path")))


def format_billions(n: Column) -> Column:
    """``x.xxxB``."""
    return F.concat(F.format_string("%.3f", n.cast("double") / BILLION), F.lit("B"))


def parse_billions(text: Column) -> Column:
    """Tokens behind ``x.xxxB``; exact to one million."""
    return F.regexp_replace(text, "B", "").cast("double") * BILLION


def mixture_table(
    rounds: DataFrame, counts: DataFrame, path: str = "path"
) -> tuple[DataFrame, DataFrame]:
    """Mixture rows ``(rounds, path, n_tokens)`` without repeats inside a round, and the paths for
    which no token count is known (must be empty before training)."""
    wanted = rounds.select("rounds", path).dropDuplicates()
    return wanted.join(counts, path), wanted.join(counts, path, "left_anti")


def mixture_weights(mix: DataFrame, mode: str = "tokens", path: str = "path") -> DataFrame:
    """Weight entries ``(rounds, path, copy_no, weight)`` of a blend.

    ``tokens``: one entry weighing ``int(tokens * rounds)``. ``repeat``: ``int(rounds)`` entries of
    weight 1, or one entry weighing the fraction when it is below 1.
    """
    name = without_extension(F.col(path))
    if mode == "tokens":
        weight = (F.col("n_tokens") * F.col("rounds")).cast("bigint").cast("string")
        return mix.select("rounds", name.alias("path"), F.lit(1).alias("copy_no"), weight.alias("weight"))
    copies = F.when(F.col("rounds") >= 1, F.col("rounds").cast("int")).otherwise(F.lit(1))
    weight = F.when(F.col("rounds") >= 1, F.lit("1")).otherwise(F.col("rounds").cast("string"))
    return mix.select(
        "rounds", name.alias("path"), F.explode(F.sequence(F.lit(1), copies)).alias("copy_no"), weight.alias("weight")
    )


def mixture_string(weights: DataFrame) -> DataFrame:
    """The blend argument ``"<weight> <path> "`` repeated in (rounds, path) order. One entry per
    dataset of a training run, so it is a single short string."""
    entries = F.sort_array(F.collect_list(F.struct("rounds", "path", "copy_no", "weight")))
    return weights.agg(
        F.array_join(F.transform(entries, lambda e: F.concat(e["weight"], F.lit(" "), e["path"], F.lit(" "))), "").alias(
            "mixture"
        )
    )


def mixture_totals(mix: DataFrame, global_batch_size: int, seq_length: int) -> DataFrame:
    """Total tokens over all rounds and the training iterations they make."""
    total = F.sum(F.col("n_tokens") * F.col("rounds"))
    return mix.agg(total.alias("total_tokens")).select(
        "total_tokens",
        format_billions(F.col("total_tokens")).alias("total_billions"),
        (F.col("total_tokens") / float(global_batch_size * seq_length)).alias("train_iters"),
    )


def plan_iterations(
    total_tokens: Column, global_batch_size: int, seq_length: int, eval_interval: int, eval_iters: int
) -> Mapping[str, Column]:
    """Iterations and sample targets per split for a token budget."""
    train = (total_tokens / float(global_batch_size * seq_length)).cast("bigint")
    evals = (F.call_function("div", train, F.lit(eval_interval)) + 1) * eval_iters
    return {
        "train_iters": train,
        "eval_iters": evals,
        "test_iters": F.lit(eval_iters).cast("bigint"),
        "train_samples": train * global_batch_size,
        "valid_samples": evals * global_batch_size,
        "test_samples": F.lit(eval_iters * global_batch_size).cast("bigint"),
    }


def with_progress(df: DataFrame, n_bytes: Column, name: str = "progress") -> tuple[DataFrame, Observation]:
    """Count documents and bytes while ``df`` is written, without a second pass. Divide the
    observed totals by the elapsed time for documents/s and MB/s."""
    seen = Observation(name)
    return (
        df.observe(seen, F.count(F.lit(1)).alias("n_docs"), F.sum(n_bytes).cast("bigint").alias("n_bytes")),
        seen,
    )


def document_bytes(line: Column, *matrices: Column, code_bytes: int = 2) -> Column:
    """Bytes a document was made from: its JSON line, and its code matrices as they are stored."""
    size = F.octet_length(line).cast("bigint")
    for m in matrices:
        codes = F.aggregate(m, F.lit(0).cast("bigint"), lambda n, row: n + F.size(row))
        size = size + F.coalesce(codes, F.lit(0).cast("bigint")) * code_bytes
    return size


def interval_totals(df: DataFrame, key: str, n_bytes: Column, every: int, ties: Sequence[str] = ()) -> DataFrame:
    """Documents and bytes so far after each ``every`` documents in key order: ``(n_docs, n_bytes)``, one row per full interval."""
    sized = df.select(key, *ties, n_bytes.cast("bigint").alias("__bytes"))
    numbered = dense_index(sized, key, "__no", ties=ties)
    sums = numbered.groupBy(F.call_function("div", F.col("__no"), F.lit(every)).alias("__part")).agg(F.sum("__bytes").alias("__bytes"), F.count(F.lit(1)).alias("__n"))
    totals = prefix_sums(sums, "__part", {"__before": F.col("__bytes")})
    full = totals.where(F.col("__n") == every)
    return full.select(((F.col("__part") + 1) * every).alias("n_docs"), (F.col("__before") + F.col("__bytes")).alias("n_bytes"))


class ProgressLog:
    """Reports documents/s and MB/s while a job runs, each time ``every`` more documents are done.

    ``watch`` counts a narrow column in the tasks that compute it; counts reach the driver as tasks end, so intervals
    follow finished tasks, and a task that runs twice counts twice. The numbers are for people; exact ones are
    those of ``with_progress`` and ``interval_totals``.
    """

    def __init__(self, spark: SparkSession, every: int, report: Callable[[str], None] = print):
        sc = spark.sparkContext
        self.every, self.report, self.begun, self.lines = every, report, time.monotonic(), 0
        self.docs, self.bytes = sc.accumulator(0), sc.accumulator(0)
        self._stop = threading.Event()
        self._thread = threading.Thread(target=self._watch, daemon=True)

    def watch(self, df: DataFrame, n_bytes: Column) -> DataFrame:
        """``df`` with each document counted when it is computed."""
        docs, total = self.docs, self.bytes

        @F.arrow_udf("boolean")
        def counted(size: pa.Array) -> pa.Array:
            docs.add(len(size))
            total.add(pc.sum(size).as_py() or 0)
            return pa.array(np.ones(len(size), bool))

        return df.where(counted(n_bytes.cast("bigint")))

    def tell(self) -> None:
        """One report for every interval that is full."""
        docs, seconds = self.docs.value, max(time.monotonic() - self.begun, 1e-9)
        while (self.lines + 1) * self.every <= docs:
            self.lines += 1
            rate, volume = docs / seconds, self.bytes.value / seconds / (1 << 20)
            self.report(f"Processed {self.lines * self.every} documents ({rate:.2f} docs/s, {volume:.2f} MB/s).")

    def _watch(self) -> None:
        while not self._stop.wait(0.5):
            self.tell()

    def __enter__(self) -> ProgressLog:
        self._thread.start()
        return self

    def __exit__(self, *_: object) -> None:
        self._stop.set()
        self._thread.join()
        self.tell()


def data_with_index(files: DataFrame, path: str = "path") -> DataFrame:
    """Paths of ``.bin`` files that have an ``.idx`` of the same stem; others are ignored."""
    stem = without_extension(F.col(path))
    data = files.where(F.col(path).endswith(".bin")).withColumn("__stem", stem)
    index = files.where(F.col(path).endswith(".idx")).select(stem.alias("__stem"))
    return data.join(index, "__stem", "left_semi").drop("__stem")
