"""From a token store to blended training samples per split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pack as P
from ..operators.blend import Blend, blend_frame, blend_requests, blend_schedule, lookup_blended, request_size
from ..operators.split import SPLITS, Bounds, assign_split
from ..session import materialize


def build_split(
    spark: SparkSession,
    lengths: DataFrame,
    sequences: DataFrame,
    blend: Blend,
    target: int,
    cfg: P.PackConfig,
    mode: str = "balanced",
    shuffle: bool = True,
) -> DataFrame:
    """Blended samples of one split: ``(sample_idx, dataset_id, dataset_sample_idx, tokens, doc_ids)``.

    ``lengths`` names the sequences of the split, ``sequences`` holds their tokens. The size is
    the sum of the requests; a single dataset is not blended and gives ``target`` samples. Places and draws are worked out on narrow rows; the schedule and the
    document index are saved once; tokens move only for samples that are really drawn.
    """
    requests = blend_requests(spark, blend, {"s": target}).select("dataset_id", "requested")
    size = target if blend.single else sum(request_size(target, share) for share in blend.shares)
    schedule = materialize(blend_schedule(spark, blend, size, mode), "blend-index")
    # Rounding every request up can make a heavy dataset's draws exceed its own request.
    draws = schedule.groupBy(F.col("dataset_id").cast("int").alias("dataset_id")).agg(F.count(F.lit(1)).alias("draws"))
    wanted = requests.join(draws, "dataset_id", "left").select("dataset_id", F.greatest("requested", F.coalesce("draws", F.lit(0))).alias("requested"))
    # From here on a dataset is its place in the blend, so a name that is listed twice is two datasets.
    entries = F.broadcast(blend_frame(spark, blend).select("dataset_id", F.col("dataset").alias(cfg.dataset)))  # < 32,767 rows
    placed = replace(cfg, dataset="dataset_id")
    named = lengths.select(*cfg.names, cfg.n_tokens).join(entries, cfg.dataset).select(*placed.names, cfg.n_tokens)
    index = materialize(P.tile_epochs(named.join(F.broadcast(wanted), "dataset_id"), placed, F.col("requested")), "document-index")
    _check_supply(wanted, index, blend)
    # The index is a small file that many samples come from: all cores get a part of it.
    index = index.repartition(max(spark.sparkContext.defaultParallelism, len(index.inputFiles())), *placed.names)
    starts = P.sample_index(index, placed).where(F.col("sample") < F.col("n_samples"))
    numbers = starts.select("dataset_id", "sample", "first_range")
    if shuffle:
        numbers = P.shuffle_samples(numbers, placed, "first_range", out="__k")
    else:
        numbers = numbers.withColumn("__k", F.col("sample"))
    drawn = lookup_blended(schedule, numbers.select("dataset_id", "__k", "sample"), "dataset_id", "__k")
    carried = ["sample_idx", "dataset_sample_idx"]
    drawn = drawn.select(F.col("dataset_id").cast("int").alias("dataset_id"), "sample", *carried)
    # Parts and draws are as many as samples; their sizes are known by the rows they are exploded from, so none is broadcast.
    needed = P.sample_parts(index, placed).join(drawn.hint("merge"), ["dataset_id", "sample"])
    tokens = sequences.join(entries, cfg.dataset).select(*placed.names, cfg.tokens)
    samples = P.gather_samples(needed, tokens, placed, carried)
    return samples.select("sample_idx", F.col("dataset_id").cast("smallint").alias("dataset_id"), "dataset_sample_idx", "tokens", "doc_ids")


def _check_supply(requests: DataFrame, index: DataFrame, blend: Blend) -> None:
    """Every dataset must hold the samples that will be drawn from it; one without any token in
    this split cannot, however many epochs are run."""
    supply = index.groupBy("dataset_id").agg(F.max("n_samples").alias("n_samples"))
    short = requests.join(supply, "dataset_id", "left").where(F.col("requested") > F.coalesce("n_samples", F.lit(0)))
    names = [blend.names[r[0]] for r in short.select("dataset_id").orderBy("dataset_id").limit(10).collect()]
    if names:
        raise ValueError(f"datasets without tokens in this split: {names}")


def build_splits(
    spark: SparkSession,
    sequences: DataFrame,
    blend: Blend | dict[str, Blend],
    bounds: Sequence[Bounds],
    targets: dict[str, int],
    cfg: P.PackConfig,
    mode: str = "balanced",
    shuffle: bool = True,
) -> dict[str, DataFrame]:
    """Blended samples per split. With one blend for all, each dataset is cut into contiguous
    split ranges; with a blend per split, every split draws from whole datasets."""
    narrow = sequences.select(*cfg.names, cfg.n_tokens)
    if isinstance(blend, dict):
        chosen = {n: (narrow.where(F.col(cfg.dataset).isin(list(b.names))), b) for n, b in blend.items()}
    else:
        labelled = materialize(assign_split(narrow, bounds, cfg.key, [cfg.dataset], ties=cfg.ties), "splits")
        present = [n for n, b in zip(SPLITS, bounds) if b is not None]
        chosen = {n: (labelled.where(F.col("split") == n), blend) for n in present}
    return {
        name: build_split(spark, lengths, sequences, b, targets[name], cfg, mode, shuffle)
        for name, (lengths, b) in chosen.items()
        if targets.get(name)
    }
