"""Packing: lay sequences end to end and cut them into fixed-length training samples.

A sample has ``L + 1`` tokens with stride ``L``; the last token is shared with the next
sample, the incomplete tail is dropped. With flat token positions known, a sequence on
``[s, e)`` contributes to samples ``ceil((s - L) / L) .. floor((e - 1) / L)``, so no range join
and no token-level explode is needed:

1. lengths (narrow) -> flat start positions, by distributed prefix sums per dataset;
2. one narrow row per (sample, sequence) overlap;
3. join the tokens once, slice them, and group by sample. A sample has at most ``L + 1`` parts.

Everything is per dataset, yet never partitioned by dataset alone, so one dataset may hold most
of the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..functions.codecs import EOD
from .order import hash_prefix_sums, hash_rank, prefix_sums

FINAL_EPOCH_THRESHOLD = 0.80


@dataclass(frozen=True)
class PackConfig:
    """How sequences become samples. Results depend on these values and the data only.

    Sequences are ordered by ``key``, then ``ties``, and each is named by dataset, key and ties: a store
    with several sequences per document takes ``ties=("seq_no",)``. Repeated names stop the job."""

    sequence_length: int
    dataset: str = "dataset"
    key: str = "doc_id"
    ties: tuple[str, ...] = ()
    tokens: str = "tokens"
    n_tokens: str = "n_tokens"
    shuffle_documents: bool = False
    seed: int = 1234
    bos: int | None = None
    eod: int = EOD
    reset_position_ids: bool = False
    reset_attention_mask: bool = False
    eod_mask_loss: bool = False

    def __post_init__(self) -> None:
        if self.sequence_length <= 1:
            raise ValueError("sequence_length must be above 1")

    @property
    def names(self) -> list[str]:
        """The columns that name a sequence."""
        return [self.dataset, self.key, *self.ties]


# ---- epochs (scalar arithmetic on token totals) ----------------------------------------------


def tokens_per_epoch(lengths: DataFrame, cfg: PackConfig) -> DataFrame:
    """Tokens one pass over each dataset yields."""
    return lengths.groupBy(cfg.dataset).agg(F.sum(cfg.n_tokens).cast("bigint").alias("tokens_per_epoch"))


def epochs_needed(num_samples: Column, seq_length: int, per_epoch: Column) -> Column:
    """Smallest number of epochs whose tokens cover ``num_samples`` samples."""
    wanted = num_samples.cast("bigint") * seq_length + 1
    return F.greatest(_div(wanted + per_epoch - 1, per_epoch), F.lit(1).cast("bigint"))


def _div(a: Column, b: Column | int) -> Column:
    """Integer division of non-negative numbers; null for a zero divisor."""
    b = F.lit(b) if isinstance(b, int) else b
    return F.call_function("div", a.cast("bigint"), F.nullif(b.cast("bigint"), F.lit(0).cast("bigint")))


def sample_count(epochs: Column, per_epoch: Column, seq_length: int) -> Column:
    """Samples in ``epochs`` passes; the tail is dropped."""
    return F.greatest(_div(epochs * per_epoch - 1, seq_length), F.lit(0).cast("bigint"))


def epoch_plan(totals: DataFrame, cfg: PackConfig, num_samples: Column | int | None = None) -> DataFrame:
    """Epochs, sample counts and the last-epoch decision per dataset.

    The last epoch is shuffled on its own when fewer than 80 % of its samples are needed.
    """
    L, tpe = cfg.sequence_length, F.col("tokens_per_epoch")
    wanted = F.lit(num_samples) if isinstance(num_samples, int) else num_samples
    epochs = F.lit(1).cast("bigint") if wanted is None else epochs_needed(wanted, L, tpe)
    requested = sample_count(F.col("epochs"), tpe, L) if wanted is None else wanted.cast("bigint")
    before_last = _div((F.col("epochs") - 1) * tpe - 1, L)
    per_epoch = _div(tpe - 1, L)
    separate = (F.col("epochs") > 1) & (
        (F.col("requested_samples") - F.col("samples_before_last"))
        < (F.lit(FINAL_EPOCH_THRESHOLD) * F.col("samples_per_epoch")).cast("bigint")
    )
    return (
        totals.withColumn("epochs", epochs)
        .withColumn("requested_samples", requested)
        .withColumn("n_samples", sample_count(F.col("epochs"), tpe, L))
        .withColumn("samples_before_last", F.when(F.col("epochs") > 1, before_last).otherwise(F.lit(0)))
        .withColumn("samples_per_epoch", per_epoch)
        .withColumn("separate_final_epoch", separate)
    )


# ---- flat order of sequences ------------------------------------------------------------------


def tile_epochs(
    lengths: DataFrame, cfg: PackConfig, num_samples: Column | int | None = None
) -> DataFrame:
    """The document index: each sequence once per epoch with its place in the flat order.

    Adds ``epoch, doc_pos`` (0-based place among all sequences), ``start`` (flat token
    position) and ``n_samples``. ``num_samples`` may be a column of ``lengths``.
    """
    narrow = [*cfg.names, cfg.n_tokens]
    extra = [c for c in lengths.columns if c not in narrow and c != cfg.tokens]
    rows = prefix_sums(
        lengths.select(*narrow, *extra),
        cfg.key,
        {"start": F.col(cfg.n_tokens), "doc_pos": F.lit(1)},
        [cfg.dataset],
        totals={"tokens_per_epoch": "start", "docs_per_epoch": "doc_pos"},
        ties=cfg.ties,
    )
    planned = epoch_plan(rows, cfg, num_samples)
    if num_samples is None:
        tiled = planned.withColumn("epoch", F.lit(0).cast("bigint"))
    else:
        tiled = planned.withColumn(
            "epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("epochs") - 1))
        )
    if not cfg.shuffle_documents:
        placed = tiled.withColumn("start", F.col("start") + F.col("epoch") * F.col("tokens_per_epoch")).withColumn(
            "doc_pos", F.col("doc_pos") + F.col("epoch") * F.col("docs_per_epoch")
        )
    else:
        # Shuffle across epochs; a separate final epoch forms its own, later range.
        late = (F.col("separate_final_epoch") & (F.col("epoch") == F.col("epochs") - 1)).cast("int")
        placed = hash_prefix_sums(
            tiled.drop("start", "doc_pos").withColumn("__late", late),
            cfg.seed,
            [cfg.key, *cfg.ties, "epoch"],
            {"start": F.col(cfg.n_tokens), "doc_pos": F.lit(1)},
            [cfg.dataset, "__late"],
        )
        epochs_before = F.col("__late") * (F.col("epochs") - 1)
        placed = placed.withColumn(
            "start", F.col("start") + epochs_before * F.col("tokens_per_epoch")
        ).withColumn("doc_pos", F.col("doc_pos") + epochs_before * F.col("docs_per_epoch"))
    return placed.select(
        *cfg.names, cfg.n_tokens, "epoch", "doc_pos", "start", "n_samples",
        "samples_before_last", "separate_final_epoch",
    )


def sample_index(doc_index: DataFrame, cfg: PackConfig) -> DataFrame:
    """Where each sample starts: ``(sample, doc_pos, offset)``, one row more than samples.
    ``first_range`` tells how many samples come before a separate final epoch."""
    L = cfg.sequence_length
    s, n = F.col("start"), F.col(cfg.n_tokens)
    first = _div(s + L - 1, L)
    last = F.least(_div(s + n - 1, L), F.col("n_samples"))
    return (
        doc_index.where((n > 0) & (first <= last))
        .withColumn("sample", F.explode(F.sequence(first, last)))
        .select(
            cfg.dataset,
            "sample",
            "doc_pos",
            (F.col("sample") * L - F.col("start")).alias("offset"),
            "n_samples",
            F.when(F.col("separate_final_epoch"), F.col("samples_before_last"))
            .otherwise(F.col("n_samples"))
            .alias("first_range"),
        )
    )


def sample_parts(doc_index: DataFrame, cfg: PackConfig) -> DataFrame:
    """One narrow row per overlap of a sequence with a sample."""
    L = cfg.sequence_length
    s, n = F.col("start"), F.col(cfg.n_tokens)
    e = s + n
    first = F.greatest(_div(s - 1, L), F.lit(0).cast("bigint"))
    first = F.when(s > 0, first).otherwise(F.lit(0).cast("bigint"))
    last = F.least(_div(e - 1, L), F.col("n_samples") - 1)
    i = F.col("sample")
    begin = F.greatest(i * L, s)
    end = F.least(i * L + L + 1, e)
    return (
        doc_index.where((n > 0) & (first <= last))
        .withColumn("sample", F.explode(F.sequence(first, last)))
        .select(
            *cfg.names,
            "epoch",
            "sample",
            "doc_pos",
            (begin - s).cast("int").alias("offset"),
            (end - begin).cast("int").alias("length"),
        )
    )


def gather_samples(
    parts: DataFrame, sequences: DataFrame, cfg: PackConfig, carry: Sequence[str] = ()
) -> DataFrame:
    """Fetch the tokens of each part and glue them: ``(dataset, sample, tokens, doc_ids)``.
    ``carry`` names columns of ``parts`` that are the same for all parts of a sample.

    The join is a sort-merge join on purpose: it spreads by document, where the tokens are, and
    not by the few partitions the narrow parts come in; and it spills."""
    tokens = sequences.select(*cfg.names, cfg.tokens).hint("merge")
    pieces = parts.join(tokens, cfg.names).select(
        cfg.dataset,
        "sample",
        *carry,
        F.struct(
            "doc_pos",
            F.col(cfg.key).alias("doc"),
            F.slice(cfg.tokens, F.col("offset") + 1, F.col("length")).alias("part"),
        ).alias("p"),
    )
    ordered = F.sort_array(F.collect_list("p"))
    samples = pieces.groupBy(cfg.dataset, "sample", *carry).agg(ordered.alias("ps"))
    tokens = F.flatten(F.col("ps.part"))
    if cfg.bos is not None:
        tokens = S.add_bos(tokens, cfg.bos, cfg.eod)
    return samples.select(cfg.dataset, "sample", *carry, tokens.alias("tokens"), F.col("ps.doc").alias("doc_ids"))


def pack_samples(
    sequences: DataFrame, cfg: PackConfig, num_samples: Column | int | None = None
) -> DataFrame:
    """Pack token sequences into samples, per dataset. Without ``num_samples`` one epoch is
    packed; with it, as many epochs as that many samples need."""
    extra = [c for c in sequences.columns if c != cfg.tokens]
    index = tile_epochs(sequences.select(*extra), cfg, num_samples)
    return gather_samples(sample_parts(index, cfg), sequences, cfg)


def shuffle_samples(
    samples: DataFrame, cfg: PackConfig, first_range: str | None = None, out: str = "shuffled_no"
) -> DataFrame:
    """Give each sample its place in a random permutation per dataset. Samples below the column
    ``first_range`` (those before a separate last epoch) are permuted among themselves, the
    others after them."""
    if first_range is None:
        return hash_rank(samples, cfg.seed, ["sample"], out, [cfg.dataset], salt="sample")
    split = samples.withColumn("__late", (F.col("sample") >= F.col(first_range)).cast("int"))
    ranked = hash_rank(split, cfg.seed, ["sample"], out, [cfg.dataset, "__late"], salt="sample")
    return ranked.withColumn(out, F.col(out) + F.col("__late") * F.col(first_range)).drop("__late")


def training_fields(samples: DataFrame, cfg: PackConfig, tokens: str = "tokens") -> DataFrame:
    """Inputs, labels, loss mask, positions and attention segments of each sample."""
    inputs = S.model_inputs(F.col(tokens))
    segments = (
        S.segment_ids(F.col("input_ids"), cfg.eod)
        if cfg.reset_attention_mask
        else F.transform(F.col("input_ids"), lambda _: F.lit(0))
    )
    return (
        samples.withColumn("input_ids", inputs)
        .withColumn("labels", S.model_labels(F.col(tokens)))
        .withColumn("loss_mask", S.loss_mask(F.col("input_ids"), cfg.eod, cfg.eod_mask_loss))
        .withColumn("position_ids", S.position_ids(F.col("input_ids"), cfg.reset_position_ids, cfg.eod))
        .withColumn("segment_ids", segments)
    )
