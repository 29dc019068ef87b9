"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown level by level on binned features and stored as flat arrays of a full binary tree
(split feature, threshold, leaf value), so a batch is scored by ``depth`` rounds of numpy gathers.
The model is fitted on at most ``SAMPLE`` labelled rows, those of the least id hash; everything is
scored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import documents, held_remainder, materialize, table
from .textstats import CLASSES, distinct, statistics
from .wordhash import slices

SAMPLE = 16_000
HELD_MOD = 5
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, MIN_ROWS, RIDGE = 60, 4, 48, 0.2, 20, 1.0


def features(arr: pa.Array) -> np.ndarray:
    """One row of statistics per text; null counts as empty."""
    w, h, s = statistics(arr)
    n, chars, words = len(arr), np.maximum(s["chars"], 1), np.maximum(s["n_words"], 1)
    letters = np.maximum(s["upper"] + s["lower"] + s["wide"], 1)
    kinds = distinct(w.rows, h, n) if len(h) else np.zeros(n)
    size = w.end - w.start
    rows = w.rows
    short = np.bincount(rows, weights=size <= 3, minlength=n) if len(h) else np.zeros(n)
    long = np.bincount(rows, weights=size >= 15, minlength=n) if len(h) else np.zeros(n)
    ratios = [s[k] / chars for k in CLASSES if k not in ("tail", "lower", "upper", "rest")]
    return np.stack(
        [np.log1p(s["n_words"]), s["word_chars"] / words, kinds / words, kinds / np.sqrt(words), short / words, long / words, s["upper"] / letters, s["lower"] / letters,
         s["n_repeat_words"] / words, s["n_dup_lines"] / (s["line"] + 1), (s["line"] + 1) / words, s["stop"] / words, s["bang"] / words, s["bar"] / words, *ratios], axis=1,
    ).astype(np.float32)


@dataclass
class Forest:
    """Full trees in flat arrays: node k has the children 2k + 1 and 2k + 2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while node[:1].size and node[0] < inner:  # all rows are on one level
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Forest:
    """Logistic boosting on quantile bins. Without rows, or with one label only, a constant."""
    inner, leaves = 2**depth - 1, 2**depth
    mean = (y.sum() + 0.5) / (len(y) + 1)
    forest = Forest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves)), float(np.log(mean / (1 - mean))))
    if not len(y) or y.min() == y.max():
        return forest
    cuts = [np.unique(np.quantile(c, np.arange(1, bins) / bins)).astype(np.float32) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    k, margin = x.shape[1], np.full(len(y), forest.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            key = ((node - first)[:, None] * k + np.arange(k)) * bins + binned
            shape = (width, k, bins)
            total = [np.bincount(key.ravel(), weights=np.repeat(v, k), minlength=width * k * bins).reshape(shape).cumsum(axis=2) for v in (grad, hess, np.ones(len(y)))]
            (gl, hl, nl), (g, h, n) = total, (v[:, :, -1:] for v in total)
            gain = gl**2 / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g**2 / (h + RIDGE)
            gain[(nl < MIN_ROWS) | (n - nl < MIN_ROWS)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for q in range(width):
                f, b = divmod(int(best[q]), bins)
                if gain[q, f, b] > 1e-6 and b < len(cuts[f]):
                    forest.feature[t, first + q], forest.threshold[t, first + q] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), forest.feature[t, node]] > forest.threshold[t, node])
        at = node - inner
        forest.leaf[t] = rate * np.bincount(at, weights=grad, minlength=leaves) / (np.bincount(at, weights=hess, minlength=leaves) + RIDGE)
        margin += forest.leaf[t][at]
    return forest


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch["text"]):
            part = batch.slice(a, b - a)
            x = features(part["text"])
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([flat, part["quality"]], names=["x", "quality"])


def _scored(forest: Forest, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(forest.scores(features(part["text"]))), *[part[c] for c in carry]], names=["doc_id", "score", *carry])

    return run


def train_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Fit on labelled documents that are not held out; at most ``sample`` rows reach the driver.

    A document with several labels counts as bad if one says so; null ids and labels are left out."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    marked = marked.where(held_remainder("doc_id", HELD_MOD) != 0)
    share = min(1.0, 1.2 * sample / max(1, marked.count()))
    cut = int(share * (2**31 - 1))
    some = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31 - 1)) <= cut).orderBy(F.xxhash64("doc_id")).limit(sample)
    some = materialize(some, "labelled")
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = base.join(some, "doc_id").select("text", "quality").mapInArrow(_featured, "x array<float>, quality int").limit(2 * sample).collect()
    if not rows:
        return fit_forest(np.zeros((0, 1), np.float32), np.zeros(0))
    x, y = np.array([r.x for r in rows], np.float32), np.array([r.quality for r in rows], float)
    order = np.lexsort((*x.T, y))  # the same model whatever order the rows come in
    return fit_forest(x[order], y[order])


def quality_scores(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, carry: Sequence[str] = ()) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: held_out, score and predicted.

    Null texts are scored as empty ones. Repeated rows and null ids get a score like any other row;
    extra columns are ignored but for those named in ``carry``, which are returned with their row; an
    empty table gives an empty result. Without usable labels all scores are one half.
    """
    forest = train_quality(train_docs, labels)
    base = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"), *carry)
    schema = ", ".join(["doc_id bigint, score double", *[f"{c} {base.schema[c].dataType.simpleString()}" for c in carry]])
    out = base.mapInArrow(_scored(forest, [*carry]), schema)
    return out.select("doc_id", (held_remainder("doc_id", HELD_MOD) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *carry)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_scores(docs, docs, table(spark, sf_dir, "labels"))
