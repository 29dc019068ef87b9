"""Language identification by the nearest of several centroids per language.

A text is a hashed vector of byte n-grams of its lower-cased letters (other characters count as
spaces), with logarithmic counts, inverse document frequencies and unit length. Each language's
sample is clustered by cosine into up to ``CLUSTERS`` centroids; one that mostly attracts other
languages' samples is dropped. The prediction is the language of the nearest centroid. A text
farther from it than nearly all of the language's own sample is marked ``rejected``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import documents, held_remainder, materialize
from .wordhash import slices, utf8

HELD_MOD, HELD = 4, 2
SIZES = (2, 3, 4)
DIMENSIONS = 4096
CLUSTERS = 4
SAMPLE_PER_LANGUAGE, SAMPLE = 500, 8_000
REJECT_QUANTILE = 0.999
UNKNOWN = "und"
_ROWS = 512
_LETTER = np.full(256, 32, np.uint32)
_LETTER[[*range(97, 123), *range(128, 256)]] = [*range(97, 123), *range(128, 256)]


def counts(arr: pa.Array) -> np.ndarray:
    """Hashed n-gram counts, one row per text."""
    data, off = utf8(pc.utf8_lower(pc.fill_null(arr, "")))
    n, x = len(arr), _LETTER[data]
    row = np.repeat(np.arange(n) * DIMENSIONS, np.diff(off))
    out = np.zeros(n * DIMENSIONS)
    inside = np.ones(len(x), bool)
    key = x.copy()
    for size in range(2, max(SIZES) + 1):
        inside[np.maximum(off[1:] - size + 1, off[:-1])[np.diff(off) > 0]] = False
        key = key[:-1] << np.uint32(8) | x[size - 1 :]
        if size in SIZES:
            ok = inside[: len(key)]
            at = (key * np.uint32(2654435761) ^ np.uint32(size * 0x1E3779B9)) >> np.uint32(32 - 12)
            out += np.bincount(row[: len(key)][ok] + at[ok], minlength=n * DIMENSIONS)
    return out.reshape(n, DIMENSIONS)


def unit(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(x) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Centroids:
    languages: list[str]
    idf: np.ndarray
    center: np.ndarray  # centroids x dimensions
    owner: np.ndarray  # language number of each centroid
    farthest: np.ndarray  # accepted distance of each language

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, cosine, rejected) for count rows."""
        near = unit(x, self.idf).astype(np.float32) @ self.center.T
        best = near.argmax(axis=1)
        cosine = np.clip(near[np.arange(len(x)), best].astype(float), 0, 1)
        lang = self.owner[best]
        return lang, cosine, 1 - cosine > self.farthest[lang]


def cluster(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from farthest-first centres; empty clusters are left out."""
    center = [x.mean(axis=0)]
    for _ in range(min(k, len(x)) - 1):
        center.append(x[(x @ np.array(center).T).max(axis=1).argmin()])
    center = np.array(center)
    for _ in range(rounds):
        own = (x @ center.T).argmax(axis=1)
        center = np.array([x[own == j].sum(axis=0) for j in range(len(center)) if (own == j).any()])
        center /= np.maximum(np.linalg.norm(center, axis=1, keepdims=True), 1e-12)
    return center


def fit_centroids(x: np.ndarray, languages: np.ndarray, clusters: int = CLUSTERS) -> Centroids:
    """Centroids of count rows ``x`` with their languages (at least one row)."""
    names = sorted(set(languages.tolist()))
    number = np.array([names.index(v) for v in languages])
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1
    v = unit(x, idf)
    parts = [cluster(v[number == j], clusters) for j in range(len(names))]
    center, owner = np.concatenate(parts), np.repeat(np.arange(len(names)), [len(p) for p in parts])
    best = (v @ center.T).argmax(axis=1)
    weight = 1 / np.bincount(number, minlength=len(names))[number]  # languages count alike
    total = np.bincount(best, weights=weight, minlength=len(owner))
    own = np.bincount(best, weights=weight * (owner[best] == number), minlength=len(owner))
    keep = (own >= 0.5 * total) & (total > 0)
    for j in range(len(names)):  # every language keeps its best centroid
        mine = np.flatnonzero(owner == j)
        if not keep[mine].any():
            keep[mine[own[mine].argmax()]] = True
    center, owner = center[keep], owner[keep]
    near = v @ center.T
    farthest = np.array([np.quantile(1 - near[number == j][:, owner == j].max(axis=1), REJECT_QUANTILE) for j in range(len(names))])
    return Centroids(names, idf, center.astype(np.float32), owner, farthest)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in _short(batch["text"]):
            part = batch.slice(a, b - a)
            x = np.minimum(counts(part["text"]), 65535).astype("<u2")
            yield pa.RecordBatch.from_arrays([part["lang"], part["rank"], pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "rank", "x"])


def _short(arr: pa.Array) -> Iterator[tuple[int, int]]:
    for a, b in slices(arr):
        for x in range(a, b, _ROWS):
            yield x, min(b, x + _ROWS)


def _predicted(model: Centroids):
    names = np.array([*model.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _short(batch["text"]):
                part = batch.slice(a, b - a)
                lang, cosine, rejected = model.predict(counts(part["text"]))
                known = part["known"].to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(names[np.where(known, lang, len(names) - 1)], pa.string()), pa.array(np.where(known, cosine, 0.0)), pa.array(np.where(known, rejected, True))],
                    names=["doc_id", "lang_pred", "score", "rejected"],
                )

    return run


def training_rows(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, sample: int = SAMPLE) -> DataFrame:
    """``(lang, rank, text)`` of the documents to learn from: per language the distinct texts with the least hash, as
    many as ``per_language`` and a fair part of ``sample`` allow, and at most ``sample`` in all. Copies
    count once, so a text that fills most of a language neither crowds out the others nor is collected often."""
    usable = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    usable = usable.where((held_remainder("doc_id", HELD_MOD) != HELD) & F.col("text").rlike(r"\p{L}")).withColumn("rank", F.xxhash64("text"))
    texts = materialize(usable.groupBy("lang", "rank").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id")).alias("first")), "lang-texts")
    quota = max(1, min(per_language, sample // max(1, texts.select("lang").distinct().count())))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("rank"))  # tasks send no more than the quota of each language
    chosen = texts.withColumn("turn", turn).where(F.col("turn") <= quota).orderBy("turn", "rank", "lang").limit(sample)
    chosen = materialize(chosen.select("lang", "rank", F.col("first.doc_id").alias("named")), "lang-sample")
    rows = usable.join(F.broadcast(chosen), ["lang", "rank"]).where(F.col("doc_id").eqNullSafe(F.col("named")))  # at most ``sample`` rows
    return rows.groupBy("lang", "rank").agg(F.first("text").alias("text"))


def train_centroids(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, sample: int = SAMPLE) -> Centroids | None:
    """Fit on a sample of the documents that are not held out (``training_rows``). None if no document
    has a language."""
    rows = training_rows(docs, per_language, sample).mapInArrow(_counted, "lang string, rank bigint, x binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r.rank))
    return fit_centroids(np.array([np.frombuffer(r.x, "<u2") for r in rows], float), np.array([r.lang for r in rows], object))


def identify_languages(docs: DataFrame, train_docs: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs(doc_id, text, lang)``: held_out, lang_pred, score (cosine) and rejected.

    Null texts and texts without letters are ``und`` with score 0 and rejected, as is everything if no
    training row has a language. Repeated rows and null ids are predicted like any other row; extra
    columns are ignored; an empty table gives an empty result.
    """
    model = train_centroids(docs if train_docs is None else train_docs)
    base = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("known"))
    if model is None:
        out = base.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    else:
        out = base.mapInArrow(_predicted(model), "doc_id bigint, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", (held_remainder("doc_id", HELD_MOD) == HELD).alias("held_out"), "lang_pred", "score", "rejected")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(documents(spark, sf_dir))
