"""Quality rules on word counts and on what a public tokeniser makes of a text.

Three measures of the whole text: characters per token, the share of byte-fallback tokens, and the
entropy of the token ids relative to its largest value for that many tokens. Each script has a
rejection band around the median of all documents of the script, ``SPREADS`` interquartile ranges
wide on either side (a range below a tenth of the median counts as that). The band of byte fallback
reaches at least ``BYTE_REACH`` from the median, as its median and range are zero where the
vocabulary spells no letters with bytes. The script is that of most letters, by their Unicode names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .parts import SLICE_BYTES
from .piece_ids import piece_ids, vocabulary_path
from .tables import documents, materialize
from .textstats import statistics
from .wordhash import slices, utf8

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
BYTE_REACH = 0.25
SPREADS = 4.0
#: Words of Unicode names that tell a script other than by the name's first word.
_NAMED = {"CJK": "han", "IDEOGRAPHIC": "han", "HIRAGANA": "kana", "KATAKANA": "kana", "KATAKANA-HIRAGANA": "kana"}
_WIDTHS = ("FULLWIDTH", "HALFWIDTH")
_TWO_WORDS = ("OLD", "NEW", "TAI", "LINEAR")
_HAN, _HANGUL = ((0x3400, 0x4DC0), (0x4E00, 0xA000), (0x20000, 0x40000)), ((0xAC00, 0xD7A4),)
BANDED = ("chars_per_token", "byte_share", "token_entropy")
MEASURES = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "script string, n_tokens bigint, chars_per_token double, byte_share double, token_entropy double"
)


@lru_cache(None)
def scripts() -> tuple[np.ndarray, np.ndarray]:
    """(names, code of each code point): the scripts of all letters; code 0 is no letter."""
    codes = {"none": 0}
    table = np.zeros(0x110000, np.int16)
    for name, spans in (("han", _HAN), ("hangul", _HANGUL)):
        for x, y in spans:
            table[x:y] = codes.setdefault(name, len(codes))
    for point in np.flatnonzero(table[:0x20000] == 0).tolist():
        letter = chr(point)
        if unicodedata.category(letter)[0] == "L":
            name = [*unicodedata.name(letter, "none").split(), ""]
            name = name[1:] if name[0] in _WIDTHS else name
            name = _NAMED.get(name[0]) or " ".join(name[: 1 + (name[0] in _TWO_WORDS)]).lower()
            table[point] = codes.setdefault(name, len(codes))
    return np.array(list(codes)), table


def row_scripts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The code of the script that most letters of each row belong to; ties go to the smaller code."""
    table = scripts()[1]
    at = np.flatnonzero(data >= 0xC0)
    b = np.concatenate((data, np.zeros(3, np.uint8)))
    lead, point = b[at], np.zeros(len(at), np.int32)
    for least, last, more in ((0xC0, 0xDF, 1), (0xE0, 0xEF, 2), (0xF0, 0xF7, 3)):
        some = np.flatnonzero((lead >= least) & (lead <= last))
        value = lead[some].astype(np.int32) & (0x3F >> more)
        for k in range(1, more + 1):
            value = (value << 6) | (b[at[some] + k] & 0x3F)
        point[some] = np.minimum(value, 0x10FFFF)
    code = table[point]
    n, latin = len(off) - 1, table[ord("a")]
    row = np.searchsorted(off, at, side="right") - 1
    row, code = row[code > 0], code[code > 0]
    met = np.union1d(np.flatnonzero(np.bincount(code)), latin)
    rank = np.zeros(len(scripts()[0]), np.int64)
    rank[met] = np.arange(len(met))
    votes = np.bincount(row * len(met) + rank[code], minlength=n * len(met)).reshape(n, len(met))
    ascii_letters = np.concatenate(([0], np.cumsum((data | 0x20) - np.uint8(97) < 26, dtype=np.int64)))
    votes[:, rank[latin]] += np.diff(ascii_letters[off])
    return np.where(votes.any(axis=1), met[votes.argmax(axis=1)], 0)


def token_measures(first: np.ndarray, ids: np.ndarray, is_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, byte share, relative entropy) of each row of ids."""
    n = np.diff(first)
    rows = np.repeat(np.arange(len(n)), n)
    key = np.sort((rows.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64))
    edge = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1], np.ones(min(1, len(key)), bool))))
    count = np.diff(edge)
    row = (key[edge[:-1]] >> np.uint64(32)).astype(np.int64) if len(key) else rows
    share = count / n[row] if len(key) else np.zeros(0)
    entropy = np.bincount(row, weights=-share * np.log2(share), minlength=len(n)) if len(key) else np.zeros(len(n))
    byte = np.bincount(rows, weights=is_byte[ids], minlength=len(n)) if len(key) else np.zeros(len(n))
    return n, byte / np.maximum(n, 1), entropy / np.log2(np.maximum(n, 2))


def _measured(path: str, carry: list[str]):
    names = [x.split()[0] for x in MEASURES.split(", ")] + carry

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_ids(path)
        for batch in batches:
            for a, b in slices(batch["text"], SLICE_BYTES):
                part = batch.slice(a, b - a)
                n, byte, entropy = token_measures(*coder.texts(part["text"]), coder.is_byte)
                done = 0
                for x, y in slices(part["text"]):
                    inner = part.slice(x, y - x)
                    s = statistics(inner["text"])[2]
                    data, off = utf8(inner["text"])
                    script = row_scripts(data, off)
                    at = slice(done, done + y - x)
                    done += y - x
                    yield pa.RecordBatch.from_arrays(
                        [inner["doc_id"], *[pa.array(s[c]) for c in ("n_words", "word_chars", "symbol", "n_dup_lines", "n_repeat_words")], pa.array(scripts()[0][script]),
                         pa.array(n[at]), pa.array(s["chars"] / np.maximum(n[at], 1)), pa.array(byte[at]), pa.array(entropy[at]), *[inner[c] for c in carry]],
                        names=names,
                    )

    return run


def fertility_rules(docs: DataFrame, path: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: base counts, token measures, ``base_failed`` and ``kept``.

    Null, empty and blank texts have no words and fail the base rules. Repeated rows and null ids are
    measured like any other row; extra columns are ignored but for those named in ``carry``, which are
    returned with their row; an empty table gives an empty result.
    """
    base = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"), *carry)
    schema = ", ".join([MEASURES, *[f"{c} {base.schema[c].dataType.simpleString()}" for c in carry]])
    found = materialize(base.mapInArrow(_measured(path or vocabulary_path(), [*carry]), schema), "measures")
    bands = found.groupBy("script").agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(f"q_{c}") for c in BANDED])

    def inside(c: str, least: float = 0.0):
        q = F.col(f"q_{c}")
        reach = F.greatest(F.greatest(q[2] - q[0], q[1] * 0.1) * SPREADS, F.lit(least))
        return F.col(c).between(q[1] - reach, q[1] + reach)

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    good = inside("chars_per_token") & inside("token_entropy") & inside("byte_share", BYTE_REACH)
    # One row per script of Unicode, so the bands may be broadcast.
    out = found.join(F.broadcast(bands), "script").withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & good)
    return out.drop(*[f"q_{c}" for c in BANDED])


def op7_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility_rules(documents(spark, sf_dir))
