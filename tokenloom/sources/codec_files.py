"""Codec matrices from ``.npy`` files and as JSON records."""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codecs import CodecOptions, codes_to_ids


_INT = np.iinfo(np.int32)


def read_codec(spark: SparkSession, path: str) -> DataFrame:
    """All ``.npy`` files below ``path`` as ``(path, codec, problem)``; see ``decode_npy``. A scan passes over empty files:
    to ``attach_codecs`` they are missing."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.npy")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return decode_npy(files.select("path", "content"))


def npy_matrix(content: pa.Buffer | None) -> tuple[np.ndarray | None, str | None]:
    """The matrix in the bytes of a file, not copied, or what is wrong with it. Values are judged as they are
    stored: nothing wraps, and no fraction is cut off."""
    try:
        if content is None:
            return None, "unreadable"
        f = pa.BufferReader(content)
        version = np.lib.format.read_magic(f)
        header = {(1, 0): np.lib.format.read_array_header_1_0, (2, 0): np.lib.format.read_array_header_2_0}[version]
        shape, by_column, kind = header(f)
        if kind.kind not in "iu":
            return None, "type"
        values = np.frombuffer(content, kind, math.prod(shape), f.tell())
    except (ValueError, TypeError, KeyError, EOFError, OSError, SyntaxError):
        return None, "unreadable"
    if len(shape) != 2:
        return None, "shape"
    if values.size and (values.min() < _INT.min or values.max() > _INT.max):
        return None, "range"
    return values.reshape(shape, order="F" if by_column else "C"), None


def decode_npy(files: DataFrame) -> DataFrame:
    """``(path, content BINARY)`` to ``(path, codec ARRAY<ARRAY<INT>>, problem)``, batch by batch. A file gives a null
    matrix and its problem if it is ``unreadable`` (damaged, cut off or null), not of integers (``type``), not
    two-dimensional (``shape``), or holds integers of more than 32 bits (``range``)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [npy_matrix(c.as_buffer()) for c in batch.column("content")]
            matrices = [np.zeros((0, 0), np.int32) if m is None else m for m, _ in found]
            rows = np.array([len(m) for m in matrices], np.int64)
            wide = np.repeat([m.shape[1] for m in matrices], rows)
            values = np.concatenate([m.ravel() for m in matrices] + [np.zeros(0, np.int32)]).astype(np.int32)
            inner = pa.ListArray.from_arrays(_offsets(wide), pa.array(values))
            codec = pa.ListArray.from_arrays(_offsets(rows), inner, mask=pa.array([m is None for m, _ in found], pa.bool_()))
            problem = pa.array([p for _, p in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("path"), codec, problem], ["path", "codec", "problem"])

    return files.select("path", "content").mapInArrow(decode, "path string, codec array<array<int>>, problem string")


def _offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())


def encode_npy(matrix: Column, dtype: str = "int16") -> Column:
    """A code matrix (or one list of codes) as the bytes of an ``.npy`` file; files are exchanged with 16 bits a code.
    A code that does not fit the type, or rows of different lengths, stop the job; null stays null."""
    kind = np.dtype(dtype)

    @F.arrow_udf("binary")
    def encode(rows: pa.Array) -> pa.Array:
        return pa.array([None if not row.is_valid else _npy_bytes(row.values, kind) for row in rows], pa.binary())

    return encode(matrix)


def _npy_bytes(row: pa.Array, kind: np.dtype) -> bytes:
    shape: tuple[int, ...] = (len(row),)
    if pa.types.is_list(row.type):
        widths = np.unique(pc.list_value_length(row).to_numpy(zero_copy_only=False))
        if len(widths) > 1:
            raise ValueError("the rows of a code matrix differ in length")
        shape, row = (len(row), int(widths[0]) if len(widths) else 0), row.flatten()
    values = row.to_numpy(zero_copy_only=False)
    if kind.kind in "iu" and len(values) and not (np.iinfo(kind).min <= values.min() and values.max() <= np.iinfo(kind).max):
        raise ValueError(f"a code does not fit {kind}")
    buffer = io.BytesIO()
    np.save(buffer, values.astype(kind).reshape(shape))
    return buffer.getvalue()


def codec_to_records(df: DataFrame, path: str, codec: str, opts: CodecOptions) -> DataFrame:
    """Each matrix as a JSON-ready record ``(text: ids, src, codec)``."""
    return df.select(
        codes_to_ids(F.col(codec), opts).alias("text"),
        F.col(path).alias("src"),
        F.lit(opts.spec.name).alias("codec"),
    )
