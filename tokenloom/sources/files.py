"""Single files in the shared file system, written by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:").removeprefix("//")
    return pafs.FileSystem.from_uri(uri)


def write_files(df: DataFrame, folder: str, name: str = "name", content: str = "content") -> DataFrame:
    """Write each row's bytes as ``folder/name``, a relative path; returns ``(path, n_bytes)``.

    A file appears under its name when it is complete, and a task that runs again writes the same file, so
    lost executors leave no halves behind. Names must be unique. A null content is an empty file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        made: set[str] = set()
        for batch in batches:
            paths, sizes = [], []
            for file, data in zip(batch["name"].to_pylist(), batch["content"]):
                target, body = f"{root}/{file}", data.as_buffer() or b""
                parent = target.rpartition("/")[0]
                if parent not in made:
                    fs.create_dir(parent, recursive=True)
                    made.add(parent)
                part = f"{parent}/.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(part, compression=None) as f:
                    f.write(body)
                fs.move(part, target)
                paths.append(f"{folder}/{file}")
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "n_bytes"])

    rows = df.select(F.col(name).alias("name"), F.col(content).cast("binary").alias("content"))
    return materialize(rows.mapInArrow(write, "path string, n_bytes bigint"), "written-files")
