"""WARC archives with a Zstandard dictionary per file.

A file starts with a skippable frame that holds a dictionary trained on records of that file; each
record follows as a frame of its own, so single records can be cut out. Tasks write files of bounded size below a
shared folder and return a manifest row for each. Only files of the saved manifest are read, so
files of lost or repeated task attempts are never counted.

Payloads of at least ``MIN_REVISIT`` bytes that are equal are stored once: the record with the least
page id is the response, the others are revisits that refer to it.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import materialize, scratch_path, table

# Fixed values of the WARC 1.1 and warc.zst formats.
VERSION = "WARC/1.1"
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT = 100
FILE_BYTES = 16 << 20
DICTIONARY_BYTES = 32 << 10
TRAINING_BYTES = 2 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "path string, records bigint, raw_bytes bigint, file_bytes bigint"
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def record_id(page_id: int | None) -> str:
    """The record name of a page; the id can be read back from it."""
    return f"<urn:uuid:{uuid.UUID(int=(1 << 64 if page_id is None else page_id & (1 << 64) - 1))}>"


def page_of(name: str) -> int | None:
    value = uuid.UUID(name[len("<urn:uuid:") : -1]).int
    return None if value >> 64 else value - (1 << 64 if value >> 63 else 0)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One response or revisit record. A revisit keeps the HTTP head, without the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "!#$&'()*+,/:;=?@[]~%-._"


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from evenly spread records; None if there is too little to train on."""
    total = sum(map(len, records))
    step = max(1, -(-total // TRAINING_BYTES))
    some = records[::step]
    if len(some) < 16 or sum(map(len, some)) < 4 * DICTIONARY_BYTES:
        return None
    return zstandard.train_dictionary(DICTIONARY_BYTES, some)


def archive_bytes(records: list[bytes], level: int = LEVEL) -> bytes:
    """The content of a file: the dictionary's skippable frame, then a frame per record."""
    dictionary = train(records)
    out = []
    if dictionary is not None:
        raw = dictionary.as_bytes()
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
    coder = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=True)
    return b"".join(out + [coder.compress(r) for r in records])


def read_archive(stream) -> Iterator[dict]:
    """Records of one archive, in order. A payload that does not match its digest is an error."""
    head = stream.read(8)
    dictionary = None
    if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_MAGIC:
        dictionary = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<II", head)[1]))
        head = b""
    source = io.BufferedReader(_Joined(head, stream))
    plain = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True))
    while line := plain.readline():
        if line.rstrip() != VERSION.encode():
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = {}
        while line := plain.readline().rstrip(b"\r\n"):
            name, value = line.decode().split(": ", 1)
            fields[name] = value
        block = plain.read(int(fields["Content-Length"]))
        plain.read(4)
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        revisit = fields["WARC-Type"] == "revisit"
        if not revisit and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        yield {
            "page_id": page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": page_of(fields["WARC-Refers-To"]) if revisit else None, "payload": None if revisit else payload,
        }


class _Joined(io.RawIOBase):
    def __init__(self, head: bytes, rest):
        self.head, self.rest = head, rest

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.head or self.rest.read(len(buffer))
        data, self.head = data[: len(buffer)], data[len(buffer) :]
        buffer[: len(data)] = data
        return len(data)


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:").removeprefix("//")
    return pafs.FileSystem.from_uri(uri)


def _written(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        fs.create_dir(root, recursive=True)
        held: list[bytes] = []

        def flush() -> pa.RecordBatch:
            data, name = archive_bytes(held), f"{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write(data)
            row = [f"{folder}/{name}", len(held), sum(map(len, held)), len(data)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["path", "records", "raw_bytes", "file_bytes"])

        size = 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*[batch[c] for c in ("page_id", "url", "html", "digest", "refers_to")]):
                html = (html.as_py() or "").encode()
                refers = refers_to.as_py()
                held.append(record_bytes(page_id.as_py(), url.as_py(), html, digest.as_py(), refers, refers is not None))
                size += len(held[-1])
                if size >= file_bytes:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def write_warc(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` below ``folder``; returns the manifest.

    A null html is an empty payload, a null url leaves the target out. Of equal payloads every row with
    the least page id is a response; a row with a null id is a revisit if any id is known. Extra columns are
    ignored; an empty table gives an empty manifest.
    """
    base = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html"))
    base = base.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    heads = base.where(F.octet_length("html") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("head"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    rows = base.join(heads, "digest", "left")
    rows = rows.withColumn("refers_to", F.when(~F.col("head").eqNullSafe(F.col("page_id")), F.col("head")))
    rows = rows.select("page_id", "url", "html", "digest", "refers_to")
    return materialize(rows.mapInArrow(_written(folder, file_bytes), MANIFEST), "manifest")


def _read(payloads: bool):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                fs, name = _file_system(path)
                rows, size = [], 0
                with fs.open_input_stream(name, compression=None) as f:
                    for r in read_archive(f):
                        size += len(r["payload"] or b"")
                        rows.append(r if payloads else r | {"payload": None})
                        if len(rows) >= 2000 or payloads and size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_warc(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the manifest's files. Payload sizes and digests are those of the full payload."""
    files = manifest.select("path").repartition(F.xxhash64("path"))
    return files.mapInArrow(_read(payloads), RECORDS)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_warc(manifest, payloads=False).drop("payload")
