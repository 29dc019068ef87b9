"""SentencePiece encoding and decoding in numpy, many words at a time.

Distinct words of a slice (with the mark that stands for a space) are grouped by length, so that a
group is a matrix of characters. Rolling hashes of all its substrings probe the sorted hashes of the
vocabulary's pieces once. On these finds run, for all words of a group together,

* ``viterbi``: the segmentation with the largest sum of piece scores; maxima and backpointers are
  kept per end position. This is what a unigram model does.
* ``merge``: best pair first, leftmost on ties, until no pair is a piece. This is what a BPE model
  does; its scores are ranks, so their largest sum is another segmentation.

Characters that are no piece become byte pieces. Decoding puts the pieces' bytes together.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .parts import SLICE_BYTES, Known, distinct_parts
from .piece_ids import MARK, vocabulary_path
from .tables import documents
from .wordhash import mix, slices, utf8

CELLS = 1 << 20
PROBE_BITS = 19
LONG = 256
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPLIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")
_loaded: dict[str, Pieces] = {}


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, data[at : at + size]
            at += size


class Pieces:
    """A vocabulary file's normal pieces as sorted hashes, and its byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            top = [(n, v) for n, v in _fields(f.read()) if n in (2, 3)]
        trainer, normal = (dict(_fields(next((v for n, v in top if n == k), b""))) for k in (2, 3))
        self.kind = {1: "viterbi", 2: "merge"}[trainer.get(3, 1)]
        if normal.get(1) not in (b"identity", b"", None) or normal.get(4, 1) and normal.get(1) is None:
            raise ValueError("only vocabularies without text normalisation are supported")
        n = model.get_piece_size()
        texts = [model.id_to_piece(k) for k in range(n)]
        special = np.array([model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k) for k in range(n)])
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.uint32)
        self.known: dict[str, Known] = {}
        self.model, usable = model, np.flatnonzero(~special)
        self.longest = max(len(texts[k]) for k in usable)
        names = np.empty(len(usable), np.uint64)
        for size in {len(texts[k]) for k in usable}:
            at = [j for j, k in enumerate(usable) if len(texts[k]) == size]
            names[at] = self._spans(np.array([[ord(c) for c in texts[usable[j]]] for j in at], np.uint32), size)[:, 0]
        order = np.argsort(names)
        self.names, self.ids = names[order], usable[order].astype(np.int32)
        if (self.names[1:] == self.names[:-1]).any():
            raise ValueError("two pieces have one hash")
        # Where each value of the leading bits starts among the sorted names.
        self.shift = np.uint64(64 - PROBE_BITS)
        lead = (self.names >> self.shift).astype(np.int64)
        self.lead = np.searchsorted(lead, np.arange((1 << PROBE_BITS) + 1)).astype(np.int32)
        self.crowd = int(np.bincount(lead).max())
        self.score = np.array([model.get_score(k) for k in range(n)])
        self.unknown = float(self.score[usable].min()) - 10
        raw = [bytes([int(texts[k][3:5], 16)]) if model.is_byte(k) else b"" if special[k] else texts[k].replace(MARK, " ").encode() for k in range(n)]
        self.raw, self.raw_size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size

    @staticmethod
    def _spans(chars: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` characters from each place of each row on."""
        n = chars.shape[1] - size + 1
        out = np.zeros((len(chars), n), np.uint64)
        for j in range(size):
            out = out * _BASE + chars[:, j : j + n].astype(np.uint64) + np.uint64(1)
        return mix(out + np.uint64(size))

    def find(self, chars: np.ndarray) -> np.ndarray:
        """``found[row, place, size - 1]``: the id of that substring, or -1."""
        rows, width = chars.shape
        found = np.full((rows, width, min(self.longest, width)), -1, np.int32)
        name = np.zeros((rows, width), np.uint64)
        for size in range(1, found.shape[2] + 1):
            n = width - size + 1
            name = name[:, :n] * _BASE + chars[:, size - 1 :].astype(np.uint64) + np.uint64(1)
            found[:, :n, size - 1] = self.probe(mix(name + np.uint64(size)).ravel()).reshape(rows, n)
        return found

    def probe(self, key: np.ndarray) -> np.ndarray:
        """The ids of hashes among the sorted ones, or -1: a look at the leading bits, then along the few names that share them."""
        out = np.full(len(key), -1, np.int32)
        lead = (key >> self.shift).astype(np.int64)
        at = self.lead[lead]
        some = np.flatnonzero(self.lead[lead + 1] > at)
        at, key = at[some], key[some]
        for j in range(self.crowd):
            place = np.minimum(at + j, len(self.names) - 1)
            hit = self.names[place] == key
            out[some[hit]] = self.ids[place[hit]]
        return out

    def viterbi(self, found: np.ndarray) -> np.ndarray:
        """Marks the first character of each piece of the best-scored segmentation."""
        rows, width, longest = found.shape
        best = np.full((rows, width + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((rows, width + 1), np.int32)
        for end in range(1, width + 1):
            size = np.arange(1, min(longest, end) + 1)
            ids = found[:, end - size, size - 1]
            score = np.where(ids >= 0, self.score[ids], -np.inf)
            score[:, 0] = np.where(ids[:, 0] >= 0, score[:, 0], self.unknown)
            total = best[:, end - size] + score
            back[:, end] = total.argmax(axis=1) + 1
            best[:, end] = total[np.arange(rows), back[:, end] - 1]
        heads = np.zeros((rows, width + 1), bool)
        at = np.full(rows, width)
        row = np.arange(rows)
        while len(row):
            at[row] -= back[row, at[row]]
            heads[row, at[row]] = True
            row = row[at[row] > 0]
        return heads[:, :width]

    def merge(self, found: np.ndarray) -> np.ndarray:
        """Marks the first character of each piece after merging best pairs first."""
        rows, width, longest = found.shape
        heads = np.ones((rows, width), bool)
        row = np.arange(rows)
        cut = np.broadcast_to(np.minimum(np.arange(width + 2), width), (rows, width + 2)).copy()  # symbol starts, then the end
        while len(row) and cut.shape[1] > 2:
            start, size = cut[:, :-2], cut[:, 2:] - cut[:, :-2]
            whole = (cut[:, 1:-1] < width) & (size <= longest)
            ids = found[row[:, None], np.minimum(start, width - 1), np.minimum(size, longest) - 1]
            score = np.where(whole & (ids >= 0), self.score[ids], -np.inf)
            k = score.argmax(axis=1)
            live = score[np.arange(len(row)), k] > -np.inf
            row, cut, k = row[live], cut[live], k[live]
            gone = cut[np.arange(len(row)), k + 1]
            heads[row, gone] = False
            place = np.arange(cut.shape[1] - 1)
            cut = np.where(place > k[:, None], cut[:, 1:], cut[:, :-1])
            if len(row):
                cut = cut[:, : int((cut < width).sum(axis=1).max()) + 2]
        return heads

    def merge_long(self, found: np.ndarray) -> np.ndarray:
        """``merge`` of a single very long word, with a heap."""
        _, width, longest = found.shape
        after, before, alive = [*range(1, width + 1)], [*range(-1, width - 1)], [True] * width
        heap: list[tuple[float, int, int]] = []

        def offer(a: int) -> None:
            if 0 <= a < width and after[a] < width:
                end = after[after[a]]
                if end - a <= longest and (piece := int(found[0, a, end - a - 1])) >= 0:
                    heapq.heappush(heap, (-self.score[piece], a, end))

        for a in range(width):
            offer(a)
        while heap:
            _, a, end = heapq.heappop(heap)
            b = after[a]
            if not alive[a] or b >= width or after[b] != end:
                continue
            alive[b], after[a] = False, end
            if end < width:
                before[end] = a
            offer(a)
            offer(before[a])
        return np.array([alive])

    def segment(self, texts: list[str], kinds: tuple[str, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each kind (ids, length): ids of all words one after another, and how many each has."""
        sizes = np.array([len(t) for t in texts], np.int64)
        chars_of = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        begin = np.cumsum(sizes) - sizes
        done: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in kinds]
        for width in np.unique(sizes[sizes > 0]).tolist():
            every = np.flatnonzero(sizes == width)
            step = max(1, CELLS // (width * min(width, self.longest)))
            for at in np.split(every, range(step, len(every), step)):
                chars = chars_of[begin[at][:, None] + np.arange(width)]
                found = self.find(chars)
                for kind, out in zip(kinds, done):
                    if kind == "merge" and width > LONG:
                        heads = np.concatenate([self.merge_long(found[k : k + 1]) for k in range(len(at))])
                    else:
                        heads = self.viterbi(found) if kind == "viterbi" else self.merge(found)
                    row, head = np.nonzero(heads)
                    end = np.append(head[1:], 0)
                    end = np.where(np.append(row[1:], -1) == row, end, width)
                    ids, row = self._with_bytes(chars[row, head], found[row, head, end - head - 1], row)
                    out.append((at, np.bincount(row, minlength=len(at)), ids))
        result = []
        for out in done:
            length, start = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            pool = np.concatenate([np.zeros(0, np.uint32), *[ids for _, _, ids in out]])
            place = 0
            for at, n, ids in out:
                length[at], start[at] = n, place + np.cumsum(n) - n
                place += len(ids)
            ends = np.cumsum(length)
            result.append((pool[np.repeat(start - ends + length, length) + np.arange(len(pool))], length))
        return result

    def _with_bytes(self, chars: np.ndarray, ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters that are no piece by their UTF-8 bytes' pieces."""
        strange = np.flatnonzero(ids < 0)
        if not len(strange):
            return ids.astype(np.uint32), row
        c = chars[strange].astype(np.int64)
        size = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        n = np.ones(len(ids), np.int64)
        n[strange] = size
        out = np.repeat(ids, n).astype(np.uint32)
        first = (np.cumsum(n) - n)[strange]
        for j in range(4):
            some = size > j
            tail = 6 * (size[some] - 1 - j)
            lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size[some]]
            byte = lead | c[some] >> tail if j == 0 else 0x80 | c[some] >> tail & 0x3F
            out[first[some] + j] = self.bytes[byte]
        return out, np.repeat(row, n)

    def encode(self, arr: pa.Array, kinds: tuple[str, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each kind (first, ids) of whole texts; null counts as empty."""
        parts = distinct_parts(arr)
        memory = [self.known.setdefault(kind, Known()) for kind in kinds]
        known = [m.find(parts.names) for m in memory]  # the kinds know the same parts
        new = np.flatnonzero(known[0] < 0)
        mark = MARK.encode()
        texts = [t.decode() for t in parts.texts(new, (mark, mark, b"\n"))]
        odd = np.flatnonzero(parts.odd)
        spare = [_SPLIT.findall(MARK + t.replace(" ", MARK)) if (t := arr[k].as_py()) else [] for k in odd.tolist()]
        extra = list(dict.fromkeys(p for row in spare for p in row))
        number = {p: k for k, p in enumerate(extra)}
        out = []
        for (ids, length), m, old in zip(self.segment(texts + extra, kinds), memory, known):
            split = int(length[: len(texts)].sum())
            first, values = parts.gather(*m.merge(parts.names, old, new, ids[:split], length[: len(texts)]))
            if len(odd):
                own = np.split(ids[split:], np.cumsum(length[len(texts) :])[:-1]) if extra else []
                rows = np.split(values, first[1:-1])
                for k, row in zip(odd.tolist(), spare):
                    rows[k] = np.concatenate([np.zeros(0, np.uint32), *[own[number[p]] for p in row]])
                first, values = np.concatenate(([0], np.cumsum([len(r) for r in rows]))), np.concatenate(rows)
            out.append((first, values))
        return out

    def decode(self, first: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, data): the bytes of each row's text; the space put before a text is taken off."""
        n = self.raw_size[ids]
        ends = np.concatenate(([0], np.cumsum(n)))
        data = self.raw[np.repeat(self.raw_start[ids] - ends[:-1], n) + np.arange(ends[-1])]
        off = ends[first]
        keep = np.ones(len(data), bool)
        keep[off[:-1][np.diff(off) > 0]] = False
        return np.concatenate(([0], np.cumsum(keep)))[off], data[keep]


def pieces_of(path: str) -> Pieces:
    """The vocabulary of this worker process."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


ENCODED = "doc_id bigint, ids array<bigint>, viterbi_ids array<bigint>, decoded boolean, viterbi_decoded boolean"
DIGEST = "doc_id bigint, n_ids bigint, ids_crc32 bigint, n_viterbi bigint, viterbi_crc32 bigint, decoded boolean, viterbi_decoded boolean"


def _coded(path: str, digest: bool):
    names = [x.split()[0] for x in (DIGEST if digest else ENCODED).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            for a, b in slices(batch["text"], SLICE_BYTES):
                part = batch.slice(a, b - a)
                data, off = utf8(part["text"])
                columns, whole = [], []
                for first, ids in pieces.encode(part["text"], (pieces.kind, "viterbi")):
                    back_off, back = pieces.decode(first, ids)
                    old, new = data.tobytes(), back.tobytes()
                    whole.append(pa.array([old[p:q] == new[x:y] for p, q, x, y in zip(off.tolist(), off[1:].tolist(), back_off.tolist(), back_off[1:].tolist())]))
                    if digest:
                        raw, at = ids.astype("<u4").tobytes(), (4 * first).tolist()
                        columns += [pa.array(np.diff(first).astype(np.int64)), pa.array([zlib.crc32(raw[x:y]) for x, y in itertools.pairwise(at)], pa.int64())]
                    else:
                        columns.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays([part["doc_id"], *columns, *whole], names=names)

    return run


def encode_texts(docs: DataFrame, path: str | None = None, digest: bool = False) -> DataFrame:
    """Ids of each whole text of ``docs(doc_id, text)``: by the vocabulary's own rule (``ids``) and by
    ``viterbi``, and whether each decodes to the text. ``digest`` gives counts and CRC-32s (of little-endian
    unsigned 32-bit ids) in place of the lists.

    Null and empty texts have no ids. Repeated rows and null ids are encoded like any other row; extra
    columns are ignored; an empty table gives an empty result.
    """
    base = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return base.mapInArrow(_coded(path or vocabulary_path(), digest), DIGEST if digest else ENCODED)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(documents(spark, sf_dir), digest=True)
