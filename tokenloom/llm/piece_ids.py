"""Token ids of whole texts by a public SentencePiece file with byte fallback.

No piece of such a file has a word mark after another letter, nor a line feed, so the ids of a
text are those of its parts (``parts``), joined. Distinct parts that are not known from earlier
slices are encoded together; texts with other white space are encoded whole.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa

from .parts import Known, distinct_parts

MARK = "▁"
VOCABULARY = "piece_bpe_32k.model"
_loaded: dict[str, PieceIds] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceIds:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("this vocabulary has pieces that reach over words")
        self.is_byte = np.array([self.model.is_byte(k) for k in range(len(pieces))])
        self.line_feed = self.model.piece_to_id("<0x0A>")
        self.is_byte[self.line_feed] = False  # a line feed is no sign of a foreign text
        self.known = Known()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def texts(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(first, ids): the ids of row r are ``ids[first[r]:first[r + 1]]``."""
        parts = distinct_parts(arr)
        known = self.known.find(parts.names)
        new = np.flatnonzero(known < 0)
        # The model itself puts a word mark before a text; after a line feed there is none.
        lists = self.encode([t.decode() for t in parts.texts(new, (b"", b"", b"\n"))])
        lists = [ids[1:] if g == 2 else ids for ids, g in zip(lists, parts.glue[new].tolist())]
        length = np.array([len(x) for x in lists], np.int64)
        values = np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(length.sum()))
        first, ids = parts.gather(*self.known.merge(parts.names, known, new, values, length))
        whole = np.flatnonzero(parts.odd)
        if not len(whole):
            return first, ids
        rows = np.split(ids, first[1:-1])
        for r in whole.tolist():
            rows[r] = np.array(self.encode([arr[r].as_py() or ""])[0], np.uint32)
        return np.concatenate(([0], np.cumsum([len(x) for x in rows]))), np.concatenate(rows)


def piece_ids(path: str) -> PieceIds:
    """The model of this worker process."""
    if path not in _loaded:
        _loaded[path] = PieceIds(path)
    return _loaded[path]
