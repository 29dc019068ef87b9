"""Token ids of whole texts by a public byte-level BPE file.

The file's own pattern always starts a new pre-token at a single space or line feed between two
visible characters, so a text's ids are those of its parts (``parts``), joined. Distinct parts of
a slice that are not known from earlier slices are encoded in one call by the file's merge ranks
in ``tiktoken``; texts with other white
space, and texts that spell one of the file's added tokens, go through ``tokenizers`` whole. Both
give the ids that ``tokenizers`` gives for the file with ``add_special_tokens=False``.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .parts import Known, distinct_parts

_loaded: dict[str, WordIds] = {}


def _byte_letters() -> dict[str, int]:
    """Byte-level files spell bytes as letters: printable Latin-1 as itself, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


class WordIds:
    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.added = [t["content"] for t in model["added_tokens"]]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in piece): n for piece, n in model["model"]["vocab"].items() if piece not in self.added}
        self.tokenizer = Tokenizer.from_file(path)
        coder = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = coder.encode_to_numpy
        self.mark = ranks[b"\r"]
        self.known = Known()

    def texts(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(first, ids): the ids of row r are ``ids[first[r]:first[r + 1]]``."""
        parts = distinct_parts(arr)
        special = np.zeros(len(arr), bool)
        for token in self.added:
            special |= np.asarray(pc.fill_null(pc.match_substring(arr, token), False))
        # A carriage return before a part is always a token of its own.
        known = self.known.find(parts.names)
        new = np.flatnonzero(known < 0)
        ids = self.encode(parts.joined(new, 13).decode(), disallowed_special=()).astype(np.uint32)
        mark = ids == self.mark
        at = np.flatnonzero(mark)
        first, values = parts.gather(*self.known.merge(parts.names, known, new, ids[~mark], np.diff(np.append(at, len(ids))) - 1))
        whole = np.flatnonzero(parts.odd | special)
        if not len(whole):
            return first, values
        rows = np.split(values, first[1:-1])
        for r in whole.tolist():
            rows[r] = np.array(self.tokenizer.encode(arr[r].as_py() or "", add_special_tokens=False).ids, np.uint32)
        return np.concatenate(([0], np.cumsum([len(x) for x in rows]))), np.concatenate(rows)


def word_ids(path: str) -> WordIds:
    """The tokenizer of this worker process."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]
