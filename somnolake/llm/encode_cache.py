"""Encode each distinct piece of text once per worker, and lay out the ids of all occurrences."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

from somnolake.llm.columnar import offsets, ranges

# of an entry beside its bytes: the object, its slot and its place
_ENTRY = 140


class EncodeCache:
    """Ids by the bytes of the piece; emptied when its entries take `most` bytes or so."""

    def __init__(self, most: int = 48 << 20):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.size = 0
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _add(self, pieces: list[bytes], found: list[list[int]]) -> None:
        length = np.fromiter(map(len, found), np.int64, len(found))
        self.known.update(zip(pieces, range(len(self.length), len(self.length) + len(pieces)), strict=True))
        self.start = np.concatenate([self.start, len(self.flat) + offsets(length)[:-1]])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.int32, int(length.sum()))])
        self.size += sum(map(len, pieces)) + _ENTRY * len(pieces)

    def encode(self, pieces: pa.Array, missing: Callable[[list[bytes]], list[list[int]]]):
        """(ids, lengths) of all pieces of a binary array in order; `missing` encodes new ones."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.size > self.most:
            self._clear()
        fresh = [piece for piece in distinct if piece not in self.known]
        if fresh:
            self._add(fresh, missing(fresh))
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        lengths = self.length[at]
        return self.flat[ranges(self.start[at], lengths)], lengths
