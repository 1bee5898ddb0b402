"""Byte-level BPE encoding and decoding by longest matches and backtracking."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from somnolake.llm.columnar import column, offsets, ranges, sums, texts
from somnolake.llm.encode_cache import EncodeCache

_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
_NOT_YET = 255


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class ByteBpe:
    """Encode byte strings as repeated merging of the lowest-ranked pair would, in linear time.

    Bytes stand as Latin-1 characters in an Aho-Corasick automaton over all tokens that merging
    can make.  From the left the longest token is taken that is compatible with the one before:
    two tokens are, when merging their joined text gives the two again.  Where none is, the last
    token is taken back and a shorter one tried; places that were given up are never tried again.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        made = []
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            parts = self._merge(token, rank)
            if len(token) == 1:
                self.parts[rank] = (rank, rank)
            elif len(parts) == 2:
                self.parts[rank] = parts
                self.pairs[parts] = rank
            else:
                continue
            made.append((token, rank))
        self.automaton = ahocorasick.Automaton()
        for token, rank in made:
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        # the longest token that is a proper start of a token
        self.shorter: dict[int, int] = {}
        by_bytes = dict(made)
        for token, rank in made:
            for size in range(len(token) - 1, 0, -1):
                if (start := by_bytes.get(token[:size])) is not None:
                    self.shorter[rank] = start
                    break
        self.compatible = lru_cache(maxsize=1 << 16)(self._compatible)

    def _merge(self, token: bytes, below: int) -> tuple[int, ...]:
        """Plain merging with the pairs of lower rank; for the few bytes of a token."""
        parts = [self.ranks[token[i:i + 1]] for i in range(len(token))]
        while len(parts) > 1:
            rank, at = min((self.pairs.get(pair, below), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= below:
                break
            parts[at:at + 2] = [rank]
        return tuple(parts)

    def _compatible(self, left: int, right: int) -> bool:
        """Whether no merge of lower rank crosses the border between two tokens.

        Both tokens are taken apart in the order opposite to merging, the later merge first.  A
        pair that meets at the border would have merged if its rank is below that of the merges
        which its two sides went into afterwards.
        """
        left_until = right_until = None
        while True:
            rank = self.pairs.get((left, right))
            if rank is not None and (left_until is None or rank < left_until) and (right_until is None or rank <= right_until):
                return False
            left_parts, right_parts = self.parts[left], self.parts[right]
            left_ends, right_ends = left_parts == (left, left), right_parts == (right, right)
            if left_ends and right_ends:
                return True
            if right_ends or (not left_ends and left > right):
                left_until, left = left, left_parts[1]
            else:
                right_until, right = right, right_parts[0]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        longest = [(-1, 0)] * size
        for end, match in self.automaton.iter(piece.decode("latin-1")):
            start = end - match[1] + 1
            if match[1] > longest[start][1]:
                longest[start] = match
        out: list[int] = []
        given_up = bytearray(size + 1)
        place, token = 0, longest[0][0]
        while place < size:
            last = out[-1] if out else None
            while token is not None:
                end = place + len(self.bytes_of[token])
                if not given_up[end] and (last is None or self.compatible(last, token)):
                    break
                token = self.shorter.get(token)
            if token is None:
                given_up[place] = 1
                place -= len(self.bytes_of[out[-1]])
                token = self.shorter.get(out.pop())
            else:
                out.append(token)
                place = end
                token = longest[place][0] if place < size else None
        return out


class Splitter:
    """Where the matches of the splitting pattern begin, for many texts at once.

    The pattern takes contractions, then letters, numbers or other characters with one space
    before them, then white space: all but its last character, where something follows.
    """

    def __init__(self):
        self.table = np.full(0x110000, _NOT_YET, np.uint8)
        self.kinds = [(_LETTER, regex.compile(r"\p{L}")), (_NUMBER, regex.compile(r"\p{N}")), (_SPACE, regex.compile(r"\s"))]

    def classes(self, codes: np.ndarray) -> np.ndarray:
        kinds = self.table[codes]
        if (kinds == _NOT_YET).any():
            for code in np.unique(codes[kinds == _NOT_YET]).tolist():
                character = chr(code)
                self.table[code] = next((k for k, p in self.kinds if p.match(character)), _OTHER)
            kinds = self.table[codes]
        return kinds

    def begins(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        kinds = self.classes(codes)
        size = len(codes)
        edge = np.zeros(size + 1, bool)
        edge[starts] = True
        new = edge.copy()
        new[1:size] |= kinds[1:] != kinds[:-1]
        # white space that something follows: its last character stands alone, or joins if it is a blank
        before = np.flatnonzero(new[1:size] & ~edge[1:size] & (kinds[:-1] == _SPACE))
        after_blank = before[codes[before] == 32]
        new[before] = True
        new[after_blank + 1] = False
        # contractions, where an apostrophe begins a match
        marks = np.flatnonzero(codes == 39)
        if len(marks):
            limit = starts[np.searchsorted(starts, marks, "right")]
            for mark, end in zip(marks[new[marks]].tolist(), limit[new[marks]].tolist(), strict=True):
                one = codes[mark + 1] if mark + 1 < end else 0
                two = codes[mark + 2] if mark + 2 < end else 0
                if one in _ONE:
                    length = 2
                elif (one, two) in _TWO:
                    length = 3
                else:
                    continue
                new[mark + 1:mark + length] = False
                if mark + length < size:
                    # a blank that ends the contraction's word begins a match by itself already
                    new[mark + length] = True
        return np.flatnonzero(new[:size])


_ONE = {ord(c) for c in "stmd"}
_TWO = {(ord(a), ord(b)) for a, b in ("re", "ve", "ll")}
_workers: dict = {}


def _worker(key: str, ranks: dict[bytes, int]):
    """One encoder, splitter and cache for each Python worker and vocabulary."""
    if key not in _workers:
        bpe = ByteBpe(ranks)
        size = max(ranks.values()) + 1
        digits = [b"%d," % i for i in range(size)]
        tokens = [bpe.bytes_of.get(i, b"") for i in range(size)]
        flat = lambda rows: (np.frombuffer(b"".join(rows), np.uint8), offsets(np.fromiter(map(len, rows), np.int64, size)))
        _workers[key] = bpe, Splitter(), EncodeCache(), flat(digits), flat(tokens)
    return _workers[key]


def _spelled(ids: np.ndarray, table) -> tuple[bytes, np.ndarray]:
    """The table's entries for all ids, joined, and the length of each."""
    data, starts = table
    lengths = (starts[1:] - starts[:-1])[ids]
    return data[ranges(starts[ids], lengths)].tobytes(), lengths


def encode_documents(documents: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every row and whole text.

    `vocabulary` is the rank file; the driver reads it and sends the ranks.  ids_sha256 is over
    the decimal ids joined by commas, decoded_sha256 over the bytes decoded from the ids.  A null
    text counts as empty and has no tokens; null ids and repeated rows come back as they are.
    """
    ranks = documents.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches):
        bpe, splitter, cache, digits, tokens = _worker(vocabulary, ranks.value)
        for batch in batches:
            for low, high, data, byte_starts in texts(batch):
                codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
                leads = (data & 0xC0) != 0x80
                starts = offsets(leads.astype(np.int64))[byte_starts]
                begin = splitter.begins(codes, starts)
                bounds = np.append(np.flatnonzero(leads)[begin], len(data))
                pieces = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(data)]
                )
                ids, lengths = cache.encode(pieces, lambda found: list(map(bpe.encode, found)))
                counts = sums(lengths, np.searchsorted(begin, starts))
                cuts = offsets(counts)
                spelled, width = _spelled(ids, digits)
                decoded, size = _spelled(ids, tokens)
                spelled_at, decoded_at = offsets(width)[cuts].tolist(), offsets(size)[cuts].tolist()
                sha = lambda data, a, b: hashlib.sha256(memoryview(data)[a:b]).hexdigest()
                columns = [
                    column(batch, "doc_id").slice(low, high - low), pa.array(counts),
                    pa.array([sha(spelled, a, max(a, b - 1)) for a, b in zip(spelled_at, spelled_at[1:], strict=False)]),
                    pa.array([sha(decoded, a, b) for a, b in zip(decoded_at, decoded_at[1:], strict=False)]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def decode(spark: SparkSession, encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); bytes that aren't UTF-8 become replacement characters."""
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches):
        table = _worker(vocabulary, ranks.value)[4]
        for batch in batches:
            out = []
            for ids in column(batch, "ids").to_pylist():
                out.append(_spelled(np.array(ids or [], np.int64), table)[0].decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
