"""Token ids in files of wavelet matrices: read any token, count, and find occurrences."""

from __future__ import annotations

import re
import zlib
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from somnolake.llm.columnar import (
    blobs, column, offsets, partitions, ranges, shared_path, sums, texts,
)
from somnolake.llm.encode_cache import EncodeCache

BITS = 16
RANK_EVERY = 512
PIECE_TEXT = 1 << 20
SEGMENT_TOKENS = 1 << 21
CACHE_BYTES = 96 << 20  # of pieces and their ids, in a worker
SCHEMA = (
    "shard int, segment int, first long, n_tokens long, doc_ids binary, lengths binary, null_ids binary, "
    "zeros array<long>, planes array<binary>, ranks array<binary>"
)


class WaveletMatrix:
    """Ids below 2**BITS as one bit plane for each bit, the highest first.

    Below each plane the ids are parted stably by its bit, the zeros first.  With the number of
    ones up to every RANK_EVERY-th position, a rank looks at one short stretch of a plane.
    """

    def __init__(self, size: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.size, self.zeros = size, zeros
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, np.uint32) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        now, zeros, planes, ranks = ids.astype(np.uint16), [], [], []
        for bit in range(BITS - 1, -1, -1):
            ones = ((now >> np.uint16(bit)) & np.uint16(1)).astype(bool)
            plane = np.packbits(ones, bitorder="little")
            planes.append(plane.tobytes())
            per = np.bitwise_count(plane)
            blocks = np.add.reduceat(per, np.arange(0, len(per), RANK_EVERY // 8), dtype=np.uint32) if len(per) else per
            ranks.append(offsets(blocks).astype(np.uint32).tobytes())
            low, high = np.flatnonzero(~ones), np.flatnonzero(ones)
            zeros.append(len(low))
            now = np.concatenate([now.take(low), now.take(high)])
        return cls(len(ids), zeros, planes, ranks)

    def _ones_before(self, level: int, at: int) -> int:
        block = at // RANK_EVERY
        first = block * RANK_EVERY // 8
        bits = np.unpackbits(self.planes[level][first:(at + 7) // 8], bitorder="little", count=at - first * 8)
        return int(self.ranks[level][block]) + int(bits.sum())

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3] >> (at & 7)) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        value = 0
        for level in range(BITS):
            bit, ones = self._bit(level, at), self._ones_before(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        for level in range(BITS):
            a, b = self._ones_before(level, low), self._ones_before(level, high)
            if token >> (BITS - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often an id stands in [low, high)."""
        a, b = self._range(token, low, self.size if high is None else high)
        return b - a

    def _nth(self, level: int, bit: int, n: int) -> int:
        """The position of the n-th (from 0) one or zero of a plane."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * RANK_EVERY - ranks
        block = int(np.searchsorted(before, n, "right")) - 1
        first = block * RANK_EVERY
        bits = np.unpackbits(self.planes[level][first // 8:(first + RANK_EVERY) // 8], bitorder="little")
        return first + int(np.flatnonzero(bits == bit)[n - int(before[block])])

    def occurrences(self, token: int) -> list[int]:
        """All positions of an id, rising."""
        low, high = self._range(token, 0, self.size)
        out = []
        for at in range(low, high):
            for level in range(BITS - 1, -1, -1):
                bit = token >> (BITS - 1 - level) & 1
                at = self._nth(level, bit, at - (self.zeros[level] if bit else 0))
            out.append(at)
        return out

    def decode(self) -> np.ndarray:
        """All ids in order: the planes undone from the last to the first."""
        now = np.zeros(self.size, np.uint16)
        for level in range(BITS - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], bitorder="little", count=self.size).view(bool)
            up = np.empty_like(now)
            up[np.flatnonzero(~ones)] = now[:self.zeros[level]]
            up[np.flatnonzero(ones)] = now[self.zeros[level]:] | np.uint16(1 << (BITS - 1 - level))
            now = up
        return now


_SPACE, _LETTER, _DIGIT, _MARK, _GLUE = range(5)


def _byte_classes() -> np.ndarray:
    table = np.full(256, _MARK, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = _SPACE
    table[ord("a"):ord("z") + 1] = _LETTER
    table[ord("A"):ord("Z") + 1] = _LETTER
    table[ord("0"):ord("9") + 1] = _DIGIT
    table[ord("'")] = _GLUE
    table[0x80:] = _GLUE
    return table


_CLASSES = _byte_classes()
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32


def units(
    data: np.ndarray, starts: np.ndarray, added: tuple[np.ndarray, np.ndarray],
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, number of the added token or -1) of stretches that are encoded alike alone and in their text.

    The strings of added tokens, from added[0] to added[1], are stretches of their own.  White space parts them, and so does a change between plain letters, ASCII digits and other
    ASCII characters, where no apostrophe and no character that normalising might join is near.
    """
    kinds = _CLASSES[data]
    high = np.flatnonzero(data == 0xC3)  # the letters of Latin-1: two bytes that begin with C3
    high = high[high + 1 < len(data)]
    high = high[(data[high + 1] != 0x97) & (data[high + 1] != 0xB7)]
    kinds[high] = _LETTER
    kinds[high + 1] = _LETTER
    change = np.zeros(len(data) + 1, bool)
    left, right = kinds[:-1], kinds[1:]
    space = (left == _SPACE) | (right == _SPACE)
    change[1:-1] = (left != right) & (space | ((left != _GLUE) & (right != _GLUE)))
    change[starts] = True
    added_begin, added_end = added
    for a, b in zip(added_begin.tolist(), added_end.tolist(), strict=True):
        change[a + 1:b] = False
    change[added_begin] = change[added_end] = True
    begin = np.flatnonzero(change[:-1])
    end = np.append(begin[1:], len(data))
    number = np.full(len(begin), -1, np.int64)
    number[np.searchsorted(begin, added_begin)] = np.arange(len(added_begin))
    solid = (kinds[begin] != _SPACE) | (number >= 0)
    return begin[solid], end[solid], number[solid]


class AddedTokens:
    """The strings that a tokenizer takes out of the raw text, before it is normalised, and their ids."""

    def __init__(self, tokenizer: Tokenizer):
        found = tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in found.values()):
            raise ValueError("added tokens are matched as they are, in raw text")
        self.ids = {t.content.encode(): i for i, t in found.items()}
        longest_first = sorted(self.ids, key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, longest_first))) if found else None

    def find(self, data: np.ndarray, starts: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], list[int]]:
        """((begin, end), ids) of all places; none crosses the border of two texts."""
        places, raw = [], data.tobytes()
        if self.pattern and self.pattern.search(raw):
            for a, b in zip(starts.tolist(), starts[1:].tolist(), strict=False):
                places.extend(self.pattern.finditer(raw, a, b))
        begin, end = (np.array([m.span()[i] for m in places], np.int64) for i in range(2))
        return (begin, end), [self.ids[m.group()] for m in places]


# small letters that no normalising changes: a to z, and those of Latin-1
_LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
_WORD = re.compile(f"[{_LETTERS}]+")


class PieceEncoder:
    """Ids of pieces, each as if encoded alone.

    A word of small letters goes straight to the tokenizer's model, which takes a third of the
    time, if the steps before leave the alphabet as it is, in one stretch, each letter as
    characters of its own.  All other pieces take all steps.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters: dict[int, str] | None = None
        before, cut = tokenizer.normalizer, tokenizer.pre_tokenizer
        if cut is not None and (before is None or before.normalize_str(_LETTERS) == _LETTERS):
            parts = {ord(c): "".join(text for text, _ in cut.pre_tokenize_str(c)) for c in _LETTERS}
            if [text for text, _ in cut.pre_tokenize_str(_LETTERS)] == [_LETTERS.translate(parts)]:
                self.letters = parts

    def _whole(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def __call__(self, pieces: list[bytes]) -> list[list[int]]:
        if self.letters is None:
            return self._whole([p.decode() for p in pieces])
        found: list[list[int]] = []
        rest: list[int] = []
        tokenize, word, letters = self.model.tokenize, _WORD.fullmatch, self.letters
        for at, piece in enumerate(pieces):
            text = piece.decode()
            if word(text):
                found.append([t.id for t in tokenize(text if len(text) == len(piece) else text.translate(letters))])
            else:
                found.append([])
                rest.append(at)
        for at, ids in zip(rest, self._whole([pieces[at].decode() for at in rest]), strict=True):
            found[at] = ids
        return found


_workers: dict = {}


def _worker(path: str, source: str):
    if path not in _workers:
        tokenizer = Tokenizer.from_str(source)
        tokenizer.encode_special_tokens = True  # they are found in raw text; what folding makes alike is ordinary
        _workers[path] = PieceEncoder(tokenizer), AddedTokens(tokenizer), EncodeCache(CACHE_BYTES)
    return _workers[path]


def encode_ids(batch: pa.RecordBatch, encoder: PieceEncoder, added: AddedTokens, cache: EncodeCache, end_id: int):
    """(first row, last row + 1, ids, lengths) of pieces of a batch, each document with its end id."""

    for low, high, data, starts in texts(batch, limit=PIECE_TEXT):
        folded = _FOLD[data]
        places, added_ids = added.find(data, starts)
        begin, end, number = units(folded, starts, places)
        size = end - begin
        ordinary = number < 0
        plain = pa.LargeBinaryArray.from_buffers(pa.large_binary(), int(ordinary.sum()), [
            None, pa.py_buffer(offsets(size[ordinary])), pa.py_buffer(folded[ranges(begin[ordinary], size[ordinary])]),
        ])
        found, found_lengths = cache.encode(plain, encoder)
        # the same string as ordinary text has other ids
        lengths = np.ones(len(begin), np.int64)
        lengths[ordinary] = found_lengths
        ids = np.empty(int(lengths.sum()), np.int64)
        at = offsets(lengths)[:-1]
        ids[ranges(at[ordinary], found_lengths)] = found
        ids[at[~ordinary]] = np.array(added_ids, np.int64)[number[~ordinary]]
        counts = sums(lengths, np.searchsorted(begin, starts))
        after = np.cumsum(counts)
        yield low, high, np.insert(ids.astype(np.uint16), after, np.uint16(end_id)), counts + 1


def write_token_files(
    documents: DataFrame, tokenizer_path: str, path: str, end_id: int = 1, shards: int | None = None,
) -> None:
    """Encode every whole text and write its ids, in rising doc_id, as one file a shard.

    A shard is a range of ids with about as many rows as any other.  Its file is Parquet, so that
    it can lie wherever Spark writes, with one row a segment: a wavelet matrix over whole
    documents of SEGMENT_TOKENS ids or a little more, and the documents' ids and lengths.  Texts
    are encoded where they are read, and only ids move.  A null text is empty and has the end id
    alone; a null id is smaller than all others; rows that repeat an id stand in the order of
    their ids' bytes.
    """
    spark = documents.sparkSession
    low = -(1 << 63)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    count = shards or partitions(spark)
    wanted = [i / count for i in range(1, count)]
    cuts = rows.select(F.coalesce("doc_id", F.lit(low)).alias("k")).approxQuantile("k", wanted, 1 / (8 * count))
    cuts = np.unique(np.array(cuts, np.float64).astype(np.int64)) if cuts else np.zeros(0, np.int64)
    with open(tokenizer_path, encoding="utf-8") as file:
        source = spark.sparkContext.broadcast(file.read())

    def encode(batches):
        encoder, added, cache = _worker(tokenizer_path, source.value)
        for batch in batches:
            doc_ids = column(batch, "doc_id").fill_null(low).to_numpy()
            for first, last, ids, lengths in encode_ids(batch, encoder, added, cache, end_id):
                starts, raw = offsets(lengths * 2).tolist(), ids.tobytes()
                keys = doc_ids[first:last]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.searchsorted(cuts, keys, "right").astype(np.int32)), pa.array(keys),
                    blobs([raw[a:b] for a, b in zip(starts, starts[1:], strict=False)]),
                ], ["shard", "key", "ids"])

    def build(batches):
        shard, segment, first, keys, parts, held = None, 0, 0, [], [], 0

        def flush():
            ids = np.frombuffer(b"".join(parts), np.uint16)
            matrix = WaveletMatrix.build(ids)
            own = np.array(keys, np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([first], pa.int64()),
                pa.array([len(ids)], pa.int64()), blobs([own.tobytes()]), blobs([np.array([len(p) // 2 for p in parts], np.int64).tobytes()]),
                blobs([np.packbits(own == low).tobytes()]), pa.array([matrix.zeros], pa.list_(pa.int64())),
                pa.array([[p.tobytes() for p in matrix.planes]], pa.list_(pa.binary())),
                pa.array([[r.tobytes() for r in matrix.ranks]], pa.list_(pa.binary())),
            ], [f.split()[0] for f in SCHEMA.split(", ")])

        for batch in batches:
            for number, key, ids in zip(*(column(batch, n).to_pylist() for n in ("shard", "key", "ids")), strict=True):
                if parts and (number != shard or held >= 2 * SEGMENT_TOKENS):
                    yield flush()
                    segment, first = (segment + 1, first + held // 2) if number == shard else (0, 0)
                    keys, parts, held = [], [], 0
                shard = number
                keys.append(key)
                parts.append(ids)
                held += len(ids)
        if parts:
            yield flush()

    (
        rows.mapInArrow(encode, "shard int, key long, ids binary").repartition(count, "shard")
        .sortWithinPartitions("shard", "key", "ids").mapInArrow(build, SCHEMA)
        .write.partitionBy("shard").parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def segment_matrix(row) -> WaveletMatrix:
    return WaveletMatrix(row["n_tokens"], row["zeros"], row["planes"], row["ranks"])


def token_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files.

    start counts the ids before it in all files; each shard's size is known to the driver, one
    number a shard.  ids_crc32 is over the ids as little-endian unsigned 32-bit integers.
    """
    files = read_token_files(spark, path)
    sizes = files.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    before, total = {}, 0
    for row in sizes:
        before[row["shard"]] = total
        total += row["n"]
    base = spark.sparkContext.broadcast(before)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = segment_matrix(row).decode().astype("<u4")
                lengths = np.frombuffer(row["lengths"], np.int64)
                own = np.frombuffer(row["doc_ids"], np.int64)
                absent = np.unpackbits(np.frombuffer(row["null_ids"], np.uint8), count=len(own)).astype(bool)
                starts, raw = offsets(lengths), memoryview(ids).cast("B")
                at = starts.tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(own, mask=absent), pa.array(starts[:-1] + (base.value[row["shard"]] + row["first"])),
                    pa.array(lengths), pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at, at[1:], strict=False)], pa.int64()),
                ], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_counts(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(shard, segment, n): how often an id stands in each segment, without decoding it."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]], pa.int32()), pa.array([row["segment"]], pa.int32()),
                     pa.array([segment_matrix(row).count(token)], pa.int64())], ["shard", "segment", "n"],
                )

    return read_token_files(spark, path).mapInArrow(run, "shard int, segment int, n long")


def token_files(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the token files of `documents` below the shared folder and read them back by document."""
    path = shared_path(documents.sparkSession, "token-files")
    write_token_files(documents, tokenizer_path, path)
    return token_documents(documents.sparkSession, path)
