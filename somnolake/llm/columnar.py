"""Texts of Arrow batches as numpy arrays, ragged arrays, hashes, and tables in the shared folder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers = {"forth": np.ones(1, np.uint64), "back": np.ones(1, np.uint64)}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster names, or below the warehouse where it names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return f"{folder.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and kept when executors are lost."""
    path = shared_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Rows left-joined to the one row of their group; the rows of large groups don't move.

    A group with more than 1 / HOT_SHARE of all rows, by the groups' `size`, is large.  There are
    fewer than HOT_SHARE of them, whatever the data, so these are broadcast.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) * HOT_SHARE > total
    hot, cold = F.broadcast(groups.where(large)), groups.where(~large)
    rest = rows.join(F.broadcast(groups.where(large).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(cold, key, "left"))


def bucket_of_id(column: str = "doc_id"):
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary array, and where each entry starts (one more for the end)."""
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if array.null_count:
        array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, starts, data = array.buffers()
    starts = np.frombuffer(starts, np.int64 if wide else np.int32)
    starts = starts[array.offset:array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0]:starts[-1]], starts - starts[0]


def pieces(starts: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole entries of about `limit` in sum; an entry over the limit is alone."""
    low, last = 0, len(starts) - 1
    while low < last:
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + limit, "right")) - 1)
        yield low, high
        low = high


def texts(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES):
    """(first row, last row + 1, bytes, starts) of every piece of a batch."""
    data, starts = utf8(batch.column(batch.schema.get_field_index(column)))
    for low, high in pieces(starts, limit):
        yield low, high, data[starts[low]:starts[high]], starts[low:high + 1] - starts[low]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    some = lengths > 0
    starts, lengths = starts[some], lengths[some]
    steps = np.ones(total, np.int64)
    steps[0] = starts[0]
    ends = np.cumsum(lengths)[:-1]
    steps[ends] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(steps)


def offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each entry's values; 0 for an empty entry."""
    running = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=running[1:])
    return running[starts[1:]] - running[starts[:-1]]


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of the value."""
    values = values.astype(np.uint64)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _power(which: str, count: int) -> np.ndarray:
    if len(_powers[which]) < count:
        base = np.full(max(count, PIECE_BYTES + 2), _MULTIPLIER if which == "forth" else _INVERSE, np.uint64)
        base[0] = 1
        _powers[which] = np.multiply.accumulate(base)
    return _powers[which][:count]


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Running polynomial sums of 64-bit codes, from which `span_hashes` cuts spans."""
    running = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _power("forth", len(codes)), out=running[1:])
    return running


def span_hashes(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans: equal spans have equal hashes wherever they stand."""
    cut = (running[ends] - running[starts]) * _power("back", len(running))[starts]
    return mix(cut + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


LONG_SPAN = 256


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes that stand for them: no polynomial, whose collisions can be written down.

    Eight bytes at a time are mixed into what came before; long spans have a cryptographic hash.
    """
    length = ends - starts
    state = mix(length.astype(np.uint64) + np.uint64(0xD6E8FEB86659FD93))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    order = np.argsort(-length, kind="stable")
    falling = -length[order]
    first = int(np.searchsorted(falling, -LONG_SPAN))
    for at in order[:first].tolist():
        digest = hashlib.blake2b(data[starts[at]:ends[at]].tobytes(), digest_size=8).digest()
        state[at] = int.from_bytes(digest, "little")
    for done in range(0, LONG_SPAN, 8):
        live = order[first:int(np.searchsorted(falling, -done))]
        if not len(live):
            break
        kept = np.minimum(length[live] - done, 8).astype(np.uint64)
        word = eight[starts[live] + done] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * kept))
        state[live] = mix(state[live] ^ word)
    return state


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def unsigned(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, np.int64).view(np.uint64)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def blobs(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets(lengths).astype(np.int32)), pa.array(values, kind))
