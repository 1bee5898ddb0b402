"""Periodic runs of words by a dictionary of basic factors, and texts with the repeats taken out."""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somnolake.llm.columnar import column, offsets, ranges, texts


@dataclass(frozen=True)
class RunRules:
    """A run has at least `least` words and `periods` of its smallest periods."""

    least: int = 12
    periods: int = 2


def factor_names(symbols: np.ndarray) -> list[np.ndarray]:
    """Level k names the factors of 2**k symbols by where they begin: equal factors, equal names.

    A name is a pair of names of the level below.  Ends with the first level without a repeat;
    4 bytes a symbol and level.
    """
    levels = [np.unique(symbols, return_inverse=True)[1].astype(np.int32)]
    while True:
        below, size = levels[-1], 1 << (len(levels) - 1)
        if len(below) <= size:
            return levels
        pairs = below[:-size].astype(np.int64) * (int(below.max()) + 1) + below[size:]
        distinct, names = np.unique(pairs, return_inverse=True)
        levels.append(names.astype(np.int32))
        if len(distinct) == len(pairs):
            return levels


def _proposals(names: np.ndarray, symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) where a run of a period from `size` to under twice that may begin.

    Equal factors nearer than half their length form an arithmetic progression, in which all but
    the first have the same symbol before them.  A run begins where the symbols before two equal
    factors differ, so one of the two is the first of its progression: only pairs of a first and
    what follows or precedes it are made, O(n) of them a level.
    """
    count = len(names)
    order = np.argsort(names, kind="stable")
    key = names[order].astype(np.int64) * (4 * count + 4 * size) + order
    gap = np.diff(key)
    first = np.ones(count, bool)
    first[1:] = gap > size // 2
    if not (gap < 2 * size).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.flatnonzero(first)
    low, high = np.searchsorted(key, key[heads] + size), np.searchsorted(key, key[heads] + 2 * size)
    left = [np.repeat(heads, high - low)]
    right = [ranges(low, high - low)]
    low, high = np.searchsorted(key, key[heads] - 2 * size, "right"), np.searchsorted(key, key[heads] - size, "right")
    left.append(ranges(low, high - low))
    right.append(np.repeat(heads, high - low))
    i, j = order[np.concatenate(left)], order[np.concatenate(right)]
    begins = (i == 0) | (symbols[i - 1] != symbols[j - 1])
    return i[begins], (j - i)[begins]


def _common(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common factor that begins at i and at j (i < j)."""
    length = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        names = levels[k]
        fits = np.flatnonzero(j + length < len(names))
        same = fits[names[i[fits] + length[fits]] == names[j[fits] + length[fits]]]
        length[same] += 1 << k
        if k == len(levels) - 1:  # names at the last level may still repeat
            while len(same):
                same = same[j[same] + length[same] < len(names)]
                same = same[names[i[same] + length[same]] == names[j[same] + length[same]]]
                length[same] += 1 << k
    return length


def maximal_runs(symbols: np.ndarray, rules: RunRules = RunRules()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run, by start, then period."""
    levels = factor_names(symbols)
    starts, lengths, periods = [], [], []
    for k, names in enumerate(levels):
        i, period = _proposals(names, symbols, 1 << k)
        length = period + _common(levels, i, i + period)
        enough = length >= np.maximum(rules.least, rules.periods * period)
        starts.append(i[enough])
        lengths.append(length[enough])
        periods.append(period[enough])
    start, length, period = np.concatenate(starts), np.concatenate(lengths), np.concatenate(periods)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # a stretch also has the multiples of its period: the smallest stays
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def edited(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Words of which one document in ten, by its id, repeats a stretch from some place on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    stretch = words[a:a + period]
    return words[:a] + (stretch * ((n - a) // len(stretch) + 1))[:n - a]


def _described(documents: list[list[bytes]], rules: RunRules):
    """One row of results a document; all documents of a piece are searched at once.

    A symbol that occurs once stands after each document, so no factor with it repeats.
    """
    counts = np.fromiter(map(len, documents), np.int64, len(documents))
    bounds = offsets(counts + 1)
    symbols = np.empty(bounds[-1], np.int64)
    flat = pa.array([word for words in documents for word in words], pa.binary()).dictionary_encode()
    words_at = ranges(bounds[:-1], counts)
    symbols[words_at] = flat.indices.to_numpy()
    symbols[bounds[1:] - 1] = len(flat.dictionary) + np.arange(len(documents))
    start, length, period = maximal_runs(symbols, rules)
    repeats = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(repeats, start + period, 1)
    np.add.at(repeats, start + length, -1)
    dropped = np.cumsum(repeats) > 0
    cut = np.searchsorted(start, bounds)
    for i, words in enumerate(documents):
        at, low, high = bounds[i], cut[i], cut[i + 1]
        lost = dropped[at:at + len(words)]
        kept = [words[k] for k in np.flatnonzero(~lost).tolist()] if lost.any() else words
        s, n, p = (start[low:high] - at).tolist(), length[low:high].tolist(), period[low:high].tolist()
        best = min(zip([-x for x in n], s, p, strict=True), default=None)
        told = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s, n, p, strict=True))
        yield (
            len(s), *((best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4),
            hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(), b" ".join(kept),
        )


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("collapsed", pa.string()),
])


def periodic_runs(documents: DataFrame, rules: RunRules = RunRules(), edit: bool = False) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, collapsed) a row.

    Words are runs without ASCII white space of the whole text.  start, length and period are of
    the longest run, ties to the smallest start; null without a run.  `collapsed` keeps of every
    run its first period.  `edit` plants a repeat in one document in ten, by its id.

    A null or empty text has no words, no run and an empty collapsed text; a null id is not
    edited; rows that repeat are each described; other columns are not read.  A text is searched
    whole in one task, with 4 bytes a word and level of the dictionary.
    """

    def run(batches):
        for batch in batches:
            ids = column(batch, "doc_id").to_pylist()
            for low, high, data, starts in texts(batch):
                own = [data[a:b].tobytes().split() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                if edit:
                    own = [edited(words, i) for words, i in zip(own, ids[low:high], strict=True)]
                columns = list(zip(*_described(own, rules), strict=True))
                kept = pa.array(columns[-1], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip([ids[low:high], *columns[:-1]], SCHEMA, strict=False)] + [kept],
                    schema=SCHEMA,
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
             "runs_sha256 string, collapsed_sha256 string, collapsed string"
    )
