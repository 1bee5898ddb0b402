"""Document fingerprints by locally consistent parsing."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somnolake.llm.columnar import column, mix, offsets, partitions, pieces, prefix_hashes, span_hashes

SLOTS = 128
FIRST_LEVEL = 2
PIECE_CHARS = 1 << 20
_EMPTY_SLOT = np.uint64(0xFFFFFFFFFFFFFFFF)


def _toss(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A coin toss of two different symbols: where they first differ, and what `right` has there."""
    differ = left ^ right
    place = np.bitwise_count(~differ & (differ - differ.dtype.type(1))).astype(np.uint8)
    bit = (right >> place.astype(right.dtype)).astype(np.uint8) & np.uint8(1)
    return (place << np.uint8(1)) | bit


# Tosses of labels, which fit a byte, are looked up.
_PAIRS = np.arange(1 << 14, dtype=np.uint16)
_TOSSED = _toss((_PAIRS >> 7).astype(np.uint8), (_PAIRS & 127).astype(np.uint8))


def _before(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The symbol to the left; at the start of a text, the symbol with its lowest bit flipped."""
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[starts[:-1]] = symbols[starts[:-1]] ^ symbols.dtype.type(1)
    return left


def phrases(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where phrases begin, in texts (none empty) whose neighbouring symbols differ.

    Repeated tosses against the left neighbour shrink the symbols to labels below 6 that still
    differ from their neighbours; a phrase begins at each local maximum and at the text's start.
    A cut depends on the four symbols to its left and one to its right only.
    """
    labels = _toss(_before(symbols, starts), symbols)
    for _ in range(3):
        labels = _TOSSED[_before(labels, starts).astype(np.uint16) << np.uint16(7) | labels]
    cut = np.zeros(len(labels), bool)
    cut[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    cut[starts[1:] - 1] = False
    cut[starts[:-1]] = True
    return np.flatnonzero(cut)


def _merge_runs(symbols, starts):
    """Runs of one symbol become one symbol that is named after symbol and length."""
    first = np.ones(len(symbols), bool)
    first[1:] = symbols[1:] != symbols[:-1]
    first[starts[:-1]] = True
    if first.all():
        return symbols, starts
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, len(symbols)))
    names = symbols[begin].astype(np.uint64)
    names[length > 1] = mix(names[length > 1] * np.uint64(0x9FB21C651E98DF25) + length[length > 1].astype(np.uint64))
    return names, np.searchsorted(begin, starts)


def signatures(codes: np.ndarray, starts: np.ndarray):
    """(owner, name) of every phrase of level FIRST_LEVEL and up, and each text's topmost name.

    Level by level the names of a text's phrases are the next level's symbols, until one symbol
    is left.  Equal names stand for equal substrings, and equal substrings are parsed alike but
    for a few symbols at both ends of each level, wherever they stand.
    """
    owners, names = [], []
    alive = np.flatnonzero(np.diff(starts) > 0)
    symbols, bounds = codes, np.append(starts[alive], starts[-1])
    level = 0
    while len(alive):
        symbols, bounds = _merge_runs(symbols, bounds)
        counts = np.diff(bounds)
        done = counts == 1
        if done.any():
            owners.append(alive[done])
            names.append(mix(symbols[bounds[:-1][done]].astype(np.uint64) + np.uint64(level)))
            keep = np.repeat(~done, counts)
            symbols, alive = symbols[keep], alive[~done]
            bounds = offsets(counts[~done])
            if not len(alive):
                break
        begin = phrases(symbols, bounds)
        running = prefix_hashes(mix(symbols.astype(np.uint64) + np.uint64(1)))
        symbols = span_hashes(running, begin, np.append(begin[1:], len(symbols)))
        bounds = np.searchsorted(begin, bounds)
        level += 1
        if level >= FIRST_LEVEL:
            owners.append(np.repeat(alive, np.diff(bounds)))
            names.append(mix(symbols + np.uint64(level)))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(names)


def fingerprints(values: list[str]) -> np.ndarray:
    """A row of SLOTS 16-bit slots for each text; all zero for an empty text.

    The phrase names are dealt over the slots and the least of each slot is kept, so the share of
    equal slots estimates the Jaccard similarity of two texts' phrase sets.  A slot without a
    name takes that of the next one that has any.
    """
    raw = "".join(values).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, np.uint32)
    starts = offsets(np.fromiter(map(len, values), np.int64, len(values)))
    out = np.zeros((len(values), SLOTS), np.uint16)
    for low, high in pieces(starts, PIECE_CHARS):
        owner, name = signatures(codes[starts[low]:starts[high]], starts[low:high + 1] - starts[low])
        table = np.full((high - low) * SLOTS, _EMPTY_SLOT)
        place = owner * SLOTS + (name >> np.uint64(57)).astype(np.int64)
        order = np.argsort(place * (1 << 32) + (name & np.uint64(0xFFFFFFFF)).astype(np.int64))
        place, name = place[order], name[order]
        first = np.ones(len(place), bool)
        first[1:] = place[1:] != place[:-1]
        table[place[first]] = name[first] & np.uint64(0xFFFFFFFF)
        table = table.reshape(-1, SLOTS)
        filled = table != _EMPTY_SLOT
        some = filled.any(axis=1)
        wanting = some & ~filled.all(axis=1)
        if wanting.any():
            sparse, has = table[wanting], filled[wanting]
            full = sparse.copy()
            for step in range(1, SLOTS):
                open_ = full == _EMPTY_SLOT
                if not open_.any():
                    break
                take = mix(np.roll(sparse, -step, axis=1) + np.uint64(step << 32))
                full = np.where(open_ & np.roll(has, -step, axis=1), take, full)
            table[wanting] = full
        slots = (mix(table) & np.uint64(0xFFFF)).astype(np.uint16)
        slots[~some] = 0
        out[low:high] = slots
    return out


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Estimated similarity of fingerprints, row by row: 1 for equal ones."""
    return (left == right).mean(axis=1)


def _hex(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes().hex() for row in rows.astype(">u2")])


def edited(text: str, following: str) -> str:
    """The text with its last half (code points, rounded down) replaced by the start of another."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_next(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The next document is the one with the next smaller doc_id; after the smallest comes the
    largest.  A null id counts as smaller than all others, rows of one id are ordered by their
    text, a null text is empty, and a document alone is its own next one.  Empty texts are alike
    (1) to each other and unlike (about 0) to all others.

    The texts move once, into ranges of ids.  Only the ids are looked at to find the ranges; each
    range also gets the rows of one id before it, and is read in order.
    """
    spark = documents.sparkSession
    low = -(1 << 63)
    rows = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(low)).alias("key"), F.coalesce("text", F.lit("")).alias("text"),
    )
    count = partitions(spark) * 4
    cuts = rows.select("key").approxQuantile("key", [i / count for i in range(1, count)], 1 / (4 * count))
    cuts = np.unique(np.array(cuts, np.float64).astype(np.int64)) if cuts else np.zeros(0, np.int64)

    @F.pandas_udf("int")
    def place(keys):
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), "right").astype(np.int32))

    edges = rows.select("key").withColumn("range", place("key")).groupBy("range").agg(F.max("key").alias("top"))
    tops = sorted((r["range"], r["top"]) for r in edges.collect())  # one row a range
    follower = {top: tops[(i + 1) % len(tops)][0] for i, (_, top) in enumerate(tops)}
    top_keys = np.array(sorted(follower), np.int64)
    targets = np.array([follower[k] for k in sorted(follower)], np.int32)

    @F.pandas_udf("array<int>")
    def places(keys):
        import pandas as pd

        values = keys.to_numpy()
        own = np.searchsorted(cuts, values, "right")
        at = np.minimum(np.searchsorted(top_keys, values), len(top_keys) - 1)
        extra = top_keys[at] == values
        return pd.Series([
            [o, targets[a]] if e else [o] for o, a, e in zip(own.tolist(), at.tolist(), extra.tolist(), strict=True)
        ])

    dealt = (
        rows.select("key", "text", F.posexplode(places("key")).alias("guest", "range"))
        .repartition(partitions(spark), "range")
        .sortWithinPartitions("range", F.desc("guest"), "key", "text")
    )

    def run(batches):
        area, text, print_ = None, "", None
        for batch in batches:
            all_ranges = column(batch, "range").to_pylist()
            all_guest = column(batch, "guest").to_pylist()
            all_keys = column(batch, "key").to_pylist()
            all_texts = column(batch, "text")
            step = 1000
            for at in range(0, len(all_ranges), step):
                own = all_texts.slice(at, step).to_pylist()
                span = all_ranges[at:at + step]
                guest = all_guest[at:at + step]
                before = [text if span[0] == area else ""] + own[:-1]
                new = [edited(a, b) for a, b in zip(own, before, strict=True)]
                prints, new_prints = fingerprints(own), fingerprints(new)
                first = print_ if print_ is not None else prints[0]
                next_prints = np.concatenate([first[None], prints[:-1]])
                near, near_next = likeness(prints, new_prints), likeness(prints, next_prints)
                keep = np.flatnonzero(np.array(guest) == 0)
                area, text, print_ = span[-1], own[-1], prints[-1]
                yield pa.RecordBatch.from_arrays([
                    pa.array([k if k != low else None for k in all_keys[at:at + step]], pa.int64()).take(pa.array(keep)),
                    pa.array([len(own[i]) for i in keep], pa.int64()),
                    pa.array([hashlib.sha256(new[i].encode("utf-8", "surrogatepass")).hexdigest() for i in keep], pa.string()),
                    _hex(prints[keep]), _hex(new_prints[keep]), pa.array(near[keep]), pa.array(near_next[keep]),
                ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return dealt.mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
