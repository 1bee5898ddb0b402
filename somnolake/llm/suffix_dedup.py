"""Removal of byte strings that an earlier document has, by suffix order with common prefixes.

Strings of LENGTH bytes are called windows.  A window's anchor is the least hash of its stretches
of GRAM bytes, so equal windows have equal anchors.  Consecutive windows of one anchor form a
piece, a string of at most LENGTH + MOST_WINDOWS - 1 bytes; pieces are dealt out by anchor, so that
all equal windows of the corpus meet in one shard, whose suffixes are then sorted.

0. Bytes are counted for each anchor.  Where an anchor has too many for a shard, its pieces are
   cut into single windows, which are dealt out by their content: equal ones still meet.
1. Anchors are counted: only those that occur in two documents can hold a repeated window.
2. Texts, dealt to parts by a hash of the id, are cut into pieces; each part sends each piece with
   such an anchor once, with the least doc_id that has it.
3. A shard sorts the suffixes of its distinct pieces by induced sorting.  Neighbours that share
   LENGTH bytes begin with one window; the least doc_id of these goes back to the parts.
4. The parts cut their texts again and remove the windows that have a smaller doc_id.

What a very common passage costs is one piece a part, not one a document; its ends, which differ
from document to document, are hot.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somnolake.llm.columnar import (
    BYTE_CODES, _power, blobs, column, mix, offsets, partitions, pieces, prefix_hashes, ranges, signed, span_hashes, texts,
    unsigned,
)
from somnolake.llm.induced_sort import suffix_order

PIECE_TEXT = 1 << 20
FLUSH_BYTES = 16 << 20
COUNT_BYTES = 32 << 20
SHARDS_A_PARTITION = 4  # at least; a shard is sorted in memory, with about 60 bytes for each of its bytes
ANCHORS_A_SHARD = 32  # an anchor with more than this part of a shard's bytes is hot
MOST_WINDOWS = 64


@dataclass(frozen=True)
class RepeatRules:
    length: int = 50
    gram: int = 20
    shard_bytes: int = 8 << 20  # of pieces that a shard has on average, at most


class Pieces:
    """The pieces of a run of texts: begin, number of windows, anchor, owner, and hash of the content.

    Pieces of the sorted anchors `hot` are single windows.  Equal windows have equal `deal`.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, rules: RepeatRules, hot: np.ndarray | None = None):
        length, gram = rules.length, rules.gram
        long = np.flatnonzero(np.diff(starts) >= length)
        counts = np.diff(starts)[long] - length + 1
        at = ranges(starts[long], counts)
        if not len(at):
            self.begin = self.windows = self.owner = np.zeros(0, np.int64)
            self.anchor = self.content = self.deal = np.zeros(0, np.uint64)
            return
        running = prefix_hashes(BYTE_CODES[data])
        low = mix((running[gram:] - running[:-gram]) * _power("back", len(running))[:len(running) - gram])
        span, width = 1, length - gram + 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:span - width], low[width - span:])
        low = low[at]
        new = np.ones(len(at), bool)
        new[1:] = (low[1:] != low[:-1]) | (np.diff(at) != 1)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        # very long runs (of periodic text) are cut; each window stays in one piece
        single = np.zeros(len(first), bool)
        if hot is not None and len(hot):
            single = hot[np.minimum(np.searchsorted(hot, low[first]), len(hot) - 1)] == low[first]
        most = np.where(single, 1, MOST_WINDOWS)
        cut = -(-size // most)
        most, single = np.repeat(most, cut), np.repeat(single, cut)
        place = ranges(np.zeros(len(cut), np.int64), cut) * most
        first, size = np.repeat(first, cut) + place, np.minimum(np.repeat(size, cut) - place, most)
        self.begin, self.windows, self.anchor = at[first], size, low[first]
        self.owner = np.searchsorted(starts, self.begin, "right") - 1
        self.content = span_hashes(running, self.begin, self.begin + size + length - 1)
        self.deal = np.where(single, self.content, self.anchor)


def _piece_bytes(documents: DataFrame, rules: RepeatRules) -> DataFrame:
    """(anchor, bytes, windows): of the distinct pieces of each anchor, and of all pieces with a null anchor.

    Counted in about COUNT_BYTES of a task's texts at a time.  Anchors that have one piece there
    are left out, so of an anchor one piece for each such stretch of the corpus may be missing.
    """

    def run(batches):
        held, size = [], 0

        def flush():
            anchor, content, lengths = (np.concatenate([h[i] for h in held]) for i in range(3))
            order = np.lexsort((content, anchor))
            anchor, content, lengths = anchor[order], content[order], lengths[order]
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
            anchor, lengths = anchor[new], lengths[new]
            windows = lengths - rules.length + 1
            new = np.ones(len(anchor), bool)
            new[1:] = anchor[1:] != anchor[:-1]
            first = np.flatnonzero(new)
            several = np.diff(np.append(first, len(anchor))) > 1
            both = [np.add.reduceat(x, first) if len(first) else x for x in (lengths, windows)]
            return pa.RecordBatch.from_arrays([
                pa.array([*signed(anchor[first[several]]).tolist(), None], pa.int64()),
                *[pa.array(np.append(x[several], x.sum())) for x in both],
            ], ["anchor", "bytes", "windows"])

        for batch in batches:
            for _low, _high, data, starts in texts(batch, limit=PIECE_TEXT):
                found = Pieces(data, starts, rules)
                held.append((found.anchor, found.content, found.windows + rules.length - 1))
                size += len(data)
                if size >= COUNT_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return documents.mapInArrow(run, "anchor long, bytes long, windows long")


def shard_plan(documents: DataFrame, rules: RepeatRules) -> tuple[int, np.ndarray]:
    """How many shards there are, and the sorted hot anchors.

    A hot anchor has more than rules.shard_bytes / ANCHORS_A_SHARD bytes; there are fewer than
    ANCHORS_A_SHARD of them for each rules.shard_bytes of pieces.
    """
    counted = _piece_bytes(documents, rules).groupBy("anchor").agg(F.sum("bytes").alias("bytes"), F.sum("windows").alias("windows"))
    found = counted.where(F.col("anchor").isNull() | (F.col("bytes") * ANCHORS_A_SHARD > rules.shard_bytes)).collect()
    # the single windows of a hot anchor have more bytes than its pieces
    total = sum(r["bytes"] if r["anchor"] is None else r["windows"] * rules.length - r["bytes"] for r in found)
    hot = np.sort(unsigned(np.array([r["anchor"] for r in found if r["anchor"] is not None], np.int64)))
    return max(SHARDS_A_PARTITION * partitions(documents.sparkSession), -(-total // rules.shard_bytes)), hot


def _anchor_rows(documents: DataFrame, rules: RepeatRules, shards: int) -> DataFrame:
    """(shard, once, often): packed anchors of each shard; each is 40 bits above the part's 24.

    An anchor stands once for each document in `once`, or once in `often` where several of the
    task's documents in one part have it.
    """

    def run(batches):
        held, size = [], 0

        def flush():
            packed = np.sort(np.concatenate(held))
            new = np.ones(len(packed), bool)
            new[1:] = packed[1:] != packed[:-1]
            first = np.flatnonzero(new)
            several = np.diff(np.append(first, len(packed))) > 1
            packed = packed[first]
            shard = ((packed >> np.uint64(24)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            packed, shard, several = packed[order], shard[order], several[order]
            cuts = np.searchsorted(shard, np.arange(shards + 1))
            once, often = [], []
            for a, b in zip(cuts, cuts[1:], strict=False):
                once.append(packed[a:b][~several[a:b]].tobytes())
                often.append(packed[a:b][several[a:b]].tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(shards, dtype=np.int32)), blobs(once), blobs(often)], ["shard", "once", "often"]
            )

        for batch in batches:
            part = column(batch, "part").to_numpy().astype(np.uint64)
            for low, _high, data, starts in texts(batch, limit=PIECE_TEXT):
                found = Pieces(data, starts, rules)
                anchor = found.anchor >> np.uint64(24)
                # once a document
                order = np.lexsort((anchor, found.owner))
                anchor, owner = anchor[order], found.owner[order]
                new = np.ones(len(anchor), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
                held.append((anchor[new] << np.uint64(24)) | part[low + owner[new]])
                size += len(data)
                if size >= FLUSH_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return documents.mapInArrow(run, "shard int, once binary, often binary")


def _grouped(batches, key: str):
    """(key, rows as a table) of batches sorted by the key."""
    held, now = [], None
    for batch in batches:
        keys = column(batch, key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and keys[a] != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def _column_bytes(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _repeated_anchors(rows: DataFrame, shards: int) -> DataFrame:
    """(part, anchors): sorted anchors of the part that occur in two documents of the corpus."""

    def run(batches):
        for _shard, table in _grouped(batches, "shard"):
            once, often = _column_bytes(table, "once", "<u8"), _column_bytes(table, "often", "<u8")
            packed = np.concatenate([once, often, often])
            packed.sort()
            anchor = packed >> np.uint64(24)
            same = anchor[1:] == anchor[:-1]
            several = np.zeros(len(packed), bool)
            several[1:] |= same
            several[:-1] |= same
            packed = packed[several]
            part = (packed & np.uint64(0xFFFFFF)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            part, anchor = part[order], (packed >> np.uint64(24))[order]
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            yield pa.RecordBatch.from_arrays([
                pa.array([part[a] for a, b in zip(cuts, cuts[1:], strict=False) if b > a], pa.int32()),
                blobs([np.unique(anchor[a:b]).tobytes() for a, b in zip(cuts, cuts[1:], strict=False) if b > a]),
            ], ["part", "side"])

    return (
        rows.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(run, "part int, side binary")
    )


def _packed(documents: DataFrame, parts: int) -> DataFrame:
    """(part, kind, ids, lengths, side): texts packed by part, compressed, many to a row."""

    def run(batches):
        held, size = [], 0

        def flush():
            part, ids, absent, lengths = (np.concatenate([h[i] for h in held]) for i in range(4))
            data = np.concatenate([h[4] for h in held])
            order = np.argsort(part, kind="stable")
            begin = offsets(lengths)[:-1]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            some = [i for i, r in enumerate(rows) if len(r)]
            rows = [rows[i] for i in some]
            pack = zstandard.ZstdCompressor(level=1).compress
            return pa.RecordBatch.from_arrays([
                pa.array(some, pa.int32()), pa.array(np.ones(len(some), np.int32)),
                blobs([ids[r].tobytes() + absent[r].tobytes() for r in rows]), blobs([lengths[r].tobytes() for r in rows]),
                blobs([pack(data[ranges(begin[r], lengths[r])].tobytes()) for r in rows]),
            ], ["part", "kind", "ids", "lengths", "side"])

        for batch in batches:
            part = column(batch, "part").to_numpy()
            ids = column(batch, "doc_id")
            absent = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for low, high, data, starts in texts(batch):
                held.append((part[low:high], ids[low:high], absent[low:high], np.diff(starts), data))
                size += len(data)
                if size >= FLUSH_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return documents.mapInArrow(run, "part int, kind int, ids binary, lengths binary, side binary")


def _with_side(packed: DataFrame, side: DataFrame, parts: int) -> DataFrame:
    """Texts and side rows of each part together, the side rows first."""
    none = F.lit(None).cast("binary")
    sides = side.select("part", F.lit(0).alias("kind"), none.alias("ids"), none.alias("lengths"), "side")
    return packed.union(sides).repartition(parts, "part").sortWithinPartitions("part", "kind")


def _by_part(batches, gather):
    """(part, ids, whether each is null, bytes, starts, what `gather` made of the part's side rows), piece by piece."""
    now, sides, made = None, [], None
    for batch in batches:
        for i in range(batch.num_rows):
            part, kind, ids, lengths, side = (batch.column(c)[i].as_py() for c in range(5))
            if part != now:
                now, sides, made = part, [], None
            if not kind:
                sides.append(side)
                continue
            if made is None:
                made, sides = gather(sides), []
            lengths = np.frombuffer(lengths, np.int64)
            absent = np.frombuffer(ids, bool, offset=8 * len(lengths))
            ids = np.frombuffer(ids, np.int64, len(lengths))
            data, starts = np.frombuffer(zstandard.ZstdDecompressor().decompress(side), np.uint8), offsets(lengths)
            for low, high in pieces(starts, PIECE_TEXT):
                own = starts[low:high + 1]
                yield now, ids[low:high], absent[low:high], data[own[0]:own[-1]], own - own[0], made


def _pieces_to_shards(together: DataFrame, rules: RepeatRules, shards: int, hot: np.ndarray) -> DataFrame:
    """(shard, part, ids, lengths, bytes): each part's distinct pieces with a repeated anchor."""

    def run(batches):
        held, size, part = [], 0, None

        def flush():
            shard, content, ids, lengths = (np.concatenate([h[i] for h in held]) for i in range(4))
            data = np.concatenate([h[4] for h in held])
            begin = offsets(lengths)[:-1]
            order = np.lexsort((ids, content, shard))
            new = np.ones(len(order), bool)
            new[1:] = content[order][1:] != content[order][:-1]
            pick = order[new]  # each distinct piece, with the least id that has it
            pick = pick[np.lexsort((begin[pick], shard[pick]))]  # in the order of the texts, which packs well
            cuts = np.searchsorted(shard[pick], np.arange(shards + 1))
            some = np.flatnonzero(np.diff(cuts))
            rows = [pick[cuts[s]:cuts[s + 1]] for s in some]
            pack = zstandard.ZstdCompressor(level=1).compress
            return pa.RecordBatch.from_arrays([
                pa.array(some.astype(np.int32)), pa.array(np.full(len(some), part, np.int32)),
                blobs([pack(ids[r].tobytes()) for r in rows]), blobs([lengths[r].astype(np.uint16).tobytes() for r in rows]),
                blobs([pack(data[ranges(begin[r], lengths[r])].tobytes()) for r in rows]),
            ], ["shard", "part", "ids", "lengths", "bytes"])

        for now, ids, absent, data, starts, anchors in _by_part(batches, lambda s: np.unique(np.frombuffer(b"".join(s), np.uint64))):
            if held and (now != part or size >= FLUSH_BYTES):
                yield flush()
                held, size = [], 0
            part = now
            found = Pieces(data, starts, rules, hot)
            if not len(found.begin) or not len(anchors):
                continue
            short = found.anchor >> np.uint64(24)
            at = np.minimum(np.searchsorted(anchors, short), len(anchors) - 1)
            hit = np.flatnonzero((anchors[at] == short) & ~absent[found.owner])
            if not len(hit):
                continue
            lengths = found.windows[hit] + rules.length - 1
            content = data[ranges(found.begin[hit], lengths)]
            held.append((
                (found.deal[hit] % np.uint64(shards)).astype(np.int32), found.content[hit], ids[found.owner[hit]], lengths, content,
            ))
            size += len(content) + 32 * len(hit)
        if held:
            yield flush()

    return together.mapInArrow(run, "shard int, part int, ids binary, lengths binary, bytes binary")


def first_owners(data: np.ndarray, lengths: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
    """For each window of each piece in order, the least id that has an equal window."""
    ends = offsets(lengths + 1)
    text = np.zeros(ends[-1], np.uint8)
    # no byte of UTF-8 is 0xFF, so bytes can be raised by one to keep 0 for the ends
    text[ranges(ends[:-1], lengths)] = data + np.uint8(1)
    positions, shared = suffix_order(text)
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)
    begins_window = ends[owner + 1] - 1 - np.arange(len(text)) >= size
    starts_class = shared < size
    number = np.cumsum(starts_class) - 1
    least = np.minimum.reduceat(ids[owner[positions]], np.flatnonzero(starts_class))
    out = np.zeros(len(text), np.int64)
    out[positions] = least[number]
    return out[begins_window]


def _owners(rows: DataFrame, rules: RepeatRules, tasks: int) -> DataFrame:
    """(part, side): for the pieces of each part, the first owners of their windows, as runs."""

    def run(batches):
        for _shard, table in _grouped(batches, "shard"):
            unpack = zstandard.ZstdDecompressor().decompress
            ids = np.frombuffer(b"".join(map(unpack, table.column("ids").to_pylist())), np.int64)
            lengths = _column_bytes(table, "lengths", np.uint16).astype(np.int64)
            data = np.frombuffer(b"".join(map(unpack, table.column("bytes").to_pylist())), np.uint8)
            ends = offsets(lengths)
            begin = ends[:-1]
            content = span_hashes(prefix_hashes(BYTE_CODES[data]), begin, ends[1:])
            order = np.lexsort((ids, content))
            new = np.ones(len(order), bool)
            new[1:] = content[order][1:] != content[order][:-1]
            pick = order[new]  # each distinct piece, with the least id that has it
            sizes = lengths[pick]
            least = first_owners(data[ranges(begin[pick], sizes)], sizes, ids[pick], rules.length)
            # as runs of windows with one first owner
            windows = sizes - rules.length + 1
            where = offsets(windows)
            change = np.ones(len(least), bool)
            change[1:] = least[1:] != least[:-1]
            change[where[:-1]] = True
            run_at = np.flatnonzero(change)
            run_id, run_size = least[run_at], np.diff(np.append(run_at, len(least)))
            run_bounds = np.searchsorted(run_at, where)
            distinct = content[pick]
            per_row = offsets(np.array([len(x) // 2 for x in table.column("lengths").to_pylist()], np.int64))
            parts, sides = table.column("part").to_numpy(), []
            for a, b in zip(per_row, per_row[1:], strict=False):
                own = content[a:b]
                at = np.searchsorted(distinct, own)
                count = run_bounds[at + 1] - run_bounds[at]
                take = ranges(run_bounds[at], count)
                sides.append(b"".join(x.tobytes() for x in (
                    np.array([len(own), len(take)], np.int64), own, count.astype(np.int64), run_id[take], run_size[take].astype(np.int64),
                )))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), blobs(sides)], ["part", "side"])

    return rows.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(run, "part int, side binary")


def _read_owners(sides: list[bytes]):
    """Sorted piece hashes, and the runs of first owners of each."""
    hashes, counts, ids, sizes = [np.zeros(0, np.uint64)], [], [], []
    for side in sides:
        pieces, runs = np.frombuffer(side, np.int64, 2)
        rest = np.frombuffer(side, np.int64, offset=16)
        hashes.append(rest[:pieces].view(np.uint64))
        counts.append(rest[pieces:2 * pieces])
        ids.append(rest[2 * pieces:2 * pieces + runs])
        sizes.append(rest[2 * pieces + runs:])
    hashes = np.concatenate(hashes)
    empty = [np.zeros(0, np.int64)]
    counts, ids, sizes = (np.concatenate(x or empty) for x in (counts, ids, sizes))
    order = np.argsort(hashes, kind="stable")
    return hashes[order], offsets(counts)[:-1][order], counts[order], ids, sizes


def _cut_texts(together: DataFrame, rules: RepeatRules, hot: np.ndarray, with_text: bool) -> DataFrame:
    def run(batches):
        for _part, ids, absent, data, starts, owners in _by_part(batches, _read_owners):
            hashes, run_at, run_count, run_id, run_size = owners
            gone = np.zeros(len(data) + 1, np.int64)
            found = Pieces(data, starts, rules, hot)
            if len(hashes) and len(found.begin):
                at = np.minimum(np.searchsorted(hashes, found.content), len(hashes) - 1)
                hit = np.flatnonzero(hashes[at] == found.content)
                at = at[hit]
                take = ranges(run_at[at], run_count[at])
                size = run_size[take]
                before = offsets(size)[:-1]
                piece = np.repeat(np.arange(len(at)), run_count[at])
                first_run = offsets(run_count[at])[:-1]
                inside = before - before[first_run][piece] if len(take) else before
                begin = found.begin[hit][piece] + inside
                owner = found.owner[hit][piece]
                remove = (run_id[take] < ids[owner]) & ~absent[owner]
                begin, size = begin[remove], size[remove]
                np.add.at(gone, begin, 1)
                np.add.at(gone, begin + size + rules.length - 1, -1)
            keep = np.cumsum(gone[:-1]) == 0
            left = offsets(np.add.reduceat(np.append(keep, False), starts[:-1], dtype=np.int64) * (np.diff(starts) > 0))
            raw = data[keep].tobytes()
            change = ~keep
            change[1:] &= keep[:-1]
            inner = starts[:-1][np.diff(starts) > 0]
            change[inner] = ~keep[inner]
            spans = np.add.reduceat(np.append(change, False), starts[:-1], dtype=np.int64) * (np.diff(starts) > 0)
            cuts = left.tolist()
            out = [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            arrays = [
                pa.array(ids, mask=absent), pa.array(np.diff(starts)), pa.array(np.diff(starts) - np.diff(left)),
                pa.array(spans), pa.array([hashlib.sha256(x).hexdigest() for x in out], pa.string()),
            ]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays.append(blobs(out))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return together.mapInArrow(run, schema)


def _dealt_pieces(rows: DataFrame, packed: DataFrame, rules: RepeatRules, shards: int, hot: np.ndarray) -> DataFrame:
    parts = partitions(rows.sparkSession)
    anchors = _repeated_anchors(_anchor_rows(rows.where("doc_id is not null"), rules, parts), parts)
    return _pieces_to_shards(_with_side(packed, anchors, parts), rules, shards, hot)


def remove_repeats(documents: DataFrame, rules: RepeatRules = RepeatRules(), with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row of `documents`.

    Each byte covered by a string of rules.length bytes that also begins in a document with a
    smaller doc_id is removed; strings never cross documents, may overlap, and are judged on the
    input.  A null text is empty.  A row with a null id keeps its text, and no other row loses
    bytes for it; rows that repeat an id don't count as earlier to each other.  kept may cut
    characters of several bytes, so it is binary.
    """
    parts = partitions(documents.sparkSession)
    rows = documents.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part"), F.col("doc_id").cast("long").alias("doc_id"), "text",
    )
    shards, hot = shard_plan(rows.where("doc_id is not null"), rules)
    packed = _packed(rows, parts)
    pieces_ = _dealt_pieces(rows, packed, rules, shards, hot)
    return _cut_texts(_with_side(packed, _owners(pieces_, rules, parts), parts), rules, hot, with_text)
