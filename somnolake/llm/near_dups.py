"""Near-duplicate classes: b-bit MinHash signatures, band candidates, links confirmed on full sets."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somnolake.llm.columnar import (
    blobs, column, join_groups, list_array, mix, partitions, signed, slice_hashes, texts, unsigned, written,
)
from somnolake.llm.components import components


@dataclass(frozen=True)
class NearDupRules:
    """What counts as a link, and how candidates are found.

    Two sets link when `percent` of their union is shared.  Of `hashes` minima the first
    bands * rows make the band keys: a pair at 0.8 misses all bands with probability 1e-4 at
    (24, 5) and 1e-6 at 0.85.  Signatures keep `bits` low bits of each minimum; a candidate is
    confirmed when its estimate is at most `slack` standard errors below the threshold.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 5
    hashes: int = 256
    bits: int = 4
    slack: float = 5.0
    seed: int = 11
    block: int = 2000

    def least_estimate(self) -> float:
        share = self.percent / 100
        chance = 2.0**-self.bits
        seen = share + (1 - share) * chance
        return share - self.slack * np.sqrt(seen * (1 - seen) / self.hashes) / (1 - chance)


_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32


def shingle_sets(data: np.ndarray, starts: np.ndarray, size: int):
    """(hashes, bounds): the distinct word shingles of each text as sorted 64-bit hashes.

    Words are runs without ASCII white space, A-Z folded.  A text of fewer words than `size` has
    its whole sequence as its one shingle; one without words has an empty set.
    """
    solid = ~_SPACES[data]
    inner = starts[1:-1][starts[1:-1] < len(data)]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[inner] = solid[inner]
    ends[:-1] &= ~solid[1:]
    left = inner[inner > 0] - 1
    ends[left] = solid[left]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    words = slice_hashes(_FOLD[data], begin, end)
    bounds = np.searchsorted(begin, starts)
    total = words.copy()
    for step in range(1, size):
        total[:-step] = mix(total[:-step]) + words[step:]
    found, lengths = [], np.zeros(len(starts) - 1, np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b - a >= size:
            own = np.unique(total[a:b - size + 1])
        elif b > a:
            own = words[a:a + 1]
            for at in range(a + 1, b):
                own = mix(own) + words[at:at + 1]
            own = own + np.uint64(b - a)
        else:
            continue
        found.append(own)
        lengths[i] = len(own)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), lengths


class Sketcher:
    """Minima of a set under `hashes` functions, cut into band keys and a packed signature."""

    def __init__(self, rules: NearDupRules):
        rng = np.random.default_rng(rules.seed)
        self.rules = rules
        self.factor = (rng.integers(0, 1 << 32, (rules.hashes, 1)) | 1).astype(np.uint32)
        self.shift = rng.integers(0, 1 << 32, (rules.hashes, 1)).astype(np.uint32)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        low = np.full(self.rules.hashes, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(short), 512):
            low = np.minimum(low, (short[at:at + 512] * self.factor + self.shift).min(axis=1))
        return low

    def bands(self, minima: np.ndarray) -> np.ndarray:
        rules = self.rules
        part = minima[:rules.bands * rules.rows].astype(np.uint64).reshape(rules.bands, rules.rows)
        key = np.arange(1, rules.bands + 1, dtype=np.uint64)
        for i in range(rules.rows):
            key = mix(key + part[:, i] * np.uint64(0x9E3779B97F4A7C15))
        return key

    def signature(self, minima: np.ndarray) -> np.ndarray:
        """The low bits of the minima, `64 / bits` to a word."""
        bits = self.rules.bits
        low = mix(minima) & np.uint64((1 << bits) - 1)
        per = 64 // bits
        return (low.reshape(-1, per) << (np.arange(per, dtype=np.uint64) * np.uint64(bits))).sum(axis=1, dtype=np.uint64)

    def estimates(self, one: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Similarity of signatures row by row: equal fields by bit counts, corrected for chance."""
        bits = self.rules.bits
        unequal = many ^ one
        differ = unequal.copy()
        for step in range(1, bits):
            differ |= unequal >> np.uint64(step)
        field = np.uint64(sum(1 << i for i in range(0, 64, bits)))
        unlike = np.bitwise_count(differ & field).sum(axis=1, dtype=np.int64)
        equal, chance = 1 - unlike / self.rules.hashes, 2.0**-bits
        return (equal - chance) / (1 - chance)


def sketches(documents: DataFrame, rules: NearDupRules) -> DataFrame:
    """(doc_id, n_shingles, digest, bands, signature) of every row; nulls count as empty."""

    def run(batches):
        sketcher = Sketcher(rules)
        for batch in batches:
            for low, high, data, starts in texts(batch):
                hashes, lengths = shingle_sets(data, starts, rules.shingle)
                digests, bands, signatures, at = [], [], [], 0
                for length in lengths.tolist():
                    own = hashes[at:at + length]
                    at += length
                    digests.append(_digest(own) if length else None)
                    if length:
                        minima = sketcher.minima(own)
                        bands.append(sketcher.bands(minima))
                        signatures.append(sketcher.signature(minima).tobytes())
                    else:
                        signatures.append(None)
                yield pa.RecordBatch.from_arrays([
                    column(batch, "doc_id").slice(low, high - low), pa.array(lengths), blobs(digests),
                    list_array(signed(np.concatenate(bands)) if bands else [], np.where(lengths > 0, rules.bands, 0), pa.int64()),
                    blobs(signatures),
                ], ["doc_id", "n_shingles", "digest", "bands", "signature"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"
    )


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _sets(documents: DataFrame, wanted: DataFrame, rules: NearDupRules) -> DataFrame:
    """(doc_id, digest, hashes): full shingle sets of the wanted documents."""

    def run(batches):
        for batch in batches:
            for low, high, data, starts in texts(batch):
                hashes, lengths = shingle_sets(data, starts, rules.shingle)
                parts = np.split(hashes, np.cumsum(lengths)[:-1])
                yield pa.RecordBatch.from_arrays([
                    column(batch, "doc_id").slice(low, high - low), blobs(list(map(_digest, parts))),
                    blobs([part.tobytes() for part in parts]),
                ], ["doc_id", "digest", "hashes"])

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (
        chosen.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
        .mapInArrow(run, "doc_id long, digest binary, hashes binary").dropDuplicates(["doc_id", "digest"])
    )


def _blocks(buckets: DataFrame, rules: NearDupRules) -> DataFrame:
    """Members of a bucket dealt to pairs of blocks, so that no task holds a large bucket.

    A bucket of n members has ceil(n / block) blocks; each member goes to every pair of blocks
    that has its own, and with it all pairs of members meet, in one task where their blocks differ.
    """
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    return (
        buckets.withColumn("blocks", F.ceil(F.col("members") / rules.block).cast("int")).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
    )


KEYS = ("band", "key", "a", "b")


def _whole_groups(batches, least_rows: int = 20_000, least_bytes: int = 8 << 20):
    """Tables of whole groups from batches sorted by KEYS, and each row's group.

    They have about `least_rows` rows or, where rows are large, about `least_bytes` bytes.
    """
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < least_rows and sum(b.nbytes for b in held) < least_bytes:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        group = _group_numbers(table)
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield table.slice(0, cut).combine_chunks(), group[:cut]
        held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield table, _group_numbers(table)


def _group_numbers(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    for name in KEYS:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def _candidates(table: pa.Table, group: np.ndarray, sketcher: Sketcher):
    """Pairs of rows (i, j) of one group that are likely enough and meet in no earlier band.

    Groups are walked together: step d pairs every row with the d-th one after it.
    """
    rules = sketcher.rules
    signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint64).reshape(table.num_rows, -1)
    bands = table.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
    band, own, size, a, b = (table.column(n).to_numpy() for n in ("band", "own", "n_shingles", "a", "b"))
    ends = np.searchsorted(group, group, "right")
    across, least = a != b, rules.least_estimate()
    active, step = np.arange(table.num_rows), 1
    while True:
        active = active[active + step < ends[active]]
        if not len(active):
            return
        i, j = active, active + step
        step += 1
        ok = 100 * np.minimum(size[i], size[j]) >= rules.percent * np.maximum(size[i], size[j])
        ok &= ~across[i] | (own[i] != own[j])
        i, j = i[ok], j[ok]
        ok = sketcher.estimates(signature[i], signature[j]) >= least
        i, j = i[ok], j[ok]
        if len(i):
            ok = (bands[i] == bands[j]).argmax(axis=1) == band[i]
            if ok.any():
                yield i[ok], j[ok]


def near_duplicate_classes(documents: DataFrame, rules: NearDupRules = NearDupRules()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `documents`.

    component_id is the smallest doc_id reachable over links.  Empty texts link with nothing.  A
    row with a null id is alone, its component is null and it is kept; rows that repeat an id
    repeat its result, where the id's sets are taken as linked.

    Equal sets are one class, whatever their number; only classes are banded.  Buckets with more
    than one class are compared by signature, block against block, and hand on members rather than
    pairs: documents with a likely partner.  Only for these the full sets are gathered, to confirm
    links; a task keeps the links that join what it hasn't joined already.
    """
    rows = written(sketches(documents, rules), "sketches")
    known = rows.where("digest is not null and doc_id is not null")
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"))
    classes = written(classes, "classes")
    firsts = classes.select("digest", F.col("class_id").alias("doc_id"))
    lone = known.join(firsts, ["digest", "doc_id"], "left_semi").dropDuplicates(["digest", "doc_id"])
    banded = lone.select("doc_id", "digest", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count("*").alias("members")).where("members > 1")
    hits = _blocks(banded.join(shared, ["band", "key"]), rules)
    same_set = ["doc_id", "digest"]
    marks = lone.select(*same_set, "n_shingles", "bands", "signature")

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.repartition(partitions(frame.sparkSession), *KEYS).sortWithinPartitions(*KEYS, *same_set)

    def likely(batches):
        sketcher = Sketcher(rules)
        for table, group in _whole_groups(batches):
            needed = np.zeros(table.num_rows, bool)
            for i, j in _candidates(table, group, sketcher):
                needed[i] = True
                needed[j] = True
            yield from table.filter(pa.array(needed)).select([*same_set, *KEYS, "own"]).to_batches()

    likely_rows = written(
        dealt(hits.select(*same_set, *KEYS, "own").join(marks, same_set)).mapInArrow(
            likely, "doc_id long, digest binary, band int, key long, a int, b int, own int"
        ), "likely"
    )
    sets = _sets(documents, likely_rows, rules)
    members = dealt(likely_rows.join(marks, same_set).join(sets, same_set))

    def confirmed(batches):
        sketcher, parent = Sketcher(rules), {}

        def root(x):
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent.get(x, x)
            return top

        for table, group in _whole_groups(batches):
            ids = table.column("doc_id").to_pylist()
            sets = table.column("hashes")
            left, right = [], []
            for some_i, some_j in _candidates(table, group, sketcher):
                for i, j in zip(some_i.tolist(), some_j.tolist(), strict=True):
                    a, b = root(ids[i]), root(ids[j])
                    if a == b:
                        continue
                    merged = np.concatenate([np.frombuffer(sets[k].as_buffer(), np.uint64) for k in (i, j)])
                    merged.sort()
                    both = int((merged[1:] == merged[:-1]).sum())
                    if 100 * both >= rules.percent * (len(merged) - both):
                        parent[a] = b
                        left.append(ids[i])
                        right.append(ids[j])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["x", "y"])

    links = members.mapInArrow(confirmed, "x long, y long")
    # a repeated id may stand for several sets: its classes are one
    several = known.groupBy("doc_id").agg(F.countDistinct("digest").alias("k")).where("k > 1").select("doc_id")
    same = known.join(several, "doc_id", "left_semi").select("doc_id", "digest").distinct().join(classes, "digest")
    bridges = same.groupBy("doc_id").agg(F.min("class_id").alias("m")).join(same, "doc_id").select(
        F.col("class_id").alias("x"), F.col("m").alias("y")
    )
    joined = components(links.union(bridges), "x", "y")
    of_class = (
        classes.join(joined, classes.class_id == joined.id, "left")
        .select("digest", F.coalesce("component_id", "class_id").alias("component_id"), "copies")
    )
    found = join_groups(rows.select("doc_id", "n_shingles", "digest"), written(of_class, "components"), "digest", "copies")
    alone = F.col("digest").isNull() | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
