"""Spelling variants: words one edit apart, found in a bit-sliced index of letters by position."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somnolake.llm.columnar import column, join_groups, offsets, partitions, ranges, texts, written


@dataclass(frozen=True)
class VariantRules:
    """Words of `least_length` letters that occur `least_count` times; a form is `ratio` times as frequent.

    `slip` is the rate of planted slips: of the occurrences whose hash it divides, one letter is
    lost (0: none).  Groups of over `block` words are compared block against block.
    """

    least_length: int = 5
    least_count: int = 3
    ratio: int = 2
    slip: int = 0
    block: int = 4096


# --- words ------------------------------------------------------------------------------

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
# U+00C0 to U+00FF are this byte and one more
_WIDE = 0xC3
_LETTER[_WIDE] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _checksums(data: np.ndarray, begin: np.ndarray, length: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each span of `data`, continued from the crc32 `before`."""
    order = np.argsort(-length, kind="stable")
    begin, length, state = begin[order], length[order], ~before[order]
    long = int(np.searchsorted(-length, -64))
    for i in range(long):
        span = data[begin[i]:begin[i] + length[i]].tobytes()
        state[i] = ~np.uint32(zlib.crc32(span, int(~state[i])))
    live = len(length)
    for k in range(int(length[long]) if long < live else 0):
        live = long + int(np.searchsorted(-length[long:], -k))
        now = state[long:live]
        state[long:live] = _CRC[(now ^ data[begin[long:live] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    return out


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the letter runs of folded texts, cut where a text ends."""
    letter = _LETTER[data]
    letter[1:] |= data[:-1] == _WIDE
    inner = starts[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins, ends = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1]
    begins[inner] = letter[inner]
    ends[:-1] &= ~letter[1:]
    ends[inner - 1] = letter[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _counted(ids: list, data: np.ndarray, starts: np.ndarray, rules: VariantRules) -> pa.StructArray:
    data = _FOLD[data]
    begin, end = word_spans(data, starts)
    wide = offsets((data == _WIDE).astype(np.int64))
    letters = end - begin - (wide[end] - wide[begin])
    enough = letters >= rules.least_length
    begin, length, letters = begin[enough], (end - begin)[enough], letters[enough]
    lost = []
    if rules.slip:
        owner = np.searchsorted(starts, begin, "right") - 1
        heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        marks = _checksums(data, begin, length, heads[owner])
        slips = marks % np.uint32(rules.slip) == 0
        for i in np.flatnonzero(slips & (letters > rules.least_length)).tolist():
            word = data[begin[i]:begin[i] + length[i]].tobytes().decode()
            at = int(marks[i]) % len(word)
            lost.append((word[:at] + word[at + 1:]).encode())
        begin, length = begin[~slips], length[~slips]
    flat = data[ranges(begin, length)]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets(length)), pa.py_buffer(flat)])
    return pa.concat_arrays([words, pa.array(lost, pa.large_binary())]).value_counts()


def word_counts(documents: DataFrame, rules: VariantRules = VariantRules()) -> DataFrame:
    """(word, n): every word of `documents` with A-Z folded, as often as it occurs.

    Counted in pieces of text before anything moves, so a word in every text is one row a piece.
    """

    def run(batches):
        for batch in batches:
            ids = column(batch, "doc_id").to_pylist()
            for low, high, data, starts in texts(batch, limit=4 << 20):
                found = _counted(ids[low:high], data, starts, rules)
                yield pa.RecordBatch.from_arrays(
                    [found.field("values").cast(pa.large_string()).cast(pa.string()), found.field("counts")], ["word", "n"]
                )

    counted = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rules.least_count)


# --- near words -------------------------------------------------------------------------


def _parts(length: int) -> tuple[tuple[int, int], ...]:
    """The three stretches of a word of `length` letters; one edit leaves two of them as they are."""
    a = length // 3
    b = a + (length - a) // 2
    return (0, a), (a, b), (b, length)


def _keyed(vocabulary: DataFrame, rules: VariantRules) -> DataFrame:
    """(group, base, part, word, n): words that agree outside one stretch share a group.

    Two near words have the length of the shorter one as `base`.  The longer one is cut at the same
    places, before the edit from its start and behind it from its end.
    """
    a = "base DIV 3"
    b = f"{a} + (base - {a}) DIV 2"
    keys = (f"right(word, base - ({a}))", f"concat(left(word, {a}), ' ', right(word, base - ({b})))", f"left(word, {b})")
    structs = ", ".join(f"struct({part} AS part, {key} AS outside)" for part, key in enumerate(keys))
    return (
        vocabulary.selectExpr("word", "n", "explode(array(length(word), length(word) - 1)) AS base")
        .where(F.col("base") >= rules.least_length)
        .selectExpr("word", "n", "base", f"inline(array({structs}))")
        .selectExpr("xxhash64(base, part, outside) AS group", "base", "part", "word", "n")
    )


INDEXED, ASKS = 1, 2
CELL = ("base", "part", "group", "a", "b")


def _cells(rows: DataFrame, rules: VariantRules) -> DataFrame:
    """Words dealt to cells of at most about `block` indexed words and as many that ask.

    A group of up to `block` words is one cell.  A larger one is a grid: each word is indexed in the
    cells of its row and asks in those of its column, so every ordered pair of words meets once.
    """
    blocks = F.ceil(F.col("members") / rules.block).cast("int")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("own", own)
    one = dealt.where("blocks = 1").selectExpr("base", "part", "group", "0 AS a", "0 AS b", f"{INDEXED + ASKS} AS role", "word", "n")
    other = dealt.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return one.unionByName(other.selectExpr(
        "base", "part", "group",
        f"inline(array(struct(own AS a, other AS b, {INDEXED} AS role), struct(other AS a, own AS b, {ASKS} AS role)))", "word", "n",
    ))


class SlicedIndex:
    """For each place and letter the bitset of the words that have it there, 64 words to a lane.

    Holds the letters of one stretch of words of `base` or `base` + 1 letters.  Groups have lanes of
    their own.  Only places and letters that occur are stored.
    """

    def __init__(self, letters: np.ndarray, begin: np.ndarray, longer: np.ndarray, group: np.ndarray, width: int):
        self.width = width
        counts = np.bincount(group, minlength=int(group.max()) + 1 if len(group) else 0)
        lanes = (counts + 63) // 64
        self.first, self.lanes = offsets(lanes)[:-1], lanes
        order = np.argsort(group, kind="stable")
        rank = np.empty(len(group), np.int64)
        rank[order] = np.arange(len(group)) - offsets(counts)[:-1][group[order]]
        lane, bit = self.first[group] + rank // 64, rank % 64
        flag = np.uint64(1) << bit.astype(np.uint64)
        total = int(lanes.sum())
        self.member = np.full(total * 64, -1, np.int64)
        self.member[lane * 64 + bit] = np.arange(len(group))
        self.short, self.long = np.zeros(total, np.uint64), np.zeros(total, np.uint64)
        np.bitwise_or.at(self.short, lane[~longer], flag[~longer])
        np.bitwise_or.at(self.long, lane[longer], flag[longer])
        size = width + longer
        place = ranges(np.zeros(len(size), np.int64), size)
        key = self._key(np.repeat(lane, size), place, letters[np.repeat(begin, size) + place])
        order = np.argsort(key, kind="stable")
        key, flag = key[order], np.repeat(flag, size)[order]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.keys = key[heads]
        self.bits = np.bitwise_or.reduceat(flag, heads) if len(heads) else np.zeros(0, np.uint64)

    def _key(self, lane, place, letter):
        return (lane * (self.width + 1) + place) * 256 + letter

    def at(self, lane: np.ndarray, place: int, letter: np.ndarray) -> np.ndarray:
        """The words of each lane that have the letter at the place."""
        if not len(self.keys):
            return np.zeros(len(lane), np.uint64)
        key = self._key(lane, place, letter)
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[found] == key, self.bits[found], np.uint64(0))

    def around(self, lane: np.ndarray, asked: list[np.ndarray], before: np.ndarray, last: bool) -> np.ndarray:
        """Words one letter replaced or one inserted away from words of `base` letters.

        `asked[k]` are the letters at place k, `before` those in front of the stretch (0: none).
        Each step keeps the words without an error so far, with one replaced, and with one
        inserted, the last with places moved by one.  Of several places where the same letter may
        be inserted the first counts, so that a pair of words is found in one stretch only.
        """
        exact = self.short[lane] | self.long[lane]
        replaced, inserted = np.zeros_like(exact), np.zeros_like(exact)
        for k, letter in enumerate(asked):
            here = self.at(lane, k, letter)
            inserted = (inserted | (exact & ~self.at(lane, k, before))) & self.at(lane, k + 1, letter)
            replaced = (replaced & here) | (exact & ~here)
            exact &= here
            before = letter
        if last:
            inserted |= exact & ~self.at(lane, len(asked), before)
        return (replaced & self.short[lane]) | (inserted & self.long[lane])

    def below(self, lane: np.ndarray, asked: list[np.ndarray], before: np.ndarray, last: bool) -> np.ndarray:
        """Words of `base` letters that come of words of one more by losing a letter, the first of equal ones."""
        exact, lost = self.short[lane], np.zeros(len(lane), np.uint64)
        for k, letter in enumerate(asked):
            lost = lost & self.at(lane, k - 1, letter) if k else lost
            if k + 1 < len(asked) or last:
                lost = lost | np.where(letter != before, exact, np.uint64(0))
            exact = exact & self.at(lane, k, letter)
            before = letter
        return lost


def _expanded(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bit) of every bit set."""
    some = np.flatnonzero(near)
    rows, bits = [], []
    for at in range(0, len(some), 1 << 16):
        part = some[at:at + (1 << 16)]
        flat = np.unpackbits(near[part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(flat)
        rows.append(part[row])
        bits.append(bit)
    return (np.concatenate(rows), np.concatenate(bits)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _near_in(table: pa.Table) -> pa.RecordBatch:
    """(word, near, best_n, best): for each word that asks in whole cells, what its cell answers."""
    words = table.column("word").to_pylist()
    base, part, role, n = (table.column(c).to_numpy() for c in ("base", "part", "role", "n"))
    stretch = {length: _parts(length) for length in np.unique(base).tolist()}
    cells, group = {}, np.empty(len(words), np.int64)
    columns = (table.column(c).to_pylist() for c in CELL)
    for i, (word, length, which, _, a, b) in enumerate(zip(words, *columns, strict=True)):
        low, high = stretch[length][which]
        # the letters themselves: groups whose hashes are equal stay apart
        cell = (length, which, a, b, word[:low], word[len(word) - (length - high):])
        group[i] = cells.setdefault(cell, len(cells))
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start, longer = offsets(size)[:-1], size > base
    order = pc.sort_indices(table, [("n", "descending"), ("word", "ascending")]).to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    kind = base.astype(np.int64) * 3 + part
    for one in np.unique(kind).tolist():
        length, which = divmod(one, 3)
        low, high = stretch[length][which]
        rows = np.flatnonzero(kind == one)
        own, dense = np.unique(group[rows], return_inverse=True)
        held = rows[(role[rows] & INDEXED) > 0]
        index = SlicedIndex(letters, start[held] + low, longer[held], dense[(role[rows] & INDEXED) > 0], high - low)
        lanes = np.zeros(len(own), np.int64)
        lanes[:len(index.lanes)] = index.lanes
        first = np.zeros(len(own), np.int64)
        first[:len(index.first)] = index.first
        for more in (False, True):
            asks = ((role[rows] & ASKS) > 0) & (longer[rows] == more)
            who, of = rows[asks], dense[asks]
            for piece in range(0, len(who), 1 << 15):
                some, g = who[piece:piece + (1 << 15)], of[piece:piece + (1 << 15)]
                lane = ranges(first[g], lanes[g])
                row = np.repeat(some, lanes[g])
                asked = [letters[start[row] + low + k] for k in range(high - low + more)]
                before = letters[start[row] + low - 1] if low else np.zeros(len(row), np.int64)
                near = (index.below if more else index.around)(lane, asked, before, which == 2)
                at, bit = _expanded(near)
                hit = rank[held[index.member[lane[at] * 64 + bit]]]
                count += np.bincount(row[at], minlength=len(words))
                np.minimum.at(best, row[at], hit)
    some = np.flatnonzero(count)
    chosen = order[best[some]]
    return pa.RecordBatch.from_arrays([
        table.column("word").take(pa.array(some)).combine_chunks(), pa.array(count[some]), pa.array(n[chosen]),
        table.column("word").take(pa.array(chosen)).combine_chunks(),
    ], ["word", "near", "best_n", "best"])


def _whole_cells(batches, least_rows: int = 50_000):
    """Tables of whole cells from batches sorted by CELL; a cell has a bounded number of rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < least_rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = np.ones(table.num_rows, bool)
        for name in CELL:
            values = table.column(name).to_numpy()
            last &= values == values[-1]
        cut = table.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held, rows = table.slice(cut).to_batches(), table.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def near_words(vocabulary: DataFrame, rules: VariantRules = VariantRules()) -> DataFrame:
    """(word, n_near, best_n, best): for each word with a near one, how many, and the most frequent of them.

    `vocabulary` is (word, n) with words of a-z and U+00C0 to U+00FF, each once.
    """
    keyed = _keyed(vocabulary, rules)
    groups = written(keyed.groupBy("group").agg(F.count("*").alias("members")).where("members > 1"), "variant-groups")
    cells = _cells(join_groups(keyed, groups, "group", "members").where("members > 1"), rules)
    dealt = cells.repartition(partitions(vocabulary.sparkSession), *CELL).sortWithinPartitions(*CELL)

    def run(batches):
        for table in _whole_cells(batches):
            yield _near_in(table)

    found = dealt.mapInArrow(run, "word string, near long, best_n long, best string")
    return found.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first"),
    ).select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


# --- forms ------------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: pointers are doubled until none moves.

    A form is at least `ratio` times as frequent, so chains are short: a form of counts up to 2**63
    has at most 62 steps, which six rounds follow.
    """
    pointers = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        moved = pointers.join(onward, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")
        )
        moved = written(moved, "variant-roots")
        pointers = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return pointers


def variant_groups(documents: DataFrame, rules: VariantRules = VariantRules()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of `documents` that is long and frequent enough.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF of the whole texts, A-Z folded.  Two are
    near when one letter inserted, deleted or replaced makes them equal.  form is the most frequent
    near word (ties: the smallest), if `ratio` times as frequent, else null; root follows forms to
    the last.  Null and empty texts have no words; a null id counts as empty text; rows that repeat
    are counted each; other columns are not read; without words there are no rows.
    """
    vocabulary = written(word_counts(documents, rules), "vocabulary")
    near = near_words(vocabulary, rules)
    is_form = F.col("best_n") >= rules.ratio * F.col("n")
    found = written(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
    ), "variants")
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
