"""Suffix order and common prefixes of many short strings, by induced sorting over spilling queues."""

from __future__ import annotations

import tempfile
from collections import deque

import numpy as np

LIMIT = 255


class SuffixQueue:
    """A queue of (first byte, rank of the source, position), least byte first, then least rank.

    Sources come in the order of their rank, so within a byte the tuples leave as they came.  When
    more than `budget` tuples are held, the waiting ones go to an unnamed scratch file of the task,
    which ends with it, as a task's other spills do.
    """

    def __init__(self, budget: int):
        self.budget, self.held, self.file = budget, 0, None
        self.waiting: list[deque] = [deque() for _ in range(256)]

    def push(self, bytes_: np.ndarray, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not len(bytes_):
            return
        order = np.argsort(bytes_, kind="stable")
        bytes_, rows = bytes_[order], np.stack([ranks[order], positions[order]])
        cuts = np.flatnonzero(bytes_[1:] != bytes_[:-1]) + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bytes_)], strict=True):
            self.waiting[bytes_[first]].append(rows[:, first:last])
        self.held += len(bytes_)
        if self.held > self.budget:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for queue in self.waiting:
            for i, rows in enumerate(queue):
                if isinstance(rows, np.ndarray):
                    at = self.file.seek(0, 2)
                    self.file.write(np.ascontiguousarray(rows).tobytes())
                    queue[i] = (at, rows.shape[1], rows.dtype)
        self.held = 0

    def pop(self, byte: int) -> tuple[np.ndarray, np.ndarray]:
        """All (ranks, positions) of a byte that wait now."""
        queue, parts = self.waiting[byte], []
        while queue:
            rows = queue.popleft()
            if not isinstance(rows, np.ndarray):
                at, count, kind = rows
                self.file.seek(at)
                rows = np.frombuffer(self.file.read(2 * count * kind.itemsize), kind).reshape(2, count)
            else:
                self.held -= rows.shape[1]
            parts.append(rows)
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        joined = np.concatenate(parts, axis=1) if len(parts) > 1 else parts[0]
        return joined[0], joined[1]


class _Order:
    """Suffixes in the order they are settled, each with the common prefix to the one before."""

    def __init__(self, most: int):
        self.position = np.zeros(most, np.int32)
        self.shared = np.zeros(most, np.uint8)
        self.size = 0

    def add(self, positions: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """The new ranks."""
        low, self.size = self.size, self.size + len(positions)
        self.position[low:self.size] = positions
        self.shared[low:self.size] = shared
        return np.arange(low, self.size, dtype=np.int32)

    def induced(self, ranks: np.ndarray, before: int) -> np.ndarray:
        """Common prefixes of suffixes that begin alike and go on as their sources do.

        `before` is the rank of the source of the suffix before the first one, or -1 for none.
        """
        out = np.zeros(len(ranks), np.int32)
        if before >= 0:
            out[0] = self.shared[before + 1:ranks[0] + 1].min() + 1
        if len(ranks) > 1:
            span = self.shared[ranks[0] + 1:ranks[-1] + 1]
            out[1:] = np.minimum.reduceat(span, ranks[:-1] - ranks[0]).astype(np.int32) + 1
        return np.minimum(out, LIMIT)


def _words(text: np.ndarray, positions: np.ndarray, word: int) -> np.ndarray:
    """Eight bytes from position + 8 * word as a big-endian number; `text` is padded by zeros."""
    raw = np.lib.stride_tricks.sliding_window_view(text, 8)[positions + 8 * word]
    return np.ascontiguousarray(raw).view(">u8").ravel().astype(np.uint64)


def sort_seeds(padded: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted up to their string's end, word by word among ties; and their common prefixes.

    The strings are short, so this ends the recursion at its first level.  Suffixes that are equal
    up to the end of their strings stay in text order.
    """
    order = np.arange(len(positions))
    group = np.zeros(len(positions), np.int64)
    shared = np.zeros(len(positions), np.int64)
    open_ = np.ones(len(positions), bool)
    word = 0
    while open_.any():
        at = np.flatnonzero(open_)
        own = order[at]
        values = _cut(_words(padded, positions[own], word))
        sort = np.lexsort((values, group[at]))
        order[at], values, groups = own[sort], values[sort], group[at][sort]
        tie = np.zeros(len(at), bool)
        tie[1:] = groups[1:] == groups[:-1]
        differ = tie.copy()
        differ[1:] &= values[1:] != values[:-1]
        same = tie & ~differ
        unlike = np.flatnonzero(differ)
        shared[at[unlike]] = 8 * word + _equal_bytes(values[unlike], values[unlike - 1])
        new = ~same
        starts = at[np.flatnonzero(new)]
        group[at] = starts[np.cumsum(new) - 1] if len(starts) else group[at]
        ended = (values & np.uint64(0xFF)) == 0
        finished = np.flatnonzero(same & ended)
        shared[at[finished]] = 8 * word + _first_zero(values[finished])
        # groups of one, and groups whose strings have ended, are settled
        size = np.diff(np.append(np.flatnonzero(new), len(at)))
        open_[at] = (np.repeat(size, size) > 1) & ~ended
        word += 1
    return positions[order], np.minimum(shared, LIMIT)


def _first_zero(words: np.ndarray) -> np.ndarray:
    """How many bytes stand before the first zero byte; 8 if there is none."""
    bytes_ = words.astype(">u8").view(np.uint8).reshape(-1, 8) == 0
    return np.where(bytes_.any(axis=1), bytes_.argmax(axis=1), 8)


def _cut(words: np.ndarray) -> np.ndarray:
    """Zero from the first zero byte on, so that what follows a string's end doesn't count."""
    keep = _first_zero(words)
    ended = np.flatnonzero(keep < 8)
    out = words.copy()
    drop = ((8 - keep[ended]) * 8).astype(np.uint64)
    whole = drop == 64
    drop[whole] = 0
    out[ended] = (words[ended] >> drop) << drop
    out[ended[whole]] = 0
    return out


def _equal_bytes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    same = (left ^ right).astype(">u8").view(np.uint8).reshape(-1, 8) != 0
    return np.where(same.any(axis=1), same.argmax(axis=1), 8)


def suffix_order(text: np.ndarray, budget: int = 1 << 23) -> tuple[np.ndarray, np.ndarray]:
    """(positions, shared) of all suffixes of the strings in `text`, greatest first.

    Each string ends with a zero byte and has no other; a suffix ends with its string.  shared is
    the length of the prefix (LIMIT at most) that a suffix has in common with the one before it.

    A suffix is of type S if it is less than the one that begins a byte later, else L.  The S
    suffixes that follow an L are sorted first; from them all L suffixes are induced in rising
    order, and from these all S suffixes in falling order: a suffix stands among those of its
    first byte as its source, the suffix one byte later, stands among all.  Its common prefix with
    its neighbour is one more than the least common prefix between their sources.
    """
    size = len(text)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    padded = np.concatenate([text, np.zeros(520, np.uint8)])
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), size - 1)  # of runs of one byte
    run_start = np.append(0, ends[:-1] + 1)
    rises = np.ones(len(ends), bool)
    rises[:-1] = text[ends[:-1] + 1] > text[ends[:-1]]
    lengths = ends - run_start + 1
    is_s = np.repeat(rises, lengths)
    is_s[text == 0] = True
    run = np.minimum(np.repeat(ends, lengths) - np.arange(size) + 1, LIMIT).astype(np.uint8)
    seeds = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if is_s[0] and text[0] == 0:
        seeds = np.append(0, seeds)
    order, shared = sort_seeds(padded, seeds)
    zeros = np.searchsorted(text[order] != 0, True) if len(order) else 0
    shared[:zeros] = 0
    first = text[order]
    cuts = np.searchsorted(first, np.arange(257))

    rising = _Order(int((~is_s).sum()) + len(order))
    queue = SuffixQueue(budget)
    l_range = np.zeros((256, 2), np.int64)

    def push_l(positions, ranks):
        some = positions > 0
        before, ranks = positions[some].astype(np.int32) - np.int32(1), ranks[some]
        l_type = ~is_s[before]
        queue.push(text[before[l_type]], ranks[l_type], before[l_type])

    for byte in range(256):
        start, last = rising.size, -1
        while True:
            ranks, positions = queue.pop(byte)
            if not len(ranks):
                break
            new = rising.add(positions, rising.induced(ranks, last))
            last = int(ranks[-1])
            push_l(positions, new)
        l_range[byte] = start, rising.size
        a, b = cuts[byte], cuts[byte + 1]
        if b > a:
            own, common = order[a:b], shared[a:b].copy()
            common[0] = min(run[own[0]], run[rising.position[rising.size - 1]], LIMIT) if rising.size > start else 0
            push_l(own, rising.add(own, common))

    falling = _Order(size)
    queue = SuffixQueue(budget)

    def push_s(positions, ranks):
        some = positions > 0
        before, ranks = positions[some].astype(np.int32) - np.int32(1), ranks[some]
        s_type = is_s[before] & (text[before] != 0)
        queue.push(text[before[s_type]], ranks[s_type], before[s_type])

    for byte in range(255, 0, -1):
        start, last = falling.size, -1
        while True:
            ranks, positions = queue.pop(byte)
            if not len(ranks):
                break
            new = falling.add(positions, falling.induced(ranks, last))
            last = int(ranks[-1])
            push_s(positions, new)
        a, b = l_range[byte]
        if b > a:
            own = rising.position[a:b][::-1]
            common = np.zeros(b - a, np.int64)
            common[1:] = rising.shared[a + 1:b][::-1]
            if falling.size > start:
                common[0] = min(run[own[0]], run[falling.position[falling.size - 1]], LIMIT)
            push_s(own, falling.add(own, common))
    return falling.position[:falling.size], falling.shared[:falling.size]
