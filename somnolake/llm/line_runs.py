"""Line dedup by winnowing: later copies of runs of lines are deleted."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somnolake.llm.columnar import (
    column, join_groups, list_array, mix, offsets, signed, slice_hashes, texts, written,
)


@dataclass(frozen=True)
class LineRules:
    """Fingerprints are hashes of `gram` lines; of every `window` neighbouring ones the least is taken.

    Two texts that share a run of window + gram - 1 lines therefore share a fingerprint of it.
    A line of `long` bytes or more is a run by itself, and its own fingerprint.
    """

    gram: int = 2
    window: int = 2
    long: int = 200

    @property
    def run(self) -> int:
        return self.window + self.gram - 1


def line_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, bounds): the lines of each text, cut at "\\n"; an empty text has one empty line."""
    breaks = np.flatnonzero(data == 10)
    counts = np.searchsorted(breaks, starts[1:]) - np.searchsorted(breaks, starts[:-1]) + 1
    bounds = offsets(counts)
    begin, end = np.empty(bounds[-1], np.int64), np.empty(bounds[-1], np.int64)
    first, last = bounds[:-1], bounds[1:] - 1
    inner_end = np.ones(len(end), bool)
    inner_end[last] = False
    inner_begin = np.ones(len(begin), bool)
    inner_begin[first] = False
    begin[first], end[last] = starts[:-1], starts[1:]
    end[inner_end] = breaks
    begin[inner_begin] = breaks + 1
    return begin, end, bounds


def _joined(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of `size` neighbouring hashes, for each place where they begin."""
    count = max(0, len(hashes) - size + 1)
    total = hashes[:count].copy()
    for step in range(1, size):
        total = mix(total) + hashes[step:step + count]
    return mix(total + np.uint64(size))


ALONE = np.uint64(0xA0761D6478BD642F)


def _fingerprints(documents: DataFrame, rules: LineRules) -> DataFrame:
    """(print, doc_id, first, lines, runs): the selected fingerprints, and the hashes of all runs around each.

    runs has the runs of `lines` lines that hold the fingerprint, from line `first` on: how far
    a match may extend to the left and to the right.  A long line has itself as its only run.
    """

    def run(batches):
        for batch in batches:
            for low, high, data, starts in texts(batch):
                begin, end, bounds = line_spans(data, starts)
                lines = slice_hashes(data, begin, end)
                counts = np.diff(bounds)
                owner = np.repeat(np.arange(high - low), counts)
                place = np.arange(len(lines)) - bounds[owner]
                whole = _joined(lines, rules.run)
                at = np.flatnonzero(place[:len(whole)] + rules.run <= counts[owner[:len(whole)]])
                grams = _joined(lines, rules.gram)
                options = np.stack([grams[at + i] for i in range(rules.window)])
                chosen = at + rules.window - 1 - options[::-1].argmin(axis=0)
                # the runs that chose a fingerprint are neighbours; each is a way to extend it
                new = np.ones(len(at), bool)
                new[1:] = chosen[1:] != chosen[:-1]
                begins = np.flatnonzero(new)
                length = np.diff(np.append(begins, len(at)))
                ids = column(batch, "doc_id").slice(low, high - low)
                long = np.flatnonzero(end - begin >= rules.long)
                alone = mix(lines[long] ^ ALONE)
                where = np.concatenate([at[begins], long])
                span = np.repeat(np.array([rules.run, 1], np.int32), [len(begins), len(long)])
                around = np.concatenate([whole[at], alone])
                yield pa.RecordBatch.from_arrays([
                    pa.array(signed(np.concatenate([grams[chosen[begins]], alone]))),
                    ids.take(pa.array(owner[where])), pa.array(place[where]), pa.array(span),
                    list_array(signed(around), np.concatenate([length, np.ones(len(long), np.int64)]), pa.int64()),
                ], ["print", "doc_id", "first", "lines", "runs"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "print long, doc_id long, first long, lines int, runs array<long>"
    )


def repeated_runs(documents: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """(doc_id, line, lines): where a run begins that began earlier already, and how many lines it has.

    Earlier means a smaller doc_id, or the same one and a smaller line.  The places of each
    fingerprint that occurs more than once are extended to the left and right by line hashes.  Each
    extension is joined to its own first place: the first place of the fingerprint alone may
    continue otherwise than a later one that still is earlier than this.  First places are minima
    taken before rows move; the rows of very frequent fingerprints and runs don't move at all.
    """
    prints = written(_fingerprints(documents.where("doc_id is not null"), rules), "line-prints")
    again = written(prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1"), "line-prints-again")
    places = join_groups(prints, again, "print", "n").where("n is not null")
    runs = written(places.select("doc_id", "first", "lines", F.posexplode("runs").alias("step", "run")).select(
        "run", "doc_id", (F.col("first") + F.col("step")).alias("line"), "lines"
    ), "line-runs")
    earliest = written(runs.groupBy("run").agg(
        F.min(F.struct("doc_id", "line")).alias("origin"), F.count("*").alias("n")
    ).where("n > 1"), "line-runs-first")
    matched = join_groups(runs, earliest, "run", "n").where("origin is not null")
    return matched.where(F.struct("doc_id", "line") > F.col("origin")).select("doc_id", "line", "lines")


def drop_repeated_runs(documents: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """(doc_id, n_lines, n_removed, text) of every row, without the lines of repeated runs.

    Lines are cut at "\\n" and compared as they are; what is left is joined by "\\n".  A line goes
    when it lies in a run of rules.run lines that also begins at an earlier place, or when it has
    rules.long bytes or more and stands at an earlier place too (runs are judged on the input, and may
    overlap).  Null texts count as empty (one empty line); rows with a null
    id are left as they are; rows that repeat an id are judged alike, and not against each other
    at the same line.
    """
    marks = repeated_runs(documents, rules).groupBy("doc_id").agg(
        F.collect_set(F.struct("line", "lines")).alias("runs")
    )
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))

    def run(batches):
        for batch in batches:
            marked = column(batch, "runs")
            for low, high, data, starts in texts(batch):
                begin, end, bounds = line_spans(data, starts)
                raw, gone = data.tobytes(), np.zeros(len(begin) + 1, np.int64)
                own = marked.slice(low, high - low)
                found = own.flatten()
                values = found.field(0).to_numpy(zero_copy_only=False)
                span = found.field(1).to_numpy(zero_copy_only=False)
                sizes = own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                line = np.repeat(bounds[:-1], sizes) + values
                limit = np.repeat(bounds[1:], sizes)
                # a row that repeats an id may be shorter than the one that the run was found in
                inside = line < limit
                line, limit, span = line[inside], limit[inside], span[inside]
                np.add.at(gone, line, 1)
                np.add.at(gone, np.minimum(line + span, limit), -1)
                keep = np.cumsum(gone)[:-1] == 0
                out = []
                for i in range(high - low):
                    a, b = bounds[i], bounds[i + 1]
                    if keep[a:b].all():
                        out.append(raw[starts[i]:starts[i + 1]])
                    else:
                        out.append(b"\n".join(raw[begin[k]:end[k]] for k in range(a, b) if keep[k]))
                counts = np.diff(bounds)
                removed = np.add.reduceat(~keep, bounds[:-1], dtype=np.int64) if len(counts) else counts
                yield pa.RecordBatch.from_arrays([
                    column(batch, "doc_id").slice(low, high - low), pa.array(counts), pa.array(removed),
                    pa.array(out, pa.binary()).cast(pa.string()),
                ], ["doc_id", "n_lines", "n_removed", "text"])

    return rows.join(marks, "doc_id", "left").mapInArrow(run, "doc_id long, n_lines long, n_removed long, text string")


def kept_digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# The same in SQL, for runs of three lines and lines of 200 bytes: the window functions see every run.
LINE_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), runs AS (
  SELECT doc_id, place, line,
         line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS run
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), judged AS (
  SELECT doc_id, place, line,
         run IS NOT NULL AND row_number() OVER (PARTITION BY run ORDER BY doc_id, place) > 1 AS later,
         strlen(line) >= 200 AND row_number() OVER (PARTITION BY line ORDER BY doc_id, place) > 1 AS again
  FROM runs
), marked AS (
  SELECT doc_id, place, line,
         again OR bool_or(later) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS gone
  FROM judged
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
