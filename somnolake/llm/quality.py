"""Quality classifier: random Fourier features, ridge scores, isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somnolake.llm.columnar import (
    BYTE_CODES, bucket_of_id, column, offsets, prefix_hashes, span_hashes, sums, texts, written,
)

STATISTICS = (
    "log_bytes", "word_length", "word_length_spread", "upper", "digits", "punctuation", "symbols",
    "doubled_punctuation", "words_ending_in_symbols", "non_ascii", "lines_per_word", "repeated_word",
    "distinct_words", "distinct_pairs", "distinct_lines", "capitalised_words", "short_words",
)
_SPACE, _LOWER, _UPPER, _DIGIT, _PUNCTUATION, _SYMBOL, _HIGH = range(7)


def _classes() -> np.ndarray:
    table = np.full(256, _SYMBOL, np.uint8)
    table[0x80:] = _HIGH
    for low, high, kind in (("a", "z", _LOWER), ("A", "Z", _UPPER), ("0", "9", _DIGIT)):
        table[ord(low):ord(high) + 1] = kind
    for byte in b" \t\n\r\x0b\x0c":
        table[byte] = _SPACE
    for byte in b".,;:!?'\"()-":
        table[byte] = _PUNCTUATION
    return table


_CLASS = _classes()


def _distinct(owner: np.ndarray, hashes: np.ndarray, documents: int) -> np.ndarray:
    """Distinct hashes of each owner."""
    keys = hashes ^ (owner.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[first], minlength=documents)


def statistics(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text, all finite; an empty text gives zeros."""
    documents = len(starts) - 1
    kind = _CLASS[data]
    size = np.maximum(1, np.diff(starts))
    share = lambda mask: sums(mask, starts) / size
    solid = kind != _SPACE
    word_start = solid.copy()
    word_start[1:] &= ~solid[:-1]
    inner = starts[1:-1][starts[1:-1] < len(data)]
    word_start[inner] = solid[inner]
    word_end = solid.copy()
    word_end[:-1] &= ~solid[1:]
    before = inner[inner > 0] - 1
    word_end[before] = solid[before]
    begin, end = np.flatnonzero(word_start), np.flatnonzero(word_end) + 1
    owner = np.searchsorted(starts, begin, "right") - 1
    words = np.bincount(owner, minlength=documents)
    some = np.maximum(1, words)
    length = (end - begin).astype(np.float64)
    mean = np.bincount(owner, length, documents) / some
    spread = np.sqrt(np.maximum(0, np.bincount(owner, length**2, documents) / some - mean**2))
    running = prefix_hashes(BYTE_CODES[data])
    hashes = span_hashes(running, begin, end)
    follows = np.zeros(len(begin), bool)
    follows[1:] = owner[1:] == owner[:-1]
    same = follows.copy()
    same[1:] &= hashes[1:] == hashes[:-1]
    pair = follows.nonzero()[0]
    pairs = hashes[pair] * np.uint64(3) + (hashes[pair - 1] ^ np.uint64(0x5851F42D4C957F2D))
    line_end = np.union1d(np.flatnonzero(data == 10), starts[1:][np.diff(starts) > 0])
    line_end = line_end[line_end > 0]
    line_begin = np.zeros(len(line_end), np.int64)
    line_begin[1:] = line_end[:-1]
    line_owner = np.searchsorted(starts, np.minimum(line_begin, max(0, len(data) - 1)), "right") - 1
    skip = (line_begin > starts[line_owner]).astype(np.int64) if len(line_begin) else line_begin
    line_hash = span_hashes(running, np.minimum(line_begin + skip, line_end), line_end)
    lines = np.bincount(line_owner, minlength=documents) if len(line_end) else np.zeros(documents)
    marks = (kind == _PUNCTUATION) | (kind == _SYMBOL)
    doubled = marks.copy()
    doubled[1:] &= marks[:-1]
    doubled[:1] = False
    last = kind[end - 1] if len(end) else kind[:0]
    ends_odd = (last == _SYMBOL) | (data[end - 1] == 0x21) if len(end) else np.zeros(0, bool)
    per_word = lambda values: np.bincount(owner, values, documents) / some
    out = np.stack([
        np.log1p(np.diff(starts)), mean, spread, share(kind == _UPPER), share(kind == _DIGIT),
        share(kind == _PUNCTUATION), share(kind == _SYMBOL), share(doubled), per_word(ends_odd.astype(float)),
        share(kind == _HIGH), lines / some, per_word(same.astype(float)),
        _distinct(owner, hashes, documents) / some,
        _distinct(owner[pair], pairs, documents) / np.maximum(1, np.bincount(owner[pair], minlength=documents)),
        (_distinct(line_owner, line_hash, documents) if len(line_end) else lines) / np.maximum(1, lines),
        per_word((kind[begin] == _UPPER).astype(float)), per_word((length <= 2).astype(float)),
    ], axis=1)
    out[words == 0, 1:] = 0
    return out


def document_statistics(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, stats): STATISTICS of every whole text; a null text counts as empty."""

    def run(batches):
        for batch in batches:
            for low, high, data, starts in texts(batch):
                values = statistics(data, starts)
                yield pa.RecordBatch.from_arrays([
                    column(batch, "doc_id").slice(low, high - low),
                    pa.ListArray.from_arrays(
                        pa.array(offsets(np.full(high - low, values.shape[1])).astype(np.int32)),
                        pa.array(values.ravel()),
                    ),
                ], ["doc_id", "stats"])

    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, stats array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return column(batch, "stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


@dataclass(frozen=True)
class QualityModel:
    """Everything a score needs; a few hundred KB whatever the input."""

    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        standard = np.clip((stats - self.centre) / self.scale, -5, 5)
        waves = np.cos(standard @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([waves, np.ones((len(stats), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0, 1)


def isotonic(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Closest rising sequence to `values` under weights `counts`: neighbours that fall are pooled."""
    blocks: list[list[float]] = []
    for value, count in zip(values, counts, strict=True):
        blocks.append([value, count, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            right = blocks.pop()
            left = blocks[-1]
            total = left[1] + right[1]
            left[:] = [(left[0] * left[1] + right[0] * right[1]) / total, total, left[2] + right[2]]
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit_quality(
    stats: DataFrame, labels: DataFrame, features: int = 192, bandwidth: float = 4.0, ridge: float = 1e-4,
    seed: int = 7, bins: int = 256,
) -> QualityModel:
    """Fit on the rows of `labels` (doc_id, quality), at most one label a document.

    Every task adds up its part of the normal equations; the parts are summed by cell, and only
    the finished (features + 1) squared sums reach the driver.  The calibration sees the scores
    as counts in `bins` bins a unit.  Without labelled rows the score is 0.5 for all.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.avg(F.col("quality").cast("double")).alias("y")
    )
    rows = written(stats.join(known, "doc_id").select("stats", "y"), "labelled-statistics")
    moments = rows.agg(*[
        f(F.col("stats")[i]).alias(f"{n}{i}")
        for i in range(len(STATISTICS)) for n, f in (("m", F.avg), ("s", F.stddev_pop))
    ]).first()
    centre = np.array([moments[f"m{i}"] or 0.0 for i in range(len(STATISTICS))])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(len(STATISTICS))])
    scale[scale < 1e-9] = 1.0
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(len(STATISTICS), features)) / bandwidth
    phases = rng.uniform(0, 2 * np.pi, features)
    size = features + 1
    empty = QualityModel(centre, scale, directions, phases, np.zeros(size), np.array([0.0]), np.array([0.5]))

    def equations(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = empty.features(_matrix(batch))
            y = column(batch, "y").to_numpy(zero_copy_only=False)
            total += z.T @ np.concatenate([z, y[:, None]], axis=1)
        left, right = np.nonzero(np.triu(np.ones((size, size + 1)), 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(total[left, right])],
            ["i", "j", "v"],
        )

    cells = rows.mapInArrow(equations, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    if not len(cells):
        return empty
    total = np.zeros((size, size + 1))
    total[cells.i, cells.j] = cells.v
    gram = np.triu(total[:, :size]) + np.triu(total[:, :size], 1).T
    count = gram[-1, -1]
    if count == 0:
        return empty
    weights = np.linalg.solve(gram + ridge * count * np.eye(size), total[:, size])
    fitted = QualityModel(centre, scale, directions, phases, weights, empty.knots, empty.levels)

    def binned(batches):
        for batch in batches:
            raw = np.round(np.clip(fitted.raw(_matrix(batch)), -1, 2) * bins).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(raw), column(batch, "y")], ["bin", "y"])

    curve = (
        rows.mapInArrow(binned, "bin long, y double").groupBy("bin")
        .agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").toPandas()
    )
    knots = curve.bin.to_numpy() / bins
    return QualityModel(
        centre, scale, directions, phases, weights, knots, isotonic(curve.y.to_numpy(), curve.n.to_numpy())
    )


def score_quality(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) for every row of `stats`."""
    sent = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(sent.value.score(_matrix(batch)))], ["doc_id", "score"]
            )

    return stats.mapInArrow(run, "doc_id long, score double")


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5) -> DataFrame:
    """The rows of `documents`, all columns, whose score is at least `threshold`.

    Learned as in `quality_scores`.  Rows are scored where they are read, and none moves.
    """
    learned = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where(bucket_of_id() % folds != 0)
    known = learned.where("quality is not null").select("doc_id").distinct()
    stats = document_statistics(documents.select("doc_id", "text")).join(known, "doc_id", "left_semi")
    sent = documents.sparkSession.sparkContext.broadcast(fit_quality(stats, learned))

    @F.arrow_udf("double")
    def score(values: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([values], ["text"])
        parts = [sent.value.score(statistics(data, starts)) for _, _, data, starts in texts(batch)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return documents.where(score(F.coalesce("text", F.lit(""))) >= threshold)


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `documents`.

    Labels are learned only from ids whose crc32 is not a multiple of `folds`.  Repeated rows are
    scored alike, a null id gets a null id back, and null labels count as no label.
    """
    stats = written(document_statistics(documents), "statistics")
    learned = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where(bucket_of_id() % folds != 0)
    scored = score_quality(stats, fit_quality(stats, learned))
    return scored.select(
        "doc_id", (bucket_of_id() % folds == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
