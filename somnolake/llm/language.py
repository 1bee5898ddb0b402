"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from somnolake.llm.columnar import bucket_of_id, column, ranges, sums, texts

SAMPLE_BYTES = 32 << 10
SAMPLE_ROWS = 200
STRETCH = 256


def byte_symbols(samples: list[bytes]) -> np.ndarray:
    """A symbol below 250 for each byte: ASCII letters folded, and digits, blanks and marks as one each.

    Bytes beyond ASCII that no sample has share symbol 0, as control characters do.
    """
    table = np.zeros(256, np.uint8)
    for byte in b" \t\n\r\x0b\x0c":
        table[byte] = 1
    table[ord("0"):ord("9") + 1] = 2
    for byte in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
        table[byte] = 3
    letters = np.arange(26, dtype=np.uint8) + 4
    table[ord("a"):ord("z") + 1] = letters
    table[ord("A"):ord("Z") + 1] = letters
    seen = sorted({b for sample in samples for b in sample if b >= 0x80})
    table[seen] = np.arange(30, 30 + len(seen), dtype=np.uint8)
    return table


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """next[state, symbol] of the automaton of all substrings, -1 where there is none; state 0 begins.

    A separator, the symbol `width`, ends no phrase of a text: its transitions are left out.
    """
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in step[state]:
            step[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = step[state][symbol]
            if length[state] + 1 == length[target]:
                link[new] = target
            else:
                copy = len(step)
                step.append(dict(step[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and step[state].get(symbol) == target:
                    step[state][symbol] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    table = np.full((len(step), width), -1, np.int32)
    for state, moves in enumerate(step):
        for symbol, target in moves.items():
            if symbol < width:
                table[state, symbol] = target
    return table


class CrossParser:
    """Phrases that a text takes to be parsed into longest matches with one language's sample."""

    def __init__(self, sample: list[bytes], table: np.ndarray):
        self.width = int(table.max()) + 1
        symbols = [s for text in sample for s in (*table[np.frombuffer(text, np.uint8)].tolist(), self.width)]
        moves = suffix_automaton(symbols, self.width)
        moves[:, 0] = -1
        self.bits = np.log2(max(2, len(symbols)))
        # each move is (next state) * row + phrases that it ends; the last column pads
        row = self.width + 1
        fresh = moves[0]
        again = np.where(fresh >= 0, fresh, 0)
        ends = np.where(fresh >= 0, 1, 2)
        target = np.where(moves >= 0, moves, again[None])
        phrases = np.where(moves >= 0, 0, ends[None])
        phrases[0] = np.where(fresh >= 0, 0, 1)
        table_ = np.zeros((len(moves), row), np.int64)
        table_[:, :-1] = target * row * 4 + phrases
        table_[:, -1] = np.arange(len(moves)) * row * 4
        self.moves = table_.ravel().astype(np.int32)

    def phrases(self, stretches: np.ndarray) -> np.ndarray:
        """Phrases of each column of symbols."""
        state = np.zeros(stretches.shape[1], np.int32)
        count = np.zeros(stretches.shape[1], np.int32)
        for symbols in stretches:
            moved = self.moves[state + symbols]
            count += moved & 3
            state = moved >> 2
        return count + (state != 0)


class LanguageModel:
    def __init__(self, samples: dict[str, list[bytes]]):
        self.names = sorted(samples)
        self.table = byte_symbols([t for texts_ in samples.values() for t in texts_])
        self.parsers = [CrossParser(samples[n], self.table) for n in self.names]

    def bits(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits that each text takes in each language: phrases times the bits of a place in the sample.

        Texts are parsed in stretches of STRETCH bytes, which all languages share.
        """
        size = np.diff(starts)
        count = -(-size // STRETCH)
        begin = np.repeat(starts[:-1], count) + ranges(np.zeros(len(count), np.int64), count) * STRETCH
        limit = np.repeat(starts[1:], count)
        out = np.zeros((len(size), len(self.names)))
        symbols = self.table[data]
        owner = np.repeat(np.arange(len(size)), count)
        for low in range(0, len(begin), 4096):
            own, end = begin[low:low + 4096], limit[low:low + 4096]
            at = own[None, :] + np.arange(STRETCH)[:, None]
            inside = at < end[None, :]
            drawn = symbols[np.minimum(at, len(symbols) - 1)].astype(np.int32)
            for i, parser in enumerate(self.parsers):
                lanes = np.where(inside, drawn, np.int32(parser.width))
                out[:, i] += np.bincount(owner[low:low + 4096], parser.phrases(lanes) * parser.bits, len(size))
        return out

    def predict(self, data: np.ndarray, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of fewest bits a byte, and how sure that is: 0 to 1."""
        size = np.maximum(1, np.diff(starts))
        bits = self.bits(data, starts)
        best = bits.argmin(axis=1)
        excess = (bits - bits.min(axis=1, keepdims=True)) / np.sqrt(size)[:, None]
        score = 1 / np.exp2(-np.minimum(excess, 60)).sum(axis=1)
        letter = _has_letter(data, starts)
        names = [self.names[b] if ok else "und" for b, ok in zip(best.tolist(), letter.tolist(), strict=True)]
        return names, np.where(letter, score, 0.0)


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True


def _has_letter(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    found = sums(_ASCII_LETTER[data], starts) > 0
    for i in np.flatnonzero(~found):
        text = data[starts[i]:starts[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(character.isalpha() for character in text)
    return found


def labelled_samples(labelled: DataFrame) -> dict[str, list[bytes]]:
    """About SAMPLE_BYTES of text of each language: a share of each of up to SAMPLE_ROWS rows.

    The rows are the first in the order of a hash of their id, chosen before the texts are read.
    Of each, as many code points as its share are taken from a place that a hash of the id names, so
    that no single text fills a sample; where there are fewer rows, shares are larger.
    """
    rows = labelled.where("doc_id is not null and lang is not null and text is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        rows.select("doc_id", "lang").withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= SAMPLE_ROWS)
        .withColumn("share", F.ceil(F.lit(SAMPLE_BYTES) / F.count("*").over(Window.partitionBy("lang"))).cast("int"))
    )
    # SAMPLE_ROWS a language: small enough to be sent to where the texts are
    picked = rows.join(
        F.broadcast(chosen.groupBy("doc_id", "lang").agg(F.min("place").alias("place"), F.max("share").alias("share"))),
        ["doc_id", "lang"],
    )
    spare = F.greatest(F.length("text") - F.col("share"), F.lit(0)) + 1
    begin = (F.pmod(F.xxhash64("doc_id", "lang"), spare) + 1).cast("int")
    cut = picked.select("lang", "place", F.substring(F.col("text"), begin, F.col("share")).alias("text")).distinct()
    samples: dict[str, list[bytes]] = {}
    for row in cut.orderBy("lang", "place", "text").collect():  # about SAMPLE_BYTES characters a language
        samples.setdefault(row["lang"], []).append(row["text"].encode())
    return samples


_models: dict = {}


def identify(documents: DataFrame, samples: dict[str, list[bytes]]) -> DataFrame:
    """(doc_id, lang_pred, score) of every row and whole text."""
    key = hash(tuple((n, tuple(t)) for n, t in sorted(samples.items())))
    sent = documents.sparkSession.sparkContext.broadcast(samples)

    def run(batches):
        if samples_key not in _models:
            _models.clear()
            _models[samples_key] = LanguageModel(sent.value)
        model = _models[samples_key]
        for batch in batches:
            for low, high, data, starts in texts(batch, limit=1 << 20):
                if model.names:
                    names, score = model.predict(data, starts)
                else:
                    names, score = ["und"] * (high - low), np.zeros(high - low)
                yield pa.RecordBatch.from_arrays([
                    column(batch, "doc_id").slice(low, high - low), pa.array(names, pa.string()), pa.array(score)
                ], ["doc_id", "lang_pred", "score"])

    samples_key = key
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )


def languages(documents: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of `documents`.

    Learned from rows with a non-null lang whose id's crc32 modulo `folds` is not `held_out`.  A
    text that is null or has no letter is `und` with score 0, as all are where nothing was
    learned; ties go to the first language by name; null ids and repeated rows come back as they are.
    """
    known = documents.where(bucket_of_id() % folds != held_out).select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"
    )
    found = identify(documents, labelled_samples(known))
    return found.select("doc_id", (bucket_of_id() % folds == held_out).alias("held_out"), "lang_pred", "score")
