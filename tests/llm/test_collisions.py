"""Texts that a polynomial hash modulo a power of two can't tell apart, whatever its base."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from somnolake.llm.byte_bpe import encode_documents, read_ranks
from somnolake.llm.columnar import slice_hashes
from somnolake.llm.encode_cache import EncodeCache
from somnolake.llm.line_runs import drop_repeated_runs
from somnolake.llm.near_dups import near_duplicate_classes
from somnolake.llm.shipping import ship
from somnolake.llm.token_files import PieceEncoder, token_documents, write_token_files

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def thue_morse(size, first, second):
    return "".join((first, second)[bin(i).count("1") % 2] for i in range(size))


PAIR = [thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")]
LINES = [f"{t}\n{t[::-1]}x\nend" for t in PAIR]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, PAIR[0]), (2, PAIR[1]), (3, LINES[0]), (4, LINES[1])]
    return ship(spark).createDataFrame(rows, "doc_id long, text string").coalesce(1)


def test_byte_bpe(docs):
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    for r in encode_documents(docs, RANKS).collect():
        text = PAIR[r["doc_id"] - 1] if r["doc_id"] < 3 else LINES[r["doc_id"] - 3]
        ids = plain.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_token_files(docs, tmp_path):
    plain = Tokenizer.from_file(WORDS)
    write_token_files(docs, WORDS, str(tmp_path / "t"))
    found = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_documents(docs.sparkSession, str(tmp_path / "t")).collect()}
    for i, text in enumerate(PAIR + LINES, 1):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert found[i] == (len(ids), zlib.crc32(ids.tobytes()))


def test_near_duplicates(docs):
    found = {r["doc_id"]: r["component_id"] for r in near_duplicate_classes(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 3, 4: 4}


def test_lines(docs):
    alone = docs.where("doc_id > 2")
    found = {r["doc_id"]: (r["n_removed"], r["text"]) for r in drop_repeated_runs(alone).collect()}
    assert found[3] == (0, LINES[0]) and found[4] == (0, LINES[1])
    # the first lines of 3 and 4 are the texts of 1 and 2, and long
    found = {r["doc_id"]: (r["n_removed"], r["text"]) for r in drop_repeated_runs(docs).collect()}
    assert found == {
        1: (0, PAIR[0]), 2: (0, PAIR[1]),
        3: (1, LINES[0].split("\n", 1)[1]), 4: (1, LINES[1].split("\n", 1)[1]),
    }


def test_span_hashes_follow_the_bytes():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 3, 5000).astype(np.uint8)
    starts = rng.integers(0, 4000, 3000)
    ends = starts + np.concatenate([rng.integers(0, 9, 2800), rng.integers(200, 300, 200)])
    found = slice_hashes(data, starts, ends).tolist()
    spans = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert len(set(found)) == len(set(spans)) == len(set(zip(found, spans)))


def test_cache_of_few_bytes_encodes_again():
    import pyarrow as pa

    asked = []

    def missing(pieces):
        asked.extend(pieces)
        return [list(p) for p in pieces]

    cache = EncodeCache(most=200)
    for words in ([b"ab", b"", b"c", b"ab"], [b"c", b"d"], [b"ab", b"d"]):
        ids, lengths = cache.encode(pa.array(words, pa.binary()), missing)
        assert bytes(ids.tolist()) == b"".join(words) and lengths.tolist() == list(map(len, words))
    assert asked == [b"ab", b"", b"c", b"c", b"d", b"ab", b"d"]


def test_words_straight_to_the_model_have_the_ids_of_the_library():
    tokenizer = Tokenizer.from_file(WORDS)
    encoder = PieceEncoder(tokenizer)
    assert encoder.letters is not None
    words = ["a", "word", "reading" * 40, "ß", "ÿ", "àíé", "été", "straße", "Àb", "É", "a×b", "a÷b", "don't", "é", "ﬁn", "12", "ab1", "--", "日本"]
    words += [chr(c) for c in range(0xC0, 0x100)] + [a + b for a in "aàí" for b in "zñü"]
    want = [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]
    assert encoder([w.encode() for w in words]) == want
    encoder.letters = None  # as where the steps before the model change letters
    assert encoder([w.encode() for w in words]) == want
    assert encoder([]) == []
