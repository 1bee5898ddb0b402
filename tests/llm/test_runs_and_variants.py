"""Periodic runs and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from somnolake.llm.queries import QUERIES
from somnolake.llm.shipping import ship
from somnolake.llm.variants import VariantRules, _checksums, near_words, variant_groups, word_counts
from somnolake.llm.word_runs import RunRules, edited, maximal_runs, periodic_runs

COLUMNS = "doc_id long, text string, n long, word string, start int, kept boolean"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def frame(spark, pairs):
    return ship(spark).createDataFrame([(i, t, 0, "w", 0, None) for i, t in pairs], COLUMNS)


def runs_by_definition(words, least=12):
    """Every stretch that has its smallest period and can't be extended."""
    found, n = {}, len(words)
    for period in range(1, n // 2 + 1):
        at = 0
        while at + period < n:
            if words[at] != words[at + period]:
                at += 1
                continue
            end = at
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if length >= max(least, 2 * period):
                found.setdefault((at, length), period)
            at = end
    return sorted((s, n, p) for (s, n), p in found.items())


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


RNG = np.random.default_rng(5)
STRINGS = [
    [0] * 40, [0, 1] * 30, fibonacci(200), [0, 1, 0, 1, 0, 1, 1] * 6, [1] + [0, 1] * 9 + [1, 0] * 9,
    list(range(50)), [0], [0, 0], list(RNG.integers(0, 2, 300)), list(RNG.integers(0, 3, 300)),
    list(range(20)) * 3 + list(range(19)) * 2, ([0] * 13 + [1]) * 7 + [2] + [0] * 15,
]


@pytest.mark.parametrize("symbols", STRINGS + [
    np.concatenate([np.tile(RNG.integers(0, 2, p), k) for p, k in zip(RNG.integers(1, 9, 12), RNG.integers(1, 5, 12))]).tolist()
    for _ in range(20)
])
@pytest.mark.parametrize("least", [2, 12])
def test_runs_are_those_of_the_definition(symbols, least):
    found = maximal_runs(np.array(symbols, np.int64), RunRules(least=least))
    # by start, then period
    assert list(zip(*(x.tolist() for x in found))) == sorted(runs_by_definition(symbols, least), key=lambda r: (r[0], r[2]))


def described(text, doc_id, edit):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if edit and doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(runs_by_definition(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(((-n, s, p) for s, n, p in runs), default=None)
    told = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return doc_id, len(runs), *told, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()), sha(kept.encode()), kept


TEXTS = [
    (1, "a b " * 20), (2, None), (3, ""), (4, "  \t\n "), (5, "one"), (5, "one"), (None, "x y z " * 9), (10, "é è ü " * 30),
    *((i, " ".join(f"w{x}" for x in RNG.integers(0, 4, 80))) for i in range(100, 160)),
    (7, " ".join(f"word{i * i % 977}" for i in range(6000)) + " again" * 500), (8, "same " * 5000),
]


@pytest.mark.parametrize("edit", [False, True])
def test_periodic_runs(spark, edit):
    found = sorted((tuple(r) for r in periodic_runs(frame(spark, TEXTS).repartition(3), edit=edit).collect()), key=repr)
    long = [t for t in TEXTS if len(t[1] or "") > 20_000]
    want = sorted((described(t, i, edit) for i, t in TEXTS if (i, t) not in long), key=repr)
    assert [r for r in found if r[0] not in (7, 8)] == want
    assert {r[0]: r[1:5] for r in found if r[0] in (7, 8)}[8] == (1, 0, 5000, 1)


def test_no_documents_no_runs(spark):
    assert periodic_runs(frame(spark, [])).count() == 0


def test_edit_repeats_a_stretch():
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    words = [b"%d" % i for i in range(50)]
    assert ids and all(len(edited(words, i)) == 50 for i in ids)
    assert edited(words, None) == words and edited([], ids[0]) == []


# --- spelling variants --------------------------------------------------------------------


def edits(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1:]
            yield from (word[:i] + c + word[i + 1:] for c in letters if c != word[i])


def variants_by_hand(pairs, rules):
    counts = Counter()
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if rules.slip and h % rules.slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= rules.least_length
    n = {w: c for w, c in counts.items() if c >= rules.least_count}
    letters = {c for w in n for c in w}
    form, near = {}, {}
    for w in n:
        around = {v for v in edits(w, letters) if v in n and v != w}
        near[w] = len(around)
        best = min(around, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= rules.ratio * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], near[w], n.get(form[w])) for w in n), key=repr)


def noisy(seed, words, letters):
    """Texts in which words of few letters stand with typing slips."""
    rng = np.random.default_rng(seed)
    own = ["".join(rng.choice(list(letters), rng.integers(4, 12))) for _ in range(words)]
    out = []
    for i in range(40):
        text = []
        for w in rng.choice(own, 200, p=(lambda x: x / x.sum())(1 / np.arange(1, words + 1))):
            at = int(rng.integers(0, len(w)))
            c = str(rng.choice(list(letters)))
            text.append([w, w, w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]][rng.integers(0, 5)])
        out.append((i, ", ".join(text)))
    return out


ODD = [
    (1, None), (2, ""), (None, "Ähnlich ähnlich ähnlIch"), (3, "École école ÉCOLE écoles écoles écoles"), (3, "École école"),
    (4, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaaaa aaaaaaa aaaaaaa"), (5, "Ābcdef×÷ bcdefgh 3bcdefgh4 bcdefgh"),
    (6, "x" * 3000 + " " + "x" * 3000 + " " + "x" * 2999 + "y " + "x" * 3000 + " " + ("x" * 2999 + "y ") * 3), (7, "short tiny"),
]


@pytest.mark.parametrize("rules", [VariantRules(), VariantRules(slip=97), VariantRules(slip=3, block=8), VariantRules(least_count=1, block=5)])
def test_variants_are_those_by_hand(spark, rules):
    pairs = ODD + noisy(1, 60, "abc") + noisy(2, 300, "etaonirsé")
    found = variant_groups(frame(spark, pairs).repartition(4), rules)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect()), key=repr) == variants_by_hand(pairs, rules)


def test_variants_of_nothing(spark):
    assert variant_groups(frame(spark, [])).count() == 0
    assert variant_groups(frame(spark, [(1, None), (2, "")])).count() == 0


def test_near_words_in_blocks_equal_one_block(spark):
    """A group of many words is compared block against block with the same result."""
    rows = [(f"prefix{a}{b}{c}suffix", i + 1) for i, (a, b, c) in enumerate(
        (a, b, c) for a in "abcdefgh" for b in "abcdefgh" for c in "abcd")]
    words = ship(spark).createDataFrame(rows, "word string, n long")
    one, many = (sorted(map(tuple, near_words(words, VariantRules(block=b)).collect())) for b in (4096, 16))
    assert one == many and len(one) == 256 and {r[1] for r in one} == {7 + 7 + 3}


def test_checksums_continue():
    data = np.frombuffer(b"abcdefgh" * 40, np.uint8)
    begin, length = np.array([0, 3, 10, 5]), np.array([4, 0, 200, 64])
    before = np.array([zlib.crc32(b"%d:" % i) for i in range(4)], np.uint32)
    found = _checksums(data, begin, length, before)
    assert found.tolist() == [zlib.crc32(b"%d:" % i + data[b:b + n].tobytes()) for i, (b, n) in enumerate(zip(begin, length))]


def test_queries_on_a_whole_table(spark, small):
    import duckdb

    texts = duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall()
    found = sorted((tuple(r) for r in QUERIES["op12_variants"](spark, small).collect()), key=repr)
    assert found == variants_by_hand(texts, VariantRules(slip=97))
    short = {i: t for i, t in texts if len(t or "") < 4000}
    for r in QUERIES["op13_word_runs"](spark, small).collect():
        if r["doc_id"] in short:
            assert tuple(r) == described(short[r["doc_id"]], r["doc_id"], True)[:-1]


def test_word_counts(spark):
    found = word_counts(frame(spark, [(1, "Alpha alpha ALPHA beta"), (2, "alpha")]), VariantRules(least_count=2))
    assert [tuple(r) for r in found.collect()] == [("alpha", 4)]
