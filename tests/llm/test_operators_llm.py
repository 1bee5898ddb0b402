"""Each operator against brute force, on a few texts with nulls, ties, repeats and odd characters."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from somnolake.llm import suffix_dedup
from somnolake.llm.byte_bpe import decode, encode_documents, read_ranks
from somnolake.llm.components import components
from somnolake.llm.digest_index import DigestIndex, deduplicated, exact_duplicates
from somnolake.llm.induced_sort import suffix_order
from somnolake.llm.language import SAMPLE_BYTES, CrossParser, byte_symbols, labelled_samples, languages
from somnolake.llm.line_runs import LineRules, drop_repeated_runs
from somnolake.llm.mixing import label_domains, mixed
from somnolake.llm.near_dups import NearDupRules, near_duplicate_classes
from somnolake.llm.parsing import compare_with_next, fingerprints, likeness
from somnolake.llm.quality import isotonic, keep_good, quality_scores
from somnolake.llm.shipping import ship
from somnolake.llm.suffix_dedup import RepeatRules, remove_repeats
from somnolake.llm.token_files import WaveletMatrix, token_documents, write_token_files

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PASSAGE = "the shared passage runs on for rather more than fifty bytes, as all of these do"
LONG = " ".join(f"word{i * i % 977}" for i in range(4000))
TEXTS = [
    (1, f"one begins here\n{PASSAGE}\nand\nends"), (2, f"two is otherwise\n{PASSAGE}\nand\nends so"), (3, ""), (4, None),
    (5, "it's we'll 'sa ''s 's\n\n x\t\ty   "), (6, "a  b\n c 123٣٤ ½ … don't ÉCOLE é 🎉"), (7, LONG), (8, LONG + " more"),
    (9, "same text"), (10, "same text"), (11, "aaaa" * 60), (12, "İ ß ẞ é. ÷×à 日本 ñ́"), (13, "   "), (13, "   "), (None, "no id"),
    (14, "one two"), (15, "one two three four five"), (16, f"x{PASSAGE[:49]}"), (17, f"y{PASSAGE[:49]}"), (18, f"y{PASSAGE[:50]}"),
]
COLUMNS = "doc_id long, text string, lang string, score double, kept boolean, part int, key string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i and i % 2 else None, 0.0, None, 1, "k") for i, t in TEXTS]
    return ship(spark).createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return ship(spark).createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def known(spark):
    """Good and poor documents of two languages, labelled."""
    rng = np.random.default_rng(3)
    stems = {"en": ["the", "house", "is", "over", "there"], "de": ["das", "haus", "ist", "dort", "drüben"]}
    rows, labels = [], []
    for i in range(400):
        lang = "en" if i % 2 else "de"
        words = rng.choice(stems[lang], 60)
        poor = i % 4 < 2
        rows.append((i, "!! ".join(words).upper() if poor else " ".join(words), lang))
        labels.append((i, 0 if poor else 1, 0 if i % 3 else 1))
    return (
        ship(spark).createDataFrame(rows, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_quality_separates_held_out_rows(known):
    documents, labels = known
    found = {r["doc_id"]: r for r in quality_scores(documents, labels).collect()}
    assert len(found) == 400
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert r["predicted"] == (0 if i % 4 < 2 else 1) and 0 <= r["score"] <= 1
    kept = keep_good(documents, labels)
    assert kept.columns == documents.columns and kept.count() == 200


def test_quality_of_odd_rows(docs, empty, known, spark):
    nothing = known[1].where("false")
    assert quality_scores(empty, known[1]).count() == 0
    assert {r["score"] for r in quality_scores(docs, nothing).collect()} == {0.5}
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 1, 0), (2, 1, 0), (7, 0, 0)], known[1].schema)
    assert quality_scores(docs, labels).count() == len(TEXTS)


def test_isotonic_pools_falling_neighbours():
    assert isotonic(np.array([0.0, 0.5, 0.2, 1.0]), np.array([1, 1, 2, 1])).tolist() == pytest.approx([0, 0.3, 0.3, 1])


def test_fingerprints_compare_with_next(docs, empty):
    found = [r for r in compare_with_next(docs).collect() if r["doc_id"] not in (None, 1, 13, 14)]
    text = {i: t or "" for i, t in TEXTS}
    ids = sorted((i for i in text if i is not None), reverse=True)
    for r in found:
        own, following = text[r["doc_id"]], text[ids[ids.index(r["doc_id"]) + 1]]
        half = len(own) // 2
        assert r["n_chars"] == len(own)
        assert r["edited_sha256"] == sha((own[:len(own) - half] + following[:half]).encode())
    prints = {r["doc_id"]: r["fingerprint"] for r in found}
    assert prints[9] == prints[10] and prints[3] == prints[4]
    assert compare_with_next(empty).count() == 0 and compare_with_next(docs).count() == len(TEXTS)


def test_fingerprints_find_text_at_any_offset():
    base = [LONG, "some other start " + LONG, " ".join(f"term{i * i * i % 971}" for i in range(4000)), LONG]
    prints = fingerprints(base)
    alike = [likeness(prints[:1], prints[i:i + 1])[0] for i in range(4)]
    assert alike[3] == 1 and alike[1] > 0.9 and alike[2] < 0.4


def components_by_brute_force(texts, size, percent):
    sets = {}
    for i, t in texts:
        words = (t or "").encode().lower().split()
        whole = [tuple(words)] if words else []
        sets[i] = set(whole) if len(words) < size else {tuple(words[k:k + size]) for k in range(len(words) - size + 1)}
    parent = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]) and parent[a] != parent[b]:
                    parent[a] = parent[b] = min(parent[a], parent[b])
                    changed = True
    return {i: (len(sets[i]), parent[i]) for i in sets}


def test_near_duplicates(docs, empty, spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(120)]
    near = [(i, t) for i, t in TEXTS if i is not None and i != 13]
    for i in range(60):
        own = list(words)
        for place in rng.integers(0, 120, i % 6):
            own[place] = f"other{rng.integers(1000)}"
        near.append((100 + i, " ".join(own)))
    frame = spark.createDataFrame(near, "doc_id long, text string")
    for size, percent, block in ((3, 85, 2000), (5, 80, 7)):
        wanted = components_by_brute_force(near, size, percent)
        found = near_duplicate_classes(frame, NearDupRules(shingle=size, percent=percent, block=block)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == wanted
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    assert near_duplicate_classes(docs).count() == len(TEXTS) and near_duplicate_classes(empty).count() == 0


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(70, 71), (None, 3), (9, 9)], "x long, y long")
    found = dict(map(tuple, components(chain, "x", "y").collect()))
    assert found == {i: 0 for i in range(51)} | {70: 70, 71: 70}


def lines_by_brute_force(texts, run, long=200):
    first, whole, out = {}, {}, {}
    for i, t in sorted(texts):
        lines = (t or "").split("\n")
        for k in range(len(lines)):
            whole.setdefault(lines[k], (i, k))
        for k in range(len(lines) - run + 1):
            first.setdefault(tuple(lines[k:k + run]), (i, k))
    for i, t in texts:
        lines = (t or "").split("\n")
        gone = {k + j for k in range(len(lines) - run + 1) if first[tuple(lines[k:k + run])] < (i, k) for j in range(run)}
        gone |= {k for k, x in enumerate(lines) if len(x.encode()) >= long and whole[x] < (i, k)}
        out[i] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


@pytest.mark.parametrize("rules", [LineRules(), LineRules(gram=1, window=3), LineRules(gram=2, window=4)])
def test_line_runs(rules, docs, empty, spark):
    rng = np.random.default_rng(1)
    texts = [(i, "\n".join(rng.choice(["a", "b", "", "cc"], rng.integers(0, 14)))) for i in range(60)] + [(90, None)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r[0]: tuple(r)[1:] for r in drop_repeated_runs(frame, rules).collect()}
    assert found == lines_by_brute_force(texts, rules.run)
    assert drop_repeated_runs(docs, rules).count() == len(TEXTS) and drop_repeated_runs(empty, rules).count() == 0


def test_long_lines_match_alone(spark):
    rng = np.random.default_rng(5)
    words = ["x" * 199, "x" * 200, "\u00e9" * 100, "\u00e9" * 99, "short", "", "y " * 400]
    texts = [(i, "\n".join(rng.choice(words, rng.integers(1, 5)))) for i in range(80)] + [(90, None), (91, words[1])]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    found = {r[0]: tuple(r)[1:] for r in drop_repeated_runs(frame).collect()}
    assert found == lines_by_brute_force(texts, 3) and found[91] == (1, 1, "")


def test_mixing_meets_its_targets(known):
    documents, labels = known
    domains = label_domains(labels.withColumn("toxic", labels.toxic * 0))
    found = mixed(documents, domains, {"good": 0.8, "poor": 0.2}).collect()
    total = sum(r["tokens"] for r in found)
    good = sum(r["tokens"] * r["p"][0] * r["rate"] for r in found)
    assert good / total == pytest.approx(0.8, abs=0.01)
    assert all(0 <= r["rate"] <= 4 and abs(r["copies"] - r["rate"]) < 1 for r in found)
    # the same by plain projected gradient steps
    p = np.array([r["p"] for r in found])
    tokens, rate = np.array([r["tokens"] for r in found]), np.ones(len(found))
    for _ in range(500):
        missing = (tokens * rate) @ p - total * np.array([0.8, 0.2])
        rate = np.clip(rate - p @ missing / total, 0, 4)
    assert (tokens * rate) @ p / total == pytest.approx([0.8, 0.2], abs=0.01)


def test_mixing_of_odd_rows(docs, empty, known):
    domains = label_domains(known[1])
    assert mixed(docs, domains.where("false"), {"good": 1.0, "poor": 1.0}).count() == len(TEXTS)
    assert mixed(empty, domains, {"good": 1.0}).count() == 0


def test_exact_duplicates(docs, empty, spark):
    found = {(r["doc_id"], r["text_sha256"]): r for r in exact_duplicates(docs, DigestIndex.fresh(spark)).collect()}
    for i, t in TEXTS:
        same = [j for j, u in TEXTS if (u or "") == (t or "")]
        r = found[i, sha((t or "").encode())]
        keep = max((j for j in same if j is not None), default=None)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(same), i == keep)
    kept = deduplicated(docs, DigestIndex.fresh(spark))
    assert kept.columns == docs.columns and kept.count() == len({t or "" for _, t in TEXTS})
    assert exact_duplicates(empty, DigestIndex.fresh(spark)).count() == 0


def test_digest_index_remembers(docs, spark):
    index = DigestIndex.fresh(spark, 4)
    first, second = docs.where("doc_id <= 9"), docs.where("doc_id > 8 or doc_id = 3")
    deduplicated(first, index)
    again = deduplicated(second, index)
    assert not {9, 10, 3} & {r["doc_id"] for r in again.collect()}
    assert index.rows(spark).count() == index.rows(spark).select("digest").distinct().count()


@pytest.mark.parametrize("loads", [1, 2, 5])
def test_loads_meet_what_those_before_left(docs, empty, spark, loads):
    index = DigestIndex.fresh(spark, 4)
    found = exact_duplicates(docs, index, loads)
    plain = {(i, sha((t or "").encode())) for i, t in TEXTS}
    assert {(r["doc_id"], r["text_sha256"]) for r in found.collect()} == plain
    for r in found.collect():
        same = [j for j, u in TEXTS if sha((u or "").encode()) == r["text_sha256"]]
        keep = max((j for j in same if j is not None), default=None)
        assert (r["keep_id"], r["group_size"]) == (keep, len(same))
    assert index.rows(spark).count() == len({t or "" for _, t in TEXTS})
    # all of it again: nothing is new, and the row that the index has stays
    more = docs.withColumn("doc_id", docs.doc_id + 1000)
    assert not [r for r in exact_duplicates(more, index, loads).collect() if r["keep_id"] is not None and r["keep_id"] > 1000]
    assert index.rows(spark).count() == len({t or "" for _, t in TEXTS})
    assert exact_duplicates(empty, DigestIndex.fresh(spark), loads).count() == 0


def test_later_loads_are_matched_by_a_sort_merge_anti_join(docs, spark):
    index = DigestIndex.fresh(spark, 4)
    exact_duplicates(docs, index)
    groups = docs.selectExpr("sha2(text, 256) AS digest").repartition(4, "digest")
    plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString()
    known = plan.split(index.table)[0].rsplit("+- ", 1)[-1]
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Exchange" not in known


def test_wavelet_matrix():
    ids = np.random.default_rng(2).integers(0, 50000, 3001)
    ids[::7] = 1
    matrix = WaveletMatrix.build(ids)
    assert matrix.decode().tolist() == ids.tolist()
    assert [matrix.access(i) for i in range(0, 3001, 100)] == ids[::100].tolist()
    assert matrix.count(1) == (ids == 1).sum() and matrix.count(1, 10, 99) == (ids[10:99] == 1).sum()
    assert matrix.occurrences(1) == np.flatnonzero(ids == 1).tolist()


def test_token_files(docs, empty, spark, tmp_path):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    write_token_files(docs, WORDS, f"file://{tmp_path}/tokens", shards=3)
    found = token_documents(spark, f"file://{tmp_path}/tokens").orderBy("start").collect()
    assert len(found) == len(TEXTS) and [r["doc_id"] for r in found][1:] == sorted(i for i, _ in TEXTS if i is not None)
    start = 0
    for r, (_, t) in zip(found, sorted(TEXTS, key=lambda x: x[0] or -1), strict=True):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    write_token_files(empty, WORDS, f"file://{tmp_path}/none", shards=3)
    assert token_documents(spark, f"file://{tmp_path}/none").count() == 0


def test_token_files_with_added_tokens(spark, tmp_path):
    tokenizer = Tokenizer.from_file(WORDS)
    texts = [
        "<|endoftext|>", "one<|endoftext|>two <|startoftext|> three", "<|EndOfText|> <|ENDOFTEXT|>", "<|endoftext|><|endoftext|>x",
        "<<|startoftext|>|> é<|endoftext|>́ it<|endoftext|>'s", "<|endof", "text|>", "<|endof text|> <|endoftext|", ">", " <|startoftext|>\n",
    ]
    frame = ship(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    write_token_files(frame, WORDS, f"file://{tmp_path}/tokens", shards=2)
    found = token_documents(spark, f"file://{tmp_path}/tokens").orderBy("start").collect()
    for r, t in zip(found, texts, strict=True):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4")
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


def repeats_by_brute_force(texts, size):
    first, out = {}, []
    for i, t in sorted((i, (t or "").encode()) for i, t in texts if i is not None):
        for k in range(len(t) - size + 1):
            first.setdefault(t[k:k + size], i)
    for i, t in texts:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, int)
        for k in range(len(data) - size + 1):
            if i is not None and first[data[k:k + size]] < i:
                gone[k] += 1
                gone[k + size] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), int(gone.sum()), spans, sha(kept)))
    return sorted(out, key=repr)


def test_repeats(docs, empty, spark):
    assert rows(remove_repeats(docs)) == repeats_by_brute_force(TEXTS, 50)
    rng = np.random.default_rng(4)
    texts = [(i, "".join(rng.choice(list("ab "), rng.integers(0, 400), p=[0.9, 0.05, 0.05]))) for i in range(40)]
    assert rows(remove_repeats(spark.createDataFrame(texts, "doc_id long, text string"))) == repeats_by_brute_force(texts, 50)
    assert remove_repeats(empty).count() == 0


def test_repeats_of_a_hot_anchor(spark, monkeypatch):
    """A short stretch amid differing text gives one distinct piece a document, all of one anchor."""
    rng = np.random.default_rng(8)

    def noise():
        return "".join(rng.choice(list("abcdefghij"), 60))

    texts = [(i, f"{noise()}-- a footer of 35 bytes, no more --{noise()}") for i in range(1200)]
    texts += [(i + 1200, f"{noise()}{texts[i][1][40:140]}{noise()}") for i in range(20)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rules, shards = RepeatRules(shard_bytes=1 << 14), {}
    dealt = suffix_dedup._owners

    def owners(rows, *others):
        for r in rows.collect():
            shards[r["shard"]] = shards.get(r["shard"], 0) + int(np.frombuffer(r["lengths"], np.uint16).sum())
        return dealt(rows, *others)

    monkeypatch.setattr(suffix_dedup, "_owners", owners)
    assert rows(remove_repeats(frame, rules)) == repeats_by_brute_force(texts, 50)
    assert 0 < max(shards.values()) < 2 * rules.shard_bytes


@pytest.mark.parametrize("budget", [4, 1 << 20])
def test_induced_sort(budget):
    rng = np.random.default_rng(6)
    for _ in range(60):
        strings = [bytes(rng.integers(1, 4, rng.integers(1, 40)).astype(np.uint8)) for _ in range(6)]
        text = b"".join(s + b"\0" for s in strings)
        positions, shared = suffix_order(np.frombuffer(text, np.uint8), budget)
        suffixes = [text[p:text.index(0, p)] for p in positions.tolist()]
        assert suffixes == sorted((s[i:] for s in strings for i in range(len(s))), reverse=True)
        for one, two, common in zip(suffixes, suffixes[1:], shared[1:].tolist(), strict=False):
            assert one[:common] == two[:common] and one[common:common + 1] != two[common:common + 1] or one == two


def test_languages(known, docs, empty):
    found = languages(known[0]).collect()
    truth = {r["doc_id"]: r["lang"] for r in known[0].collect()}
    assert all(r["lang_pred"] == truth[r["doc_id"]] for r in found if r["held_out"])
    assert {r["held_out"] for r in found} == {True, False}
    odd = {r["doc_id"]: r for r in languages(docs).collect()}
    assert all(odd[i]["lang_pred"] == "und" and odd[i]["score"] == 0 for i in (3, 4, 13))
    assert languages(empty).count() == 0 and len(languages(docs).collect()) == len(TEXTS)


def test_a_long_text_does_not_fill_a_language(spark):
    rows = [(0, "xx", "long " * 20000)] + [(i, "xx", f"row{i} " * 30) for i in range(1, 40)] + [(50, "yy", "few"), (51, None, "no")]
    found = labelled_samples(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    texts = dict((r[0], r[2]) for r in rows)
    assert set(found) == {"xx", "yy"} and found["yy"] == [b"few"] and len(found["xx"]) == 40
    assert max(map(len, found["xx"])) <= -(-SAMPLE_BYTES // 40)
    assert all(any(s.decode() in t for t in texts.values()) for s in found["xx"])


def longest_matches(text, sample, joined):
    """Phrases of a greedy parse into longest pieces that `sample` holds, by `in`."""
    at = count = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in joined:
            size += 1
        at += size
        count += 1
    return count


def test_phrases_are_those_of_a_search_for_longest_matches():
    rng = np.random.default_rng(8)
    sample = ["".join(rng.choice(list("abc "), 60)) for _ in range(3)]
    table = byte_symbols([s.encode() for s in sample])
    parser = CrossParser([s.encode() for s in sample], table)
    joined = "|".join(sample)
    for size in (1, 2, 7, 40):
        texts = ["".join(rng.choice(list("abc "), size)) for _ in range(30)]
        lanes = np.stack([table[np.frombuffer(t.encode(), np.uint8)].astype(np.int32) for t in texts], axis=1)
        assert parser.phrases(lanes).tolist() == [longest_matches(t, sample, joined) for t in texts]


def test_byte_bpe(docs, empty, spark):
    ranks = read_ranks(RANKS)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = []
    for i, t in TEXTS:
        ids = encoding.encode_ordinary(t or "")
        wanted.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    encoded = encode_documents(docs, RANKS, with_ids=True)
    assert rows(encoded.drop("ids")) == sorted(wanted, key=repr)
    assert rows(decode(spark, encoded, RANKS)) == sorted(((i, t or "") for i, t in TEXTS), key=repr)
    assert encode_documents(empty, RANKS).count() == 0
