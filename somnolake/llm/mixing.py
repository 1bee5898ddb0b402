"""Mixing to target weights: domain posteriors, then document rates by projected gradient.

All of it is DataFrame functions; only per-domain numbers reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from somnolake.llm.columnar import written

STATISTICS = ("size", "word", "upper", "marks", "high", "fresh")


SAMPLE_ROWS = 2000  # labelled documents of a domain that its telling words are counted in
TELLING_WORDS = 40  # of a domain


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \n]"), lambda w: w != "")


def telling_words(documents: DataFrame, labelled: DataFrame, domains: list[str]) -> dict[str, list[float]]:
    """The words that tell the domains apart, each with its share of the documents of each domain.

    Counted in whole texts of at most SAMPLE_ROWS documents of each domain, taken in the order of
    a hash of their id; of a domain the TELLING_WORDS with the most weight of evidence are taken.
    """
    order = Window.partitionBy("domain").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = (
        labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).distinct()
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_ROWS).drop("place")
    )
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    texts = written(rows.select("domain", F.array_distinct(_words(F.col("text"))).alias("words")), "labelled-words")
    sizes = {r["domain"]: r["count"] for r in texts.groupBy("domain").count().collect()}
    total = sum(sizes.values())
    if not total:
        return {}
    counts = [F.sum((F.col("domain") == d).cast("long")).alias(f"n{i}") for i, d in enumerate(domains)]
    words = texts.select("domain", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), *counts)
    scored = []
    for i, d in enumerate(domains):
        own, all_own = F.col(f"n{i}"), sizes.get(d, 0)
        ratio = (own + 0.5) / (all_own + 1) / ((F.col("n") - own + 0.5) / (total - all_own + 1))
        score = F.struct((own * F.log(ratio)).alias("evidence"), "word")
        top = words.withColumn("score", score).orderBy(F.desc("score")).limit(TELLING_WORDS)
        scored.append(top.select("word", *[f"n{j}" for j in range(len(domains))]))
    found = reduce(DataFrame.union, scored).collect()  # TELLING_WORDS a domain
    return {
        r["word"]: [(r[f"n{i}"] + 0.5) / (sizes.get(d, 0) + 1) for i, d in enumerate(domains)]
        for r in sorted(found)
    }


def mixing_statistics(documents: DataFrame, words: list[str]) -> DataFrame:
    """(doc_id, tokens, told, STATISTICS) of every whole text, told being those of `words` it has.

    A null text counts as empty, with no tokens.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.length(text).cast("double").alias("n"), _words(text).alias("words"),
    )
    n, tokens = F.greatest(F.col("n"), F.lit(1.0)), F.size("words").cast("double")
    some = F.greatest(tokens, F.lit(1.0))
    telling = F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")
    return rows.select(
        "doc_id", F.size("words").cast("long").alias("tokens"), F.array_intersect("words", telling).alias("told"), F.log1p("n").alias("size"), (F.col("n") / some).alias("word"),
        (F.regexp_count("text", F.lit("[A-Z]")) / n).alias("upper"),
        (F.regexp_count("text", F.lit("[!#$%&*]")) / n).alias("marks"),
        ((F.octet_length("text") - F.col("n")) / n).alias("high"),
        (F.size(F.array_distinct("words")) / F.sqrt(some)).alias("fresh"),
    )


def _exact_sum(value: Column) -> Column:
    """A sum that doesn't depend on the order of rows or on retries."""
    return F.sum(value.cast("decimal(38,9)"))


def domain_posteriors(
    stats: DataFrame, labelled: DataFrame, domains: list[str], words: Mapping[str, list[float]],
) -> DataFrame:
    """(doc_id, tokens, p) with p the probability of each domain, in the order of `domains`.

    A naive Bayes classifier, learned from `labelled` (doc_id, domain): Gaussian over STATISTICS,
    and for each telling word whether the text has it.
    A domain without labelled documents gets 0; without any, all are equally likely.
    """
    moments = {
        r["domain"]: r for r in stats.join(labelled.where("doc_id is not null").distinct(), "doc_id")
        .where(F.col("domain").isin(domains)).groupBy("domain").agg(
            F.count("*").alias("n"), *[f(c).alias(f"{m}_{c}") for c in STATISTICS for m, f in (("m", F.avg), ("v", F.var_pop))]
        ).collect()  # one row a domain
    }
    total = sum(r["n"] for r in moments.values())
    logs = []
    for i, domain in enumerate(domains):
        if domain not in moments:
            logs.append(F.lit(0.0 if not total else -1e9))
            continue
        row = moments[domain]
        value = F.lit(math.log(row["n"] / total))
        for c in STATISTICS:
            mean, spread = round(row[f"m_{c}"], 9), round(row[f"v_{c}"] + 1e-4, 9)
            value = value - (F.col(c) - mean) * (F.col(c) - mean) / (2 * spread) - 0.5 * math.log(spread)
        if words:
            odds = {w: math.log(shares[i] / (1 - shares[i])) for w, shares in words.items()}
            lookup = F.create_map(*[F.lit(x) for pair in odds.items() for x in pair])
            value = value + sum(math.log(1 - shares[i]) for shares in words.values())
            value = value + F.aggregate(F.transform("told", partial(F.try_element_at, lookup)), F.lit(0.0), lambda a, b: a + b)
        logs.append(value)
    top = F.array_max("logs")
    return (
        stats.select("doc_id", "tokens", F.array(*logs).alias("logs"))
        .select("doc_id", "tokens", F.transform("logs", lambda x: F.exp(x - top)).alias("e"))
        .select("doc_id", "tokens", F.transform(
            "e", lambda x: F.round(x / F.aggregate("e", F.lit(0.0), lambda a, b: a + b), 9)
        ).alias("p"))
    )


def _largest_eigenvalue(matrix: list[list[float]]) -> float:
    """Power iteration; the matrix is small and has no negative cell."""
    vector, value = [1.0] * len(matrix), 0.0
    for _ in range(200):
        image = [sum(a * b for a, b in zip(row, vector, strict=True)) for row in matrix]
        value = max(map(abs, image)) or 1.0
        vector = [x / value for x in image]
    return value


def fit_rates(
    posteriors: DataFrame, targets: list[float], budget: float = 1.0, most: float = 4.0, rounds: int = 60,
    block: int = 12, tolerance: float = 1e-4,
) -> DataFrame:
    """`posteriors` with a `rate` in [0, most] for every document.

    The expected tokens of each domain, the sum of tokens * p * rate, shall equal its share
    `targets` of `budget` times all tokens.  Projected gradient steps on the weighted squares of
    what is missing start from rate 1; a step needs one sum per domain, and a document's rate
    follows from its posteriors and the sums so far.  Every `block` steps the rates are written.
    Documents without tokens keep rate 1.
    """
    k = len(targets)
    p = [F.col("p")[i] for i in range(k)]
    state = posteriors.withColumn("rate", F.lit(1.0))
    first = state.agg(
        F.sum("tokens").alias("all"), *[_exact_sum(F.col("tokens") * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(k) for j in range(k)]
    ).first()
    total = float(first["all"] or 0)
    if not total:
        return state
    shares = sum(targets)
    wanted = [budget * total * t / shares for t in targets]
    matrix = [[float(first[f"m{i}_{j}"]) for j in range(k)] for i in range(k)]
    # domains count relative to their size; one with next to nothing can't be had, and is let be
    weight = [1 / (matrix[i][i] + 1e-3 * total) for i in range(k)]
    scaled = [[matrix[i][j] * math.sqrt(weight[i] * weight[j]) for j in range(k)] for i in range(k)]
    step = 1 / _largest_eigenvalue(scaled)
    for done in range(1, rounds + 1):
        found = state.agg(*[_exact_sum(F.col("tokens") * p[i] * F.col("rate")).alias(f"s{i}") for i in range(k)]).first()
        missing = [float(found[f"s{i}"]) - wanted[i] for i in range(k)]
        if max(map(abs, missing)) < tolerance * total:
            break
        slope = sum((p[i] * (step * weight[i] * missing[i]) for i in range(k)), F.lit(0.0))
        moved = F.least(F.greatest(F.col("rate") - slope, F.lit(0.0)), F.lit(float(most)))
        state = state.withColumn("rate", F.when(F.col("tokens") > 0, moved).otherwise(F.col("rate")))
        if done % block == 0:
            state = written(state, "rates")
    return state


def mixed(
    documents: DataFrame, labelled: DataFrame, targets: Mapping[str, float], budget: float = 1.0, most: float = 4.0,
) -> DataFrame:
    """(doc_id, tokens, p, rate, copies) of every row: how often it shall stand in the mixture.

    copies is the rate rounded down or up, up as often as its fraction says, by a hash of the id,
    so that the expected tokens are those of the rates and a rerun decides alike.  Repeated rows
    decide alike.  `labelled` is (doc_id, domain); other domains than those of `targets`, and
    nulls, are left out.
    """
    domains = sorted(targets)
    words = telling_words(documents, labelled, domains)
    stats = written(mixing_statistics(documents, list(words)), "mixing-statistics")
    posteriors = written(domain_posteriors(stats, labelled, domains, words), "posteriors")
    rated = fit_rates(posteriors, [targets[d] for d in domains], budget, most)
    chance = F.pmod(F.xxhash64(F.lit("mix"), F.coalesce("doc_id", F.lit(-1))), F.lit(1 << 30)) / float(1 << 30)
    return rated.select(
        "doc_id", "tokens", "p", "rate", F.floor(F.col("rate") + chance).cast("int").alias("copies")
    )


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from a table of marks: toxic, else poor or good by its quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain")).where("domain is not null")


# Token shares of the training mixture.
TARGETS = {"good": 0.98, "poor": 0.015, "toxic": 0.005}
