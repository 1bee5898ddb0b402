"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from somnolake.llm.byte_bpe import encode_documents
from somnolake.llm.digest_index import DigestIndex, exact_duplicates
from somnolake.llm.language import languages
from somnolake.llm.line_runs import LINE_SQL, drop_repeated_runs
from somnolake.llm.mixing import TARGETS, label_domains, mixed
from somnolake.llm.near_dups import NearDupRules, near_duplicate_classes
from somnolake.llm.parsing import compare_with_next
from somnolake.llm.quality import quality_scores
from somnolake.llm.shipping import ship
from somnolake.llm.suffix_dedup import remove_repeats
from somnolake.llm.token_files import token_files
from somnolake.llm.variants import VariantRules, variant_groups
from somnolake.llm.word_runs import periodic_runs
from somnolake.llm.wrappers import extracted


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return ship(spark).read.parquet(f"{folder}/documents.parquet")


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(_documents(spark, folder), _labels(spark, folder))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return compare_with_next(_documents(spark, folder))


def op3_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_classes(_documents(spark, folder), NearDupRules(shingle=3, percent=85))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = drop_repeated_runs(_documents(spark, folder))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixed(_documents(spark, folder), label_domains(_labels(spark, folder)), TARGETS)
    shares = [F.col("p")[i].alias(f"p_{domain}") for i, domain in enumerate(sorted(TARGETS))]
    return found.select("doc_id", "tokens", *shares, "rate", "copies")


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(_documents(spark, folder), DigestIndex.fresh(spark))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(_documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(_documents(spark, folder))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return languages(_documents(spark, folder))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(_documents(spark, folder), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op11_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(ship(spark).read.parquet(f"{folder}/pages.parquet"))


def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variant_groups(_documents(spark, folder), VariantRules(slip=97))


def op13_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs(_documents(spark, folder), edit=True).drop("collapsed")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f for f in (
        op1_quality, op2_fingerprints, op3_near_dups, op4_line_dedup, op5_mixing, op6_exact_dedup, op7_token_files,
        op8_suffix_dedup, op9_language, op10_byte_bpe, op11_html_text, op12_variants, op13_word_runs, pipeline,
    )
}

ORACLES = {
    "op4_line_dedup": LINE_SQL,
    "op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
}
