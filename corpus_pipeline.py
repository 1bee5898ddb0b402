"""A training corpus from raw documents: STAGES in order, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from somnolake.llm.byte_bpe import encode_documents
from somnolake.llm.columnar import written
from somnolake.llm.digest_index import DigestIndex, deduplicated
from somnolake.llm.mixing import TARGETS, label_domains, mixed
from somnolake.llm.near_dups import near_duplicate_classes
from somnolake.llm.quality import keep_good
from somnolake.llm.shipping import ship

# No single statement gives these rows: the classifier, the mixture and the merges aren't SQL.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality is 0.3 or more."""
    ship(spark)
    return keep_good(docs, _labels(spark, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest doc_id."""
    return deduplicated(docs, DigestIndex.fresh(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    ship(spark)
    gone = near_duplicate_classes(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture wants them: none, once or more."""
    rates = mixed(docs, label_domains(_labels(spark, sf_dir)), TARGETS)
    copies = rates.groupBy(F.col("doc_id").alias("__id")).agg(F.max("copies").alias("__copies"))
    joined = docs.join(copies, F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))).where("__copies > 0")
    repeated = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return repeated.select(*[repeated[f"`{c}`"] for c in docs.columns])


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes decoded from them."""
    ship(spark)
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each keeps is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
