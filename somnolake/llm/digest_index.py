"""Exact dedup against a persistent digest index, a table bucketed and sorted by hash."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from somnolake.llm.columnar import join_groups, written


def text_digest(text):
    """sha256 (lowercase hex) of the text in UTF-8, as it is; a null text counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


@dataclass(frozen=True)
class DigestIndex:
    """One row per known text: (digest, keep_id, group_size), in `buckets` files a load, sorted by digest.

    The table is in the warehouse, so it outlives the session's executors; loads append to it.
    New data is matched by a sort-merge join in which the index needs no shuffle.
    """

    table: str
    buckets: int = 64

    @classmethod
    def fresh(cls, spark: SparkSession, buckets: int | None = None) -> DigestIndex:
        return cls(f"digest_index_{uuid.uuid4().hex}", buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.table)

    def rows(self, spark: SparkSession) -> DataFrame:
        if self.exists(spark):
            return spark.table(self.table)
        return spark.createDataFrame([], "digest string, keep_id long, group_size long")

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The groups whose digest isn't in the index: a sort-merge anti-join."""
        spark = groups.sparkSession
        if not self.exists(spark):
            return groups
        known = spark.table(self.table).select("digest").hint("merge")
        return groups.join(known, "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        (
            groups.select("digest", "keep_id", "group_size").write.format("parquet").mode("append")
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table)
        )


def digests(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest"))


def add_documents(documents: DataFrame, index: DigestIndex) -> DataFrame:
    """Append the texts that the index doesn't know; return them as (digest, keep_id, group_size).

    Of equal new texts the row with the largest doc_id stays; a text that is in the index already
    adds nothing.  Rows are counted per task before they move, so a text with very many copies
    costs one row a task.  A null id is smaller than any other.
    """
    return _add(digests(documents), index)


def _add(rows: DataFrame, index: DigestIndex) -> DataFrame:
    return _append_unseen(rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    ), index)


def _append_unseen(groups: DataFrame, index: DigestIndex) -> DataFrame:
    # dealt as the index is: neither the join nor the bucketed files need another shuffle
    fresh = written(index.unseen(groups.repartition(index.buckets, "digest")), "new-digests")
    index.append(fresh.repartition(index.buckets, "digest"))
    return fresh


def _loads(rows: DataFrame, count: int):
    """Number of the load of each row: ids in `count` stretches of about as many rows, larger ids first.

    Null ids, which are smaller than any other, come last.
    """
    if count == 1:
        return F.lit(0)
    shares = [i / count for i in range(1, count)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares).alias("cuts")).first()["cuts"] or []
    if not cuts:
        return F.lit(0)
    smaller = sum((F.coalesce(F.col("doc_id") <= cut, F.lit(True)).cast("int") for cut in sorted(set(cuts))), F.lit(0))
    return smaller


def exact_duplicates(documents: DataFrame, index: DigestIndex, loads: int = 2) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of `documents`.

    The rows come into the index in `loads` batches, larger ids first, each matched with what those
    before it left there.  keep_id is the row that the index has for the text: the largest doc_id,
    unless the index knew the text before.  group_size counts the equal rows of `documents`.  kept
    is true for that row only; rows that repeat its id and text are as one and are all marked kept
    (`deduplicated` leaves one of them).  Where all ids of a text are null, keep_id is null and its
    rows are kept.
    """
    rows = written(digests(documents), "digests")
    groups = written(
        rows.withColumn("load", _loads(rows, loads)).groupBy("digest", "load")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "digest-groups",
    )
    for load in range(loads):
        _append_unseen(groups.where(F.col("load") == load).drop("load"), index)
    sizes = groups.groupBy("digest").agg(F.sum("group_size").alias("group_size"))
    kept = index.rows(documents.sparkSession).select("digest", "keep_id")
    found = join_groups(rows, written(sizes.join(kept, "digest", "left"), "digest-kept"), "digest", "group_size")
    return found.select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicated(documents: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of `documents` that stay, all columns: one for each text that the index didn't know.

    Rows are matched by id and digest, so the copies of a text are spread over all tasks.
    """
    fresh = add_documents(documents, index).select(
        F.col("keep_id").alias("__keep_id"), F.col("digest").alias("__keep_digest")
    )
    named = documents.withColumn("__digest", text_digest(F.col("text"))).withColumn("__id", F.col("doc_id").cast("long"))
    same = (named["__digest"] == fresh["__keep_digest"]) & named["__id"].eqNullSafe(fresh["__keep_id"])
    return named.join(fresh, same, "left_semi").dropDuplicates(["__digest", "__id"]).drop("__digest", "__id")
