"""Registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
import pytest
from compare import connect, difference
from llm.test_operators_llm import components_by_brute_force

from somnolake.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark, small):
    with connect(small) as duck:
        assert difference(QUERIES[name](spark, small), duck, ORACLES[name]) is None


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    good = {r["doc_id"] for r in spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, small).write.parquet(f"file://{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"file://{tmp_path}/{name}")
        assert docs.columns == before.columns
        assert docs.join(before, before.columns, "left_anti").count() == 0
        seen[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
    all_ids = {r["doc_id"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert good & all_ids <= {i for i, _ in seen["quality"]}
    exact = {}
    for i, t in seen["quality"]:
        exact[t] = max(i, exact.get(t, -1))
    assert sorted(seen["exact_dedup"]) == sorted((i, t) for t, i in exact.items())
    out = {r["doc_id"]: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()}
    assert all(out[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() for i, t in seen["mixing"])


def test_what_near_dedup_keeps_and_mixing_repeats(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    stages["near_dedup"](spark, docs, small).write.parquet(f"file://{tmp_path}/near")
    near = spark.read.parquet(f"file://{tmp_path}/near")
    wanted = components_by_brute_force(given, 5, 80)
    kept = sorted(r["doc_id"] for r in near.collect())
    assert kept == sorted(i for i, (_, component) in wanted.items() if i == component)
    assert len(kept) < len(given)
    labels = corpus_pipeline.label_domains(spark.read.parquet(f"{small}/labels.parquet"))
    copies = {r["doc_id"]: r["copies"] for r in corpus_pipeline.mixed(near, labels, corpus_pipeline.TARGETS).collect()}
    out = Counter(r["doc_id"] for r in stages["mixing"](spark, near, small).collect())
    assert sorted(copies) == kept and out == Counter({i: n for i, n in copies.items() if n})
