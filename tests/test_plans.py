"""Physical plans: what must not appear, and what must."""

from __future__ import annotations

import itertools

import pytest

from somnolake.checks.queries import QUERIES


def plan(spark, name, folder) -> str:
    return QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def as_if_large(spark):
    """Plans as for tables too large to broadcast on their size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(name, spark, small, as_if_large):
    text = plan(spark, name, small)
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
                      "MapInPandas", "BatchEvalPython"):
        assert forbidden not in text


@pytest.mark.parametrize("name", [
    "mart_comorbidity_by_age", "mart_diabetes_risk_profile", "mart_bmi_sleep_disorder",
    "mart_occupation_risk", "dq_join_fanout",
])
def test_rollups_aggregate_before_they_shuffle(name, spark, small, as_if_large):
    """Exchanges by patient key carry sums per key, never raw rows."""
    lines = plan(spark, name, small).splitlines()
    by_key = [at for at, line in enumerate(lines) if "Exchange hashpartitioning(patient_key" in line]
    assert len(by_key) >= 2
    for at in by_key:
        # down to the next exchange or scan, whichever comes first
        below = itertools.takewhile(
            lambda line: "Exchange" not in line and "FileScan" not in line, lines[at + 1:]
        )
        assert any("HashAggregate" in line for line in below)


def test_only_needed_columns_are_read(spark, small):
    text = plan(spark, "agg_count", small)
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_filters_reach_the_scan(spark, small, tmp_path):
    path = str(tmp_path / "p")
    QUERIES["silver_diabetes_prediction"](spark, small).write.parquet(path)
    rows = spark.read.parquet(path).where("gender <> 'Unknown'").select("age")
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(gender), Not(EqualTo(gender,Unknown))]" in text


def test_ids_need_no_shuffle_of_the_rows(spark, small, as_if_large):
    text = plan(spark, "key_dense_id", small)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_means_are_read_in_one_scan(spark, small):
    text = plan(spark, "silver_hypertension_risk", small)
    # the rows themselves, and one aggregate for all five means
    assert text.count("FileScan parquet") == 2
