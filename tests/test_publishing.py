"""What stands between a load and its readers: gates, versions, stored views."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from somnolake import schemas
from somnolake.checks.queries import write_extracts
from somnolake.config import WarehouseConfig
from somnolake.operators.quality import Gate, Refused, range_split
from somnolake.plans import gold, jobs, silver, views
from somnolake.plans.runlog import LoadStopped
from somnolake.sources import tables


@pytest.fixture(scope="module")
def loaded(spark, small, tmp_path_factory):
    extracts = tmp_path_factory.mktemp("extracts")
    write_extracts(spark, small, str(extracts))
    config = WarehouseConfig(
        str(extracts), str(tmp_path_factory.mktemp("lake")), prefix="p_", keep_versions=2,
        ranges={"diabetes_prediction": {"age": (18, 60), "bmi": (10, 40)}},
    )
    assert jobs.run_all(spark, config)
    return config


def test_views_are_read_from_a_second_session(spark, loaded):
    other = spark.newSession()
    stored = jobs.silver_tables(spark, loaded)
    lifestyle, apnea = stored["sleep_health_lifestyle"], stored["sleep_apnea_core"]
    wanted = {
        "vw_risk_factor_correlation": views.risk_factor_correlation(
            stored["diabetes_sleep_link"], apnea, stored["sleep_disordered_breathing"]
        ),
        "vw_occupational_health_metrics": views.occupational_health(lifestyle, apnea),
        "vw_sleep_disorder_analysis": views.sleep_disorder_analysis(lifestyle),
    }
    for name, rows in wanted.items():
        found = other.table(loaded.table("gold", name))
        assert set(rows.columns) <= set(found.columns)
        values = [tuple(r) for r in found.select(*rows.columns).collect()]
        assert sorted(map(repr, values)) == sorted(map(repr, map(tuple, rows.collect()))), name


def test_rejected_and_accepted_rows_come_from_one_cleansing(spark, loaded):
    name = "diabetes_prediction"
    raw = spark.table(loaded.table("bronze", silver.SOURCES[name]))
    accepted, rejected = range_split(silver.LOADS[name](raw.withColumn("record_id", F.lit(1))), loaded.ranges[name])
    assert spark.table(loaded.table("silver", name)).count() == accepted.count() > 0
    assert spark.table(loaded.table("silver", f"{name}_rejected")).count() == rejected.count() > 0


def test_the_gold_job_refuses_an_orphaned_band(spark, loaded, monkeypatch):
    table = loaded.table("gold", "fact_patient_health_snapshot")
    before = spark.table(table).count()
    build = gold.fact_patient_health_snapshot
    monkeypatch.setattr(gold, "fact_patient_health_snapshot", lambda *args: build(*args).withColumn(
        "age_band_id", F.lit(99).cast(schemas.GOLD["fact_patient_health_snapshot"]["age_band_id"].dataType)
    ))
    with pytest.raises(LoadStopped) as stopped:
        jobs.run_gold(spark, loaded)
    assert isinstance(stopped.value.__cause__, Refused) and "age_band_id without parent" in str(stopped.value.__cause__)
    assert spark.table(table).count() == before and spark.table(table).where("age_band_id = 99").isEmpty()


def test_gate_counts_each_rule_without_another_scan(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5.0, 7), (None, 50.0, 8), (3, None, None)], "a int, b double, c int")
    gate = Gate(not_null=["a"], ranges={"b": (0, 10)}, references={"c": [7]})
    watched, seen = gate.watch(rows)
    watched.write.parquet(f"{tmp_path}/rows")
    assert seen.get == {"a missing": 1, "b out of range": 1, "c without parent": 1}
    with pytest.raises(Refused):
        gate.check("t", seen)
    watched, seen = gate.watch(rows.where("a = 1"))
    watched.write.parquet(f"{tmp_path}/good")
    gate.check("t", seen)
    watched, seen = gate.watch(rows.where("a > 5"))
    watched.write.parquet(f"{tmp_path}/none")
    gate.check("t", seen)
    assert Gate().watch(rows) == (rows, None)


def test_versions_expire(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS p_versions")
    folder = f"file://{tmp_path}/t"
    for n in range(4):
        tables.full_refresh(spark, spark.range(n + 1), "p_versions.t", folder, keep=2)
        assert len(tables.versions(spark, folder)) == min(n + 1, 2)
    assert spark.table("p_versions.t").count() == 4
    current = spark.sql("DESCRIBE FORMATTED p_versions.t").where("col_name = 'Location'").first()["data_type"]
    assert len(tables.expire_versions(spark, folder, current, 1)) == 1
    assert tables.versions(spark, folder) == [current.rsplit("/", 1)[-1]]
    assert spark.table("p_versions.t").count() == 4
    with pytest.raises(ValueError):
        tables.expire_versions(spark, folder, f"{folder}/v-other", 1)
    with pytest.raises(ValueError):
        tables.expire_versions(spark, folder, current, 0)


def test_loads_leave_at_most_the_versions_that_are_kept(spark, loaded):
    jobs.run_bronze(spark, loaded)
    jobs.run_bronze(spark, loaded)
    for name in schemas.BRONZE:
        assert len(tables.versions(spark, f"{loaded.root}/{loaded.database('bronze')}/{name}")) == 2
        assert spark.table(loaded.table("bronze", name)).count() > 0
