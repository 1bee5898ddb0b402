"""The load jobs end to end, over raw CSV extracts written from the small test tables.

Most clinical extracts are not at hand; projections of the test tables stand in for them.
"""

from __future__ import annotations

import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from somnolake import schemas
from somnolake.checks.adapters import ADAPTERS
from somnolake.checks.queries import write_extracts
from somnolake.config import WarehouseConfig, shared_folder
from somnolake.operators.joins import Skew
from somnolake.operators.quality import key_report, orphans
from somnolake.plans import gold, jobs, silver
from somnolake.plans.runlog import LoadStopped
from somnolake.sources import tables
from somnolake.sources.csv import read_csv

@pytest.fixture(scope="module")
def extracts(spark, small, tmp_path_factory):
    target = tmp_path_factory.mktemp("extracts")
    write_extracts(spark, small, str(target))
    return target


@pytest.fixture(scope="module")
def loaded(spark, extracts, tmp_path_factory):
    config = WarehouseConfig(str(extracts), str(tmp_path_factory.mktemp("lake")), prefix="t_")
    assert jobs.run_all(spark, config)
    return config


def count(spark, config, layer, name):
    return spark.table(config.table(layer, name)).count()


def test_all_32_tables_are_loaded(spark, loaded):
    for layer, declared in (
        ("bronze", schemas.BRONZE), ("silver", schemas.SILVER), ("gold", schemas.GOLD)
    ):
        for name, schema in declared.items():
            table = spark.table(loaded.table(layer, name))
            assert table.count() > 0, name
            extra = {"bronze": [], "silver": ["record_id", tables.STAMP], "gold": [tables.STAMP]}
            assert set(table.columns) == set(schema.names) | set(extra[layer])


def test_cleansed_tables_keep_every_row_and_number_them(spark, loaded):
    for name, source in silver.SOURCES.items():
        rows = count(spark, loaded, "bronze", source)
        ids = spark.table(loaded.table("silver", name)).agg(
            F.count("record_id"), F.min("record_id"), F.max("record_id"),
            F.countDistinct("record_id"),
        ).first()
        assert tuple(ids) == (rows, 1, rows, rows)


def test_stored_tables_equal_the_functions(spark, loaded, small):
    for name, adapter in (("diabetes_sleep_link", "b_link"), ("hypertension_risk", "b_hyp"),
                          ("diabetes_prediction", "b_prediction")):
        raw = ADAPTERS[adapter].rows(spark, small)
        if "smoking_history" in raw.columns:
            # an empty CSV field is read as NULL
            raw = raw.withColumn("smoking_history", F.nullif("smoking_history", F.lit("")))
        direct = silver.LOADS[name](raw).drop("record_id")
        stored = spark.table(loaded.table("silver", name)).select(*direct.columns)
        assert direct.exceptAll(stored).isEmpty() and stored.exceptAll(direct).isEmpty()


def test_fact_has_at_least_the_link_rows(spark, loaded):
    link = count(spark, loaded, "silver", "diabetes_sleep_link")
    assert count(spark, loaded, "gold", "fact_patient_health_snapshot") >= link


def test_comorbidity_mart_equals_grouping_the_stored_fact(spark, loaded):
    fact = spark.table(loaded.table("gold", "fact_patient_health_snapshot"))
    plain = fact.groupBy("age_band").agg(
        F.count(F.lit(1)).alias("total_patients"), F.sum("diabetes_flag").alias("diabetes_count"),
        F.sum("snoring_flag").alias("snoring_count"),
        F.round(F.avg("ahi_score"), 2).cast("decimal(6,2)").alias("avg_ahi_score"),
        F.round(F.avg("neck_circumference"), 2).cast("decimal(6,2)").alias(
            "avg_neck_circumference"),
    )
    mart = spark.table(loaded.table("gold", "mart_comorbidity_by_age")).select(*plain.columns)
    assert Counter(map(tuple, mart.collect())) == Counter(map(tuple, plain.collect()))


def test_keys_hold_in_the_loaded_tables(spark, loaded):
    for name, key in schemas.PRIMARY_KEYS.items():
        report = key_report(spark.table(loaded.table("gold", name)), key).first()
        assert (report["duplicate_keys"], report["null_keys"]) == (0, 0), name
    for child, column, parent, key in schemas.FOREIGN_KEYS:
        lost = orphans(
            spark.table(loaded.table("gold", child)), column,
            spark.table(loaded.table("gold", parent)), key,
        )
        assert lost.isEmpty()


def test_one_load_time_per_run(spark, loaded):
    for name in schemas.GOLD:
        stamps = spark.table(loaded.table("gold", name)).select(tables.STAMP).distinct()
        assert stamps.count() == 1


def test_run_log(spark, loaded):
    log = spark.read.parquet(f"{loaded.root}/run_log")
    assert log.where("status <> 'ok'").isEmpty()
    per_layer = {r["layer"]: r["count"] for r in log.groupBy("layer").count().collect()}
    assert per_layer == {"bronze": 11, "silver": 11, "gold": 13}
    for row in log.where("step <> '(total)'").collect():
        assert row["rows"] == count(spark, loaded, row["layer"], row["step"])
        assert row["seconds"] >= 0


def test_views(spark, loaded):
    assert spark.table("vw_risk_factor_correlation").count() == 21
    occupations = spark.table(loaded.table("gold", "mart_occupation_risk")).count()
    assert spark.table("vw_occupational_health_metrics").count() == occupations
    assert spark.table("vw_sleep_disorder_analysis").count() >= occupations


def test_reloading_gives_the_same_rows(spark, loaded):
    def content(name):
        rows = spark.table(loaded.table("silver", name)).drop(tables.STAMP)
        return Counter(map(tuple, rows.collect()))

    before = content("sleep_apnea_core"), content("diabetes_aggregate_2016")
    assert jobs.run_silver(spark, loaded)
    assert before == (content("sleep_apnea_core"), content("diabetes_aggregate_2016"))


def broken(extracts, tmp_path):
    """The extracts without the sixth of them."""
    target = tmp_path / "broken"
    shutil.copytree(extracts, target, ignore=shutil.ignore_patterns("diabetes_all_2016.csv"))
    return target


def test_a_failed_step_raises_and_keeps_the_steps_before(spark, extracts, tmp_path):
    config = WarehouseConfig(str(broken(extracts, tmp_path)), str(tmp_path / "lake"), prefix="f_")
    with pytest.raises(LoadStopped, match="diabetes_all_2016"):
        jobs.run_bronze(spark, config)
    assert count(spark, config, "bronze", "sleep_apnea_dataset") > 0
    assert not spark.catalog.tableExists(config.table("bronze", "sleep_health_lifestyle"))


def test_stop_quiet_logs_and_skips_the_rest(spark, extracts, tmp_path):
    config = WarehouseConfig(
        str(broken(extracts, tmp_path)), str(tmp_path / "lake"), prefix="q_", on_error="stop_quiet"
    )
    assert not jobs.run_all(spark, config)
    log = spark.read.parquet(f"{config.root}/run_log").where("step <> '(total)'")
    status = {r["step"]: r["status"] for r in log.collect()}
    assert status["diabetes_all_2016"] == "failed"
    assert "sleep_health_lifestyle" not in status and status["diabetes_data"] == "ok"
    failed = log.where("status = 'failed'").first()
    assert failed["error_class"] == "PATH_NOT_FOUND" and failed["sql_state"] == "42K03"


def test_notes_with_line_breaks_pass_the_raw_load(spark, extracts, tmp_path):
    target = tmp_path / "extracts"
    shutil.copytree(extracts, target, ignore=shutil.ignore_patterns("enhanced_sleep_sdb.csv"))
    schema = schemas.BRONZE["enhanced_sleep_sdb"]
    row = ",".join('"two\nlines"' if f.name == "physician_notes" else "" for f in schema)
    (target / "enhanced_sleep_sdb.csv").write_text(",".join(schema.names) + "\n" + row + "\n")
    config = WarehouseConfig(str(target), str(tmp_path / "lake"), prefix="n_")
    assert jobs.run_bronze(spark, config)
    stored = spark.table(config.table("bronze", "enhanced_sleep_sdb")).collect()
    assert [r["physician_notes"] for r in stored] == ["two\nlines"]


def test_cleansing_options(spark, loaded, extracts, tmp_path):
    rules = {"heart_rate": (60, 70)}
    config = WarehouseConfig(
        str(extracts), str(tmp_path / "lake"), prefix="c_", imputed_flags=True,
        drop_repeats=("sleep_health_lifestyle",), ranges={"sleep_health_lifestyle": rules},
    )
    assert jobs.run_bronze(spark, config) and jobs.run_silver(spark, config)
    raw = spark.table(config.table("bronze", "sleep_health_lifestyle"))
    kept = spark.table(config.table("silver", "sleep_health_lifestyle"))
    rejected = spark.table(config.table("silver", "sleep_health_lifestyle_rejected"))
    assert kept.where("heart_rate NOT BETWEEN 60 AND 70").isEmpty()
    assert {r["broken"] for r in rejected.select("broken").distinct().collect()} == {"heart_rate"}
    assert kept.count() + rejected.count() == raw.distinct().count()
    marks = spark.table(config.table("silver", "hypertension_imputed"))
    assert marks.where("glucose_imputed = 1").count() == marks.where("glucose IS NULL").count() > 0


def test_counts_over_joined_rows_outgrow_64_bits(spark, small):
    def one_key(name, adapter):
        rows = silver.LOADS[name](ADAPTERS[adapter].rows(spark, small)).limit(1)
        hot = rows.withColumn("patient_key", F.lit("0123456789ABCDEF"))
        return spark.range(2_200_000).crossJoin(F.broadcast(hot)).drop("id")

    mart = gold.mart_comorbidity_by_age(
        one_key("diabetes_sleep_link", "b_link"), one_key("sleep_apnea_core", "b_sleep_apnea"),
        one_key("sleep_disordered_breathing", "b_sdb"), gold.dim_age_band(spark),
    )
    assert [int(r["total_patients"]) for r in mart.collect()] == [2_200_000**3]


def test_a_repeated_key_is_not_published(spark, tmp_path):
    table, folder = "key_probe", str(tmp_path / "k")
    good = spark.createDataFrame([(1,), (2,)], "census_tract long")
    tables.full_refresh(spark, good, table, folder, "census_tract")
    with pytest.raises(ValueError, match="census_tract"):
        tables.full_refresh(spark, good.unionAll(good), table, folder, "census_tract")
    assert spark.table(table).count() == 2
    spark.sql(f"DROP TABLE {table}")


def test_dim_patient_without_the_shuffle_is_the_same(spark, small):
    rows = silver.sleep_health_lifestyle(ADAPTERS["b_shl"].rows(spark, small))
    one, two = gold.dim_patient(rows), gold.dim_patient(rows, ids_unique=True)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_dim_patient_keeps_the_latest_load(spark, small):
    rows = silver.sleep_health_lifestyle(ADAPTERS["b_shl"].rows(spark, small))
    old = rows.withColumn("occupation", F.lit("old")).withColumn(
        tables.STAMP, F.lit("2024-01-01").cast("timestamp_ntz"))
    new = rows.withColumn(tables.STAMP, F.lit("2024-01-02").cast("timestamp_ntz"))
    patients = gold.dim_patient(old.unionByName(new))
    assert patients.count() == rows.count()
    assert patients.where("occupation = 'old'").isEmpty()


def test_numeric_midpoint_lets_the_disorder_mart_join(spark, small):
    raw = ADAPTERS["b_shl"].rows(spark, small)
    apnea = silver.sleep_apnea_core(ADAPTERS["b_sleep_apnea"].rows(spark, small))
    # an apnea row that has one of the profiles
    person = raw.where("bmi_category = 'Overweight' AND gender = 'Male'").selectExpr("age").first()
    extra = apnea.limit(1).withColumn(
        "patient_key",
        F.upper(F.left(F.md5(F.encode(F.lit(f"{person['age']}_Male_27"), "UTF-16LE")), F.lit(16))),
    )
    breathing = silver.sleep_disordered_breathing(ADAPTERS["b_sdb"].rows(spark, small))
    found = {}
    for numeric in (False, True):
        mart = gold.mart_bmi_sleep_disorder(
            silver.sleep_health_lifestyle(raw, numeric), extra, breathing)
        found[numeric] = mart.where("avg_neck_circumference IS NOT NULL").count()
    assert found[False] == 0 and found[True] > 0


def test_skewed_fact_equals_plain_fact(spark, small):
    """Salting every key gives the fact that plain joins give."""
    def load(name, adapter):
        return silver.LOADS[name](ADAPTERS[adapter].rows(spark, small))

    inputs = [
        load("diabetes_sleep_link", "b_link"), load("sleep_apnea_core", "b_sleep_apnea"),
        load("sleep_disordered_breathing", "b_sdb"),
        load("sleep_health_lifestyle", "b_shl"), load("diabetes_detailed", "b_diabetes"),
    ]
    # one profile holds many rows on every side
    hot = F.when(F.col("record_id") % 3 == 0, F.lit("0123456789ABCDEF")).otherwise(
        F.col("patient_key"))
    inputs[0] = inputs[0].limit(200).withColumn("patient_key", hot)
    inputs[1] = inputs[1].withColumn("patient_key", hot)
    inputs[2] = inputs[2].withColumn("patient_key", hot)
    dims = gold.dim_age_band(spark), gold.dim_bmi_category(spark)
    plain = gold.fact_patient_health_snapshot(*inputs, *dims)
    salted = gold.fact_patient_health_snapshot(*inputs, *dims, skew=Skew(target_tasks=50))
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, salted.collect()))


# --- typed reads and writes -----------------------------------------------------------------


def test_too_long_text_is_an_error(spark):
    rows = spark.createDataFrame([("short",), ("much too long",)], "x string")
    with pytest.raises(Exception, match="text longer than 5"):
        tables.conform(rows, schemas.table(x=schemas.text(5))).collect()


def test_overflow_is_an_error(spark):
    rows = spark.createDataFrame([(1234567.0,)], "x double")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        tables.conform(rows, schemas.table(x=schemas.dec(5, 1))).collect()


def test_full_refresh_may_read_the_table_it_replaces(spark, tmp_path):
    folder, table = str(tmp_path / "t"), "refresh_probe"
    first = tables.full_refresh(spark, spark.range(10).toDF("v"), table, folder)
    second = tables.full_refresh(spark, first.where("v < 4"), table, folder)
    assert sorted(r["v"] for r in second.collect()) == [0, 1, 2, 3]
    # another set of columns re-creates the table
    third = tables.full_refresh(spark, second.selectExpr("v", "v * 2 AS w"), table, folder)
    assert third.columns == ["v", "w"] and spark.table(table).count() == 4
    spark.sql(f"DROP TABLE {table}")


def test_bom_crlf_quotes_and_the_text_none(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_bytes(
        "﻿Age,The Notes,Other\r\n1,\"a, \"\"b\"\" c\",None\r\n2,,NA\r\n".encode("utf-8"))
    schema = schemas.table(age=schemas.INT, notes=schemas.TEXT, other=schemas.text(10))
    rows = [tuple(r) for r in read_csv(spark, str(path), schema, "keepnulls").collect()]
    assert rows == [(1, 'a, "b" c', "None"), (2, None, "NA")]


def test_plain_style_takes_quotes_as_text(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('a,b\n"x,1\n')
    schema = schemas.table(a=schemas.TEXT, b=schemas.INT)
    assert [tuple(r) for r in read_csv(spark, str(path), schema, "plain").collect()] == [('"x', 1)]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    below = spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    assert folder == (named.rstrip("/") if named else below)


def test_unknown_failure_policy_is_refused():
    with pytest.raises(ValueError, match="on_error"):
        WarehouseConfig("a", "b", on_error="ignore")
