"""The three load jobs, each a full refresh of its layer in a fixed order."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from somnolake import schemas
from somnolake.config import WarehouseConfig, scratch_path
from somnolake.operators.identity import dense_id
from somnolake.operators.joins import Skew
from somnolake.operators.quality import Gate, broken_rules, deduplicate
from somnolake.plans import gold, silver, views
from somnolake.plans.runlog import RunLog
from somnolake.sources.csv import SOURCE_STYLES, read_csv
from somnolake.sources.tables import STAMP, conform, full_refresh, stamped

def create_layers(spark: SparkSession, config: WarehouseConfig) -> None:
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {config.database(layer)}")


def _folder(config: WarehouseConfig, layer: str, name: str) -> str:
    return f"{config.root}/{config.database(layer)}/{name}"


def _log(spark: SparkSession, config: WarehouseConfig, layer: str) -> RunLog:
    return RunLog(spark, layer, config.root, config.on_error)


def _writer(
    spark: SparkSession, config: WarehouseConfig, layer: str, name: str
) -> Callable[[DataFrame], None]:
    def write(rows: DataFrame) -> None:
        key, gate = None, Gate()
        if layer == "gold":
            key, gate = schemas.PRIMARY_KEYS.get(name), _references(spark, config, name)
        folder = _folder(config, layer, name)
        full_refresh(spark, rows, config.table(layer, name), folder, key, gate, config.keep_versions)

    return write


def _references(spark: SparkSession, config: WarehouseConfig, name: str) -> Gate:
    """The declared foreign keys of a gold table; all refer to dimensions of fixed, few rows."""
    known = {}
    for child, column, parent, key in schemas.FOREIGN_KEYS:
        if child == name:
            ids = spark.table(config.table("gold", parent)).select(key).collect()
            known[column] = [row[0] for row in ids]
    return Gate(references=known)


def run_bronze(spark: SparkSession, config: WarehouseConfig) -> bool:
    """Load every raw extract into a typed table; True if all steps ran."""
    create_layers(spark, config)
    log = _log(spark, config, "bronze")
    for name, schema in schemas.BRONZE.items():
        def load(name=name, schema=schema) -> DataFrame:
            raw = read_csv(
                spark, config.source_path(name), schema, SOURCE_STYLES[name],
                multi_line=name in config.multi_line,
            )
            return conform(raw, schema)

        log.step(name, load, _writer(spark, config, "bronze", name))
    log.finish()
    return not log.stopped


def run_silver(spark: SparkSession, config: WarehouseConfig) -> bool:
    """Cleanse every raw table; row ids follow the order of the raw table's files.

    Where ``config`` asks for it, repeated raw rows are dropped first (the lowest id stays)
    and rows out of range are written to a table of their own, with the columns at fault.
    """
    create_layers(spark, config)
    log = _log(spark, config, "silver")
    moment = datetime.datetime.now()
    for name, transform in silver.LOADS.items():
        def load(name=name, transform=transform) -> DataFrame:
            source = spark.table(config.table("bronze", silver.SOURCES[name]))
            raw = dense_id(source)
            if name in config.drop_repeats:
                raw = deduplicate(raw, source.columns, silver.ID)
            if name in ("sleep_lifestyle", "sleep_health_lifestyle"):
                return stamped(transform(raw, config.numeric_midpoint), moment)
            return stamped(transform(raw), moment)

        if name in config.ranges:
            staged = scratch_path(spark, name)

            def rejected(rules=config.ranges[name], load=load, staged=staged) -> DataFrame:
                # cleansed once; both tables are cut from what was written
                load().withColumn("broken", broken_rules(rules)).write.parquet(staged)
                return spark.read.parquet(staged).where("broken <> ''")

            def accepted(staged=staged) -> DataFrame:
                return spark.read.parquet(staged).where("broken = ''").drop("broken")

            log.step(f"{name}_rejected", rejected, _writer(spark, config, "silver", f"{name}_rejected"))
            log.step(name, accepted, _writer(spark, config, "silver", name))
        else:
            log.step(name, load, _writer(spark, config, "silver", name))
    if config.imputed_flags:
        def marked() -> DataFrame:
            raw = dense_id(spark.table(config.table("bronze", "hypertension_risk")))
            return stamped(views.hypertension_with_flags(raw), moment)

        log.step("hypertension_imputed", marked, _writer(spark, config, "silver", "hypertension_imputed"))
    log.finish()
    return not log.stopped


def silver_tables(spark: SparkSession, config: WarehouseConfig) -> dict[str, DataFrame]:
    return {name: spark.table(config.table("silver", name)) for name in silver.LOADS}


def run_gold(spark: SparkSession, config: WarehouseConfig) -> bool:
    """Dimensions, then the fact, then the marts, then the views."""
    create_layers(spark, config)
    log = _log(spark, config, "gold")
    moment = datetime.datetime.now()
    tables = silver_tables(spark, config)
    apnea, breathing = tables["sleep_apnea_core"], tables["sleep_disordered_breathing"]
    lifestyle, detailed = tables["sleep_health_lifestyle"], tables["diabetes_detailed"]
    link = tables["diabetes_sleep_link"]
    skew = Skew(rows_a_task=config.rows_a_task)

    def ages() -> DataFrame:
        return spark.table(config.table("gold", "dim_age_band")).drop(STAMP)

    def categories() -> DataFrame:
        return spark.table(config.table("gold", "dim_bmi_category")).drop(STAMP)

    steps: dict[str, Callable[[], DataFrame]] = {
        name: (lambda build=build: build(spark)) for name, build in gold.DIMENSIONS.items()
    }
    steps |= {
        "dim_patient": lambda: gold.dim_patient(lifestyle, ids_unique=True),
        "fact_patient_health_snapshot": lambda: gold.fact_patient_health_snapshot(
            link, apnea, breathing, lifestyle, detailed, ages(), categories(), config.dedup, skew
        ),
        "mart_comorbidity_by_age": lambda: gold.mart_comorbidity_by_age(
            link, apnea, breathing, ages(), config.dedup
        ),
        "mart_bmi_sleep_disorder": lambda: gold.mart_bmi_sleep_disorder(
            lifestyle, apnea, breathing
        ),
        "mart_occupation_risk": lambda: gold.mart_occupation_risk(lifestyle, apnea),
        "mart_clinical_severity": lambda: gold.mart_clinical_severity(
            breathing, apnea, config.dedup, skew
        ),
        "mart_epidemiology_combined": lambda: gold.mart_epidemiology_combined(
            tables["diabetes_aggregate_2016"], tables["diabetes_hypertension_aggregate_2016"]
        ),
        "mart_diabetes_risk_profile": lambda: gold.mart_diabetes_risk_profile(
            tables["diabetes_prediction"], detailed, apnea
        ),
    }
    for name, build in steps.items():
        log.step(
            name,
            lambda build=build: stamped(build(), moment),
            _writer(spark, config, "gold", name),
        )
    log.finish()
    if not log.stopped:
        views.create_views(tables)
        views.store_views(spark, config)
    return not log.stopped


def run_all(spark: SparkSession, config: WarehouseConfig) -> bool:
    return (
        run_bronze(spark, config) and run_silver(spark, config) and run_gold(spark, config)
    )
