"""Known results on the clinical extracts themselves.

Set CLINICAL_CSV_DIR to a folder that holds the four public extracts; they are told apart
by their number of columns.  Skipped where the folder is not given.
"""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from somnolake import schemas
from somnolake.operators.quality import key_report
from somnolake.plans import gold, silver
from somnolake.sources.csv import SOURCE_STYLES, read_csv
from somnolake.sources.tables import conform

FOLDER = os.environ.get("CLINICAL_CSV_DIR", "")
pytestmark = pytest.mark.skipif(not FOLDER, reason="CLINICAL_CSV_DIR is not set")

EXTRACTS = ("enhanced_sleep_sdb", "sleep_health_lifestyle", "diabetes_all_2016",
            "diabetes_hypertension_2016")


@pytest.fixture(scope="module")
def raw(spark):
    by_width = {}
    for path in Path(FOLDER).glob("*.csv"):
        with path.open(encoding="utf-8-sig") as lines:
            by_width[len(lines.readline().split(","))] = str(path)
    found = {}
    for name in EXTRACTS:
        schema = schemas.BRONZE[name]
        rows = read_csv(spark, by_width[len(schema)], schema, SOURCE_STYLES[name])
        found[name] = conform(rows, schema).withColumn(
            "record_id", F.monotonically_increasing_id() + 1)
    return found


@pytest.fixture(scope="module")
def no_apnea(spark):
    empty = spark.createDataFrame(
        [], "age double, bmi double, diabetes int, hypertension int, gender_male int, "
            "neck_circumference double, smoking int, alcohol_use int, snoring int, fatigue int, "
            "sleep_apnea int, record_id long")
    return silver.sleep_apnea_core(empty)


@pytest.fixture(scope="module")
def lifestyle(raw):
    return silver.sleep_health_lifestyle(raw["sleep_health_lifestyle"])


@pytest.fixture(scope="module")
def breathing(raw):
    return silver.sleep_disordered_breathing(raw["enhanced_sleep_sdb"])


def test_epidemiology(raw):
    mart = gold.mart_epidemiology_combined(
        silver.diabetes_aggregate_2016(raw["diabetes_all_2016"]),
        silver.diabetes_hypertension_aggregate_2016(raw["diabetes_hypertension_2016"]),
    )
    assert key_report(mart, "census_tract").first().asDict() == {
        "rows": 390, "distinct_keys": 390, "duplicate_keys": 0, "null_keys": 0}
    sums = mart.agg(F.sum("bp_adult_diab"), F.sum("total_bp_diab_hyp"),
                    F.sum("diab_hyp_overlap_rate"), F.min("diab_hyp_overlap_rate")).first()
    assert [float(v) for v in sums] == [647007, 572341, 334.8885, 0.2941]
    first = mart.orderBy("census_tract").select(
        "census_tract", "bp_adult_diab", "total_bp_diab_hyp", "diab_hyp_overlap_rate").take(3)
    assert [tuple(map(float, r)) for r in first] == [
        (10300, 674, 422, 0.6261), (20100, 3742, 2610, 0.6975), (20300, 401, 354, 0.8828)]


def test_patients(lifestyle):
    patients = gold.dim_patient(lifestyle)
    by_band = {r["age_band"]: r["count"] for r in patients.groupBy("age_band").count().collect()}
    assert by_band == {"18-30": 32, "31-45": 232, "46-60": 110}
    by_gender = {r["gender"]: r["count"] for r in patients.groupBy("gender").count().collect()}
    assert by_gender == {"Male": 189, "Female": 185}


def test_bmi_and_disorder(lifestyle, breathing, no_apnea):
    mart = gold.mart_bmi_sleep_disorder(lifestyle, no_apnea, breathing)
    got = {
        (r["bmi_category"], r["sleep_disorder"]): tuple(
            float(r[c]) for c in ("patient_count", "avg_sleep_hrs", "avg_stress", "avg_systolic",
                                  "avg_heart_rate"))
        for r in mart.collect()
    }
    assert got == {
        ("Normal", "Insomnia"): (9, 7.20, 5.44, 127.44, 71.22),
        ("Normal", "None"): (200, 7.41, 5.09, 123.38, 68.77),
        ("Normal", "Sleep Apnea"): (7, 6.96, 6.00, 125.29, 72.00),
        ("Obese", "Insomnia"): (4, 6.70, 6.25, 141.00, 83.25),
        ("Obese", "Sleep Apnea"): (6, 7.13, 5.33, 138.00, 85.00),
        ("Overweight", "Insomnia"): (64, 6.50, 5.91, 132.13, 69.56),
        ("Overweight", "None"): (19, 6.80, 5.37, 131.11, 71.63),
        ("Overweight", "Sleep Apnea"): (65, 7.03, 5.66, 139.09, 72.11),
    }
    joined = mart.select("avg_neck_circumference", "avg_ahi_score", "avg_oxygen_saturation",
                         F.col("snoring_rate_pct").cast("double")).distinct().collect()
    assert [tuple(r) for r in joined] == [(None, None, None, 0.0)]


OCCUPATIONS = {
    "Accountant": (37, 0, 7, 7.11, 4.59, 117.73, 6881.08, 7.89, 0.0, 18.9),
    "Doctor": (71, 4, 3, 6.97, 6.73, 123.00, 6808.45, 6.65, 5.6, 4.2),
    "Engineer": (63, 1, 5, 7.99, 3.89, 125.90, 5980.95, 8.41, 1.6, 7.9),
    "Lawyer": (47, 3, 2, 7.41, 5.06, 129.96, 7661.70, 7.89, 6.4, 4.3),
    "Manager": (1, 0, 0, 6.90, 5.00, 125.00, 5500.00, 7.00, 0.0, 0.0),
    "Nurse": (73, 61, 3, 7.06, 5.55, 138.52, 8057.53, 7.37, 83.6, 4.1),
    "Sales Representative": (2, 2, 0, 5.90, 8.00, 140.00, 3000.00, 4.00, 100.0, 0.0),
    "Salesperson": (32, 1, 29, 6.40, 7.00, 130.00, 6000.00, 6.00, 3.1, 90.6),
    "Scientist": (4, 2, 0, 6.00, 7.00, 129.50, 5350.00, 5.00, 50.0, 0.0),
    "Software Engineer": (4, 0, 1, 6.75, 6.00, 126.50, 5800.00, 6.50, 0.0, 25.0),
    "Teacher": (40, 4, 27, 6.69, 4.53, 131.23, 5957.50, 6.98, 10.0, 67.5),
}


def test_occupations(lifestyle, no_apnea):
    columns = ("total_patients", "sleep_apnea_count", "insomnia_count", "avg_sleep_hrs",
               "avg_stress", "avg_systolic", "avg_daily_steps", "avg_quality_of_sleep",
               "sleep_apnea_rate_pct", "insomnia_rate_pct")
    mart = gold.mart_occupation_risk(lifestyle, no_apnea).collect()
    assert {r["occupation"]: tuple(float(r[c]) for c in columns) for r in mart} == OCCUPATIONS
    assert {(r["avg_neck_circumference"], float(r["fatigue_rate_pct"])) for r in mart} == {
        (None, 0.0)}


def test_severity(breathing, no_apnea):
    mart = gold.mart_clinical_severity(breathing, no_apnea)

    def per(column):
        return {r[column]: r["count"] for r in mart.groupBy(column).count().collect()}

    assert per("bmi_category") == {"Normal": 3, "Overweight": 4, "Obese": 3}
    assert per("severity") == {"None": 2, "Mild": 2, "Moderate": 5, "Severe": 1}
    assert per("treatment") == {"None": 4, "CPAP": 4, "Surgery": 2}


def test_defaults(spark, lifestyle, breathing):
    row = spark.range(1).withColumns({
        "l": gold.mean_defaults(lifestyle, "sleep_health_lifestyle"),
        "b": gold.mean_defaults(breathing, "sleep_disordered_breathing"),
        "fl": gold.fact_defaults(lifestyle, "sleep_health_lifestyle"),
        "fb": gold.fact_defaults(breathing, "sleep_disordered_breathing"),
    }).first()
    assert [float(v) for v in row["l"]] == [128.55, 84.65, 70.17, 6817, 7.13, 7, 5, 59]
    assert [float(v) for v in row["b"]] == [93.38, 21.20, 91.72, 0.3050, 0.3730]
    life, signals = row["fl"].asDict(), row["fb"].asDict()
    assert life["occupation"] == "Nurse"
    assert (life["systolic_bp"], life["diastolic_bp"], life["heart_rate"]) == (128, 84, 70)
    assert (signals["eeg_sleep_stage"], signals["sleep_position"]) == ("REM", "Prone")
    numbers = ("oxygen_saturation", "ahi_score", "spo2_ratio", "nasal_airflow_rate",
               "chest_movement_effort")
    assert [float(signals[n]) for n in numbers] == [93.4, 21.20, 91.7, 0.31, 0.37]
