"""Cleansed tables: one function per table, raw rows in, declared columns out.

Every function is a single scan and projection (the hypertension table adds one
aggregate for its means).  A ``record_id`` in the input is carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from somnolake import schemas
from somnolake.functions import keys, numeric, text
from somnolake.operators.impute import int_mean, scalars_of
from somnolake.sources.tables import conform

ID = "record_id"

# Cleansed table -> raw table.
SOURCES = {
    "sleep_apnea_core": "sleep_apnea_dataset",
    "sleep_lifestyle": "sleep_data_sampled",
    "sleep_health_lifestyle": "sleep_health_lifestyle",
    "sleep_disordered_breathing": "enhanced_sleep_sdb",
    "diabetes_detailed": "diabetes_data",
    "diabetes_sleep_link": "diabetes_dataset_10k",
    "diabetes_prediction": "diabetes_prediction",
    "hypertension_risk": "hypertension_risk",
    "diabetes_aggregate_2016": "diabetes_all_2016",
    "diabetes_hypertension_aggregate_2016": "diabetes_hypertension_2016",
}

# Source name -> written name.
AGGREGATE_NAMES = {
    "ct": "area_code",
    "bpad": "bp_affected_diabetic",
    "bpan": "bp_affected_non_diab",
    "bpan2": "bp_affected_non_diab2",
    "bwad": "bw_affected_diabetic",
    "bwan": "bw_affected_non_diab",
    "bwan2": "bw_affected_non_diab2",
    "bmad": "bm_affected_diabetic",
    "bman": "bm_affected_non_diab",
    "bman2": "bm_affected_non_diab2",
}
AGGREGATE_HYPERTENSION_NAMES = {
    "ct": "area_code",
    "btpad": "both_affected_diabetic",
    "btpan": "both_affected_non_diab",
    "btwad": "both_bw_affected_diabetic",
    "btwan": "both_bw_affected_non_diab",
    "btmad": "both_bm_affected_diabetic",
    "btman": "both_bm_affected_non_diab",
}
# Measures stored rounded to two decimals, source name -> written name.
ROUNDED_MEASURES = {
    "bmi": "bmi",
    "alcoholconsumption": "alcohol_consumption",
    "physicalactivity": "physical_activity",
    "dietquality": "diet_quality",
    "sleepquality": "sleep_quality",
    "fastingbloodsugar": "fasting_blood_sugar",
    "hba1c": "hba1c",
    "cholesteroltotal": "cholesterol_total",
    "cholesterolldl": "cholesterol_ldl",
    "cholesterolhdl": "cholesterol_hdl",
    "cholesteroltriglycerides": "cholesterol_triglycerides",
    "fatiguelevels": "fatigue_level",
    "qualityoflifescore": "quality_of_life_score",
}


# Text made here from fixed labels, digits of numbers or hashes.
BOUNDED = ("gender", "bmi_category", "patient_key", "area_code")


def _finish(rows: DataFrame, name: str, columns: dict[str, Column]) -> DataFrame:
    carried = [ID] if ID in rows.columns else []
    shaped = rows.select(*carried, *(value.alias(column) for column, value in columns.items()))
    return conform(shaped, schemas.SILVER[name], keep=[ID], bounded=BOUNDED)


def sleep_apnea_core(raw: DataFrame) -> DataFrame:
    gender = text.gender_from_male_flag(F.col("gender_male"))
    return _finish(raw, "sleep_apnea_core", {
        "age": F.col("age"),
        "gender": gender,
        "bmi": F.col("bmi"),
        "neck_circumference": F.col("neck_circumference"),
        "diabetes_flag": F.col("diabetes"),
        "hypertension_flag": F.col("hypertension"),
        "smoking_flag": F.col("smoking"),
        "alcohol_flag": F.col("alcohol_use"),
        "snoring_flag": F.col("snoring"),
        "fatigue_flag": F.col("fatigue"),
        "sleep_apnea_flag": F.col("sleep_apnea"),
        "patient_key": keys.patient_key(F.col("age"), gender, keys.number_text(F.col("bmi"))),
    })


def _lifestyle(raw: DataFrame, name: str, disorder: Column, numeric_midpoint: bool) -> DataFrame:
    systolic, diastolic = text.split_reading(F.col("blood_pressure"))
    midpoint = keys.midpoint_text(F.col("bmi_category"), numeric_midpoint)
    return _finish(raw, name, {
        "gender": text.gender_canonical(F.col("gender")),
        "age": F.col("age"),
        "occupation": F.trim("occupation"),
        "sleep_duration_hrs": F.col("sleep_duration"),
        "quality_of_sleep": F.col("quality_of_sleep"),
        "physical_activity_level": F.col("physical_activity_level"),
        "stress_level": F.col("stress_level"),
        "bmi_category": text.bmi_label(F.col("bmi_category")),
        "systolic_bp": systolic,
        "diastolic_bp": diastolic,
        "heart_rate": F.col("heart_rate"),
        "daily_steps": F.col("daily_steps"),
        "sleep_disorder": disorder,
        "patient_key": keys.patient_key(
            F.col("age"), text.gender_in_key(F.col("gender")), midpoint
        ),
    })


def sleep_lifestyle(raw: DataFrame, numeric_midpoint: bool = False) -> DataFrame:
    disorder = text.disorder_sampled(F.col("sleep_disorder"))
    return _lifestyle(raw, "sleep_lifestyle", disorder, numeric_midpoint)


def sleep_health_lifestyle(raw: DataFrame, numeric_midpoint: bool = False) -> DataFrame:
    disorder = text.disorder_clinical(F.col("sleep_disorder"))
    return _lifestyle(raw, "sleep_health_lifestyle", disorder, numeric_midpoint)


def sleep_disordered_breathing(raw: DataFrame) -> DataFrame:
    return _finish(raw, "sleep_disordered_breathing", {
        "age": F.col("age"),
        "gender": text.gender_canonical(F.col("gender")),
        "bmi": F.col("bmi"),
        "snoring": F.col("snoring"),
        "oxygen_saturation": F.col("oxygen_saturation"),
        "apnea_hypopnea_index": F.col("apnea_hypopnea_index_ahi"),
        "nasal_airflow_rate": F.col("nasal_airflow_flow_rate"),
        "chest_movement_effort": F.col("chest_movement_effort"),
        "ecg_heart_rate": F.col("ecg_heart_rate"),
        "spo2_ratio": F.col("spo2_ratio"),
        "sleep_position": F.col("position"),
        "eeg_sleep_stage": F.col("eeg_sleep_stage"),
        "diagnosis_sdb": F.col("diagnosis_of_sdb"),
        # only NULL is replaced: the text None in these columns is data
        "severity": F.coalesce("severity", F.lit("None")),
        "treatment": F.coalesce("treatment", F.lit("Not Assigned")),
        "patient_key": keys.patient_key(
            F.col("age"), text.gender_in_key(F.col("gender")), keys.number_text(F.col("bmi"))
        ),
    })


def diabetes_detailed(raw: DataFrame) -> DataFrame:
    gender = text.gender_from_code(F.col("gender"))
    return _finish(raw, "diabetes_detailed", {
        "patient_source_id": F.col("patientid"),
        "age": F.col("age"),
        "gender": gender,
        "smoking_flag": F.col("smoking"),
        "hypertension_flag": F.col("hypertension"),
        "systolic_bp": F.col("systolicbp"),
        "diastolic_bp": F.col("diastolicbp"),
        "family_history_diabetes": F.col("familyhistorydiabetes"),
        "previous_pre_diabetes": F.col("previousprediabetes"),
        "diabetes_diagnosis": F.col("diagnosis"),
        "patient_key": keys.patient_key(F.col("age"), gender, keys.number_text(F.col("bmi"))),
        **{written: F.round(source, 2) for source, written in ROUNDED_MEASURES.items()},
    })


def diabetes_sleep_link(raw: DataFrame) -> DataFrame:
    gender = text.gender_from_male_flag(F.col("gender_male"))
    return _finish(raw, "diabetes_sleep_link", {
        "patient_source_id": F.col("patientid"),
        "age": F.col("age"),
        "gender": gender,
        "bmi": F.col("bmi"),
        "glucose": F.col("glucose"),
        "insulin": F.col("insulin"),
        "blood_pressure": F.col("blood_pressure"),
        "family_history_flag": F.col("family_history"),
        "hypertension_flag": F.col("hypertension"),
        "sleep_apnea_flag": F.col("sleep_apnea"),
        "smoking_flag": F.col("smoking"),
        "diabetes_flag": F.col("diabetes"),
        "patient_key": keys.patient_key(F.col("age"), gender, keys.number_text(F.col("bmi"))),
    })


def diabetes_prediction(raw: DataFrame) -> DataFrame:
    gender = text.gender_canonical(F.col("gender"))
    return _finish(raw, "diabetes_prediction", {
        "gender": gender,
        "age": F.col("age"),
        "bmi": F.col("bmi"),
        "hypertension_flag": F.col("hypertension"),
        "heart_disease_flag": F.col("heart_disease"),
        "smoking_history": text.smoking_label(F.col("smoking_history")),
        "hba1c_level": F.col("hba1c_level"),
        "blood_glucose_level": F.col("blood_glucose_level"),
        "diabetes_flag": F.col("diabetes"),
        "patient_key": keys.patient_key(F.col("age"), gender, keys.number_text(F.col("bmi"))),
    })


def hypertension_defaults(raw: DataFrame) -> Column:
    """Means over the parsable values of the raw table, from one scan."""
    parsed = raw.select(
        "currentsmoker",
        *(numeric.try_float(F.col(name)).alias(name) for name in ("bmi", "totchol", "glucose")),
        *(numeric.try_int(F.col(name)).alias(name) for name in ("heartrate", "cigsperday")),
    )
    return scalars_of(
        parsed,
        bmi="avg(bmi)",
        total_cholesterol="avg(totchol)",
        glucose="avg(glucose)",
        heart_rate=int_mean("heartrate"),
        smoker_cigs=int_mean("CASE WHEN currentsmoker = 1 THEN cigsperday END"),
    )


def smoking_default(default: Column) -> Column:
    """Cigarettes a day: known non-smokers 0, everyone else the mean of smokers."""
    return F.when(F.col("currentsmoker") == 0, F.lit(0)).otherwise(default)


def hypertension_risk(raw: DataFrame) -> DataFrame:
    gender = text.gender_from_male_flag(F.col("male"))
    bmi = F.coalesce(numeric.try_float(F.col("bmi")), F.col("_mean.bmi"))
    with_means = raw.withColumn("_mean", hypertension_defaults(raw))
    return _finish(with_means, "hypertension_risk", {
        "gender": gender,
        "age": F.col("age"),
        "bmi": bmi,
        "current_smoker": F.col("currentsmoker"),
        "cigs_per_day": F.coalesce(
            numeric.try_int(F.col("cigsperday")), smoking_default(F.col("_mean.smoker_cigs"))
        ),
        "bp_medication": F.coalesce(numeric.try_int(F.col("bpmeds")), F.lit(0)),
        "diabetes_flag": F.col("diabetes"),
        "total_cholesterol": F.coalesce(
            numeric.try_float(F.col("totchol")), F.col("_mean.total_cholesterol")
        ),
        "systolic_bp": F.col("sysbp"),
        "diastolic_bp": F.col("diabp"),
        "heart_rate": F.coalesce(numeric.try_int(F.col("heartrate")), F.col("_mean.heart_rate")),
        "glucose": F.coalesce(numeric.try_float(F.col("glucose")), F.col("_mean.glucose")),
        "hypertension_risk": F.col("risk"),
        "patient_key": keys.patient_key(F.col("age"), gender, keys.number_text(bmi)),
    })


def diabetes_aggregate_2016(raw: DataFrame) -> DataFrame:
    renamed = raw.withColumnsRenamed(AGGREGATE_NAMES)
    return conform(renamed, schemas.SILVER["diabetes_aggregate_2016"], [ID], BOUNDED)


def diabetes_hypertension_aggregate_2016(raw: DataFrame) -> DataFrame:
    renamed = raw.withColumnsRenamed(AGGREGATE_HYPERTENSION_NAMES)
    return conform(renamed, schemas.SILVER["diabetes_hypertension_aggregate_2016"], [ID], BOUNDED)


LOADS = {
    "sleep_apnea_core": sleep_apnea_core,
    "sleep_lifestyle": sleep_lifestyle,
    "sleep_health_lifestyle": sleep_health_lifestyle,
    "sleep_disordered_breathing": sleep_disordered_breathing,
    "diabetes_detailed": diabetes_detailed,
    "diabetes_sleep_link": diabetes_sleep_link,
    "diabetes_prediction": diabetes_prediction,
    "hypertension_risk": hypertension_risk,
    "diabetes_aggregate_2016": diabetes_aggregate_2016,
    "diabetes_hypertension_aggregate_2016": diabetes_hypertension_aggregate_2016,
}
