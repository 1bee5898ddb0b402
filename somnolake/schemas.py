"""Declared schemas of the 32 tables.

Column names, order, lengths and decimal scales are fixed values: results are
compared on them.  Two widenings keep the tables usable beyond 2^31 rows: row ids are
BIGINT, and counts over joined rows, which outgrow 64 bits, DECIMAL(38,0).  Unsigned one-byte columns are SMALLINT, since Spark's
BYTE is signed.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

INT, BIGINT, SMALL, DOUBLE, TEXT = (
    IntegerType(), LongType(), ShortType(), DoubleType(), StringType(),
)
TINY = SMALL
COUNT = DecimalType(38, 0)


def dec(precision: int, scale: int) -> DecimalType:
    return DecimalType(precision, scale)


def text(length: int) -> VarcharType:
    return VarcharType(length)


def table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_LIFESTYLE_RAW = table(
    gender=text(50), age=INT, occupation=text(50), sleep_duration=DOUBLE, quality_of_sleep=INT,
    physical_activity_level=INT, stress_level=INT, bmi_category=text(50), blood_pressure=text(50),
    heart_rate=INT, daily_steps=INT, sleep_disorder=text(50),
)

# Raw extracts, in file order.
BRONZE: dict[str, StructType] = {
    "diabetes_data": table(
        patientid=INT, age=INT, gender=text(50), ethnicity=INT, socioeconomicstatus=INT,
        educationlevel=INT, bmi=DOUBLE, smoking=INT, alcoholconsumption=DOUBLE,
        physicalactivity=DOUBLE, dietquality=DOUBLE, sleepquality=DOUBLE,
        familyhistorydiabetes=INT, gestationaldiabetes=INT, polycysticovarysyndrome=INT,
        previousprediabetes=INT, hypertension=INT, systolicbp=INT, diastolicbp=INT,
        fastingbloodsugar=DOUBLE, hba1c=DOUBLE, serumcreatinine=DOUBLE, bunlevels=DOUBLE,
        cholesteroltotal=DOUBLE, cholesterolldl=DOUBLE, cholesterolhdl=DOUBLE,
        cholesteroltriglycerides=DOUBLE, antihypertensivemedications=INT, statins=INT,
        antidiabeticmedications=INT, frequenturination=INT, excessivethirst=INT,
        unexplainedweightloss=INT, fatiguelevels=DOUBLE, blurredvision=INT, slowhealingsores=INT,
        tinglinghandsfeet=INT, qualityoflifescore=DOUBLE, heavymetalsexposure=INT,
        occupationalexposurechemicals=INT, waterquality=INT, medicalcheckupsfrequency=DOUBLE,
        medicationadherence=DOUBLE, healthliteracy=DOUBLE, diagnosis=INT, doctorincharge=text(50),
    ),
    "diabetes_dataset_10k": table(
        patientid=INT, age=DOUBLE, bmi=DOUBLE, glucose=DOUBLE, insulin=DOUBLE,
        blood_pressure=DOUBLE, family_history=INT, hypertension=INT, sleep_apnea=INT, smoking=INT,
        gender_male=INT, diabetes=INT,
    ),
    "diabetes_prediction": table(
        gender=text(50), age=DOUBLE, hypertension=INT, heart_disease=INT, smoking_history=text(50),
        bmi=DOUBLE, hba1c_level=DOUBLE, blood_glucose_level=INT, diabetes=INT,
    ),
    "enhanced_sleep_sdb": table(
        age=INT, gender=text(50), bmi=DOUBLE, snoring=text(50), oxygen_saturation=DOUBLE,
        apnea_hypopnea_index_ahi=INT, nasal_airflow_flow_rate=DOUBLE, chest_movement_effort=DOUBLE,
        ecg_heart_rate=INT, spo2_ratio=DOUBLE, position=text(50), eeg_sleep_stage=text(50),
        diagnosis_of_sdb=text(50), severity=text(50), treatment=text(50), physician_notes=TEXT,
        patient_symptoms=TEXT,
    ),
    "sleep_apnea_dataset": table(
        age=DOUBLE, bmi=DOUBLE, diabetes=INT, hypertension=INT, gender_male=INT,
        neck_circumference=DOUBLE, smoking=INT, alcohol_use=INT, snoring=INT, fatigue=INT,
        sleep_apnea=INT,
    ),
    "diabetes_all_2016": table(
        ct=INT, bpad=INT, bpan=INT, bpan2=INT, bwad=INT, bwan=INT, bwan2=INT, bmad=INT, bman=INT,
        bman2=INT,
    ),
    "diabetes_hypertension_2016": table(
        ct=INT, btpad=INT, btpan=INT, btwad=INT, btwan=INT, btmad=INT, btman=INT,
    ),
    "hypertension_risk": table(
        male=INT, age=INT, currentsmoker=INT, cigsperday=text(50), bpmeds=text(50), diabetes=INT,
        totchol=text(50), sysbp=DOUBLE, diabp=DOUBLE, bmi=text(50), heartrate=text(50),
        glucose=text(50), risk=INT,
    ),
    "sleep_data_sampled": _LIFESTYLE_RAW,
    "sleep_health_lifestyle": _LIFESTYLE_RAW,
}

_LIFESTYLE = table(
    gender=text(10), age=INT, occupation=text(100), sleep_duration_hrs=dec(4, 2),
    quality_of_sleep=TINY, physical_activity_level=INT, stress_level=TINY, bmi_category=text(20),
    systolic_bp=SMALL, diastolic_bp=SMALL, heart_rate=INT, daily_steps=INT,
    sleep_disorder=text(20), patient_key=text(16),
)

# Cleansed tables, without record_id and dwh_create_date.
SILVER: dict[str, StructType] = {
    "sleep_apnea_core": table(
        age=dec(5, 1), gender=text(10), bmi=dec(5, 1), neck_circumference=dec(5, 1),
        diabetes_flag=TINY, hypertension_flag=TINY, smoking_flag=TINY, alcohol_flag=TINY,
        snoring_flag=TINY, fatigue_flag=TINY, sleep_apnea_flag=TINY, patient_key=text(16),
    ),
    "sleep_lifestyle": _LIFESTYLE,
    "sleep_health_lifestyle": _LIFESTYLE,
    "sleep_disordered_breathing": table(
        age=INT, gender=text(10), bmi=dec(5, 1), snoring=text(5), oxygen_saturation=dec(5, 1),
        apnea_hypopnea_index=dec(6, 2), nasal_airflow_rate=dec(6, 2),
        chest_movement_effort=dec(6, 2), ecg_heart_rate=INT, spo2_ratio=dec(6, 1),
        sleep_position=text(20), eeg_sleep_stage=text(20), diagnosis_sdb=text(5),
        severity=text(20), treatment=text(100), patient_key=text(16),
    ),
    "diabetes_detailed": table(
        patient_source_id=INT, age=INT, gender=text(10), bmi=dec(6, 2), smoking_flag=TINY,
        alcohol_consumption=dec(5, 2), physical_activity=dec(5, 2), diet_quality=dec(5, 2),
        sleep_quality=dec(5, 2), hypertension_flag=TINY, systolic_bp=INT, diastolic_bp=INT,
        fasting_blood_sugar=dec(7, 2), hba1c=dec(5, 2), cholesterol_total=dec(7, 2),
        cholesterol_ldl=dec(7, 2), cholesterol_hdl=dec(7, 2), cholesterol_triglycerides=dec(7, 2),
        family_history_diabetes=TINY, previous_pre_diabetes=TINY, fatigue_level=dec(5, 2),
        quality_of_life_score=dec(5, 2), diabetes_diagnosis=TINY, patient_key=text(16),
    ),
    "diabetes_sleep_link": table(
        patient_source_id=INT, age=dec(5, 1), gender=text(10), bmi=dec(5, 1), glucose=dec(7, 2),
        insulin=dec(7, 2), blood_pressure=INT, family_history_flag=TINY, hypertension_flag=TINY,
        sleep_apnea_flag=TINY, smoking_flag=TINY, diabetes_flag=TINY, patient_key=text(16),
    ),
    "diabetes_prediction": table(
        gender=text(10), age=dec(5, 1), bmi=dec(5, 1), hypertension_flag=TINY,
        heart_disease_flag=TINY, smoking_history=text(30), hba1c_level=dec(5, 2),
        blood_glucose_level=INT, diabetes_flag=TINY, patient_key=text(16),
    ),
    "hypertension_risk": table(
        gender=text(10), age=INT, bmi=dec(5, 2), current_smoker=TINY, cigs_per_day=dec(5, 1),
        bp_medication=TINY, diabetes_flag=TINY, total_cholesterol=dec(7, 1), systolic_bp=dec(6, 1),
        diastolic_bp=dec(6, 1), heart_rate=INT, glucose=dec(6, 1), hypertension_risk=TINY,
        patient_key=text(16),
    ),
    "diabetes_aggregate_2016": table(
        area_code=text(20), bp_affected_diabetic=INT, bp_affected_non_diab=INT,
        bp_affected_non_diab2=INT, bw_affected_diabetic=INT, bw_affected_non_diab=INT,
        bw_affected_non_diab2=INT, bm_affected_diabetic=INT, bm_affected_non_diab=INT,
        bm_affected_non_diab2=INT,
    ),
    "diabetes_hypertension_aggregate_2016": table(
        area_code=text(20), both_affected_diabetic=INT, both_affected_non_diab=INT,
        both_bw_affected_diabetic=INT, both_bw_affected_non_diab=INT,
        both_bm_affected_diabetic=INT, both_bm_affected_non_diab=INT,
    ),
}

# Analytical tables, without dwh_create_date.
GOLD: dict[str, StructType] = {
    "dim_age_band": table(age_band_id=INT, label=text(20), age_min=INT, age_max=INT),
    "dim_bmi_category": table(bmi_cat_id=INT, label=text(20), bmi_min=dec(5, 2), bmi_max=dec(5, 2)),
    "dim_disorder_type": table(disorder_id=INT, label=text(30), is_sleep_disorder=TINY),
    "dim_gender": table(gender_id=INT, label=text(10)),
    "dim_patient": table(
        person_id=BIGINT, gender=text(10), age=INT, age_band=text(20), occupation=text(100),
        bmi_category=text(20), sleep_disorder=text(50),
    ),
    "fact_patient_health_snapshot": table(
        patient_primarykey=text(50), age_band_id=INT, bmi_cat_id=INT, age=dec(5, 1),
        gender=text(10), occupation=text(100), bmi=dec(5, 2), glucose=dec(7, 2),
        insulin=dec(7, 2), blood_pressure=dec(7, 2), systolic_bp=dec(6, 2),
        diastolic_bp=dec(6, 2), heart_rate=dec(6, 2), daily_steps=INT, hba1c=dec(5, 2),
        cholesterol_total=dec(7, 2), cholesterol_ldl=dec(7, 2), cholesterol_hdl=dec(7, 2),
        family_history_flag=TINY, hypertension_flag=TINY, sleep_apnea_flag=TINY,
        smoking_flag=TINY, gender_male_flag=TINY, diabetes_flag=TINY, alcohol_flag=TINY,
        neck_circumference=dec(5, 2), snoring_flag=TINY, fatigue_flag=TINY,
        oxygen_saturation=dec(5, 2), ahi_score=dec(6, 2), spo2_ratio=dec(7, 4),
        eeg_sleep_stage=text(20), nasal_airflow_rate=dec(7, 4), chest_movement_effort=dec(7, 4),
        sleep_position=text(20), sleep_duration_hrs=dec(4, 2), quality_of_sleep=INT,
        stress_level=INT, physical_activity_level=INT, alcohol_consumption=text(20),
        fatigue_level=INT, diet_quality=text(20), quality_of_life_score=dec(5, 2),
        age_band=text(20), bmi_category=text(20),
    ),
    "mart_comorbidity_by_age": table(
        age_band=text(20), total_patients=COUNT, diabetes_count=COUNT, sleep_apnea_count=COUNT,
        hypertension_count=COUNT, all_three_count=COUNT, avg_bmi=dec(6, 2), avg_glucose=dec(8, 2),
        avg_blood_pressure=dec(7, 2), avg_neck_circumference=dec(6, 2), snoring_count=COUNT,
        fatigue_count=COUNT, avg_ahi_score=dec(6, 2), avg_spo2=dec(5, 2),
        diabetes_rate_pct=dec(6, 1), sleep_apnea_rate_pct=dec(6, 1),
        hypertension_rate_pct=dec(6, 1), all_three_rate_pct=dec(6, 1), snoring_rate_pct=dec(6, 1),
        fatigue_rate_pct=dec(6, 1),
    ),
    "mart_bmi_sleep_disorder": table(
        bmi_category=text(20), sleep_disorder=text(30), patient_count=COUNT,
        avg_sleep_hrs=dec(5, 2), avg_stress=dec(5, 2), avg_systolic=dec(6, 2),
        avg_heart_rate=dec(6, 2), avg_neck_circumference=dec(6, 2), snoring_rate_pct=dec(6, 1),
        avg_ahi_score=dec(6, 2), avg_oxygen_saturation=dec(5, 2),
    ),
    "mart_occupation_risk": table(
        occupation=text(100), total_patients=COUNT, sleep_apnea_count=COUNT, insomnia_count=COUNT,
        avg_sleep_hrs=dec(5, 2), avg_stress=dec(5, 2), avg_systolic=dec(6, 2),
        avg_daily_steps=dec(8, 2), avg_quality_of_sleep=dec(5, 2),
        avg_neck_circumference=dec(6, 2), fatigue_rate_pct=dec(6, 1),
        sleep_apnea_rate_pct=dec(6, 1), insomnia_rate_pct=dec(6, 1),
    ),
    "mart_clinical_severity": table(
        patient_id=BIGINT, age=INT, gender=text(10), bmi=dec(5, 2), bmi_category=text(20),
        neck_circumference=dec(5, 2), snoring=text(10), ahi_score=INT, spo2_pct=dec(5, 2),
        spo2_ratio=dec(7, 4), oxygen_saturation=dec(5, 2), nasal_airflow_rate=dec(7, 4),
        chest_movement_effort=dec(7, 4), eeg_sleep_stage=text(20), sleep_position=text(20),
        ecg_heart_rate=dec(6, 2), fatigue_flag=TINY, severity=text(20), treatment=text(50),
        diagnosed_sdb=text(5),
    ),
    "mart_epidemiology_combined": table(
        census_tract=BIGINT, bp_adult_diab=INT, bp_adult_nondiab=INT, bw_adult_diab=INT,
        bw_adult_nondiab=INT, bm_adult_diab=INT, bm_adult_nondiab=INT, total_bp_diab_hyp=INT,
        total_bp_nondiab_hyp=INT, total_bw_diab_hyp=INT, total_bw_nondiab_hyp=INT,
        total_bm_diab_hyp=INT, total_bm_nondiab_hyp=INT, diab_hyp_overlap_rate=dec(8, 4),
    ),
    "mart_diabetes_risk_profile": table(
        age_band=text(20), gender=text(10), bmi_category=text(20), total=COUNT,
        diabetes_count=COUNT, hypertension_count=COUNT, sleep_apnea_count=COUNT,
        avg_hba1c=dec(8, 6), avg_glucose=dec(10, 6), avg_cholesterol_total=dec(7, 2),
        avg_cholesterol_ldl=dec(7, 2), avg_cholesterol_hdl=dec(7, 2),
        avg_neck_circumference=dec(6, 2), diabetes_rate_pct=dec(6, 1),
        sleep_apnea_rate_pct=dec(6, 1),
    ),
}

# Primary keys, and (table, column, referenced table, referenced column).
PRIMARY_KEYS = {
    "dim_age_band": "age_band_id",
    "dim_bmi_category": "bmi_cat_id",
    "dim_disorder_type": "disorder_id",
    "dim_gender": "gender_id",
    "dim_patient": "person_id",
    "mart_epidemiology_combined": "census_tract",
}
FOREIGN_KEYS = (
    ("fact_patient_health_snapshot", "age_band_id", "dim_age_band", "age_band_id"),
    ("fact_patient_health_snapshot", "bmi_cat_id", "dim_bmi_category", "bmi_cat_id"),
)
