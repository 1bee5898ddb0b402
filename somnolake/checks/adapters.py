"""Raw-extract shapes projected from the test tables.

Most clinical extracts are not at hand, so each is stood in for by a deterministic
projection of one whole test table.  The expressions mean the same in Spark and DuckDB:
integer arithmetic, tenths as ``cast(n AS double) / 10``, a natural unique ``record_id``
where a later step orders by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Adapter:
    table: str
    columns: dict[str, str]
    where: str = ""

    def rows(self, spark: SparkSession, folder: str) -> DataFrame:
        source = spark.read.parquet(f"{folder}/{self.table}.parquet")
        if self.where:
            source = source.where(self.where)
        return source.selectExpr(*(f"{value} AS {name}" for name, value in self.columns.items()))

    def sql(self) -> str:
        items = ", ".join(f"{value} AS {name}" for name, value in self.columns.items())
        where = f" WHERE {self.where}" if self.where else ""
        return f"SELECT {items} FROM {self.table}{where}"


def flag(condition: str) -> str:
    return f"cast({condition} AS int)"


def tenths(whole: str) -> str:
    return f"cast({whole} AS double) / 10"


ADAPTERS = {
    "b_sleep_apnea": Adapter("customer", {
        "age": "cast(18 + c_custkey % 70 AS double)",
        # few distinct profiles, so that keys repeat
        "bmi": tenths("150 + c_custkey % 25 * 10"),
        "diabetes": flag("c_custkey % 3 = 0"),
        "hypertension": flag("c_custkey % 4 = 0"),
        "gender_male": "cast(c_custkey % 2 AS int)",
        "neck_circumference": "CASE WHEN c_custkey % 9 = 4 THEN NULL ELSE cast(300 + c_custkey % 150 AS double) / 10 END",
        "smoking": flag("c_custkey % 5 = 0"),
        "alcohol_use": flag("c_custkey % 7 = 0"),
        "snoring": "CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE cast(c_nationkey % 2 AS int) END",
        "fatigue": flag("c_nationkey % 3 = 0"),
        "sleep_apnea": flag("c_acctbal < 0"),
        "record_id": "c_custkey + 1",
    }),
    "b_link": Adapter("orders", {
        "patientid": "cast(o_orderkey AS int)",
        "age": "cast(o_orderkey % 103 AS double)",
        "bmi": tenths("150 + (o_custkey * 7 + o_orderkey) % 250"),
        "glucose": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE cast(70 + o_orderkey % 130 AS double) END",
        "insulin": "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE cast(o_custkey % 200 AS double) / 4 END",
        "blood_pressure": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE cast(90 + o_orderkey % 80 AS double) END",
        "family_history": flag("o_custkey % 6 = 0"),
        "hypertension": "cast(o_orderkey % 2 AS int)",
        "sleep_apnea": "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE cast(o_orderkey % 3 = 0 AS int) END",
        "smoking": flag("o_orderkey % 5 = 0"),
        "gender_male": "cast(o_custkey % 2 AS int)",
        # nothing is known of the youngest band
        "diabetes": "CASE WHEN o_orderkey % 103 < 18 THEN NULL ELSE cast(o_custkey % 4 = 0 AS int) END",
        "record_id": "o_orderkey + 1",
    }),
    "b_prediction": Adapter("lineitem", {
        "gender": "CASE l_orderkey % 21 WHEN 0 THEN 'Other' WHEN 1 THEN ' male' "
                  "WHEN 2 THEN 'FEMALE ' ELSE CASE WHEN l_orderkey % 2 = 0 THEN 'Male' "
                  "ELSE 'Female' END END",
        "age": "cast(l_partkey % 80 AS double)",
        "hypertension": flag("l_linenumber % 4 = 0"),
        "heart_disease": flag("l_suppkey % 9 = 0"),
        "smoking_history": "CASE l_orderkey % 8 WHEN 0 THEN 'No Info' WHEN 1 THEN 'never' "
                           "WHEN 2 THEN 'current' WHEN 3 THEN 'former' WHEN 4 THEN 'ever' "
                           "WHEN 5 THEN 'not current' WHEN 6 THEN '' ELSE NULL END",
        "bmi": tenths("120 + (l_partkey * 3 + l_linenumber) % 330"),
        "hba1c_level": tenths("35 + l_orderkey % 56"),
        "blood_glucose_level": "cast(80 + l_partkey % 220 AS int)",
        "diabetes": flag("l_returnflag = 'R'"),
    }),
    "b_diabetes": Adapter("part", {
        "patientid": "cast(p_partkey AS int)",
        "age": "cast(20 + p_partkey % 70 AS int)",
        "gender": "cast(p_partkey % 2 AS string)",
        "bmi": tenths("150 + (p_partkey * 11) % 250"),
        "smoking": "cast(p_size % 2 AS int)",
        "alcoholconsumption": "cast(p_size AS double) / 3",
        "physicalactivity": "cast(p_partkey % 100 AS double) / 7",
        "dietquality": "cast(p_size AS double) / 6",
        "sleepquality": "cast(40 + p_size AS double) / 11",
        "hypertension": flag("p_partkey % 5 = 0"),
        "systolicbp": "cast(90 + p_partkey % 90 AS int)",
        "diastolicbp": "cast(60 + p_partkey % 60 AS int)",
        "fastingbloodsugar": "cast(70 + p_partkey % 130 AS double) / 1",
        "hba1c": tenths("40 + p_size % 60"),
        "cholesteroltotal": "cast(1050 + p_partkey % 1000 AS double) / 7",
        "cholesterolldl": "cast(350 + p_partkey % 1000 AS double) / 7",
        "cholesterolhdl": "cast(140 + p_partkey % 500 AS double) / 7",
        "cholesteroltriglycerides": "cast(350 + p_partkey % 2000 AS double) / 7",
        "familyhistorydiabetes": flag("p_partkey % 3 = 0"),
        "previousprediabetes": flag("p_partkey % 6 = 0"),
        "fatiguelevels": "cast(p_size AS double) / 5",
        "qualityoflifescore": "cast(p_partkey % 700 AS double) / 7",
        "diagnosis": flag("p_size > 30"),
        "doctorincharge": "'Confidential'",
        "record_id": "p_partkey + 1",
    }),
    "b_shl": Adapter("events", {
        "gender": "CASE WHEN event_id % 25 = 3 THEN 'x' WHEN event_id % 2 = 0 THEN 'Male' "
                  "ELSE ' female ' END",
        "age": "cast(27 + user_id % 33 AS int)",
        "occupation": "event_type",
        "sleep_duration": tenths("55 + event_id % 30"),
        "quality_of_sleep": "cast(4 + event_id % 6 AS int)",
        "physical_activity_level": "cast(30 + event_id % 61 AS int)",
        "stress_level": "cast(3 + user_id % 6 AS int)",
        "bmi_category": "CASE event_id % 5 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Normal Weight' "
                        "WHEN 2 THEN 'Overweight' WHEN 3 THEN 'obese' ELSE 'Other' END",
        "blood_pressure": "CASE WHEN event_id % 50 = 7 THEN 'n/a' WHEN event_id % 50 = 9 "
                          "THEN '120' ELSE concat(cast(110 + event_id % 40 AS string), '/', "
                          "cast(70 + event_id % 20 AS string)) END",
        "heart_rate": "cast(60 + event_id % 30 AS int)",
        "daily_steps": "cast(3000 + user_id * 10 AS int)",
        "sleep_disorder": "CASE event_id % 6 WHEN 0 THEN 'Sleep Apnea' WHEN 1 THEN 'Insomnia' "
                          "WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN 'Healthy' "
                          "ELSE 'None' END",
        "record_id": "event_id + 1",
    }),
    "b_sdb": Adapter("supplier", {
        "age": "cast(18 + s_suppkey % 70 AS int)",
        "gender": "CASE WHEN s_suppkey % 2 = 1 THEN 'Male' ELSE 'Female' END",
        "bmi": tenths("150 + s_suppkey % 5 * 10"),
        "snoring": "CASE WHEN s_suppkey % 3 = 0 THEN 'Yes' ELSE 'No' END",
        "oxygen_saturation": "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE cast(850 + s_suppkey % 140 AS double) / 10 END",
        "apnea_hypopnea_index_ahi": "CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE cast(s_suppkey % 60 AS int) END",
        "nasal_airflow_flow_rate": "cast(s_suppkey % 50 AS double) / 100",
        "chest_movement_effort": "cast(s_suppkey % 90 AS double) / 100",
        "ecg_heart_rate": "cast(60 + s_suppkey % 40 AS int)",
        "spo2_ratio": tenths("850 + s_suppkey % 150"),
        "position": "CASE s_suppkey % 3 WHEN 0 THEN 'Supine' WHEN 1 THEN 'Prone' "
                    "ELSE 'Lateral' END",
        "eeg_sleep_stage": "CASE s_suppkey % 4 WHEN 0 THEN 'REM' ELSE 'NREM' END",
        "diagnosis_of_sdb": "CASE WHEN s_suppkey % 4 = 0 THEN 'No' ELSE 'Yes' END",
        "severity": "CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Mild' "
                    "WHEN 2 THEN 'Moderate' WHEN 3 THEN 'None' ELSE 'Severe' END",
        "treatment": "CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'CPAP' "
                     "ELSE 'Surgery' END",
        "record_id": "s_suppkey + 1",
    }),
    "b_hyp": Adapter("orders", {
        "male": "cast(o_custkey % 2 AS int)",
        "age": "cast(30 + o_orderkey % 40 AS int)",
        "currentsmoker": "cast(o_orderkey % 2 AS int)",
        "cigsperday": "CASE WHEN o_orderkey % 13 = 0 THEN 'NA' "
                      "ELSE cast(o_orderkey % 30 AS string) END",
        "bpmeds": "CASE WHEN o_orderkey % 17 = 0 THEN 'NA' ELSE cast(o_custkey % 2 AS string) END",
        "diabetes": flag("o_custkey % 9 = 0"),
        "totchol": "CASE WHEN o_orderkey % 19 = 0 THEN NULL "
                   "ELSE cast(150 + o_custkey % 150 AS string) END",
        "sysbp": "cast(180 + o_orderkey % 240 AS double) / 2",
        "diabp": "cast(120 + o_orderkey % 100 AS double) / 2",
        "bmi": "CASE WHEN o_orderkey % 23 = 0 THEN 'NA' "
               "ELSE concat(cast(18 + o_custkey % 20 AS string), '.5') END",
        "heartrate": "CASE WHEN o_orderkey % 29 = 0 THEN NULL "
                     "ELSE cast(55 + o_custkey % 60 AS string) END",
        "glucose": "CASE WHEN o_orderkey % 11 = 0 THEN 'NA' "
                   "ELSE cast(60 + o_custkey % 110 AS string) END",
        "risk": flag("o_orderpriority = '1-URGENT'"),
        "record_id": "o_orderkey + 1",
    }),
    "b_agg": Adapter("part", {
        "ct": "cast(p_partkey AS int)",
        "bpad": "cast(p_size - 1 AS int)",
        "bpan": "cast(p_partkey % 40 AS int)",
        "bpan2": "cast(p_partkey % 30 AS int)",
        "bwad": "cast(p_size % 20 AS int)",
        "bwan": "cast(p_partkey % 20 AS int)",
        "bwan2": "cast(p_partkey % 15 AS int)",
        "bmad": "cast(p_size % 25 AS int)",
        "bman": "cast(p_partkey % 25 AS int)",
        "bman2": "cast(p_partkey % 12 AS int)",
    }),
    # one area in ten is unknown to the other table, so that the inner join drops some
    "b_aggh": Adapter("part", {
        "ct": "cast(CASE WHEN p_partkey % 10 = 0 THEN -p_partkey ELSE p_partkey END AS int)",
        "btpad": "cast((p_size - 1) % 7 AS int)",
        "btpan": "cast(p_partkey % 9 AS int)",
        "btwad": "cast(p_size % 5 AS int)",
        "btwan": "cast(p_partkey % 6 AS int)",
        "btmad": "cast(p_size % 6 AS int)",
        "btman": "cast(p_partkey % 5 AS int)",
    }),
}
