"""Dimensions, the observation fact and the six marts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, VarcharType

from somnolake import schemas
from somnolake.functions import keys, numeric, text
from somnolake.operators.impute import mean_default, modes_of, scalars_of
from somnolake.operators.joins import Skew, grid_lookup, skew_left_joins
from somnolake.operators.rollups import (
    Attached,
    Banded,
    fanout_rollup,
    mean_of,
    rate_pct,
    sum_units,
    units,
)
from somnolake.operators.windows import first_row_per, latest_row_per
from somnolake.sources.tables import STAMP, conform

KEY = "patient_key"

# --- dimensions -----------------------------------------------------------------------


def _literal(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    def value(item) -> str:
        return "NULL" if item is None else f"'{item}'" if isinstance(item, str) else str(item)

    schema = schemas.GOLD[name]
    lines = ", ".join("(" + ", ".join(map(value, row)) + ")" for row in rows)
    inline = spark.sql(f"SELECT * FROM VALUES {lines} AS t({', '.join(schema.names)})")
    return conform(inline, schema)


def dim_age_band(spark: SparkSession) -> DataFrame:
    return _literal(spark, "dim_age_band", list(numeric.AGE_BANDS))


def dim_bmi_category(spark: SparkSession) -> DataFrame:
    return _literal(spark, "dim_bmi_category", list(numeric.BMI_CATEGORIES))


def dim_disorder_type(spark: SparkSession) -> DataFrame:
    return _literal(spark, "dim_disorder_type", list(numeric.DISORDERS))


def dim_gender(spark: SparkSession) -> DataFrame:
    return _literal(spark, "dim_gender", list(numeric.GENDERS))


DIMENSIONS = {
    "dim_age_band": dim_age_band,
    "dim_bmi_category": dim_bmi_category,
    "dim_disorder_type": dim_disorder_type,
    "dim_gender": dim_gender,
}


def dim_patient(lifestyle: DataFrame, ids_unique: bool = False) -> DataFrame:
    """One row per record id of the lifestyle table: its latest load.

    ``ids_unique`` states that no id repeats, as after a full refresh, which saves the
    shuffle by id.
    """
    if not ids_unique:
        time = STAMP if STAMP in lifestyle.columns else KEY
        lifestyle = latest_row_per(lifestyle, "record_id", time, KEY)
    shaped = lifestyle.select(
        F.col("record_id").alias("person_id"),
        "gender",
        "age",
        numeric.age_band(F.col("age")).alias("age_band"),
        "occupation",
        text.bmi_mart_label(F.trim("bmi_category")).alias("bmi_category"),
        text.blank_to_unknown(F.col("sleep_disorder")).alias("sleep_disorder"),
    )
    return conform(shaped, schemas.GOLD["dim_patient"])


# --- fact -----------------------------------------------------------------------------


def _two(column: str, kind: str = "decimal(5,2)") -> str:
    return mean_default(column, 2, kind, scale=2)


# Means that fill missing values, as aggregates of the cleansed tables.  Decimals and
# types are fixed values.
MEANS = {
    "sleep_health_lifestyle": {
        "systolic_bp": mean_default("systolic_bp", 2, "decimal(6,2)"),
        "diastolic_bp": mean_default("diastolic_bp", 2, "decimal(6,2)"),
        "heart_rate": mean_default("heart_rate", 2, "decimal(6,2)"),
        "daily_steps": mean_default("daily_steps", 0, "int"),
        "sleep_duration_hrs": _two("sleep_duration_hrs", "decimal(4,2)"),
        "quality_of_sleep": mean_default("quality_of_sleep", 0, "int"),
        "stress_level": mean_default("stress_level", 0, "int"),
        "physical_activity_level": mean_default("physical_activity_level", 0, "int"),
    },
    "diabetes_detailed": {
        "hba1c": _two("hba1c"),
        "cholesterol_total": _two("cholesterol_total", "decimal(7,2)"),
        "cholesterol_ldl": _two("cholesterol_ldl", "decimal(7,2)"),
        "cholesterol_hdl": _two("cholesterol_hdl", "decimal(7,2)"),
        "alcohol_consumption": _two("alcohol_consumption"),
        "fatigue_level": mean_default("fatigue_level", 0, "int", scale=2),
        "diet_quality": _two("diet_quality"),
        "quality_of_life_score": _two("quality_of_life_score"),
    },
    "sleep_apnea_core": {
        "neck_circumference": mean_default("neck_circumference", 2, "decimal(5,2)", scale=1),
        # the rounded mean of a 0/1 flag is its majority value
        "snoring_flag": mean_default("snoring_flag", 0, "smallint"),
        "fatigue_flag": mean_default("fatigue_flag", 0, "smallint"),
        "alcohol_flag": mean_default("alcohol_flag", 0, "smallint"),
    },
    "sleep_disordered_breathing": {
        "oxygen_saturation": mean_default("oxygen_saturation", 2, "decimal(5,2)", scale=1),
        "apnea_hypopnea_index": _two("apnea_hypopnea_index", "decimal(6,2)"),
        "spo2_ratio": mean_default("spo2_ratio", 4, "decimal(7,4)", scale=1),
        "nasal_airflow_rate": mean_default("nasal_airflow_rate", 4, "decimal(7,4)", scale=2),
        "chest_movement_effort": mean_default("chest_movement_effort", 4, "decimal(7,4)", scale=2),
    },
}


def mean_defaults(rows: DataFrame, table: str) -> Column:
    """The means of a cleansed table as one struct-valued scalar."""
    return scalars_of(rows, **MEANS[table])


def _kind(table: str, column: str):
    return schemas.SILVER[table][column].dataType


def lowest_record_per_key(rows: DataFrame) -> DataFrame:
    return first_row_per(rows, [KEY], ["record_id"])


def largest_age() -> int:
    """The largest whole number of years that a link row's age can hold."""
    kind = _kind("diabetes_sleep_link", "age")
    return 10 ** (kind.precision - kind.scale) - 1


def first_lifestyle(lifestyle: DataFrame) -> DataFrame:
    """First record per age and gender.

    Only ages a link row can have are kept, which bounds the result: with four digits at
    most 19,999 ages times the three gender labels.
    """
    reachable = lifestyle.where(F.col("age").between(-largest_age(), largest_age()))
    return first_row_per(reachable, ["age", "gender"], ["record_id"])


def first_detailed(detailed: DataFrame) -> DataFrame:
    """First record per age, gender and whole-number BMI."""
    rounded = detailed.withColumn("bmi_whole", F.round("bmi", 0).cast("int"))
    return first_row_per(rounded, ["age", "gender", "bmi_whole"], ["record_id"])


def banded_link(link: DataFrame, ages: DataFrame, categories: DataFrame) -> DataFrame:
    """Link rows with the age band and BMI category they fall in, if any."""
    age_dim = ages.select("age_band_id", F.col("label").alias("age_label"), "age_min", "age_max")
    bmi_dim = categories.where(F.col("label") != text.UNKNOWN).select(
        "bmi_cat_id", F.col("label").alias("bmi_label"), "bmi_min", "bmi_max"
    )
    rows = grid_lookup(link, age_dim, "floor(age)", "age_min", "age_max", 1)
    rows = grid_lookup(rows, bmi_dim, "bmi", "bmi_min", "bmi_max", 10)
    return rows.withColumns({
        "age_band": F.coalesce("age_label", F.lit(text.UNKNOWN)),
        "bmi_category": F.coalesce("bmi_label", F.lit(text.UNKNOWN)),
    }).drop("age_label", "bmi_label", "age_min", "age_max", "bmi_min", "bmi_max")


def fact_patient_health_snapshot(
    link: DataFrame,
    apnea: DataFrame,
    breathing: DataFrame,
    lifestyle: DataFrame,
    detailed: DataFrame,
    ages: DataFrame,
    categories: DataFrame,
    dedup: bool = False,
    skew: Skew = Skew(),
    cast: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Every link row with its matches from four tables, missing measures filled.

    A link row stands once per pair of apnea and breathing rows of its key; ``dedup``
    keeps the lowest record of each key instead.  ``cast`` gives the fact's columns other
    types, each by itself and present values present ones; that is done before rows are repeated.
    """
    # means and modes are over all rows, also where the joins keep one per key
    defaults = {
        "sleep_health_lifestyle": fact_defaults(lifestyle, "sleep_health_lifestyle"),
        "diabetes_detailed": fact_defaults(detailed, "diabetes_detailed"),
        "sleep_apnea_core": fact_defaults(apnea, "sleep_apnea_core", cast),
        "sleep_disordered_breathing": fact_defaults(breathing, "sleep_disordered_breathing", cast),
    }

    def matches(side: DataFrame, table: str, *keys: str) -> DataFrame:
        return side.selectExpr(*keys, *fact_values(table))

    def filled(rows: DataFrame, tables: Sequence[str], names: Sequence[str]) -> DataFrame:
        """A missing match and a missing measure both take the table's default."""
        measures = {
            name: f"coalesce({name}, _default_{table}.{name}) AS {name}"
            for table in tables for name in FACT_SOURCES[table]
        }
        rows = rows.withColumns({f"_default_{table}": defaults[table] for table in tables})
        return rows.selectExpr(*(measures.get(name, name) for name in names))

    located = link.selectExpr(
        "*", "CAST(floor(age) AS int) AS _age", "CAST(round(bmi, 0) AS int) AS _bmi"
    )
    rows = banded_link(located, ages, categories)
    # The joins to at most one row come first, while the table is at its smallest.  Of such a
    # join adaptive execution splits the larger side by itself.
    life = matches(
        first_lifestyle(lifestyle), "sleep_health_lifestyle", "age AS _age", "gender"
    )
    rows = rows.join(F.broadcast(life), ["_age", "gender"], "left")
    detail = matches(
        first_detailed(detailed), "diabetes_detailed",
        "age AS _age", "gender", "bmi_whole AS _bmi",
    )
    rows = rows.join(detail, ["_age", "gender", "_bmi"], "left")
    rows = rows.withColumns({
        "patient_primarykey": keys.composite_key(F.col("bmi"), F.col("gender"), F.col("age")),
        "gender_male_flag": numeric.flag(F.col("gender") == text.MALE),
    })
    # What a link row has by itself is made and typed once, before the joins that repeat it.
    schema = schemas.GOLD["fact_patient_health_snapshot"]
    by_key = {"sleep_apnea_core": apnea, "sleep_disordered_breathing": breathing}
    later = {name for table in by_key for name in FACT_SOURCES[table]}
    own = StructType([field for field in schema if field.name not in later])
    rows = filled(rows, ("sleep_health_lifestyle", "diabetes_detailed"), (KEY, "record_id", *own.names))
    # All texts are labels, or columns of the cleansed tables no longer than these.
    rows = cast(conform(rows, own, (KEY, "record_id"), bounded=own.names))
    if dedup:
        for table, side in by_key.items():
            rows = rows.join(cast(matches(lowest_record_per_key(side), table, KEY)), KEY, "left")
    else:
        rows = skew_left_joins(
            rows,
            [(cast(matches(side, table, KEY, f"record_id AS _rid_{table}")), F.col(f"_rid_{table}"))
             for table, side in by_key.items()],
            [KEY], F.col("record_id"), counted=link, skew=skew,
        )
    return filled(rows, tuple(by_key), schema.names)


# Columns the fact takes from each table it joins: fact name -> cleansed name.
FACT_SOURCES = {
    "sleep_health_lifestyle": {
        name: name for name in (
            "occupation", "systolic_bp", "diastolic_bp", "heart_rate", "daily_steps",
            "sleep_duration_hrs", "quality_of_sleep", "stress_level", "physical_activity_level",
        )
    },
    "diabetes_detailed": {
        name: name for name in (
            "hba1c", "cholesterol_total", "cholesterol_ldl", "cholesterol_hdl",
            "alcohol_consumption", "fatigue_level", "diet_quality", "quality_of_life_score",
        )
    },
    "sleep_apnea_core": {
        name: name for name in (
            "neck_circumference", "snoring_flag", "fatigue_flag", "alcohol_flag",
        )
    },
    "sleep_disordered_breathing": {
        "oxygen_saturation": "oxygen_saturation",
        "ahi_score": "apnea_hypopnea_index",
        "spo2_ratio": "spo2_ratio",
        "eeg_sleep_stage": "eeg_sleep_stage",
        "nasal_airflow_rate": "nasal_airflow_rate",
        "chest_movement_effort": "chest_movement_effort",
        "sleep_position": "sleep_position",
    },
}


def _fact_kind(column: str) -> str:
    kind = schemas.GOLD["fact_patient_health_snapshot"][column].dataType
    return "string" if isinstance(kind, VarcharType) else kind.simpleString()


def fact_values(table: str) -> list[str]:
    """A joined table's columns in the fact's names and types.

    Made on the joined side, which is smaller, and before the join.
    """
    return [
        f"CAST({source} AS {_fact_kind(name)}) AS {name}"
        for name, source in FACT_SOURCES[table].items()
    ]


def fact_defaults(
    rows: DataFrame, table: str, cast: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> Column:
    """The defaults for a joined table's columns as one struct-valued scalar.

    A mean is first narrowed to the type of the cleansed column, then takes the type of
    the fact's column, by ``cast`` another one; text columns have their commonest value.
    """
    means = MEANS[table]
    modes, fields = [], []
    for name, source in FACT_SOURCES[table].items():
        if source in means:
            narrow = f"CAST({source} AS {_kind(table, source).simpleString()})"
            fields.append(f"CAST({narrow} AS {_fact_kind(name)}) AS {name}")
        else:
            modes.append(source)
            fields.append(f"_mode.{source} AS {name}")
    one_row = rows.agg(*(F.expr(value).alias(source) for source, value in means.items()))
    if modes:
        one_row = one_row.withColumn("_mode", modes_of(rows, modes))
    return cast(one_row.selectExpr(*fields)).select(F.struct("*").alias("defaults")).scalar()


# --- marts ----------------------------------------------------------------------------


def _observed(rows: DataFrame, **scales: int) -> Attached:
    """Sums and counts of the values present in each column; nothing where no row joins."""
    sums: dict[str, tuple[str, str]] = {}
    for column, scale in scales.items():
        sums[f"{column}__sum"] = (sum_units(column, scale), "0L")
        sums[f"{column}__n"] = (f"count({column})", "0L")
    return Attached(rows, sums)


def _base_sums(**scales: int) -> dict[str, str]:
    sums = {}
    for column, scale in scales.items():
        sums[f"{column}__sum"] = sum_units(column, scale)
        sums[f"{column}__n"] = f"count({column})"
    return sums


def _avg(column: str, scale: int, digits: int) -> str:
    return mean_of(f"{column}__sum", f"{column}__n", scale, digits)


def _imputed(rows: DataFrame, defaults: Column, **measures: tuple[str, int]) -> Attached:
    """Sums of columns with their typed defaults where the value or the row is missing."""
    sums = {}
    for column, (table, scale) in measures.items():
        default = typed_default(table, column)
        value = f"coalesce({column}, {default})"
        alone = f"CASE WHEN {default} IS NULL THEN 0L ELSE 1L END"
        sums[f"{column}__sum"] = (sum_units(value, scale), units(default, scale))
        sums[f"{column}__n"] = (f"count({value})", alone)
    return Attached(rows, sums, defaults)


def typed_default(table: str, column: str) -> str:
    """A field of the attached defaults, narrowed to the column it fills."""
    return f"CAST(_default.{column} AS {_kind(table, column).simpleString()})"


def _shaped(rolled: DataFrame, name: str, **values: str) -> DataFrame:
    """Add the mart's derived columns and conform to its schema."""
    added = [f"{value} AS {column}" for column, value in values.items()]
    return conform(rolled.selectExpr("*", *added), schemas.GOLD[name])


# Measures of the comorbidity mart taken from the attached tables: table and scale.
APNEA_MEASURES = {
    "neck_circumference": ("sleep_apnea_core", 1),
    "snoring_flag": ("sleep_apnea_core", 0),
    "fatigue_flag": ("sleep_apnea_core", 0),
}
BREATHING_MEASURES = {
    "apnea_hypopnea_index": ("sleep_disordered_breathing", 2),
    "oxygen_saturation": ("sleep_disordered_breathing", 1),
}


def mart_comorbidity_by_age(
    link: DataFrame,
    apnea: DataFrame,
    breathing: DataFrame,
    ages: DataFrame,
    dedup: bool = False,
) -> DataFrame:
    """Comorbidity counts, means and rates per age band of the observation fact.

    Computed from the fact's inputs without the fan-out; the lifestyle and detail joins
    of the fact add at most one row each, so they change nothing here.
    """
    age_dim = ages.select(F.col("label").alias("age_label"), "age_min", "age_max")
    years = link.selectExpr("*", "CAST(floor(age) AS int) AS _years")

    def band(grouped: DataFrame) -> DataFrame:
        found = grid_lookup(grouped, age_dim, "_years", "age_min", "age_max", 1)
        return found.withColumn("age_band", F.coalesce("age_label", F.lit(text.UNKNOWN))).drop(
            *age_dim.columns
        )

    defaults = (
        mean_defaults(apnea, "sleep_apnea_core"),
        mean_defaults(breathing, "sleep_disordered_breathing"),
    )
    if dedup:
        apnea, breathing = lowest_record_per_key(apnea), lowest_record_per_key(breathing)
    flags = {"diabetes_count": "diabetes_flag", "sleep_apnea_count": "sleep_apnea_flag",
             "hypertension_count": "hypertension_flag"}
    all_three = " AND ".join(f"{name} = 1" for name in flags.values())
    rolled = fanout_rollup(
        years, KEY, ["age_band"],
        {
            # a plain SUM: NULL where a group has no value
            **{count: f"sum({name})" for count, name in flags.items()},
            "all_three_count": f"count_if({all_three})",
            **_base_sums(bmi=1, glucose=2, blood_pressure=0),
        },
        [_imputed(apnea, defaults[0], **APNEA_MEASURES),
         _imputed(breathing, defaults[1], **BREATHING_MEASURES)],
        count_as="total_patients",
        banded=Banded(["_years"], band),
    )
    counts = [*flags, "all_three_count", "snoring_count", "fatigue_count"]
    renamed = rolled.withColumnsRenamed(
        {"snoring_flag__sum": "snoring_count", "fatigue_flag__sum": "fatigue_count"}
    )
    return _shaped(
        renamed, "mart_comorbidity_by_age",
        avg_bmi=_avg("bmi", 1, 2),
        avg_glucose=_avg("glucose", 2, 2),
        avg_blood_pressure=_avg("blood_pressure", 0, 2),
        avg_neck_circumference=_avg("neck_circumference", 1, 2),
        avg_ahi_score=_avg("apnea_hypopnea_index", 2, 2),
        avg_spo2=_avg("oxygen_saturation", 1, 2),
        **{
            name.replace("_count", "_rate_pct"): rate_pct(name, "total_patients")
            for name in counts
        },
    )


def mart_bmi_sleep_disorder(
    lifestyle: DataFrame, apnea: DataFrame, breathing: DataFrame
) -> DataFrame:
    """Sleep measures per BMI category and disorder.

    With the default midpoint keys nothing joins, so the joined means are NULL and the
    snoring rate is 0.
    """
    known = lifestyle.where(
        (F.col("sleep_disorder") != text.UNKNOWN) | F.col("sleep_disorder").isNull()
    ).withColumns({
        "bmi_category": text.bmi_mart_label(F.col("bmi_category")),
        "sleep_disorder": text.blank_to_unknown(F.col("sleep_disorder")),
    })
    rolled = fanout_rollup(
        known, KEY, ["bmi_category", "sleep_disorder"],
        _base_sums(sleep_duration_hrs=2, stress_level=0, systolic_bp=0, heart_rate=0),
        [_observed(apnea, neck_circumference=1, snoring_flag=0),
         _observed(breathing, apnea_hypopnea_index=2, oxygen_saturation=1)],
        count_as="patient_count",
    )
    return _shaped(
        rolled, "mart_bmi_sleep_disorder",
        avg_sleep_hrs=_avg("sleep_duration_hrs", 2, 2),
        avg_stress=_avg("stress_level", 0, 2),
        avg_systolic=_avg("systolic_bp", 0, 2),
        avg_heart_rate=_avg("heart_rate", 0, 2),
        avg_neck_circumference=_avg("neck_circumference", 1, 2),
        snoring_rate_pct=rate_pct("snoring_flag__sum", "patient_count"),
        avg_ahi_score=_avg("apnea_hypopnea_index", 2, 2),
        avg_oxygen_saturation=_avg("oxygen_saturation", 1, 2),
    )


def mart_occupation_risk(lifestyle: DataFrame, apnea: DataFrame) -> DataFrame:
    """Disorder counts, lifestyle means and rates per occupation."""
    def has(disorder: str) -> str:
        return f"count_if(sleep_disorder = '{disorder}')"

    rolled = fanout_rollup(
        lifestyle, KEY, ["occupation"],
        {
            "sleep_apnea_count": has("Sleep Apnea"),
            "insomnia_count": has("Insomnia"),
            **_base_sums(sleep_duration_hrs=2, stress_level=0, systolic_bp=0, daily_steps=0,
                         quality_of_sleep=0),
        },
        [_observed(apnea, neck_circumference=1, fatigue_flag=0)],
        count_as="total_patients",
    )
    return _shaped(
        rolled, "mart_occupation_risk",
        avg_sleep_hrs=_avg("sleep_duration_hrs", 2, 2),
        avg_stress=_avg("stress_level", 0, 2),
        avg_systolic=_avg("systolic_bp", 0, 2),
        avg_daily_steps=_avg("daily_steps", 0, 2),
        avg_quality_of_sleep=_avg("quality_of_sleep", 0, 2),
        avg_neck_circumference=_avg("neck_circumference", 1, 2),
        fatigue_rate_pct=rate_pct("fatigue_flag__sum", "total_patients"),
        sleep_apnea_rate_pct=rate_pct("sleep_apnea_count", "total_patients"),
        insomnia_rate_pct=rate_pct("insomnia_count", "total_patients"),
    )


def mart_clinical_severity(
    breathing: DataFrame, apnea: DataFrame, dedup: bool = False, skew: Skew = Skew()
) -> DataFrame:
    """Every breathing record with the apnea markers of its key."""
    if dedup:
        apnea = lowest_record_per_key(apnea)
    markers = apnea.select(
        KEY, F.col("record_id").alias("_rid"), "neck_circumference",
        F.col("snoring_flag").alias("snoring_mark"), "fatigue_flag",
    )
    if dedup:
        rows = breathing.join(markers, KEY, "left")
    else:
        rows = skew_left_joins(breathing, [(markers, F.col("_rid"))], [KEY], F.col("record_id"), skew=skew)
    shaped = rows.withColumns({
        "patient_id": F.col("record_id"),
        "bmi_category": numeric.bmi_band(F.col("bmi")),
        "snoring": F.col("snoring_mark"),
        "ahi_score": F.col("apnea_hypopnea_index"),
        "spo2_pct": F.col("oxygen_saturation"),
        "diagnosed_sdb": F.col("diagnosis_sdb"),
    })
    return conform(shaped, schemas.GOLD["mart_clinical_severity"])


# Cleansed name -> mart name.
EPIDEMIOLOGY_NAMES = {
    "bp_affected_diabetic": "bp_adult_diab",
    "bp_affected_non_diab": "bp_adult_nondiab",
    "bw_affected_diabetic": "bw_adult_diab",
    "bw_affected_non_diab": "bw_adult_nondiab",
    "bm_affected_diabetic": "bm_adult_diab",
    "bm_affected_non_diab": "bm_adult_nondiab",
    "both_affected_diabetic": "total_bp_diab_hyp",
    "both_affected_non_diab": "total_bp_nondiab_hyp",
    "both_bw_affected_diabetic": "total_bw_diab_hyp",
    "both_bw_affected_non_diab": "total_bw_nondiab_hyp",
    "both_bm_affected_diabetic": "total_bm_diab_hyp",
    "both_bm_affected_non_diab": "total_bm_nondiab_hyp",
}


def mart_epidemiology_combined(diabetes: DataFrame, hypertension: DataFrame) -> DataFrame:
    """Area counts of both extracts side by side, with the share that has both conditions."""
    drop = ["record_id", STAMP]
    rows = diabetes.drop(*drop).join(hypertension.drop(*drop), "area_code", "inner")
    overlap = numeric.guarded_ratio(
        F.col("both_affected_diabetic"), F.col("bp_affected_diabetic"), 4
    )
    shaped = rows.withColumns(
        {"census_tract": F.col("area_code").cast("bigint"), "diab_hyp_overlap_rate": overlap}
    ).withColumnsRenamed(EPIDEMIOLOGY_NAMES)
    return conform(shaped, schemas.GOLD["mart_epidemiology_combined"])


def mart_diabetes_risk_profile(
    prediction: DataFrame, detailed: DataFrame, apnea: DataFrame
) -> DataFrame:
    """Counts, means and rates per age band, gender and BMI band."""
    known = prediction.where(F.col("gender") != text.UNKNOWN)

    def band(grouped: DataFrame) -> DataFrame:
        return grouped.withColumns({
            "age_band": numeric.age_band(F.col("age")),
            "bmi_category": numeric.bmi_band(F.col("bmi")),
        }).drop("age", "bmi")

    rolled = fanout_rollup(
        known, KEY, ["age_band", "gender", "bmi_category"],
        {
            "diabetes_count": "sum(diabetes_flag)",
            "hypertension_count": "sum(hypertension_flag)",
            **_base_sums(hba1c_level=2, blood_glucose_level=0),
        },
        [_observed(detailed, cholesterol_total=2, cholesterol_ldl=2, cholesterol_hdl=2),
         _observed(apnea, sleep_apnea_flag=0, neck_circumference=1)],
        count_as="total",
        banded=Banded(["age", "gender", "bmi"], band),
    )
    return _shaped(
        rolled.withColumnRenamed("sleep_apnea_flag__sum", "sleep_apnea_count"),
        "mart_diabetes_risk_profile",
        avg_hba1c=_avg("hba1c_level", 2, 6),
        avg_glucose=_avg("blood_glucose_level", 0, 6),
        avg_cholesterol_total=_avg("cholesterol_total", 2, 2),
        avg_cholesterol_ldl=_avg("cholesterol_ldl", 2, 2),
        avg_cholesterol_hdl=_avg("cholesterol_hdl", 2, 2),
        avg_neck_circumference=_avg("neck_circumference", 1, 2),
        diabetes_rate_pct=rate_pct("diabetes_count", "total"),
        sleep_apnea_rate_pct=rate_pct("sleep_apnea_count", "total"),
    )
