"""The operators and tables of the warehouse, each run over whole test tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DecimalType, ShortType

from somnolake import schemas
from somnolake.checks.adapters import ADAPTERS
from somnolake.config import WarehouseConfig, scratch_path
from somnolake.functions import keys, numeric, text
from somnolake.operators import impute, quality, rollups
from somnolake.operators.identity import dense_id
from somnolake.operators.joins import grid_lookup, skew_left_joins
from somnolake.operators.windows import first_row_per, latest_row_per
from somnolake.plans import gold, jobs, silver, views
from somnolake.plans.runlog import RunLog
from somnolake.sources import tables
from somnolake.sources.csv import SOURCE_STYLES, read_csv

C = F.col
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Inputs:
    """Lazily built inputs over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        return ADAPTERS[name].rows(self.spark, self.folder)

    @cached_property
    def apnea(self) -> DataFrame:
        return silver.sleep_apnea_core(self.raw("b_sleep_apnea"))

    @cached_property
    def breathing(self) -> DataFrame:
        return silver.sleep_disordered_breathing(self.raw("b_sdb"))

    @cached_property
    def lifestyle(self) -> DataFrame:
        return silver.sleep_health_lifestyle(self.raw("b_shl"))

    @cached_property
    def sampled(self) -> DataFrame:
        return silver.sleep_lifestyle(self.raw("b_shl"))

    @cached_property
    def detailed(self) -> DataFrame:
        return silver.diabetes_detailed(self.raw("b_diabetes"))

    @cached_property
    def link(self) -> DataFrame:
        return silver.diabetes_sleep_link(self.raw("b_link"))

    @cached_property
    def prediction(self) -> DataFrame:
        return silver.diabetes_prediction(self.raw("b_prediction"))

    @cached_property
    def ages(self) -> DataFrame:
        return gold.dim_age_band(self.spark)

    @cached_property
    def categories(self) -> DataFrame:
        return gold.dim_bmi_category(self.spark)


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, counts as BIGINT and SMALLINT as INT, as two engines can compare them."""
    def swap(kind: DataType) -> str | None:
        if kind == schemas.COUNT:
            return "bigint"
        return {DecimalType: "double", ShortType: "int"}.get(type(kind))

    return rows.selectExpr(*(
        f"CAST({f.name} AS {swap(f.dataType)}) AS {f.name}" if swap(f.dataType) else f.name
        for f in rows.schema
    ))


def query(build: Callable[[Inputs], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Inputs(spark, folder)))

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


# --- sources and sinks ------------------------------------------------------------------


def _through_csv(t: Inputs, rows: DataFrame, schema, style: str, **options) -> DataFrame:
    """Write rows as a folder of CSV files in the given style and read them back."""
    path = scratch_path(t.spark, "csv")
    writer = rows.write.option("header", True).option("emptyValue", "")
    if style == "plain":
        writer = writer.option("quote", "")
    else:
        writer = writer.option("escape", '"').option("quoteAll", style == "quoted")
    for name in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(name, False)
    writer.csv(path)
    return tables.conform(read_csv(t.spark, path, schema, style, **options), schema)


@query
def src_csv_plain(t: Inputs) -> DataFrame:
    schema = schemas.BRONZE["diabetes_dataset_10k"]
    return _through_csv(t, t.raw("b_link").select(*schema.names), schema, "plain")


@query
def src_csv_quoted(t: Inputs) -> DataFrame:
    schema = schemas.table(
        doc_id=schemas.BIGINT, lang=schemas.TEXT, notes=schemas.TEXT, n_chars=schemas.BIGINT
    )
    notes = t.table("documents").select("doc_id", "lang", C("text").alias("notes"), "n_chars")
    return _through_csv(t, notes, schema, "quoted", multi_line=True)


@query
def src_csv_keepnulls(t: Inputs) -> DataFrame:
    schema = schemas.BRONZE["hypertension_risk"]
    return _through_csv(t, t.raw("b_hyp").select(*schema.names), schema, "keepnulls")


@query
def sink_full_refresh(t: Inputs) -> DataFrame:
    """Loading twice leaves one copy, also when the second load reads the first."""
    folder, table = scratch_path(t.spark, "refresh"), f"refresh_{uuid.uuid4().hex}"
    first = tables.full_refresh(t.spark, t.lifestyle, table, folder)
    return tables.full_refresh(t.spark, first, table, folder)


CONFORM_TARGET = schemas.table(
    record_id=schemas.BIGINT, age=schemas.dec(5, 1), bmi=schemas.dec(5, 2), glucose=schemas.INT,
    insulin=schemas.dec(7, 1), blood_pressure=schemas.text(10), diabetes=schemas.TINY,
)


@query
def sink_conform_schema(t: Inputs) -> DataFrame:
    return tables.conform(t.raw("b_link"), CONFORM_TARGET)


@query
def sink_parquet_roundtrip(t: Inputs) -> DataFrame:
    path = tables.write_refresh(t.prediction, scratch_path(t.spark, "parquet"))
    return t.spark.read.parquet(path)


@query
def sink_load_timestamp(t: Inputs) -> DataFrame:
    """Every row of a load carries the same time."""
    loaded = tables.stamped(t.lifestyle, datetime.datetime.now())
    return loaded.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(tables.STAMP).alias("load_times")
    )


@query
def job_run_log(t: Inputs) -> DataFrame:
    """Both area extracts taken from CSV to raw and cleansed Parquet, as the log tells it."""
    root = scratch_path(t.spark, "job")
    written = {}

    def run(layer: str, steps: dict[str, Callable[[], DataFrame]]) -> None:
        log = RunLog(t.spark, layer, root, "raise")
        for name, rows in steps.items():
            def write(loaded: DataFrame, name=name) -> None:
                written[name] = tables.write_refresh(loaded, f"{root}/{layer}/{name}")

            log.step(name, rows, write)
        log.finish()

    def extract(name: str, adapter: str) -> DataFrame:
        schema = schemas.BRONZE[name]
        return _through_csv(t, t.raw(adapter), schema, SOURCE_STYLES[name])

    def cleansed(name: str) -> DataFrame:
        return silver.LOADS[name](t.spark.read.parquet(written[silver.SOURCES[name]]))

    run("bronze", {
        "diabetes_all_2016": lambda: extract("diabetes_all_2016", "b_agg"),
        "diabetes_hypertension_2016": lambda: extract("diabetes_hypertension_2016", "b_aggh"),
    })
    areas = ("diabetes_aggregate_2016", "diabetes_hypertension_aggregate_2016")
    run("silver", {name: (lambda name=name: cleansed(name)) for name in areas})
    return t.spark.read.parquet(f"{root}/run_log").select("layer", "step", "rows", "status")


# Raw extract -> adapter that stands in for it.
STAND_INS = {
    "diabetes_data": "b_diabetes",
    "diabetes_dataset_10k": "b_link",
    "diabetes_prediction": "b_prediction",
    "enhanced_sleep_sdb": "b_sdb",
    "sleep_apnea_dataset": "b_sleep_apnea",
    "diabetes_all_2016": "b_agg",
    "diabetes_hypertension_2016": "b_aggh",
    "hypertension_risk": "b_hyp",
    "sleep_data_sampled": "b_shl",
    "sleep_health_lifestyle": "b_shl",
}


def write_extracts(spark: SparkSession, folder: str, target: str) -> None:
    """All ten raw extracts as folders of CSV files, from the test tables in ``folder``."""
    for name, adapter in STAND_INS.items():
        rows = ADAPTERS[adapter].rows(spark, folder)
        columns = [
            C(f.name) if f.name in rows.columns else F.lit(None).cast("string").alias(f.name)
            for f in schemas.BRONZE[name]
        ]
        writer = rows.select(*columns).write.option("header", True).option("emptyValue", "")
        for option in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
            writer = writer.option(option, False)
        writer.csv(f"{target}/{name}.csv")


def _jobs(t: Inputs, *layers: Callable[[SparkSession, WarehouseConfig], bool]) -> WarehouseConfig:
    """Run the load jobs over all ten extracts, in databases of their own."""
    source = scratch_path(t.spark, "extracts")
    write_extracts(t.spark, t.folder, source)
    prefix = f"run_{uuid.uuid4().hex}_"
    config = WarehouseConfig(source, scratch_path(t.spark, "lake"), prefix=prefix)
    for layer in layers:
        layer(t.spark, config)
    return config


@query
def job_bronze(t: Inputs) -> DataFrame:
    """The raw load, as the stored link extract shows it."""
    config = _jobs(t, jobs.run_bronze)
    return t.spark.table(config.table("bronze", "diabetes_dataset_10k"))


@query
def job_silver(t: Inputs) -> DataFrame:
    """The raw and the cleansing load, as the stored link table shows them."""
    config = _jobs(t, jobs.run_bronze, jobs.run_silver)
    stored = t.spark.table(config.table("silver", "diabetes_sleep_link"))
    return stored.drop("record_id", tables.STAMP)


@query
def job_gold(t: Inputs) -> DataFrame:
    """All three loads, as the stored comorbidity mart shows them."""
    config = _jobs(t, jobs.run_bronze, jobs.run_silver, jobs.run_gold)
    return t.spark.table(config.table("gold", "mart_comorbidity_by_age")).drop(tables.STAMP)


@query
def dim_age_band(t: Inputs) -> DataFrame:
    """The seeded dimension with the observations that fall in each band."""
    return quality.usage(t.ages, "age_band_id", _aged(t), "age_band_id")


@query
def dim_bmi_category(t: Inputs) -> DataFrame:
    banded = gold.banded_link(t.link, t.ages, t.categories)
    return quality.usage(t.categories, "bmi_cat_id", banded, "bmi_cat_id")


@query
def dim_disorder_type(t: Inputs) -> DataFrame:
    """No row is labelled Healthy: the cleansed tables write None for it."""
    return quality.usage(gold.dim_disorder_type(t.spark), "label", t.sampled, "sleep_disorder")


@query
def dim_gender(t: Inputs) -> DataFrame:
    return quality.usage(gold.dim_gender(t.spark), "label", t.prediction, "gender")


# --- projections and filters --------------------------------------------------------------


@query
def prj_rename_cast(t: Inputs) -> DataFrame:
    return silver.diabetes_aggregate_2016(t.raw("b_agg"))


@query
def prj_column_subset(t: Inputs) -> DataFrame:
    return t.raw("b_diabetes").drop("doctorincharge")


@query
def prj_decode_binary(t: Inputs) -> DataFrame:
    return t.raw("b_link").select(
        "record_id", text.gender_from_male_flag(C("gender_male")).alias("gender")
    )


@query
def prj_gender_canonical(t: Inputs) -> DataFrame:
    return t.raw("b_prediction").select(
        C("gender").alias("raw_gender"), text.gender_canonical(C("gender")).alias("gender")
    )


@query
def prj_bmi_label(t: Inputs) -> DataFrame:
    label = text.bmi_label(C("bmi_category"))
    return t.raw("b_shl").select(
        "record_id", label.alias("bmi_category"), text.bmi_mart_label(label).alias("mart_label"),
        text.bmi_mart_label(F.trim("bmi_category")).alias("raw_mart_label"),
    )


@query
def prj_disorder_a(t: Inputs) -> DataFrame:
    return t.raw("b_shl").select(
        "record_id", text.disorder_sampled(C("sleep_disorder")).alias("sleep_disorder")
    )


@query
def prj_disorder_b(t: Inputs) -> DataFrame:
    return t.raw("b_shl").select(
        "record_id", text.disorder_clinical(C("sleep_disorder")).alias("sleep_disorder"),
        text.blank_to_unknown(C("sleep_disorder")).alias("mart_disorder"),
    )


@query
def prj_split_bp(t: Inputs) -> DataFrame:
    systolic, diastolic = text.split_reading(C("blood_pressure"))
    return t.raw("b_shl").select(
        "record_id", systolic.alias("systolic_bp"), diastolic.alias("diastolic_bp")
    )


@query
def prj_smoking_vocab(t: Inputs) -> DataFrame:
    return t.raw("b_prediction").select(
        C("smoking_history").alias("raw_history"),
        text.smoking_label(C("smoking_history")).alias("smoking_history"),
    )


@query
def prj_round_scale(t: Inputs) -> DataFrame:
    return t.raw("b_diabetes").select(
        "record_id",
        *(numeric.round_decimal(C(source), 2, "decimal(7,2)").alias(written)
          for source, written in silver.ROUNDED_MEASURES.items()),
    )


@query
def prj_try_cast(t: Inputs) -> DataFrame:
    return t.raw("b_hyp").select(
        "record_id",
        numeric.try_int(C("cigsperday")).alias("cigs"),
        numeric.try_int(C("bpmeds")).alias("bpmeds"),
        # a fraction is no whole number
        numeric.try_int(C("bmi")).alias("bmi_whole"),
        numeric.try_float(C("bmi")).alias("bmi"),
        numeric.try_float(C("totchol")).alias("totchol"),
        numeric.try_float(C("glucose")).alias("glucose"),
    )


@query
def band_age_case(t: Inputs) -> DataFrame:
    return t.raw("b_link").select("record_id", numeric.age_band(C("age")).alias("age_band"))


@query
def band_bmi_case(t: Inputs) -> DataFrame:
    return t.raw("b_prediction").select("bmi", numeric.bmi_band(C("bmi")).alias("bmi_category"))


@query
def prj_flag(t: Inputs) -> DataFrame:
    return t.link.select(
        "record_id", numeric.flag(C("gender") == text.MALE).alias("gender_male_flag")
    )


@query
def prj_guarded_ratio(t: Inputs) -> DataFrame:
    rows = t.raw("b_agg").join(t.raw("b_aggh"), "ct", "inner")
    return rows.select("ct", numeric.guarded_ratio(C("btpad"), C("bpad"), 4).alias("ratio"))


@query
def prj_narrowing(t: Inputs) -> DataFrame:
    flag = (C("severity") == "Mild").cast("smallint")
    return t.breathing.select(
        "record_id",
        # the index halved has a fraction for the cast to cut
        (C("apnea_hypopnea_index") / 2).cast("decimal(6,2)").cast("int").alias("ahi_score"),
        C("oxygen_saturation").cast("double").cast("int").alias("oxygen_whole"),
        C("spo2_ratio").cast("string").alias("spo2_text"),
        flag.cast("string").alias("mild_text"),
    )


@query
def flt_not_unknown_or_null(t: Inputs) -> DataFrame:
    """Three-valued: the NULL rows are asked for, the blank ones (Unknown) are not."""
    blank = F.trim("sleep_disorder") == ""
    label = F.when(blank, F.lit(text.UNKNOWN)).otherwise(C("sleep_disorder"))
    return (
        t.raw("b_shl")
        .select("record_id", label.alias("sleep_disorder"))
        .where((C("sleep_disorder") != text.UNKNOWN) | C("sleep_disorder").isNull())
    )


@query
def flt_neq(t: Inputs) -> DataFrame:
    return t.prediction.where(C("gender") != text.UNKNOWN).select(
        "patient_key", "gender", "age", "bmi"
    )


@query
def flt_not_null(t: Inputs) -> DataFrame:
    return (
        t.raw("b_hyp")
        .where((C("currentsmoker") == 1) & C("totchol").isNotNull())
        .select("record_id", "cigsperday", "totchol")
    )


# --- keys -----------------------------------------------------------------------------------


@query
def key_patient_md5(t: Inputs) -> DataFrame:
    gender = text.gender_from_male_flag(C("gender_male"))
    return t.raw("b_link").select(
        "record_id",
        keys.number_text(C("bmi")).alias("bmi_text"),
        keys.patient_key(C("age"), gender, keys.number_text(C("bmi"))).alias("patient_key"),
    )


@query
def key_patient_midpoint(t: Inputs) -> DataFrame:
    gender = text.gender_in_key(C("gender"))
    category = C("bmi_category")
    return t.raw("b_shl").select(
        "record_id",
        keys.patient_key(C("age"), gender, keys.midpoint_text(category)).alias("patient_key"),
        keys.patient_key(C("age"), gender, keys.midpoint_text(category, numeric=True)).alias(
            "numeric_key"
        ),
    )


@query
def key_dense_id(t: Inputs) -> DataFrame:
    return dense_id(t.table("lineitem")).select(
        "record_id", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )


@query
def key_composite(t: Inputs) -> DataFrame:
    return t.link.select(
        "record_id",
        keys.composite_key(C("bmi"), C("gender"), C("age")).alias("patient_primarykey"),
    )


# --- imputation -----------------------------------------------------------------------------


@query
def imp_constant(t: Inputs) -> DataFrame:
    return t.breathing.select("record_id", "severity", "treatment")


@query
def imp_mean_float(t: Inputs) -> DataFrame:
    raw = t.raw("b_hyp")
    filled = {"bmi": "bmi", "totchol": "total_cholesterol", "glucose": "glucose"}
    return raw.withColumn("d", silver.hypertension_defaults(raw)).select(
        "record_id",
        *(F.round(F.coalesce(numeric.try_float(C(name)), C(f"d.{field}")), 4).alias(field)
          for name, field in filled.items()),
    )


@query
def imp_mean_int(t: Inputs) -> DataFrame:
    raw = t.raw("b_hyp")
    default = C("d.heart_rate")
    return raw.withColumn("d", silver.hypertension_defaults(raw)).select(
        "record_id", F.coalesce(numeric.try_int(C("heartrate")), default).alias("heart_rate")
    )


@query
def imp_mean_conditional(t: Inputs) -> DataFrame:
    raw = t.raw("b_hyp")
    default = silver.smoking_default(C("d.smoker_cigs"))
    return raw.withColumn("d", silver.hypertension_defaults(raw)).select(
        "record_id", F.coalesce(numeric.try_int(C("cigsperday")), default).alias("cigs_per_day")
    )


@query
def imp_cross_table_means(t: Inputs) -> DataFrame:
    """Every default of the fact, in the type its column takes, next to the rows to fill."""
    sources = {
        "sleep_health_lifestyle": t.lifestyle,
        "diabetes_detailed": t.detailed,
        "sleep_apnea_core": t.apnea,
        "sleep_disordered_breathing": t.breathing,
    }
    defaults = {table: gold.mean_defaults(rows, table) for table, rows in sources.items()}
    columns: dict[str, Column] = {}
    for table, means in gold.MEANS.items():
        for name in means:
            kind = schemas.SILVER[table][name].dataType
            columns[f"{name}_mean"] = C(f"{table}.{name}")
            columns[f"{name}_default"] = C(f"{table}.{name}").cast(kind)
    counted = t.link.agg(F.count(F.lit(1)).alias("link_rows")).withColumns(defaults)
    return counted.select("link_rows", *(value.alias(n) for n, value in columns.items()))


@query
def imp_mode(t: Inputs) -> DataFrame:
    """NULL and blank disorders are values of their own."""
    raw = t.raw("b_shl")
    return raw.agg(F.count(F.lit(1)).alias("rows")).withColumns({
        "mode_occupation": impute.mode_default(raw, "occupation"),
        "mode_disorder": impute.mode_default(raw, "sleep_disorder"),
    })


@query
def imp_flag_majority(t: Inputs) -> DataFrame:
    counted = t.apnea.agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("d", gold.mean_defaults(t.apnea, "sleep_apnea_core")).select(
        "rows", "d.snoring_flag", "d.fatigue_flag", "d.alcohol_flag"
    )


@query
def imp_typed_isnull(t: Inputs) -> DataFrame:
    rows = t.lifestyle.withColumn(
        "d", gold.mean_defaults(t.lifestyle, "sleep_health_lifestyle")
    )
    return rows.select(
        "record_id",
        *(numeric.isnull_typed(C(name), C(f"d.{name}"), "smallint").alias(name)
          for name in ("systolic_bp", "diastolic_bp")),
        C("systolic_bp").isNull().cast("int").alias("was_missing"),
    )


@query
def imp_median(t: Inputs) -> DataFrame:
    raw = t.raw("b_hyp")
    glucose, bmi = numeric.try_float(C("glucose")), numeric.try_float(C("bmi"))
    middle = impute.exact_median(raw, glucose, 6, 1).scalar()
    bmi_middle = impute.exact_median(raw, bmi, 5, 2).scalar()
    return raw.select(
        "record_id",
        F.coalesce(glucose, middle).alias("glucose"),
        F.coalesce(bmi, bmi_middle).alias("bmi"),
    )


@query
def imp_median_double(t: Inputs) -> DataFrame:
    """The median of a DOUBLE column, as it is."""
    raw = t.raw("b_link")
    middle = impute.median(raw, C("insulin")).scalar()
    return raw.select("record_id", F.coalesce("insulin", middle).alias("insulin"))


# Fixed value: numbers of up to eighteen digits, four of them decimals.
WIDE_NUMBER = """cast(concat(cast(l_partkey * 7919 + l_orderkey * 104729 AS string), '.',
    lpad(cast(l_suppkey * 37 % 10000 AS string), 4, '0')) AS decimal(18,4))"""


@query
def imp_median_decimal(t: Inputs) -> DataFrame:
    """The median of DECIMAL(18,4) values by return flag, in ten-thousandths doubled."""
    rows = t.table("lineitem").select("l_returnflag", F.expr(WIDE_NUMBER).alias("amount"))
    lines = [
        impute.median(rows.where(C("l_returnflag") == mark), C("amount")).select(
            F.lit(mark).alias("l_returnflag"), (C("median") * 20000).cast("bigint").alias("twice")
        )
        for mark in ("A", "N", "R")
    ]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


@query
def imp_flags(t: Inputs) -> DataFrame:
    return views.hypertension_with_flags(t.raw("b_hyp")).select(
        "record_id", "bmi_imputed", "cigsperday_imputed", "bpmeds_imputed", "totchol_imputed",
        "heartrate_imputed", "glucose_imputed",
    )


# --- joins ----------------------------------------------------------------------------------


@query
def join_inner(t: Inputs) -> DataFrame:
    left = silver.diabetes_aggregate_2016(t.raw("b_agg"))
    right = silver.diabetes_hypertension_aggregate_2016(t.raw("b_aggh"))
    return left.join(right, "area_code", "inner").select(
        "area_code", "bp_affected_diabetic", "both_affected_diabetic"
    )


@query
def join_left_fanout(t: Inputs) -> DataFrame:
    """Every match of a key is kept, on both joined tables."""
    # typed here, as a row is repeated after this
    people = plain(t.prediction.select(
        F.monotonically_increasing_id().alias("_row"), "patient_key", "gender", "diabetes_flag"
    ))
    detailed = plain(t.detailed.select(
        "patient_key", C("record_id").alias("detailed_id"), "cholesterol_total"
    ))
    apnea = plain(t.apnea.select("patient_key", C("record_id").alias("apnea_id"), "neck_circumference"))
    key = ["patient_key"]
    sides = [(detailed, C("detailed_id")), (apnea, C("apnea_id"))]
    return skew_left_joins(people, sides, key, C("_row"), counted=t.prediction).drop("_row")


def _aged(t: Inputs) -> DataFrame:
    return grid_lookup(t.link, t.ages, "floor(age)", "age_min", "age_max", 1)


@query
def join_range_age(t: Inputs) -> DataFrame:
    """Ages over 99 meet no band."""
    return _aged(t).select(
        "record_id", "age", "age_band_id", F.coalesce("label", F.lit(text.UNKNOWN)).alias("label")
    )


@query
def join_range_bmi(t: Inputs) -> DataFrame:
    rows = gold.banded_link(t.link, t.ages, t.categories)
    return rows.select("record_id", "bmi", "bmi_cat_id", "bmi_category")


@query
def join_range_gaps(t: Inputs) -> DataFrame:
    """Values of two decimals: those between two categories, as 24.95, meet none."""
    rows = t.table("orders").selectExpr(
        "o_orderkey AS record_id", "CAST((1500 + (o_orderkey * 7) % 9000) / 100.0 AS decimal(6,2)) AS bmi"
    )
    bands = t.categories.where(C("label") != text.UNKNOWN).select("label", "bmi_min", "bmi_max")
    return grid_lookup(rows, bands, "bmi", "bmi_min", "bmi_max", 10).select("record_id", "bmi", "label")


@query
def join_left_first_row(t: Inputs) -> DataFrame:
    first = gold.first_lifestyle(t.lifestyle).select(
        C("age").alias("_age"), "gender", C("record_id").alias("first_id"), "occupation"
    )
    rows = t.link.withColumn("_age", F.floor("age").cast("int"))
    return rows.join(F.broadcast(first), ["_age", "gender"], "left").select(
        "record_id", "gender", "age", "first_id", "occupation"
    )


@query
def join_left_computed_key(t: Inputs) -> DataFrame:
    first = gold.first_detailed(t.detailed).select(
        C("age").alias("_age"), "gender", C("bmi_whole").alias("_bmi"),
        C("record_id").alias("first_id"), "hba1c",
    )
    rows = t.link.withColumns({
        "_age": F.floor("age").cast("int"), "_bmi": F.round("bmi", 0).cast("int")
    })
    joined = rows.join(first, ["_age", "gender", "_bmi"], "left")
    return joined.select("record_id", "gender", "age", "bmi", "first_id", "hba1c")


@query
def join_scalar_subquery(t: Inputs) -> DataFrame:
    raw = t.raw("b_hyp")
    glucose = numeric.try_float(C("glucose"))
    mean_glucose = raw.agg(F.avg(glucose).alias("m")).scalar()
    return raw.withColumn("m", mean_glucose).select(
        "record_id",
        F.round("m", 4).alias("mean_glucose"),
        (glucose > C("m")).cast("int").alias("above_mean"),
    )


# --- aggregation ----------------------------------------------------------------------------


def _banded(t: Inputs) -> DataFrame:
    return t.link.withColumn("age_band", numeric.age_band(C("age")))


@query
def agg_count(t: Inputs) -> DataFrame:
    return _banded(t).groupBy("age_band").agg(F.count(F.lit(1)).alias("total"))


@query
def agg_sum_flag(t: Inputs) -> DataFrame:
    return _banded(t).groupBy("age_band").agg(
        F.sum("diabetes_flag").alias("diabetes_count"),
        F.sum("sleep_apnea_flag").alias("sleep_apnea_count"),
    )


@query
def agg_conditional(t: Inputs) -> DataFrame:
    both = (C("diabetes_flag") == 1) & (C("sleep_apnea_flag") == 1)
    return _banded(t).groupBy("age_band").agg(
        F.count_if(both).alias("both_count"),
        F.count_if(both & (C("hypertension_flag") == 1)).alias("all_three_count"),
    )


@query
def agg_avg_round(t: Inputs) -> DataFrame:
    return _banded(t).groupBy("age_band").agg(
        F.expr(rollups.mean("bmi", 2, scale=1)).alias("avg_bmi"),
        F.expr(rollups.mean("glucose", 6, scale=2)).alias("avg_glucose"),
        F.expr(rollups.mean("blood_pressure", 2)).alias("avg_blood_pressure"),
    )


@query
def agg_rate_pct(t: Inputs) -> DataFrame:
    return _banded(t).groupBy("age_band").agg(*(
        F.expr(rollups.rate_pct(f"sum({name}_flag)", "count(1)")).alias(
            f"{name}_rate_pct"
        )
        for name in ("diabetes", "smoking")
    ))


@query
def agg_group_multi(t: Inputs) -> DataFrame:
    return t.prediction.groupBy("gender", "smoking_history", "hypertension_flag").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("diabetes_flag").alias("diabetes_count"),
    )


@query
def agg_group_expr(t: Inputs) -> DataFrame:
    raw = t.raw("b_shl")
    return raw.groupBy(
        text.bmi_mart_label(C("bmi_category")).alias("bmi_category"),
        text.blank_to_unknown(C("sleep_disorder")).alias("sleep_disorder"),
    ).agg(F.count(F.lit(1)).alias("total"))


@query
def agg_global(t: Inputs) -> DataFrame:
    return t.lifestyle.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(rollups.mean("systolic_bp", 2)).alias("avg_systolic"),
        F.expr(rollups.mean("sleep_duration_hrs", 2, scale=2)).alias("avg_sleep"),
        F.expr(rollups.mean("daily_steps", 0)).alias("avg_steps"),
        F.min("age").alias("youngest"),
    )


# --- window, sort, limit --------------------------------------------------------------------


@query
def win_latest_row(t: Inputs) -> DataFrame:
    return latest_row_per(t.table("events"), "user_id", "ts", "event_id").select(
        "user_id", "event_id", "event_type"
    )


@query
def win_first_row(t: Inputs) -> DataFrame:
    return first_row_per(t.lifestyle, ["age", "gender"], ["record_id"]).select(
        "age", "gender", "record_id", "occupation", "heart_rate"
    )


@query
def win_first_row_expr(t: Inputs) -> DataFrame:
    return gold.first_detailed(t.detailed).select(
        "age", "gender", "bmi_whole", "record_id", "hba1c"
    )


@query
def sort_by_min(t: Inputs) -> DataFrame:
    groups = _banded(t).groupBy("age_band").agg(
        F.count(F.lit(1)).alias("total"), F.min("age").alias("youngest")
    )
    return groups.orderBy("youngest")


@query
def topk_1(t: Inputs) -> DataFrame:
    return impute.most_frequent(t.lifestyle, "occupation")


# --- scalar functions -----------------------------------------------------------------------


@query
def fn_string_case_trim(t: Inputs) -> DataFrame:
    return t.raw("b_prediction").select(
        C("gender").alias("raw"),
        F.upper("gender").alias("upper_text"),
        F.lower("gender").alias("lower_text"),
        F.trim("gender").alias("trimmed"),
        text.tidy(C("gender")).alias("tidy_text"),
    )


@query
def fn_string_slice(t: Inputs) -> DataFrame:
    reading = C("blood_pressure")
    return t.raw("b_shl").select(
        "record_id",
        F.left(reading, F.lit(3)).alias("first_three"),
        F.substring(reading, 2, 4).alias("middle"),
        F.length(F.rtrim(reading)).alias("text_length"),
        F.instr(reading, "/").alias("slash_at"),
    )


@query
def fn_concat_nulls(t: Inputs) -> DataFrame:
    parts = [C("occupation"), F.lit("_"), C("sleep_disorder")]
    return t.raw("b_shl").select(
        "record_id",
        text.concat_blank(*parts).alias("blank_for_null"),
        F.concat(*parts).alias("null_if_any"),
    )


@query
def fn_cast(t: Inputs) -> DataFrame:
    return t.table("orders").select(
        "o_orderkey",
        C("o_orderkey").cast("string").alias("key_text"),
        C("o_totalprice").cast("int").alias("price_whole"),
        C("o_totalprice").cast("decimal(12,1)").alias("price_tenths"),
        C("o_custkey").cast("double").alias("customer_float"),
        C("o_orderkey").cast("string").cast("bigint").alias("key_again"),
    )


@query
def fn_round_floor(t: Inputs) -> DataFrame:
    price = C("l_extendedprice")
    return t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(price / 7, 2).alias("price_two"),
        F.round(C("l_quantity") / 2, 0).alias("half_up"),
        F.round(-C("l_quantity") / 2, 0).alias("half_away"),
        F.floor(price / 7).alias("price_floor"),
    )


@query
def fn_nulls(t: Inputs) -> DataFrame:
    disorder = C("sleep_disorder")
    return t.raw("b_shl").select(
        "record_id",
        F.nullif(disorder, F.lit("")).alias("blank_is_null"),
        F.coalesce(disorder, F.lit("Unknown")).alias("null_is_unknown"),
        text.blank_to_unknown(disorder).alias("both"),
    )


@query
def fn_elapsed_seconds(t: Inputs) -> DataFrame:
    midnight = C("ts").cast("date").cast("timestamp_ntz")
    return t.table("events").select(
        "event_id", numeric.elapsed_seconds(midnight, C("ts")).alias("seconds_of_day")
    )


# --- data quality ---------------------------------------------------------------------------

RANGE_RULES = {"systolic_bp": (70, 140), "diastolic_bp": (40, 85), "heart_rate": (61, 88)}


@query
def dq_dedup(t: Inputs) -> DataFrame:
    declared = ["gender", "age", "occupation", "quality_of_sleep", "stress_level", "bmi_category"]
    return quality.deduplicate(t.lifestyle, declared, "record_id")


@query
def dq_range_check(t: Inputs) -> DataFrame:
    passed, quarantined = quality.range_split(t.lifestyle, RANGE_RULES)
    named = passed.withColumn("broken", F.lit("")).unionByName(quarantined)
    return named.groupBy("broken").agg(
        F.count(F.lit(1)).alias("rows"), F.min("record_id").alias("first_id")
    )


@query
def dq_null_profile(t: Inputs) -> DataFrame:
    return quality.null_profile(t.raw("b_hyp"), {
        "cigsperday": numeric.try_int(C("cigsperday")),
        "bpmeds": numeric.try_int(C("bpmeds")),
        "totchol": numeric.try_float(C("totchol")),
        "bmi": numeric.try_float(C("bmi")),
        "heartrate": numeric.try_int(C("heartrate")),
        "glucose": numeric.try_float(C("glucose")),
    })


@query
def dq_pk_unique(t: Inputs) -> DataFrame:
    return quality.key_report(silver.diabetes_aggregate_2016(t.raw("b_agg")), "area_code")


@query
def dq_fk_orphans(t: Inputs) -> DataFrame:
    return quality.orphans(t.table("lineitem"), "l_orderkey", t.table("orders"), "o_orderkey")


@query
def dq_fk_orphans_found(t: Inputs) -> DataFrame:
    """Parts of order lines that no supplier shares a number with: most of them."""
    return quality.orphans(t.table("lineitem"), "l_partkey", t.table("supplier"), "s_suppkey")


@query
def dq_join_fanout(t: Inputs) -> DataFrame:
    sides = [t.detailed, t.apnea]
    return quality.fanout_audit(t.prediction, sides, "patient_key")


# --- cleansed tables ------------------------------------------------------------------------

CLEANSED = {
    "sleep_apnea_core": "b_sleep_apnea",
    "sleep_lifestyle": "b_shl",
    "sleep_health_lifestyle": "b_shl",
    "sleep_disordered_breathing": "b_sdb",
    "diabetes_detailed": "b_diabetes",
    "diabetes_sleep_link": "b_link",
    "diabetes_prediction": "b_prediction",
    "hypertension_risk": "b_hyp",
    "diabetes_aggregate_2016": "b_agg",
    "diabetes_hypertension_aggregate_2016": "b_aggh",
}


def _cleansed(name: str, adapter: str) -> None:
    def build(t: Inputs) -> DataFrame:
        return silver.LOADS[name](t.raw(adapter))

    build.__name__ = f"silver_{name}"
    query(build)


for _name, _adapter in CLEANSED.items():
    _cleansed(_name, _adapter)


# --- analytical tables ----------------------------------------------------------------------


@query
def dim_patient(t: Inputs) -> DataFrame:
    return gold.dim_patient(t.lifestyle)


@query
def fact_patient_health_snapshot(t: Inputs) -> DataFrame:
    return gold.fact_patient_health_snapshot(
        t.link, t.apnea, t.breathing, t.lifestyle, t.detailed, t.ages, t.categories, cast=plain
    )


@query
def mart_comorbidity_by_age(t: Inputs) -> DataFrame:
    return gold.mart_comorbidity_by_age(t.link, t.apnea, t.breathing, t.ages)


@query
def mart_bmi_sleep_disorder(t: Inputs) -> DataFrame:
    return gold.mart_bmi_sleep_disorder(t.lifestyle, t.apnea, t.breathing)


@query
def mart_occupation_risk(t: Inputs) -> DataFrame:
    return gold.mart_occupation_risk(t.lifestyle, t.apnea)


@query
def mart_clinical_severity(t: Inputs) -> DataFrame:
    return gold.mart_clinical_severity(t.breathing, t.apnea)


@query
def mart_epidemiology_combined(t: Inputs) -> DataFrame:
    return gold.mart_epidemiology_combined(
        silver.diabetes_aggregate_2016(t.raw("b_agg")),
        silver.diabetes_hypertension_aggregate_2016(t.raw("b_aggh")),
    )


@query
def mart_diabetes_risk_profile(t: Inputs) -> DataFrame:
    return gold.mart_diabetes_risk_profile(t.prediction, t.detailed, t.apnea)


@query
def mart_bmi_sleep_disorder_numeric(t: Inputs) -> DataFrame:
    """The mart with the corrected midpoint keys, where the joins do match."""
    lifestyle = silver.sleep_health_lifestyle(t.raw("b_shl"), numeric_midpoint=True)
    return gold.mart_bmi_sleep_disorder(lifestyle, t.apnea, t.breathing)


@query
def fact_dedup(t: Inputs) -> DataFrame:
    """The fact with at most one match per key: one row per link row."""
    return gold.fact_patient_health_snapshot(
        t.link, t.apnea, t.breathing, t.lifestyle, t.detailed, t.ages, t.categories, dedup=True
    ).select("patient_primarykey", "age", "bmi", "neck_circumference", "snoring_flag",
             "ahi_score", "spo2_ratio", "sleep_position")


# --- views ----------------------------------------------------------------------------------


@query
def view_risk_factor_correlation(t: Inputs) -> DataFrame:
    return views.risk_factor_correlation(t.link, t.apnea, t.breathing)


@query
def view_occupational_health(t: Inputs) -> DataFrame:
    return views.occupational_health(t.lifestyle, t.apnea)


@query
def view_sleep_disorder_analysis(t: Inputs) -> DataFrame:
    return views.sleep_disorder_analysis(t.lifestyle)
