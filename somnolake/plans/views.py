"""User-level views that the warehouse describes but has no load for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from somnolake import schemas
from somnolake.config import WarehouseConfig
from somnolake.functions import numeric
from somnolake.operators.impute import with_imputed_flags
from somnolake.operators.rollups import (
    Attached,
    fanout_rollup,
    mean,
    rate_pct,
    sum_units,
    units,
)
from somnolake.plans import gold

OUTCOMES = ("diabetes_flag", "sleep_apnea_flag", "hypertension_flag")
LINK_MEASURES = {"bmi": 1, "glucose": 2, "insulin": 2, "blood_pressure": 0}
HIGH_STRESS = 7
# measures that the fact names otherwise
FACT_NAMES = {"apnea_hypopnea_index": "ahi_score"}


def _sums(name: str, value: str, scale: int) -> dict[str, str]:
    """Aggregates: number of values, sum of units, and sum of squared units, which outgrow 64 bits."""
    amount = f"CAST({units(value, scale)} AS decimal(18,0))"
    return {
        f"{name}__n": f"count({value})",
        f"{name}__sum": sum_units(value, scale),
        f"{name}__sq": f"coalesce(sum({amount} * {amount}), 0)",
    }


def risk_factor_correlation(
    link: DataFrame, apnea: DataFrame, breathing: DataFrame
) -> DataFrame:
    """Pearson correlation of each outcome flag with each measure over the fact rows.

    Uses whole-number moments, so the result does not depend on the order of rows, and
    takes them from the fact's inputs without the fan-out.  Each pair is over the rows that
    have both, as the fact fills only the joined tables' measures; ``n`` counts all rows.
    NULL where a side does not vary.
    """
    defaults = (
        gold.mean_defaults(apnea, "sleep_apnea_core"),
        gold.mean_defaults(breathing, "sleep_disordered_breathing"),
    )
    attached = []
    measures: dict[str, object] = dict(LINK_MEASURES)
    sides = (
        (apnea, defaults[0], {"neck_circumference": gold.APNEA_MEASURES["neck_circumference"]}),
        (breathing, defaults[1], gold.BREATHING_MEASURES),
    )
    for rows, default, columns in sides:
        sums = {}
        for name, (table, scale) in columns.items():
            fill = gold.typed_default(table, name)
            each = _sums(name, f"coalesce({name}, {fill})", scale)
            alone = units(fill, scale)
            sums[f"{name}__n"] = (each[f"{name}__n"], f"CAST({fill} IS NOT NULL AS bigint)")
            sums[f"{name}__sum"] = (each[f"{name}__sum"], alone)
            sums[f"{name}__sq"] = (each[f"{name}__sq"], f"{alone} * {alone}")
        measures.update(columns)
        attached.append(Attached(rows, sums, default))
    base = {}
    for name, scale in LINK_MEASURES.items():
        base |= _sums(name, name, scale)
    # Grouped by the flags, a flag is constant in a group and its product sums follow.
    rolled = fanout_rollup(link, gold.KEY, list(OUTCOMES), base, attached, count_as="n")

    one_row = rolled.agg(*(F.expr(value).alias(name) for name, value in _totals(measures).items()))
    return one_row.selectExpr(_correlations(measures))


def _totals(measures) -> dict[str, str]:
    """Aggregates over groups of equal flags: the moments of each outcome with each measure."""
    totals = {"n": "sum(n)"}
    for outcome in OUTCOMES:
        for name in measures:
            count, total, square = (f"CAST({name}__{part} AS double)" for part in ("n", "sum", "sq"))
            pair = f"{outcome}__{name}"
            totals |= {
                f"{pair}__x": f"sum({outcome} * {count})",
                f"{pair}__xy": f"sum({outcome} * {total})",
                f"{pair}__n": f"sum(IF({outcome} IS NULL, 0, {count}))",
                f"{pair}__y": f"sum(IF({outcome} IS NULL, 0, {total}))",
                f"{pair}__yy": f"sum(IF({outcome} IS NULL, 0, {square}))",
            }
    return totals


def _correlations(measures) -> str:
    """One line for each outcome and measure, from the moments."""
    lines = []
    for outcome in OUTCOMES:
        for name in measures:
            n, sx, sy, syy, sxy = (
                f"{outcome}__{name}__{part}" for part in ("n", "x", "y", "yy", "xy")
            )
            # x is 0 or 1, so the sum of its squares is its sum
            spread = f"({n} * {sx} - {sx} * {sx}) * ({n} * {syy} - {sy} * {sy})"
            value = f"round(try_divide({n} * {sxy} - {sx} * {sy}, sqrt({spread})), 6)"
            lines.append(
                f"struct('{outcome}' AS outcome, '{name}' AS measure, "
                f"n, {value} AS correlation)"
            )
    return f"inline(array({', '.join(lines)}))"


def occupational_health(lifestyle: DataFrame, apnea: DataFrame) -> DataFrame:
    """The occupation mart with further lifestyle means."""
    means = lifestyle.groupBy(F.col("occupation").alias("_occupation")).agg(
        F.expr(mean("physical_activity_level", 2)).alias("avg_activity"),
        F.expr(mean("heart_rate", 2)).alias("avg_heart_rate"),
        F.expr(mean("diastolic_bp", 2)).alias("avg_diastolic"),
    )
    mart = gold.mart_occupation_risk(lifestyle, apnea)
    same = F.col("occupation").eqNullSafe(F.col("_occupation"))
    return mart.join(means, same, "left").drop("_occupation")


def sleep_disorder_analysis(lifestyle: DataFrame, high_stress: int = HIGH_STRESS) -> DataFrame:
    """Prevalence of each sleep disorder by occupation and high stress."""
    stressed = numeric.flag(F.col("stress_level") >= high_stress).cast("int")
    return (
        lifestyle.withColumn("high_stress", stressed)
        .groupBy("occupation", "high_stress")
        .agg(
            F.count(F.lit(1)).alias("patients"),
            F.count_if(F.col("sleep_disorder") == "Sleep Apnea").alias("sleep_apnea_count"),
            F.count_if(F.col("sleep_disorder") == "Insomnia").alias("insomnia_count"),
        )
        .selectExpr(
            "*",
            f"{rate_pct('sleep_apnea_count', 'patients')} AS sleep_apnea_rate_pct",
            f"{rate_pct('insomnia_count', 'patients')} AS insomnia_rate_pct",
        )
    )


def create_views(silver: dict[str, DataFrame]) -> None:
    """Register the three views in the session."""
    lifestyle, apnea = silver["sleep_health_lifestyle"], silver["sleep_apnea_core"]
    views = {
        "vw_risk_factor_correlation": risk_factor_correlation(
            silver["diabetes_sleep_link"], apnea, silver["sleep_disordered_breathing"]
        ),
        "vw_occupational_health_metrics": occupational_health(lifestyle, apnea),
        "vw_sleep_disorder_analysis": sleep_disorder_analysis(lifestyle),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)


def view_texts(config: WarehouseConfig) -> dict[str, str]:
    """The three views as SQL over stored tables; the correlation reads the stored fact once."""
    def listed(columns: dict[str, str]) -> str:
        return ", ".join(f"{value} AS {name}" for name, value in columns.items())

    measures = [*LINK_MEASURES, "neck_circumference", *gold.BREATHING_MEASURES]
    stored = schemas.GOLD["fact_patient_health_snapshot"]
    sums = {"n": "CAST(count(1) AS decimal(38,0))"}
    for name in measures:
        column = FACT_NAMES.get(name, name)
        sums |= _sums(name, column, getattr(stored[column].dataType, "scale", 0))
    fact = config.table("gold", "fact_patient_health_snapshot")
    flags = ", ".join(OUTCOMES)
    lifestyle = config.table("silver", "sleep_health_lifestyle")
    means = {
        "avg_activity": mean("physical_activity_level", 2),
        "avg_heart_rate": mean("heart_rate", 2),
        "avg_diastolic": mean("diastolic_bp", 2),
    }
    mart = ", ".join(f"m.{name}" for name in schemas.GOLD["mart_occupation_risk"].names)
    counts = {
        "patients": "count(1)",
        "sleep_apnea_count": "count_if(sleep_disorder = 'Sleep Apnea')",
        "insomnia_count": "count_if(sleep_disorder = 'Insomnia')",
    }
    rates = {
        "sleep_apnea_rate_pct": rate_pct("sleep_apnea_count", "patients"),
        "insomnia_rate_pct": rate_pct("insomnia_count", "patients"),
    }
    return {
        "vw_risk_factor_correlation":
            f"SELECT {_correlations(measures)} FROM (SELECT {listed(_totals(measures))} FROM "
            f"(SELECT {flags}, {listed(sums)} FROM {fact} GROUP BY {flags}))",
        "vw_occupational_health_metrics":
            f"SELECT {mart}, {', '.join(means)} FROM {config.table('gold', 'mart_occupation_risk')} m "
            f"LEFT JOIN (SELECT occupation, {listed(means)} FROM {lifestyle} GROUP BY occupation) a "
            "ON m.occupation <=> a.occupation",
        "vw_sleep_disorder_analysis":
            f"SELECT *, {listed(rates)} FROM (SELECT occupation, high_stress, {listed(counts)} FROM "
            f"(SELECT *, IF(stress_level >= {HIGH_STRESS}, 1, 0) AS high_stress FROM {lifestyle}) "
            "GROUP BY occupation, high_stress)",
    }


def store_views(spark: SparkSession, config: WarehouseConfig) -> None:
    """Create or replace the three views in the catalog, beside the gold tables."""
    for name, text in view_texts(config).items():
        spark.sql(f"CREATE OR REPLACE VIEW {config.table('gold', name)} AS {text}")


def hypertension_with_flags(raw: DataFrame) -> DataFrame:
    """Raw hypertension rows parsed, with a mark on each value the silver load fills."""
    parsed = raw.withColumns({
        "bmi": numeric.try_float(F.col("bmi")),
        "cigsperday": numeric.try_int(F.col("cigsperday")),
        "bpmeds": numeric.try_int(F.col("bpmeds")),
        "totchol": numeric.try_float(F.col("totchol")),
        "heartrate": numeric.try_int(F.col("heartrate")),
        "glucose": numeric.try_float(F.col("glucose")),
    })
    return with_imputed_flags(
        parsed, ["bmi", "cigsperday", "bpmeds", "totchol", "heartrate", "glucose"]
    )
