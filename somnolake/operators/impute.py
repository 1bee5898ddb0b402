"""Defaults for missing values, as uncorrelated scalar subqueries.

Each default is a one-row aggregate over a whole table; it stays lazy and is computed
once per query, next to the scan that uses it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from somnolake.operators.rollups import mean


def scalars_of(rows: DataFrame, **aggregates: str) -> Column:
    """Several aggregates of one table as a single struct-valued scalar.

    An empty table gives NULL fields, hence NULL defaults.
    """
    fields = ", ".join(f"{value} AS {name}" for name, value in aggregates.items())
    return rows.agg(F.expr(f"struct({fields})").alias("defaults")).scalar()


def mean_default(value: str, digits: int, kind: str, scale: int = 0) -> str:
    """Aggregate: mean rounded and kept in the type of the variable that holds it."""
    return f"CAST({mean(value, digits, scale)} AS {kind})"


def int_mean(value: str) -> str:
    """Aggregate: mean of whole numbers as a whole number, cut toward zero."""
    return f"CAST(avg({value}) AS int)"


def most_frequent(rows: DataFrame, column: str) -> DataFrame:
    """One row holding the commonest value; NULL counts as a value.

    Ties go to the smallest value, NULL first.
    """
    return (
        rows.groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), F.asc_nulls_first(column))
        .limit(1)
        .select(column)
    )


def mode_default(rows: DataFrame, column: str) -> Column:
    return most_frequent(rows, column).scalar()


def modes_of(rows: DataFrame, columns: Sequence[str]) -> Column:
    """The commonest value of each text column, as one struct-valued scalar from one scan.

    NULL counts as a value; ties go to the smallest, NULL first; an empty table has NULLs.
    """
    pairs = F.array(*(F.struct(F.lit(name).alias("_column"), F.col(name).alias("_value")) for name in columns))
    counted = rows.select(F.inline(pairs)).groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    # the least of (fewest last, NULL first, smallest)
    rank = F.struct((-F.col("_n")).alias("a"), F.col("_value").isNotNull().alias("b"), F.col("_value").alias("c"))
    best = counted.agg(*(
        F.min(F.when(F.col("_column") == name, rank)).alias(name) for name in columns
    ))
    return best.select(F.struct(*(F.col(f"{name}.c").alias(name) for name in columns))).scalar()


# --- medians ----------------------------------------------------------------------------

SKETCH_ACCURACY = 10_000
BLOCKS = 1 << 16


def median(rows: DataFrame, value: Column) -> DataFrame:
    """One row ``median``: the exact median of a numeric value of any type and number of digits.

    The range is narrowed twice.  A quantile sketch gives two values around the middle; rows
    are counted below, above and in BLOCKS equal stretches between them; only values of the
    one or two stretches that hold the middle are ordered, equal ones as one.  Stretches
    follow the order of the values and every row is counted in one, so the result is exact
    however good the sketch is.  NULL is left out, NaN is the largest value; without a value
    the median is NULL.
    """
    share = 2 / SKETCH_ACCURACY
    values = rows.select(value.alias("_v")).where("_v IS NOT NULL")
    ends = values.agg(F.struct(
        *(F.percentile_approx(F.col("_v").cast("double"), half, SKETCH_ACCURACY).alias(name)
          for name, half in (("low", 0.5 - share), ("high", 0.5 + share))),
    )).scalar()
    placed = values.withColumn("_ends", ends).selectExpr(
        "_v", "CAST(_v AS double) AS _d", "_ends.low AS _low", "_ends.high AS _high"
    ).selectExpr("_v", f"""CASE WHEN _d < _low THEN -1 WHEN _d > _high THEN {BLOCKS} WHEN _low = _high THEN 0
        ELSE CAST(least({BLOCKS - 1}D, floor((_d - _low) / (_high - _low) * {BLOCKS})) AS int) END AS _block""")
    in_order = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    middle = (
        placed.groupBy("_block").agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_block", "_rows", F.coalesce(F.sum("_rows").over(in_order), F.lit(0)).alias("_before"),
            F.expr("sum(_rows) OVER () AS _total"),
        )
        .withColumns({"_lo": F.expr("(_total + 1) DIV 2"), "_hi": F.expr("(_total + 2) DIV 2")})
        .where("_before < _hi AND _before + _rows >= _lo")
    )
    within = Window.partitionBy("_block").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (
        placed.join(F.broadcast(middle), "_block")
        .groupBy("_block", "_before", "_lo", "_hi", "_v").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_last", F.col("_before") + F.sum("_n").over(within))
    )

    def at(rank: str) -> Column:
        here = (F.col("_last") >= F.col(rank)) & (F.col("_last") - F.col("_n") < F.col(rank))
        return F.max(F.when(here, F.col("_v")))

    return counted.agg(((at("_lo") + at("_hi")) / F.lit(2)).alias("median"))


def exact_median(rows: DataFrame, value: Column, precision: int, scale: int) -> DataFrame:
    """One row ``median``: the exact median of a value stored as DECIMAL(precision, scale).

    Equal values are counted first, so what follows depends on the number of distinct
    values the type admits and not on the rows.  The values are then counted in blocks
    of the type's range; the running count over blocks (at most 20,000 for the largest
    precision allowed) names the one or two blocks holding the middle, and only those
    are ordered.
    """
    if precision > 8:
        raise ValueError("store the value in a DECIMAL of at most 8 digits")
    block_size = 10 ** ((precision + 1) // 2)
    stored = value.cast(f"decimal({precision},{scale})")
    counts = (
        rows.select((stored * F.lit(10**scale)).cast("bigint").alias("_u"))
        .where("_u IS NOT NULL")
        .groupBy("_u")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_block", F.floor(F.col("_u") / F.lit(block_size)))
    )
    in_order = Window.orderBy("_block")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    middle = (
        counts.groupBy("_block")
        .agg(F.sum("_n").alias("_rows"))
        .select(
            "_block",
            "_rows",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.expr("sum(_rows) OVER () AS _total"),
        )
        .withColumns({"_lo": F.expr("(_total + 1) DIV 2"), "_hi": F.expr("(_total + 2) DIV 2")})
        .where("_before < _hi AND _before + _rows >= _lo")
    )
    within = Window.partitionBy("_block").orderBy("_u").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # two blocks at most
    ranked = counts.join(F.broadcast(middle), "_block").withColumn(
        "_last", F.col("_before") + F.sum("_n").over(within)
    )

    def at(rank: str) -> Column:
        here = (F.col("_last") >= F.col(rank)) & (F.col("_last") - F.col("_n") < F.col(rank))
        return F.max(F.when(here, F.col("_u")))

    total = (at("_lo") + at("_hi")).cast("double")
    return ranked.agg((total / F.lit(2.0 * 10**scale)).alias("median"))


def with_imputed_flags(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_imputed``, 1 where the column is NULL and so will be filled."""
    marks: Mapping[str, Column] = {
        f"{name}_imputed": F.col(name).isNull().cast("int") for name in columns
    }
    return rows.withColumns(dict(marks))
