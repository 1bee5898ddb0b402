"""Data-quality checks: constraints the tables declare but Spark does not enforce."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F


def null_profile(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Per column: rows, NULLs, and values present that do not parse.

    ``checks`` maps a column to its parsed form.  All columns are counted in one pass.
    """
    counted = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(F.col(name).isNull()).alias(f"{name}__null") for name in checks),
        *(
            F.count_if(F.col(name).isNotNull() & parsed.isNull()).alias(f"{name}__invalid")
            for name, parsed in checks.items()
        ),
    )
    lines = F.array(
        *(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("rows"),
                F.col(f"{name}__null").alias("nulls"),
                F.col(f"{name}__invalid").alias("invalid"),
            )
            for name in checks
        )
    )
    return counted.select(F.inline(lines)).withColumn(
        "missing_pct", F.round(F.lit(100.0) * (F.col("nulls") + F.col("invalid")) / F.col("rows"), 1)
    )


def broken_rules(rules: Mapping[str, tuple[float, float]]) -> Column:
    """Names of the columns outside their closed range, comma-separated; '' if none.

    NULL breaks no rule.
    """
    return F.concat_ws(
        ",",
        *(
            F.when(~F.col(name).between(low, high), F.lit(name))
            for name, (low, high) in rules.items()
        ),
    )


class Refused(ValueError):
    """Rows that were written but break a rule of their table, which therefore wasn't pointed at them."""


@dataclass(frozen=True)
class Gate:
    """Rules that a table's rows must keep, counted while they are written: no further scan or join.

    ``references`` maps a column to the ids of a dimension of few rows; NULL refers to nothing
    and is allowed.  NULL breaks no range.
    """

    not_null: Collection[str] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    references: Mapping[str, Collection] = field(default_factory=dict)

    def counts(self) -> list[Column]:
        """One aggregate a rule: how many rows break it."""
        return [
            *(F.count_if(F.col(c).isNull()).alias(f"{c} missing") for c in self.not_null),
            *(
                F.count_if(~F.col(c).between(low, high)).alias(f"{c} out of range")
                for c, (low, high) in self.ranges.items()
            ),
            *(
                F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*ids)).alias(f"{c} without parent")
                for c, ids in self.references.items()
            ),
        ]

    def watch(self, rows: DataFrame) -> tuple[DataFrame, Observation | None]:
        """The rows, and what is known of them once they are written."""
        counts = self.counts()
        if not counts:
            return rows, None
        seen = Observation()
        return rows.observe(seen, *counts), seen

    def check(self, table: str, seen: Observation | None) -> None:
        broken = {rule: n for rule, n in (seen.get if seen else {}).items() if n}
        if broken:
            raise Refused(f"{table} isn't published: {broken}")


def range_split(
    rows: DataFrame, rules: Mapping[str, tuple[float, float]]
) -> tuple[DataFrame, DataFrame]:
    """Rows inside every range, and the others with the columns at fault."""
    checked = rows.withColumn("broken", broken_rules(rules))
    return checked.where("broken = ''").drop("broken"), checked.where("broken <> ''")


def deduplicate(rows: DataFrame, columns: Sequence[str], row_id: str) -> DataFrame:
    """One row per distinct content, with the lowest id of its copies.

    A plain hash aggregation: copies collapse before the shuffle.
    """
    return rows.groupBy(*columns).agg(F.min(row_id).alias(row_id))


def key_report(rows: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, keys held by several rows, rows without a key."""
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    some = F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count_if(some).alias("distinct_keys"),
        F.count_if(some & (F.col("_n") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(~some, F.col("_n"))), F.lit(0)).alias("null_keys"),
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values with no parent, and how many rows hold each; NULL is allowed.

    Counted before the anti join, so a value in many rows crosses the shuffle once per
    task.
    """
    counted = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    keys = parent.select(F.col(parent_key).alias(column))
    return counted.join(keys, column, "left_anti")


def fanout_audit(left: DataFrame, sides: Sequence[DataFrame], key: str) -> DataFrame:
    """How often left rows stand in ``left LEFT JOIN side1 … USING (key)``.

    One line per multiplicity: keys, rows before and rows after the join.  Only counts
    are joined; a sum of ``rows_after`` gives the size of the join before it is run.
    """
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    multiplicity = F.lit(1).cast("decimal(38,0)")
    for index, side in enumerate(sides):
        name = f"_m{index}"
        per_key = (
            side.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
        )
        counts = counts.join(per_key, key, "left")
        multiplicity = multiplicity * F.coalesce(F.col(name), F.lit(1)).cast("decimal(38,0)")
    return (
        counts.withColumn("multiplicity", multiplicity)
        .groupBy("multiplicity")
        .agg(
            F.count(F.lit(1)).alias("keys"),
            F.sum("_rows").alias("rows_before"),
            F.sum(F.col("_rows").cast("decimal(38,0)") * F.col("multiplicity")).alias("rows_after"),
        )
    )


def usage(dim: DataFrame, dim_key: str, rows: DataFrame, column: str) -> DataFrame:
    """Dimension rows with the number of rows that refer to each."""
    counted = rows.groupBy(F.col(column).alias(dim_key)).agg(F.count(F.lit(1)).alias("used_by"))
    return dim.join(counted, dim_key, "left").withColumn(
        "used_by", F.coalesce("used_by", F.lit(0))
    )
