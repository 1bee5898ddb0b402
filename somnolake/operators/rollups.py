"""Exact grouped counts, means and rates, and rollups over fan-out joins.

Amounts and aggregates are SQL expression texts over column names.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_BIG = "decimal(38,0)"


def units(value: str, scale: int = 0) -> str:
    """A DECIMAL(p, scale) or whole number as a count of its smallest units, NULL as 0.

    Sums of whole numbers do not depend on the order of rows or tasks.
    """
    return f"coalesce(CAST({value} * {10**scale} AS bigint), 0L)"


def sum_units(value: str, scale: int = 0, digits: int = 8) -> str:
    """Aggregate: ``units`` summed, 0 for no values.

    ``digits`` is the precision of a DECIMAL value; up to 8 of them are summed as a 64-bit
    number.  Scaled afterwards.
    """
    if scale == 0:
        return f"coalesce(sum({value}), 0L)"
    total = f"sum(CAST({value} AS decimal({digits},{scale})))"
    return f"coalesce(CAST({total} * {10**scale} AS {_BIG if digits > 8 else 'bigint'}), 0)"


def mean_of(total: str, count: str, scale: int, digits: int) -> str:
    """Rounded mean from a sum of units and a count; NULL for no values."""
    divisor = f"(CAST({count} AS double) * {10**scale})"
    return f"round(try_divide(CAST({total} AS double), {divisor}), {digits})"


def mean(value: str, digits: int, scale: int = 0) -> str:
    """Aggregate: rounded mean of a DECIMAL(p, scale) or whole-number column."""
    return mean_of(sum_units(value, scale), f"count({value})", scale, digits)


def rate_pct(total: str, rows: str) -> str:
    """Share in percent with one decimal."""
    return f"round(100.0D * CAST({total} AS double) / CAST({rows} AS double), 1)"


@dataclass(frozen=True)
class Attached:
    """One side of a fan-out left join on the patient key.

    ``sums`` maps a result name to a whole-number, never NULL aggregate of the rows of a
    key, and to its value where no row joins.  Both may use the fields of ``defaults``, a
    struct-valued scalar, as ``_default``.
    """

    rows: DataFrame
    sums: Mapping[str, tuple[str, str]]
    defaults: Column | None = None

    def with_defaults(self, rows: DataFrame) -> DataFrame:
        return rows if self.defaults is None else rows.withColumn("_default", self.defaults)


@dataclass(frozen=True)
class Banded:
    """Columns to group by first, and what turns them into the columns asked for."""

    columns: Sequence[str]
    derive: Callable[[DataFrame], DataFrame]


def fanout_rollup(
    base: DataFrame,
    key: str,
    group_by: Sequence[str],
    base_sums: Mapping[str, str],
    attached: Sequence[Attached],
    count_as: str,
    banded: Banded | None = None,
) -> DataFrame:
    """Group ``base LEFT JOIN a1 USING (key) LEFT JOIN a2 USING (key) …`` without joining rows.

    Each input is first summed per key, so the joins are one row to one row and a key
    that fills a third of every table costs no more than any other.  In the joined
    table a base row would stand once per pair of matches, so a sum over one input is
    its per-key sum times the row counts of the others.  Products use DECIMAL(38,0):
    row counts of a fan-out outgrow 64 bits long before the inputs do.

    An amount of the base may be a plain ``sum``: it is NULL where a group has no value.

    ``banded`` groups the base by finer columns and derives those of ``group_by`` from the
    grouped rows, of which there are far fewer.
    """
    joined = base.groupBy(*(banded.columns if banded else group_by), key).agg(
        F.count(F.lit(1)).alias("_n0"),
        *(F.expr(amount).alias(name) for name, amount in base_sums.items()),
    )
    if banded:
        joined = banded.derive(joined)
    counts = ["_n0"]
    names = [list(base_sums)]
    for index, side in enumerate(attached, start=1):
        rows = f"_n{index}"
        per_key = (
            side.with_defaults(side.rows.where(F.col(key).isNotNull()))
            .groupBy(key)
            .agg(
                F.count(F.lit(1)).alias(rows),
                *(F.expr(amount).alias(name) for name, (amount, _) in side.sums.items()),
            )
        )
        matched = side.with_defaults(joined.join(per_key, key, "left"))
        joined = matched.selectExpr(
            *joined.columns,
            f"coalesce({rows}, 1L) AS {rows}",
            *(f"coalesce({name}, {alone}) AS {name}" for name, (_, alone) in side.sums.items()),
        )
        counts.append(rows)
        names.append(list(side.sums))

    def sum_of_products(columns: Sequence[str], name: str) -> Column:
        product = " * ".join(f"CAST({column} AS {_BIG})" for column in columns)
        return F.expr(f"sum({product})").alias(name)

    sums = [sum_of_products(counts, count_as)]
    for index, own in enumerate(names):
        others = [rows for at, rows in enumerate(counts) if at != index]
        sums += [sum_of_products([name, *others], name) for name in own]
    return joined.groupBy(*group_by).agg(*sums)
