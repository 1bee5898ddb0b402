"""What moves, and what is worked out, on the rows that joins multiply."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from somnolake.checks.adapters import ADAPTERS
from somnolake.checks.queries import QUERIES
from somnolake.operators.joins import Skew, skew_left_joins
from somnolake.plans import gold, silver


def plan_of(rows) -> list[str]:
    return rows._jdf.queryExecution().executedPlan().toString().splitlines()


def above(lines: list[str], index: int) -> list[str]:
    """The operators that a line's rows go through."""
    found, depth = [], re.search(r"\w", lines[index]).start()
    for line in reversed(lines[:index]):
        if (at := re.search(r"\w|$", line).start()) < depth and line.strip():
            found.append(line)
            depth = at
    return found


def side(spark, name, rows=60):
    return spark.range(rows).selectExpr(f"id AS {name}", f"if(id % 10 > 0, 'hot', concat(id, '{name}')) AS k")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_joined_rows_of_a_chain_do_not_move(spark, threshold):
    """Whatever is small enough for a broadcast, the tables are dealt once, before the first join."""
    a, b, c, d = (side(spark, name) for name in "abcd")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = skew_left_joins(a, [(b, F.col("b")), (c, F.col("c")), (d, F.col("d"))], ["k"], F.col("a"))
        lines = plan_of(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
    assert len(joins) == 3
    for i in joins:
        assert not [line for line in above(lines, i) if "Exchange" in line]


@pytest.mark.parametrize(("sizes", "rows_a_task"), [((60, 60, 60), 1000), ((200, 1, 30), 50), ((3, 400, 2), 7)])
def test_pieces_are_of_about_the_rows_a_task(spark, sizes, rows_a_task):
    a, b, c = (
        spark.range(n).selectExpr(f"id AS {name}", "'hot' AS k") for name, n in zip("abc", sizes, strict=True)
    )
    rows = skew_left_joins(
        a, [(b, F.col("b")), (c, F.col("c"))], ["k"], F.col("a"), skew=Skew(rows_a_task=rows_a_task)
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        held = rows.select(F.spark_partition_id().alias("task"), "a", "b", "c").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    n = sizes[0] * sizes[1] * sizes[2]
    assert len(held) == len({row[1:] for row in held}) == n
    # rows are dealt by a hash, and two pieces may meet in a task
    tasks = Counter(row["task"] for row in held)
    assert n / rows_a_task / 2 <= len(tasks) and max(tasks.values()) <= 8 * rows_a_task


def test_a_link_rows_own_values_are_made_before_the_joins_that_repeat_it(spark, small):
    def load(name, adapter):
        return silver.LOADS[name](ADAPTERS[adapter].rows(spark, small))

    inputs = [
        load("diabetes_sleep_link", "b_link"), load("sleep_apnea_core", "b_sleep_apnea"),
        load("sleep_disordered_breathing", "b_sdb"),
        load("sleep_health_lifestyle", "b_shl"), load("diabetes_detailed", "b_diabetes"),
    ]
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        fact = gold.fact_patient_health_snapshot(*inputs, gold.dim_age_band(spark), gold.dim_bmi_category(spark))
        last = next(line for line in plan_of(fact) if "Project [" in line)
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    values = last.split("Project [", 1)[1]
    assert "concat(" not in values and "cast(" not in values and "CASE" not in values
    # only what the key joins add is filled after them
    later = len(gold.FACT_SOURCES["sleep_apnea_core"]) + len(gold.FACT_SOURCES["sleep_disordered_breathing"])
    assert values.count("coalesce(") == later


def test_parts_of_few_bytes_and_many_joined_rows_are_not_put_together(spark):
    """Thirty keys of 60 x 60 rows are some kilobytes, and one task's work only if they were judged by that."""
    a, b = (spark.range(1800).selectExpr(f"id AS {name}", "id % 30 AS k") for name in "ab")
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = skew_left_joins(a, [(b, F.col("b"))], ["k"], F.col("a"))
        sizes = [row["count"] for row in rows.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 30 * 3600 and len(sizes) >= 6


def test_the_joins_of_a_chain_meet_blocks_and_rows_are_made_after_them(spark):
    """1000 x 130 x 70 joined rows, of which the two joins make 1000 x 3 and 1000 x 3 x 2."""
    a, b, c = (
        spark.range(n).selectExpr(f"id AS {name}", "'k' AS k") for name, n in zip("abc", (1000, 130, 70), strict=True)
    )
    rows = skew_left_joins(
        a, [(b, F.col("b")), (c, F.col("c"))], ["k"], F.col("a"), skew=Skew(rows_a_task=10_000_000)
    )
    assert rows.count() == rows.distinct().count() == 1000 * 130 * 70
    lines = plan_of(rows)
    last = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    over = above(lines, last)
    assert len([line for line in over if "Generate inline(" in line]) == 2
    # not a part of generated code, which would hold all rows of a left row at once
    assert [line for line in over if "Filter forall(" in line and "*(" not in line]


@pytest.mark.parametrize("name", ["join_left_fanout", "fact_patient_health_snapshot"])
def test_rows_are_typed_before_they_are_repeated(spark, small, name):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        lines = plan_of(QUERIES[name](spark, small))
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    last = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert not [line for line in above(lines, last) if "cast(" in line]


def test_counting_makes_the_key_of_a_row_once(spark):
    """A condition on the key below the aggregation would have it made for the condition, too."""
    a, b = (spark.range(60).selectExpr(f"id AS {name}", "md5(string(id % 7)) AS k") for name in "ab")
    lines = plan_of(skew_left_joins(a, [(b, F.col("b"))], ["k"], F.col("a")))
    first = next(i for i, line in enumerate(lines) if "Union" in line)
    counted = [line for line in lines[first:first + 7] if "md5(" in line]
    assert len(counted) == 2 and not [line for line in counted if "Filter" in line]
