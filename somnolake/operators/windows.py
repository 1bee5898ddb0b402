"""First and latest rows of groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_row_per(
    rows: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]
) -> DataFrame:
    """Keep the first row of each group.

    Filtering ROW_NUMBER on 1 lets Spark cut every input partition to one row per
    group before the shuffle, so a group holding much of the table moves one row per
    task.  ``order`` must be total within a group for the result to be repeatable.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def latest_row_per(rows: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    return first_row_per(rows, [key], [F.desc(time), F.desc(tie)])
