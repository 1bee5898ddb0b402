"""Chained joins of hot keys, medians of any type, interval gaps, splittable CSV with line breaks."""

from __future__ import annotations

import math
import statistics
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from somnolake import schemas
from somnolake.checks.queries import QUERIES
from somnolake.operators import impute
from somnolake.operators.joins import Skew, chain_key_rows, grid_lookup, skew_left_joins
from somnolake.plans import gold
from somnolake.plans.runlog import RunLog
from somnolake.sources.csv import read_csv

FEW = settings(max_examples=6, deadline=None)
SIDE = st.lists(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), max_size=14)


def side(spark, keys, name):
    return spark.createDataFrame(list(enumerate(keys)), f"{name} long, k string")


@FEW
@given(SIDE, SIDE, SIDE, st.integers(1, 40))
def test_chain_equals_left_joins(spark, one, two, three, rows_a_task):
    a, b, c = side(spark, one, "a"), side(spark, two, "b"), side(spark, three, "c")
    joined = skew_left_joins(a, [(b, F.col("b")), (c, F.col("c"))], ["k"], F.col("a"), skew=Skew(rows_a_task=rows_a_task))
    assert joined.columns == ["k", "a", "b", "c"]
    by_key = [defaultdict(list), defaultdict(list)]
    for found, keys in zip(by_key, (two, three)):
        for i, k in enumerate(keys):
            found[k].append(i)
    want = Counter(
        (k, i, x, y) for i, k in enumerate(one)
        for x in (k and by_key[0].get(k)) or [None] for y in (k and by_key[1].get(k)) or [None]
    )
    assert Counter(map(tuple, joined.collect())) == want


def test_chain_spreads_a_hot_key_without_a_job(spark):
    def own(name):
        return spark.range(60).selectExpr(f"id AS {name}", f"if(id % 10 > 0, 'hot', concat(id, '{name}')) AS k")

    spark.sparkContext.setJobGroup("building chain", "")
    rows = skew_left_joins(
        own("a"), [(own("b"), F.col("b")), (own("c"), F.col("c"))], ["k"], F.col("a"), skew=Skew(rows_a_task=2500)
    )
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building chain")
    spark.sparkContext.setJobGroup("other", "")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 54**3 + 6 and max(sizes) <= sum(sizes) / 2


def test_key_rows_of_a_chain(spark):
    found = chain_key_rows([side(spark, ["x", "x", None], "k1").select("k"), side(spark, ["x", "y"], "k2").select("k")], ["k"])
    assert sorted(map(tuple, found.collect())) == [("x", 2, 1), ("y", 0, 1)]


@pytest.mark.parametrize(("name", "most"), [("join_left_fanout", 12), ("fact_patient_health_snapshot", 20)])
def test_scans_of_the_plan_before_reuse(name, most, spark, small):
    text = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") <= most


@FEW
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=32)), max_size=40))
def test_median_of_doubles(spark, numbers):
    rows = spark.createDataFrame([(x,) for x in numbers], "x double")
    some = [x for x in numbers if x is not None]
    got = impute.median(rows, F.col("x")).first()["median"]
    assert got == (statistics.median(some) if some else None)


@FEW
@given(st.lists(st.integers(-(10**29), 10**29), min_size=1, max_size=30))
def test_median_of_wide_decimals_is_not_rounded(spark, numbers):
    rows = spark.createDataFrame([(Decimal(n).scaleb(-4),) for n in numbers], "x decimal(34,4)")
    got = impute.median(rows, F.col("x")).first()["median"]
    ordered = sorted(numbers)
    low, high = ordered[(len(ordered) - 1) // 2], ordered[len(ordered) // 2]
    assert got * 20000 == low + high


def test_median_of_many_rows_nan_and_ties(spark):
    rows = spark.range(200_001).selectExpr("if(id % 3 = 0, 7.25D, cast(id * id AS double)) AS x")
    assert impute.median(rows, F.col("x")).first()["median"] == rows.agg(F.median("x")).first()[0]
    rows = spark.createDataFrame([(1.0,), (math.nan,), (2.0,)], "x double")
    assert impute.median(rows, F.col("x")).first()["median"] == 2.0


def test_values_between_intervals_match_nothing(spark):
    rows = spark.sql("SELECT * FROM VALUES (24.9), (24.95), (25.0), (99.0), (99.05), (-1.0), (NULL) AS t(bmi)")
    bands = gold.dim_bmi_category(spark).where("label <> 'Unknown'")
    found = {str(r["bmi"]): r["label"] for r in grid_lookup(rows, bands, "bmi", "bmi_min", "bmi_max", 10).collect()}
    assert found["24.95"] is found["99.05"] is found["-1.00"] is found["None"] is None
    assert found["24.90"] == "Normal" and found["25.00"] == "Overweight" and found["99.00"] is not None


NOTES = schemas.table(id=schemas.BIGINT, note=schemas.TEXT, other=schemas.TEXT)


def written(folder, rows, end="\n"):
    def field(value):
        return "" if value is None else '"' + value.replace('"', '""') + '"'

    text = end.join(["id,note,other", *(f"{i},{field(n)},{field(o)}" for i, n, o in rows)]) + end
    path = folder / "notes.csv"
    path.write_bytes(text.encode())
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_with_line_breaks_in_quotes_is_many_tasks(spark, tmp_path, end):
    notes = ["plain", "two\nlines", 'a ""quoted"" "word"', "many\n" * 40, '"\n"', ",,\n,", None, "é\n\nü", "x" * 900]
    rows = [(i, notes[i % len(notes)], notes[(i * 7 + 3) % len(notes)]) for i in range(800)]
    path = written(tmp_path, rows, end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 8
        found = read_csv(spark, path, NOTES, "quoted", multi_line=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, found)) == sorted(rows)
    whole = spark.read.schema("id long, note string, other string").options(
        header=True, enforceSchema=True, multiLine=True, quote='"', escape='"'
    ).csv(path).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, whole))


def test_several_files_and_an_empty_one(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        written(tmp_path / name, [(1, f"{name}\n1", "x"), (2, name, None)])
    (tmp_path / "a" / "none.csv").write_text("id,note,other\n")
    found = read_csv(spark, [str(tmp_path / "a"), str(tmp_path / "b")], NOTES, "quoted", multi_line=True)
    assert sorted(map(str, (r["note"] for r in found.collect()))) == ["a", "a\n1", "b", "b\n1"]


def test_log_rows_are_stored_as_their_steps_end(spark, tmp_path):
    """Nothing after the last step runs, as when the driver is lost."""
    log = RunLog(spark, "silver", str(tmp_path), "stop_quiet")
    log.step("one", lambda: spark.range(7), lambda rows: rows.write.parquet(f"{tmp_path}/one"))
    log.step("two", lambda: spark.range(1).selectExpr("raise_error('no')"), lambda rows: rows.collect())
    stored = spark.read.parquet(f"{tmp_path}/run_log").select("step", "rows", "status").collect()
    assert sorted(map(tuple, stored)) == [("one", 7, "ok"), ("two", None, "failed")]
    log.finish()
    assert spark.read.parquet(f"{tmp_path}/run_log").count() == 3
