"""Joins, rollups, ids and defaults against brute force on small fixtures."""

from __future__ import annotations

import statistics
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from somnolake.operators import impute, quality
from somnolake.operators.identity import dense_id
from somnolake.operators.joins import Skew, grid_lookup, joined_key_rows, key_rows, skew_left_join
from somnolake.operators.rollups import Attached, fanout_rollup, sum_units
from somnolake.operators.windows import first_row_per, latest_row_per
from somnolake.plans import gold

FEW = settings(max_examples=8, deadline=None)
KEYS = st.sampled_from(["hot", "hot", "hot", "a", "b", "c", None])
SIDE = st.lists(st.tuples(KEYS, st.integers(0, 50)), max_size=25)


def frame(spark, pairs, value):
    rows = [(i, key, number) for i, (key, number) in enumerate(pairs)]
    return spark.createDataFrame(rows, f"id_{value} long, k string, {value} long")


def brute_left_join(left, right):
    by_key = defaultdict(list)
    for key, number in right:
        by_key[key].append(number)
    out = Counter()
    for key, number in left:
        matches = by_key[key] if key is not None and by_key.get(key) else [None]
        out.update((key, number, match) for match in matches)
    return out


@FEW
@given(SIDE, SIDE)
def test_pieced_join_equals_left_join(spark, left, right):
    l, r = frame(spark, left, "x"), frame(spark, right, "y")
    joined = skew_left_join(
        l, r, ["k"], F.col("id_x"), F.col("id_y"), skew=Skew(target_tasks=9)
    ).select("k", "x", "y")
    assert Counter(map(tuple, joined.collect())) == brute_left_join(left, right)


@FEW
@given(SIDE, st.dictionaries(st.sampled_from(["hot", "a", "b", "d"]), st.integers(0, 9)))
def test_pieced_join_with_unique_right_side(spark, left, right):
    l, r = frame(spark, left, "x"), frame(spark, list(right.items()), "y").drop("id_y")
    joined = skew_left_join(l, r, ["k"], F.col("id_x"), skew=Skew(target_tasks=9))
    got = Counter(map(tuple, joined.select("k", "x", "y").collect()))
    assert got == brute_left_join(left, list(right.items()))


def test_pieced_join_spreads_a_hot_key(spark):
    l = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id AS string)) AS k")
    r = spark.range(300).selectExpr("id AS rid", "if(id % 3 = 0, 'hot', cast(id AS string)) AS k")
    skew = Skew(target_tasks=40)
    joined = skew_left_join(l, r, ["k"], F.col("id"), F.col("rid"), skew=skew)
    plain = l.join(r, "k", "left")
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    assert joined.columns == plain.columns


def test_chained_joins_spread_a_key_hot_on_all_sides(spark):
    """Nine tenths of three tables of 60 rows are one key: 157,464 of the joined rows."""
    def side(name):
        key = f"if(id % 10 > 0, 'hot', concat(id, '{name}')) AS k"
        return spark.range(60).selectExpr(f"id AS {name}", key)

    a, b, c = side("a"), side("b"), side("c")
    spark.sparkContext.setJobGroup("building", "")
    rows = skew_left_join(a, b, ["k"], F.col("a"), F.col("b"), skew=Skew(target_tasks=64))
    held = joined_key_rows(key_rows(a, ["k"]), key_rows(b, ["k"]), ["k"])
    both = F.struct("a", "b")
    rows = skew_left_join(rows, c, ["k"], both, F.col("c"), held, Skew(target_tasks=64))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("other", "")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = rows.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    total = sum(r["count"] for r in sizes)
    assert total == 54**3 + 6
    assert max(r["count"] for r in sizes) <= 4 * total / 8


@FEW
@given(SIDE, SIDE, SIDE)
def test_rollup_equals_grouping_the_joined_rows(spark, base, one, two):
    b, o, t = frame(spark, base, "x"), frame(spark, one, "y"), frame(spark, two, "z")
    b = b.withColumn("g", F.expr("x % 2"))
    attached = [
        Attached(o, {"y_sum": (sum_units("y"), "0L"), "y_n": ("count(y)", "0L")}),
        Attached(t, {"z_sum": (sum_units("z"), "100L")}),
    ]
    rolled = fanout_rollup(b, "k", ["g"], {"x_sum": sum_units("x")}, attached, "n")
    plain = b.join(o, "k", "left").join(t, "k", "left").groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("x_sum"),
        F.coalesce(F.sum("y"), F.lit(0)).alias("y_sum"), F.count("y").alias("y_n"),
        F.sum(F.coalesce("z", F.lit(100))).alias("z_sum"),
    )
    names = ["g", "n", "x_sum", "y_sum", "y_n", "z_sum"]
    as_ints = [Counter(tuple(int(v) for v in row) for row in side.select(names).collect())
               for side in (rolled, plain)]
    assert as_ints[0] == as_ints[1]


def test_rollup_does_not_expand_a_hot_key(spark):
    """10,000 x 10,000 x 10,000 joined rows, counted without making them."""
    rows = spark.range(10_000).selectExpr("'same' AS k", "1L AS x")
    rolled = fanout_rollup(
        rows.withColumn("g", F.lit(1)), "k", ["g"], {"x_sum": "sum(x)"},
        [Attached(rows, {"a": ("sum(x)", "0L")}), Attached(rows, {"b": ("sum(x)", "0L")})], "n",
    ).first()
    assert int(rolled["n"]) == int(rolled["x_sum"]) == int(rolled["a"]) == 10_000**3


def test_wide_decimals_are_summed_whole(spark):
    rows = spark.createDataFrame([("123456789012.34",), ("0.01",), (None,)], "x string")
    total = rows.selectExpr("CAST(x AS decimal(14,2)) AS x").agg(F.expr(sum_units("x", 2, digits=14)).alias("s"))
    assert int(total.first()["s"]) == 12345678901235


def test_dense_ids_follow_files_and_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 1000, 1, 7).selectExpr("id AS v").write.parquet(path)
    once = dense_id(spark.read.parquet(path)).collect()
    assert sorted(r["record_id"] for r in once) == list(range(1, 1001))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        again = dense_id(spark.read.parquet(path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r["v"], r["record_id"]) for r in once} == {(r["v"], r["record_id"]) for r in again}


def test_dense_ids_of_no_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.range(0).selectExpr("id AS v").write.parquet(path)
    assert dense_id(spark.read.parquet(path)).collect() == []


def test_age_bands_meet_whole_years_only_within_0_to_99(spark):
    ages = ["17.9", "18.0", "30.5", "60.9", "99.9", "100.0", None]
    rows = spark.createDataFrame([(a,) for a in ages], "t string").selectExpr(
        "CAST(t AS decimal(5,1)) AS age")
    got = grid_lookup(rows, gold.dim_age_band(spark), "floor(age)", "age_min", "age_max", 1)
    assert {str(r["age"]): r["label"] for r in got.collect()} == {
        "17.9": "Under 18", "18.0": "18-30", "30.5": "18-30", "60.9": "46-60", "99.9": "61+",
        "100.0": None, "None": None,
    }


def test_bmi_categories_end_at_99(spark):
    bmis = ["0.0", "24.9", "25.0", "29.9", "30.0", "99.0", "99.1", None]
    rows = spark.createDataFrame([(b,) for b in bmis], "t string").selectExpr(
        "CAST(t AS decimal(5,1)) AS bmi", "CAST(20 AS decimal(5,1)) AS age")
    got = gold.banded_link(rows, gold.dim_age_band(spark), gold.dim_bmi_category(spark))
    assert {str(r["bmi"]): (r["bmi_cat_id"], r["bmi_category"]) for r in got.collect()} == {
        "0.0": (1, "Normal"), "24.9": (1, "Normal"), "25.0": (2, "Overweight"),
        "29.9": (2, "Overweight"), "30.0": (3, "Obese"), "99.0": (3, "Obese"),
        "99.1": (None, "Unknown"), "None": (None, "Unknown"),
    }


@FEW
@given(st.lists(st.integers(-3000, 3000), min_size=1, max_size=60), st.integers(0, 3))
def test_exact_median(spark, numbers, nulls):
    values = [n / 10 for n in numbers] + [None] * nulls
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    got = impute.exact_median(rows, F.col("x"), 6, 1).first()["median"]
    assert got == pytest.approx(statistics.median(n / 10 for n in numbers), abs=1e-9)


def test_median_of_nothing_is_null(spark):
    rows = spark.createDataFrame([], "x double")
    assert impute.exact_median(rows, F.col("x"), 6, 1).first()["median"] is None


def test_median_needs_a_bounded_type(spark):
    with pytest.raises(ValueError, match="at most 8 digits"):
        impute.exact_median(spark.range(1), F.col("id"), 12, 2)


def test_mode_counts_null_and_breaks_ties_low(spark):
    rows = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), (None,)], "x string")
    assert impute.most_frequent(rows, "x").first()["x"] == "a"
    rows = spark.createDataFrame([("b",), (None,), (None,)], "x string")
    assert impute.most_frequent(rows, "x").first()["x"] is None


def test_integer_mean_is_cut(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    assert rows.select(F.expr(impute.int_mean("x"))).first()[0] == 1


def test_defaults_of_an_empty_table_are_null(spark):
    empty = spark.createDataFrame([], "x int, t string")
    one = spark.range(1).withColumns({
        "d": impute.scalars_of(empty, x=impute.mean_default("x", 2, "decimal(6,2)")),
        "m": impute.mode_default(empty, "t"),
    })
    row = one.select("id", "d.x", "m").collect()
    assert [tuple(r) for r in row] == [(0, None, None)]


def test_first_and_latest_rows(spark):
    rows = spark.createDataFrame(
        [(1, "a", 3, 1), (2, "a", 5, 2), (3, "a", 5, 3), (4, "b", 1, 4)],
        "id int, k string, at int, tie int",
    )
    assert {r["id"] for r in first_row_per(rows, ["k"], ["id"]).collect()} == {1, 4}
    assert {r["id"] for r in latest_row_per(rows, "k", "at", "tie").collect()} == {3, 4}


def test_first_row_is_cut_before_the_shuffle(spark):
    rows = first_row_per(spark.range(10).selectExpr("id", "id % 2 AS k"), ["k"], ["id"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_key_report_and_orphans(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert quality.key_report(rows, "k").first().asDict() == {
        "rows": 5, "distinct_keys": 2, "duplicate_keys": 1, "null_keys": 2,
    }
    parents = spark.createDataFrame([(2,)], "p int")
    assert [tuple(r) for r in quality.orphans(rows, "k", parents, "p").collect()] == [(1, 2)]


def test_range_split_lets_null_pass(spark):
    rows = spark.createDataFrame([(1, 5), (2, 50), (3, None)], "id int, x int")
    passed, broken = quality.range_split(rows, {"x": (0, 10)})
    assert {r["id"] for r in passed.collect()} == {1, 3}
    assert [(r["id"], r["broken"]) for r in broken.collect()] == [(2, "x")]


def test_fanout_audit(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    lines = {int(r["multiplicity"]): (r["rows_before"], int(r["rows_after"]))
             for r in quality.fanout_audit(left, [right], "k").collect()}
    assert lines == {2: (2, 4), 1: (1, 1)}
