"""Edge cases of the cleansing rules, on rows written by hand."""

from __future__ import annotations

import datetime
import hashlib
import re
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from somnolake.functions import keys, numeric, text


def values(spark, kind, items, *columns):
    """Results of column expressions over ``x``, in the order of the items."""
    rows = spark.createDataFrame(list(enumerate(items)), f"i int, x {kind}")
    out = rows.select("i", *(c.alias(f"c{n}") for n, c in enumerate(columns))).orderBy("i").collect()
    return [tuple(row[1:]) if len(columns) > 1 else row[1] for row in out]


def test_age_band_does_not_floor_and_null_is_oldest(spark):
    ages = [0.0, 17.5, 18.0, 30.0, 30.5, 45.0, 60.0, 60.9, 100.0, None]
    assert values(spark, "double", ages, numeric.age_band(F.col("x"))) == [
        "Under 18", "Under 18", "18-30", "18-30", "31-45", "31-45", "46-60", "61+", "61+", "61+",
    ]


def test_bmi_band_has_no_gaps(spark):
    bmis = [24.9, 24.95, 25.0, 29.99, 30.0, 99.1, None]
    assert values(spark, "double", bmis, numeric.bmi_band(F.col("x"))) == [
        "Normal", "Normal", "Overweight", "Overweight", "Obese", "Obese", "Unknown",
    ]


def test_gender(spark):
    raw = [" male", "MALE ", "Female", "Other", "", None]
    both = values(spark, "string", raw, text.gender_canonical(F.col("x")), text.gender_in_key(F.col("x")))
    assert both == [
        ("Male", "Male"), ("Male", "Male"), ("Female", "Female"),
        ("Unknown", "Female"), ("Unknown", "Female"), ("Unknown", "Female"),
    ]


def test_binary_gender_codes_treat_null_differently(spark):
    assert values(spark, "int", [1, 0, None], text.gender_from_male_flag(F.col("x"))) == [
        "Male", "Female", "Female",
    ]
    assert values(spark, "string", ["0", "1", None], text.gender_from_code(F.col("x"))) == [
        "Female", "Male", "Male",
    ]


def test_labels(spark):
    raw = ["Normal Weight", " normal ", "OVERWEIGHT", "obese", "thin", None]
    assert values(spark, "string", raw, text.bmi_label(F.col("x"))) == [
        "Normal", "Normal", "Overweight", "Obese", "Normal", "Normal",
    ]
    assert values(spark, "string", ["Normal Weight", "Obese", "obese", None],
                  text.bmi_mart_label(F.col("x"))) == ["Normal", "Obese", "Unknown", "Unknown"]


def test_disorders_keep_the_text_none(spark):
    raw = ["Healthy", "None", " Insomnia ", "", "  ", None]
    assert values(
        spark, "string", raw,
        text.disorder_sampled(F.col("x")), text.disorder_clinical(F.col("x")), text.blank_to_unknown(F.col("x")),
    ) == [
        ("None", "Healthy", "Healthy"), ("None", "None", "None"),
        ("Insomnia", "Insomnia", "Insomnia"), ("", "None", "Unknown"), ("", "None", "Unknown"),
        ("None", "None", "Unknown"),
    ]


def test_smoking_vocabulary(spark):
    raw = ["No Info", "", "not current", " EVER ", " sometimes ", None]
    assert values(spark, "string", raw, text.smoking_label(F.col("x"))) == [
        "Unknown", "Unknown", "Not Current", "Ever", "sometimes", None,
    ]


def test_reading_without_slash_is_null_on_both_sides(spark):
    raw = ["120/80", " 120 / 80 ", "n/a", "120", "120/", "99999/80", None]
    assert values(spark, "string", raw, *text.split_reading(F.col("x"))) == [
        (120, 80), (120, 80), (None, None), (None, None), (120, None), (None, 80), (None, None),
    ]


def test_numbers_in_text(spark):
    raw = ["20", " 20 ", "20.0", "1e2", "NA", "", "NaN", "12d", "Infinity", ".5", None]
    assert values(spark, "string", raw, numeric.try_int(F.col("x")), numeric.try_float(F.col("x"))) == [
        (20, 20.0), (20, 20.0), (None, 20.0), (None, 100.0), (None, None), (None, None),
        (None, None), (None, None), (None, None), (None, 0.5), (None, None),
    ]


def test_rounding_is_half_away_from_zero(spark):
    assert values(spark, "double", [2.5, -2.5, 1.005, 0.125], numeric.round_decimal(
        F.col("x"), 2, "decimal(7,2)")) == [Decimal("2.50"), Decimal("-2.50"), Decimal("1.01"),
                                   Decimal("0.13")]
    assert values(spark, "double", [2.5, -2.5], F.round(F.col("x"), 0)) == [3.0, -3.0]


@pytest.mark.parametrize(
    ("value_kind", "default", "default_kind", "expected"),
    [
        ("smallint", "128.55", "decimal(6,2)", 128),
        ("smallint", "84.65", "decimal(6,2)", 84),
        ("int", "70.17", "decimal(6,2)", 70),
        ("decimal(5,1)", "93.38", "decimal(5,2)", Decimal("93.4")),
        ("decimal(6,1)", "91.72", "decimal(7,4)", Decimal("91.7")),
        ("decimal(6,2)", "0.3050", "decimal(7,4)", Decimal("0.31")),
        ("decimal(6,2)", "0.3730", "decimal(7,4)", Decimal("0.37")),
    ],
)
def test_default_takes_the_type_of_the_value(spark, value_kind, default, default_kind, expected):
    filled = numeric.isnull_typed(F.col("x"), F.lit(default).cast(default_kind), value_kind)
    rows = spark.createDataFrame([(None,)], "t string").select(F.col("t").cast(value_kind).alias("x"))
    result = rows.select(filled.alias("y"))
    assert result.schema["y"].dataType.simpleString() == value_kind
    assert result.first()["y"] == expected


def test_guarded_ratio(spark):
    rows = spark.createDataFrame([(1, 3), (5, 0), (None, 2), (2, None)], "a int, b int")
    got = [r[0] for r in rows.select(numeric.guarded_ratio(F.col("a"), F.col("b"), 4)).collect()]
    assert got == [0.3333, None, None, None]


def test_elapsed_seconds_counts_boundaries(spark):
    at = datetime.datetime(2024, 1, 1, 0, 0, 0, 900_000)
    rows = spark.createDataFrame(
        [(at, at + datetime.timedelta(milliseconds=200)), (at, at)],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [r[0] for r in rows.select(numeric.elapsed_seconds(F.col("a"), F.col("b"))).collect()]
    assert got == [1, 0]


KEYS = [
    (46, "Female", 23.8, "69391E5E98D24939"),
    (69, "Female", 28.2, "CD75A8B99F0053C7"),
    (48, "Male", 19.6, "2F636B80738A21CF"),
    (47, "Male", 32.2, "46332DEAC528FCDF"),
    (27, "Male", 27.0, "8172DE285FC2083B"),
]


def test_patient_key_goldens(spark):
    rows = spark.createDataFrame(KEYS, "age int, gender string, bmi double, expected string")
    key = keys.patient_key(F.col("age"), F.col("gender"), keys.number_text(F.col("bmi")))
    for row in rows.withColumn("key", key).collect():
        assert row["key"] == row["expected"]


@pytest.mark.parametrize(
    ("age", "category", "expected"),
    [(27, "Overweight", "7FA15442CE724727"), (28, "Normal", "73FF664B7C7D1FAE"),
     (28, "OBESE", "BAD303A04452539A")],
)
def test_midpoint_keys(spark, age, category, expected):
    rows = spark.createDataFrame([(age, category)], "age int, x string")
    key = keys.patient_key(F.col("age"), F.lit("Male"), keys.midpoint_text(F.col("x")))
    assert rows.select(key).first()[0] == expected


def test_numeric_midpoint_meets_measured_keys(spark):
    rows = spark.createDataFrame([(27, "Overweight", 27.0)], "age int, x string, bmi double")
    male = F.lit("Male")
    row = rows.select(
        keys.patient_key(F.col("age"), male, keys.midpoint_text(F.col("x"), numeric=True)).alias("a"),
        keys.patient_key(F.col("age"), male, keys.number_text(F.col("bmi"))).alias("b"),
    ).first()
    assert row["a"] == row["b"]


def test_key_parts_that_are_null_count_as_blank(spark):
    rows = spark.createDataFrame([(None, "Male", None)], "age double, gender string, bmi double")
    key = keys.patient_key(F.col("age"), F.col("gender"), keys.number_text(F.col("bmi")))
    expected = hashlib.md5("_Male_".encode("utf-16-le")).hexdigest().upper()[:16]
    assert rows.select(key).first()[0] == expected


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(
    st.integers(0, 1200), st.sampled_from(["Male", "Female", "Unknown"]), st.integers(0, 999),
), min_size=1, max_size=30))
def test_key_is_the_hash_of_its_text(spark, people):
    rows = spark.createDataFrame(
        [(a / 10, g, b / 10) for a, g, b in people], "age double, gender string, bmi double"
    )
    key = keys.patient_key(F.col("age"), F.col("gender"), keys.number_text(F.col("bmi")))
    got = [r[0] for r in rows.select(key).collect()]
    for (age, gender, bmi), found in zip(people, got, strict=True):
        joined = f"{age // 10}_{gender}_{bmi / 10:g}"
        assert found == hashlib.md5(joined.encode("utf-16-le")).hexdigest().upper()[:16]
        assert re.fullmatch("[0-9A-F]{16}", found)


def test_composite_key(spark):
    rows = spark.createDataFrame(
        [(27.9, "Male", 30.5), (20.0, "Unknown", 7.0), (None, "Male", 30.0), (20.0, "Female", None)],
        "bmi double, gender string, age double",
    )
    got = [r[0] for r in rows.select(
        keys.composite_key(F.col("bmi"), F.col("gender"), F.col("age"))).collect()]
    assert got == ["27_m_30", "20_u_7", None, None]
