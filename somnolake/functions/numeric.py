"""Numeric parsing, rounding, banding and typed null replacement."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

# Fixed values: (id, label, lowest age, highest age), whole years.
AGE_BANDS = (
    (1, "Under 18", 0, 17),
    (2, "18-30", 18, 30),
    (3, "31-45", 31, 45),
    (4, "46-60", 46, 60),
    (5, "61+", 61, 99),
)
# Fixed values: (id, label, lowest BMI, highest BMI).
BMI_CATEGORIES = (
    (1, "Normal", "0", "24.9"),
    (2, "Overweight", "25", "29.9"),
    (3, "Obese", "30", "99.0"),
    (4, "Unknown", None, None),
)
# Fixed values: (id, label, is a sleep disorder).
DISORDERS = ((1, "Healthy", 0), (2, "Sleep Apnea", 1), (3, "Insomnia", 1), (4, "Unknown", 0))
# Fixed values: (id, label).
GENDERS = ((1, "Male"), (2, "Female"), (3, "Unknown"))

_FLOAT_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def try_float(text: Column) -> Column:
    """Text to DOUBLE, NULL when it is no plain number.

    The pattern keeps out spellings only Java reads as numbers ('NaN', '12d').
    """
    return F.when(text.rlike(_FLOAT_TEXT), text.try_cast("double"))


def try_int(text: Column) -> Column:
    """Text to INT, NULL when it is no whole number ('20.0' is none)."""
    return text.try_cast("int")


def round_decimal(value: Column, scale: int, kind: str | DataType) -> Column:
    """Round half away from zero, then store in a declared type."""
    return F.round(value, scale).cast(kind)


def guarded_ratio(part: Column, whole: Column, scale: int) -> Column:
    """part / whole, NULL where whole is 0."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), scale)


def isnull_typed(value: Column, default: Column, kind: str | DataType) -> Column:
    """Replace NULL by a default narrowed to the type of the value.

    A plain coalesce would widen to the common type instead.
    """
    return F.coalesce(value, default.cast(kind))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (NULL too)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("smallint")


def age_band(age: Column) -> Column:
    """Band of an age that is not floored first; NULL falls in the last band."""
    _, youngest, _, _ = AGE_BANDS[0]
    chain = F.when(age < AGE_BANDS[1][2], F.lit(youngest))
    for _, label, _, highest in AGE_BANDS[1:-1]:
        chain = chain.when(age <= highest, F.lit(label))
    return chain.otherwise(F.lit(AGE_BANDS[-1][1]))


def bmi_band(bmi: Column) -> Column:
    """Half-open bands with no gaps; NULL is Unknown."""
    (_, normal, _, _), (_, over, over_from, _), (_, obese, obese_from, _), (_, unknown, _, _) = (
        BMI_CATEGORIES
    )
    return (
        F.when(bmi < int(over_from), F.lit(normal))
        .when(bmi < int(obese_from), F.lit(over))
        .when(bmi >= int(obese_from), F.lit(obese))
        .otherwise(F.lit(unknown))
    )


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Second boundaries passed between two TIMESTAMP_NTZ values."""

    def second_number(moment: Column) -> Column:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.floor(F.timestamp_diff("MICROSECOND", epoch, moment) / F.lit(1_000_000))

    return second_number(end) - second_number(start)
