"""Reproducible patient keys.

The key is the first 16 upper-case hex digits of the MD5 of ``age_gender_bmi``,
taken over the text's UTF-16LE bytes.  It identifies a profile, not a person: two
people of the same age, gender and BMI share it, so joins on it are many-to-many.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from somnolake.functions.text import MALE, FEMALE, concat_blank, relabel, tidy

# BMI text a category stands for in a key.
BMI_MIDPOINTS = {
    "NORMAL WEIGHT": "22.0",
    "NORMAL": "22.0",
    "OVERWEIGHT": "27.0",
    "OBESE": "32.0",
}
DEFAULT_MIDPOINT = "22.0"


def number_text(value: Column) -> Column:
    """A number rounded to one decimal, as text without a trailing ``.0``.

    The cast rounds half away from zero.
    """
    return F.replace(value.cast("decimal(10,1)").cast("string"), F.lit(".0"), F.lit(""))


def whole_text(value: Column) -> Column:
    return F.floor(value).cast("string")


def midpoint_text(raw_category: Column, numeric: bool = False) -> Column:
    """BMI text of a category.

    The default spelling ('22.0') never equals the spelling of a measured BMI ('22'),
    so these keys meet none made from measurements; ``numeric`` drops the '.0'.
    """
    text = relabel(tidy(raw_category), BMI_MIDPOINTS, F.lit(DEFAULT_MIDPOINT))
    return F.replace(text, F.lit(".0"), F.lit("")) if numeric else text


def patient_key(age: Column, gender: Column, bmi_text: Column) -> Column:
    joined = concat_blank(whole_text(age), F.lit("_"), gender, F.lit("_"), bmi_text)
    return F.upper(F.left(F.md5(F.encode(joined, "UTF-16LE")), F.lit(16)))


def composite_key(bmi: Column, gender: Column, age: Column) -> Column:
    """Readable key ``bmi_g_age`` with whole numbers; NULL if any part is."""
    initial = (
        F.when(gender == MALE, F.lit("m"))
        .when(gender == FEMALE, F.lit("f"))
        .otherwise(F.lower(F.left(gender, F.lit(1))))
    )
    whole = [part.cast("int").cast("string") for part in (bmi, age)]
    return F.concat(whole[0], F.lit("_"), initial, F.lit("_"), whole[1])
