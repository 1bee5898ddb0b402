"""Text cleansing as built-in column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

MALE, FEMALE, UNKNOWN = "Male", "Female", "Unknown"

# Accepted spelling (upper case) -> written label.
GENDER_LABELS = {"MALE": MALE, "FEMALE": FEMALE}
BMI_LABELS = {
    "NORMAL WEIGHT": "Normal",
    "NORMAL": "Normal",
    "OVERWEIGHT": "Overweight",
    "OBESE": "Obese",
}
SMOKING_LABELS = {
    "NO INFO": "Unknown",
    "": "Unknown",
    "NEVER": "Never",
    "CURRENT": "Current",
    "FORMER": "Former",
    "EVER": "Ever",
    "NOT CURRENT": "Not Current",
}
BMI_MART_LABELS = {
    "Normal": "Normal",
    "Normal Weight": "Normal",
    "Overweight": "Overweight",
    "Obese": "Obese",
}


def relabel(value: Column, labels: Mapping[str, str], default: Column) -> Column:
    """Map exact texts to labels; anything else, NULL included, takes the default."""
    by_label: dict[str, list[str]] = {}
    for accepted, label in labels.items():
        by_label.setdefault(label, []).append(accepted)
    chain = None
    for label, accepted in by_label.items():
        step = F if chain is None else chain
        chain = step.when(value.isin(accepted), F.lit(label))
    return chain.otherwise(default)


def tidy(value: Column) -> Column:
    """Spelling used for comparison: outer blanks off, upper case."""
    return F.upper(F.trim(value))


def gender_canonical(raw: Column) -> Column:
    return relabel(tidy(raw), GENDER_LABELS, F.lit(UNKNOWN))


def gender_in_key(raw: Column) -> Column:
    """Gender as two of the patient keys spell it: anything that is not male is female."""
    return F.when(tidy(raw) == "MALE", F.lit(MALE)).otherwise(F.lit(FEMALE))


def gender_from_male_flag(flag: Column) -> Column:
    """1 is male, everything else (NULL too) female."""
    return F.when(flag == 1, F.lit(MALE)).otherwise(F.lit(FEMALE))


def gender_from_code(code: Column) -> Column:
    """0 is female, everything else (NULL too) male; the code arrives as text."""
    return F.when(code.try_cast("int") == 0, F.lit(FEMALE)).otherwise(F.lit(MALE))


def bmi_label(raw: Column) -> Column:
    """Cleansed category; an unknown spelling counts as Normal."""
    return relabel(tidy(raw), BMI_LABELS, F.lit("Normal"))


def bmi_mart_label(label: Column) -> Column:
    """Category as the marts group it; an unknown spelling counts as Unknown."""
    return relabel(label, BMI_MART_LABELS, F.lit(UNKNOWN))


def disorder_sampled(raw: Column) -> Column:
    """NULL and any spelling of Healthy become the text None; blank text stays blank."""
    return F.when(raw.isNull() | (tidy(raw) == "HEALTHY"), F.lit("None")).otherwise(F.trim(raw))


def disorder_clinical(raw: Column) -> Column:
    """NULL and blank become the text None; Healthy is kept."""
    return F.coalesce(F.nullif(F.trim(raw), F.lit("")), F.lit("None"))


def blank_to_unknown(value: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(UNKNOWN))


def smoking_label(raw: Column) -> Column:
    """Known spellings take their label, others are only trimmed; NULL stays NULL."""
    return relabel(tidy(raw), SMOKING_LABELS, F.trim(raw))


def split_reading(reading: Column) -> tuple[Column, Column]:
    """``systolic/diastolic`` as two SMALLINTs.

    Text without a slash gives NULL on both sides, as does a side that is no number.
    """
    has_both = F.contains(reading, F.lit("/"))

    def side(index: int) -> Column:
        part = F.split_part(reading, F.lit("/"), F.lit(index))
        return F.when(has_both, part.try_cast("smallint"))

    return side(1), side(2)


def concat_blank(*parts: Column) -> Column:
    """Concatenation in which NULL counts as empty text."""
    return F.concat(*(F.coalesce(part.cast("string"), F.lit("")) for part in parts))
