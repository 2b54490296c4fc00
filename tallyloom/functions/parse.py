"""Parsers of coded answers and persona attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyloom.functions.text import extract, tidy, to_long

#: Option codes from here up say "none", "other" or "don't know" and are no scale points.
SENTINEL = 90
PREFIX = r"^\s*\d+\.\s*(\d+\.\s+)?"
OPTIONS_TYPE = "array<struct<option_code:bigint,option_label:string>>"


def options(selected: Column) -> Column:
    """The options of a pipe-joined selection as (code, label), in order.

    The code is the number before the first dot (null without one). The label loses a single or
    doubled `n. ` prefix but keeps a number of its own. Blank parts are dropped; null or blank
    text gives an empty array.
    """
    parts = F.filter(F.split(F.coalesce(selected, F.lit("")), r"\|"), lambda o: tidy(o) != "")
    return F.transform(parts, lambda o: F.struct(
        to_long(extract(o, r"^\s*(\d+)\.")).alias("option_code"), tidy(F.regexp_replace(o, PREFIX, "")).alias("option_label")
    ))


def primary_code(opts: Column) -> Column:
    """The least code that is a scale point; null without one."""
    return F.array_min(F.transform(F.filter(opts, lambda o: o["option_code"] < SENTINEL), lambda o: o["option_code"]))


#: Upper ends and names of the age bands; ranges that map to a band; ranges of uncertain band.
AGE_BANDS = ((17, "13-17"), (24, "18-24"), (34, "25-34"), (44, "35-44"), (54, "45-54"), (None, "55-64"))
AGE_RANGES = {"13-16": "13-17", "17-24": "18-24", "25-29": "25-34", "30-34": "25-34", "35-39": "35-44", "40-44": "35-44"}
AGE_IMPUTED = "17-24"


def age_exact(raw: Column) -> Column:
    return to_long(extract(raw, r"^(\d{1,2})(?:\s|$|\()"))


def banded(value: Column, bands) -> Column:
    """The name of the first band whose upper end is not below the value; the last band has none."""
    out = F.lit(bands[-1][1])
    for top, name in reversed(bands[:-1]):
        out = F.when(value <= top, name).otherwise(out)
    return F.when(value.isNotNull(), out)


def age_band(raw: Column) -> Column:
    """The banner band of an age or age range; a band's own name maps to itself, unknown text to null."""
    known = {**{name: name for _, name in AGE_BANDS}, **AGE_RANGES}
    out = F.lit(None).cast("string")
    for text, name in known.items():
        out = F.when(raw == text, name).otherwise(out)
    return F.when(raw.rlike(r"^\d{1,2}\s*(\(|$)"), banded(to_long(extract(raw, r"^(\d{1,2})")), AGE_BANDS)).otherwise(out)


def age_imputed(raw: Column) -> Column:
    return raw == AGE_IMPUTED


def _dollars(text: Column) -> Column:
    return to_long(F.regexp_replace(text, ",", ""))


def income_low(raw: Column) -> Column:
    return _dollars(extract(raw, r"^\$([\d,]+)"))


def income_high(raw: Column) -> Column:
    """The upper end of a range; of a single amount, the amount."""
    return F.coalesce(_dollars(extract(raw, r"-\s*\$([\d,]+)")), income_low(raw))


def nps_band(score: Column, null_is_detractor: bool = False) -> Column:
    """Promoter from 9, Passive from 7, else Detractor. A null score has no band unless told otherwise."""
    band = F.when(score >= 9, "Promoter").when(score >= 7, "Passive").otherwise("Detractor")
    return band if null_is_detractor else F.when(score.isNotNull(), band)


def quadrant(is_male: Column, is_younger: Column) -> Column:
    """Men or Women, under 35 or not, from two flags; null if either is."""
    sex = F.when(is_male, "Men").when(~is_male, "Women")
    return F.concat(sex, F.when(is_younger, " <35").when(~is_younger, " 35+"))
