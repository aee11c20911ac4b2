"""Scalar expressions: fixed-point stars, recodes, dates, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Activity codes, completed state, star types, date text format.
CERTIFICATE = "OAMTYPCD01"
LANGUAGE = "OAMTYPCD02"
VOLUNTEERING = "OAMTYPCD03"
EXTERNAL = "OAMTYPCD04"
PLACEMENT = "OAMTYPCD05"
TITLE_CODES = [CERTIFICATE, LANGUAGE]
COUNT_CODES = [VOLUNTEERING, EXTERNAL, PLACEMENT]
COMPLETED = "NCR_T07_P05"
COURSE_STAR = "C"
PROGRAMME_STAR = "N"
DATE_TEXT_FORMAT = "dd-MMM-yyyy (HH:mm:ss.SSSSSS)"

# Stars are summed as whole ten-thousandths, so means do not depend on row order.
STAR_UNITS = 10_000


def int_div(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, denominator)


def star_units(star: Column) -> Column:
    return F.floor(star * STAR_UNITS + 0.5).cast("bigint")


def units_mean(units: Column, count: Column) -> Column:
    """Mean star from a sum of units and a row count."""
    return units / (count * F.lit(float(STAR_UNITS)))


def mean_star(star: Column) -> Column:
    return units_mean(F.sum(star_units(star)), F.count(star))


def quantise(value: Column, scale: int = 10) -> Column:
    """``value * scale`` cut toward zero to a whole number."""
    return (value * F.lit(float(scale))).cast("bigint")


def safe_int_ratio(part: Column, total: Column) -> Column:
    """Whole-number ratio; a total of 0 counts as 1."""
    return int_div(part, F.greatest(total, F.lit(1).cast("bigint")))


def safe_ratio(part: Column, total: Column) -> Column:
    return part / F.greatest(total, F.lit(1).cast("bigint")).cast("double")


def zero_safe_div(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0.0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def short_gender(gender: Column) -> Column:
    """Student register wording to graduate register wording."""
    return F.when(gender == "남성", "남").otherwise("여")


def date_to_text(ts: Column) -> Column:
    return F.date_format(ts, DATE_TEXT_FORMAT)


def text_to_date(text: Column) -> Column:
    """Null where the text does not follow the format."""
    return F.try_to_timestamp(text, F.lit(DATE_TEXT_FORMAT))


def round_places(value: Column, places: int) -> Column:
    return F.round(value, places)


def random_score(seed: int) -> Column:
    """Uniform placeholder score in [0, 1)."""
    return F.rand(seed)
