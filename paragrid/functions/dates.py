"""Dates kept as ISO strings: shapes are checked, calendars are not, as in the source material."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import zero_pad

#: German month names.
MONTHS = {
    "januar": 1, "februar": 2, "maerz": 3, "märz": 3, "april": 4, "mai": 5, "juni": 6,
    "juli": 7, "august": 8, "september": 9, "oktober": 10, "november": 11, "dezember": 12,
}
GERMAN = r"^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{2,4})"
INSIDE = r"([0-9]{1,2}\.[0-9]{1,2}\.[0-9]{2,4})"
PIVOT = 50


def _iso(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", zero_pad(year, 4), zero_pad(month, 2), zero_pad(day, 2))


def german_date(text: Column) -> Column:
    """``d.m.yy(yy)`` at the start of a text to ISO; two-digit years turn at 50; null if absent."""
    day, month, year = (F.regexp_extract(text, GERMAN, k) for k in (1, 2, 3))
    century = F.when(F.length(year) == 2, F.when(year >= str(PIVOT), F.concat(F.lit("19"), year)).otherwise(F.concat(F.lit("20"), year))).otherwise(year)
    return F.when(text.rlike(GERMAN), _iso(century, month, day))


def first_stand_date(comments: Column) -> Column:
    """Date of the first comment, in order, that has one."""
    dated = F.filter(comments, lambda c: F.coalesce(c, F.lit("")).rlike(INSIDE))
    return german_date(F.regexp_extract(F.get(dated, F.lit(0)), INSIDE, 1))


def long_german_date(day: Column, month: Column, year: Column) -> Column:
    """Day, month name or number, and year to ISO; an unknown month is null."""
    name = F.lit(None).cast("string")
    for k, v in MONTHS.items():
        name = F.when(F.lower(month) == k, str(v)).otherwise(name)
    number = F.when(month.rlike("^[0-9]+$"), month).otherwise(name)
    return F.when(number.isNotNull() & day.rlike("^[0-9]+$") & year.rlike("^[0-9]+$"), _iso(year, number, day))


def decision_date(text: Column) -> Column:
    """ISO stays, ``d.m.yyyy`` becomes ISO, anything else stays trimmed."""
    clean = F.trim(text)
    return F.when(clean.rlike(r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$"), german_date(clean)).otherwise(clean)


def strict_date(text: Column) -> Column:
    """DATE of the first ten characters; an invalid date is an error."""
    return F.to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def effective_date(stand: Column, as_of: str) -> Column:
    """The stand date, or the run's date where it is missing or empty."""
    return F.coalesce(F.nullif(stand, F.lit("")), F.lit(as_of))
