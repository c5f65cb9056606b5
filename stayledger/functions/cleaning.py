"""Text cleaning and typing. Nothing here raises on bad input: it yields NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that count as absent, and the month names of the data.
NULL_LITERAL = "NULL"
MISSING_SPELLINGS = ["", "null", "none", "nan", "na", "n/a"]
MONTH_NAMES = [
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
]
TIMESTAMP_FORMATS = {"space": "yyyy-M-d H:m:s", "letter": "yyyy-M-d'T'H:m:s", "date": "yyyy-M-d"}


def null_if_absent(trimmed: Column) -> Column:
    """Empty text and the exact word NULL become NULL."""
    return F.when(~trimmed.isin("", NULL_LITERAL), trimmed)


def clean_text(value: Column) -> Column:
    """Trim spaces, then drop null-like text."""
    return null_if_absent(F.trim(value))


def strip(value: Column) -> Column:
    """Remove white space of any kind on both ends."""
    return F.btrim(value, F.lit(" \t\n\r\f\x0b"))


def is_missing(value: Column) -> Column:
    """The profile's wider, case-blind test for absent values."""
    return F.coalesce(F.lower(strip(value)).isin(MISSING_SPELLINGS), F.lit(True))


def month_number(name: Column) -> Column:
    """1..12 for an English month name in any case, else NULL."""
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return F.nullif(F.array_position(names, F.lower(name)), F.lit(0)).cast("int")


def at_least(text: Column, width: int) -> Column:
    """A number's text with zeros in front up to a width; longer ones stay whole."""
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """A date from three numbers; NULL if any is NULL or there is no such day."""
    two = [at_least(part.cast("string"), 2) for part in (month, day)]
    made = F.concat(year.cast("string"), F.lit("-"), two[0], F.lit("-"), two[1]).try_cast("date")
    return F.when(month.between(1, 12) & day.between(1, 31), made)


def parse_effective_at(value: Column) -> Column:
    """A batch time in any of the accepted formats, else NULL.

    The format is chosen by shape, so that a good value is parsed once and no
    parse fails on the way to the right one.
    """
    text = strip(value)

    def parsed(shape: str) -> Column:
        return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMATS[shape]))

    return (
        F.when(F.contains(text, F.lit("T")), parsed("letter"))
        .when(F.contains(text, F.lit(":")), parsed("space"))
        .otherwise(parsed("date"))
    )
