"""Small typed expressions shared by the plans. None of them raises on bad data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def int_or_null(text: Column) -> Column:
    """A whole number; of plain decimal text the whole part. Anything else is null.

    The cast raises and catches an error for text that does not fit, so text with other characters
    than digits, signs and those the cast trims never gets there.
    """
    other = text.rlike(r"[^0-9+\-\x00-\x20\x7F]")
    decimal = F.regexp_extract(F.trim(text), r"^([+-]?[0-9]+)[.][0-9]*$", 1)
    return F.when(other, F.nullif(decimal, F.lit("")).try_cast("int")).otherwise(
        text.try_cast("int")
    )


def date_or_null(text: Column) -> Column:
    """The date of a text that is exactly ``yyyy-MM-dd``.

    A cast also takes shorter and longer forms, so the date must print as the text it came from.
    This is faster than a format pattern, most of all on text that does not fit, where the pattern
    parser raises and catches an error per row.
    """
    day = text.try_cast("date")
    return F.when(day.cast("string") == text, day)


def timestamp_or_null(text: Column) -> Column:
    """Midnight of a ``yyyy-MM-dd`` day in the session zone."""
    return date_or_null(text).cast("timestamp")


def flag(condition: Column) -> Column:
    """A boolean that is false, not null, when the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def ratio(part: Column, whole: Column) -> Column:
    """Double division; null instead of an error when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def yesterday(as_of: Column) -> Column:
    return F.date_sub(as_of, 1)
