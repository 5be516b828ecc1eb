"""Casts that give null instead of failing, and strict format checks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DECIMAL_TEXT = r"^-?\d+(\.\d+)?$"
# decimal text that is not negative once rounded to a whole number
ROUNDS_TO_POSITIVE = r"^(\d+(\.\d+)?|-0+(\.[0-4]\d*)?)$"
WIDE = "decimal(38,10)"


# A cast to a number or an instant leaves out blanks at both ends itself: only the pattern needs the trimmed text.


def digits_to_long(c: Column) -> Column:
    return F.when(F.trim(c).rlike(r"^\d+$"), c.try_cast("bigint"))


def positive_id(c: Column) -> Column:
    return F.when(F.trim(c).rlike(r"^0*[1-9]\d*$"), c.try_cast("bigint"))


def rounded_decimal(c: Column, places: int) -> Column:
    """Decimal text rounded half away from zero; other text is null."""
    return F.when(c.rlike(DECIMAL_TEXT), F.round(c.try_cast(WIDE), places))


def _whole_or_rounded(c: Column) -> Column:
    """Whole numbers are read as they are; only text with a fraction takes the way over decimals."""
    return F.coalesce(c.try_cast("bigint"), F.round(c.try_cast(WIDE), 0).try_cast("bigint"))


def rounded_long(c: Column) -> Column:
    return F.when(c.rlike(DECIMAL_TEXT), _whole_or_rounded(c))


def rounded_not_negative(c: Column) -> Column:
    """Decimal text rounded to a whole number; unreadable or negative text is null."""
    return F.when(c.rlike(ROUNDS_TO_POSITIVE), _whole_or_rounded(c))


def iso_date(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def iso_timestamp(c: Column) -> Column:
    """ISO date, or date and time joined by ``T`` or a blank; the cast reads either."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2})?$"), c.try_cast("timestamp_ntz"))


def matches_date_format(c: Column) -> Column:
    """Year-month-day and nothing else; month and day may lack the leading zero."""
    text = F.trim(c)
    shaped = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    return F.coalesce(shaped & text.try_cast("date").isNotNull(), F.lit(False))


def matches_timestamp_format(c: Column) -> Column:
    text = F.trim(c)
    shaped = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$")
    return F.coalesce(shaped & text.try_cast("timestamp_ntz").isNotNull(), F.lit(False))


def whole_number(c: Column) -> Column:
    """Integral numeric text such as ``7``, ``-7`` or ``7.0``; a fraction is null."""
    return F.when(F.trim(c).rlike(r"^[+-]?\d+(\.0*)?$"), F.trim(c).try_cast(WIDE).try_cast("bigint"))


def truncated_number(c: Column) -> Column:
    """Numeric text cut to its whole part."""
    return F.trim(c).try_cast("double").try_cast("bigint")
