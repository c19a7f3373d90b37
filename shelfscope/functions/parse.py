"""Safe typing of landed strings.

Every function returns NULL for text it cannot read and never raises, whatever
the session's ANSI setting. A cast that refuses a text throws inside Spark, which costs
many times what reading a value does, so numbers are cast only if they look like one; the
costlier patterns are evaluated only for the values that a cheap test refuses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: an integer with an optional ignored fraction, and a date that
# may have one-digit month or day and trailing text after a non-digit.
INT_PATTERN = r"^\s*([+-]?\d+)(\.\d*)?\s*$"
# What a cast reads, blanks and control characters around it included.
CAST_PATTERN = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*\z"
# Every numeral has a digit, or is one of these names.
NUMERAL_PATTERN = r"[0-9]|(?i:nan|inf)"
DATE_PATTERN = r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})(?:\D|$)"


def clean_text(value: Column) -> Column:
    """Strip leading and trailing spaces (tabs are data and stay)."""
    return F.trim(value)


def title_text(value: Column) -> Column:
    """Strip spaces and title-case each space-separated word."""
    return F.initcap(F.trim(value))


def to_double(value: Column) -> Column:
    return F.when(F.rlike(value, F.lit(NUMERAL_PATTERN)), value).try_cast("double")


def to_int(value: Column) -> Column:
    """Integer part of a decimal numeral; NULL for exponents and overflow."""
    whole = F.nullif(F.regexp_extract(value, INT_PATTERN, 1), F.lit(""))
    return F.when(F.rlike(value, F.lit(CAST_PATTERN)), value).otherwise(whole).try_cast("int")


def to_date(value: Column) -> Column:
    """``yyyy-MM-dd``, also with one-digit parts or trailing text."""
    shaped = (
        (F.length(value) == 10)
        & (F.substring(value, 5, 1) == "-")
        & (F.substring(value, 8, 1) == "-")
    )
    parts = [F.regexp_extract(value, DATE_PATTERN, group) for group in (1, 2, 3)]
    padded = F.concat_ws("-", parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0"))
    return F.coalesce(F.when(shaped, value.try_cast("date")), padded.try_cast("date"))
