"""Tolerant text-to-type conversion: anything unreadable becomes NULL, nothing raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPACT_DATE = r"^\s*[0-9]{8}\s*$"


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    """Plain notation only: exponents are not numbers here although Spark's cast takes them.
    A byte search is enough to tell, and costs far less than a pattern on every value."""
    has_exponent = text.contains("e") | text.contains("E")
    return F.when(~has_exponent, text.try_cast(f"decimal({precision},{scale})"))


def to_int(text: Column) -> Column:
    return text.try_cast("int")


def to_date(text: Column) -> Column:
    """ISO dates, plus the compact yyyyMMdd spelling."""
    compact = F.when(text.rlike(_COMPACT_DATE), F.try_to_date(F.trim(text), "yyyyMMdd"))
    return F.coalesce(text.try_cast("date"), compact)


def to_bit(text: Column) -> Column:
    """'true'/'false' in any case, otherwise any readable non-zero integer is true."""
    word = F.lower(F.trim(text))
    return (F.when(word == "true", F.lit(True))
            .when(word == "false", F.lit(False))
            .otherwise(text.try_cast("int") != 0))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
