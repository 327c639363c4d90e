"""Date dimension and snapshot calendars."""

from __future__ import annotations

import calendar
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.risk import date_key

OPEN_END = "9999-12-31"


def dim_date(spark: SparkSession, start: str = "2018-01-01", end: str = "2030-12-31") -> DataFrame:
    """One row per day; as many rows as the range has days, so its size is known up front."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("full_date"))
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"), day, F.year(day).alias("year"), F.quarter(day).alias("quarter"),
        F.month(day).alias("month"), F.date_format(day, "MMMM").alias("month_name"),
        (day == F.last_day(day)).alias("is_reporting_period_end"))


def key_to_date(key: int) -> date:
    return date(key // 10000, key // 100 % 100, key % 100)


def key_day(key: Column) -> Column:
    """The date of an integer yyyymmdd, without a round trip through text."""
    return F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100)


def date_to_key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def months_before(day: date, months: int) -> date:
    """Same day some months earlier, clamped to the end of a shorter month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = index // 12, index % 12 + 1
    return date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


def month_ends(last: date, count: int) -> list[date]:
    """The ``count`` month ends up to and including the month of ``last``, oldest first."""
    out = []
    for back in range(count - 1, -1, -1):
        first = months_before(last.replace(day=1), back)
        out.append(first.replace(day=calendar.monthrange(first.year, first.month)[1]))
    return out
