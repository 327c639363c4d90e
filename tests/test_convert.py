from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.convert import to_bit, to_date, to_decimal, to_int
from ledgerloom.functions.risk import (date_key, event_type, ifrs9_stage, internal_rating, month_boundaries,
                                       quarter_label, score_band, utilization)

CASES = [
    # text, int, decimal(18,2), date, bit
    ("", None, None, None, None),
    (None, None, None, None, None),
    (" 12 ", 12, Decimal("12.00"), None, True),
    ("12.5", None, Decimal("12.50"), None, None),
    ("1e3", None, None, None, None),
    ("12.345", None, Decimal("12.35"), None, None),
    ("-.5", None, Decimal("-0.50"), None, None),
    (".", None, None, None, None),
    ("abc", None, None, None, None),
    ("-0", 0, Decimal("0.00"), None, False),
    ("true", None, None, None, True),
    ("FALSE", None, None, None, False),
    ("5", 5, Decimal("5.00"), None, True),
    ("20260731", 20260731, Decimal("20260731.00"), date(2026, 7, 31), True),
    ("2026-07-31", None, None, date(2026, 7, 31), None),
    ("31/07/2026", None, None, None, None),
    ("2026-02-30", None, None, None, None),
    ("99999999999", None, Decimal("99999999999.00"), None, None),
    ("99999999999999999", None, None, None, None),
]


@pytest.fixture(scope="module")
def converted(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, s string")
    s = F.col("s")
    return rows.select("i", to_int(s), to_decimal(s, 18, 2), to_date(s), to_bit(s)).orderBy("i").collect()


@pytest.mark.parametrize("i", range(len(CASES)))
def test_conversion(converted, i):
    assert tuple(converted[i])[1:] == CASES[i][1:]


def _one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("score,band,rating", [
    (None, None, "SPECULATIVE"), (0, "0-500", "SPECULATIVE"), (499, "0-500", "SPECULATIVE"), (500, "500-600", "BBB"),
    (600, "600-700", "A"), (700, "700-750", "AA"), (749, "700-750", "AA"), (750, "750+", "AAA"), (1000, "750+", "AAA")])
def test_score_classes(spark, score, band, rating):
    value = F.lit(score).cast("int")
    assert _one(spark, score_band(value)) == band
    assert _one(spark, internal_rating(value)) == rating


@pytest.mark.parametrize("dpd,stage,event", [(0, 1, "REGULAR"), (1, 1, "MISSED_PAYMENT"), (30, 1, "MISSED_PAYMENT"),
                                             (31, 2, "MISSED_PAYMENT"), (90, 2, "MISSED_PAYMENT"), (91, 3, "DEFAULT")])
def test_stage_and_event(spark, dpd, stage, event):
    assert _one(spark, ifrs9_stage(F.lit(dpd))) == stage
    assert _one(spark, event_type(F.lit(dpd))) == event


def test_calendar_arithmetic(spark):
    def day(text):
        return F.lit(text).cast("date")
    assert _one(spark, month_boundaries(day("2026-01-31"), day("2026-02-01"))) == 1
    assert _one(spark, month_boundaries(day("2025-12-01"), day("2026-12-31"))) == 12
    assert _one(spark, date_key(day("2026-07-31"))) == 20260731
    assert _one(spark, quarter_label(day("2024-09-30"))) == "2024Q3"


@pytest.mark.parametrize("balance,limit,expected", [(50, 100, 0.5), (500, 100, 2.0), (5, 0, 2.0), (0, 0, None), (None, 10, None)])
def test_capped_utilization(spark, balance, limit, expected):
    value = utilization(F.lit(balance).cast("decimal(18,2)"), F.lit(limit).cast("decimal(18,2)"), 2.0)
    assert _one(spark, value) == expected
