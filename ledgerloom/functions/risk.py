"""Business classifications and calendar arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def signed_amount(kind: Column, amount: Column) -> Column:
    """Repayments lower the balance, every other movement raises it."""
    return F.when(kind == "REPAYMENT", -amount).otherwise(amount)


def ifrs9_stage(dpd: Column) -> Column:
    return F.when(dpd > 90, 3).when(dpd > 30, 2).otherwise(1)


def score_band(score: Column) -> Column:
    """Left-closed bands: a score of exactly 500 belongs to 500-600."""
    return (F.when(score.isNull(), F.lit(None).cast("string"))
            .when(score < 500, "0-500").when(score < 600, "500-600")
            .when(score < 700, "600-700").when(score < 750, "700-750").otherwise("750+"))


def internal_rating(score: Column) -> Column:
    return (F.when(score >= 750, "AAA").when(score >= 700, "AA")
            .when(score >= 600, "A").when(score >= 500, "BBB").otherwise("SPECULATIVE"))


def event_type(dpd: Column) -> Column:
    return F.when(dpd > 90, "DEFAULT").when(dpd > 0, "MISSED_PAYMENT").otherwise("REGULAR")


def drift_status(psi: Column) -> Column:
    # Published status wording.
    return F.when(psi > 0.25, "Dérive").when(psi > 0.1, "Surveillance").otherwise("Stable")


def date_key(day: Column) -> Column:
    """Integer yyyymmdd, computed without a round trip through text."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_boundaries(start: Column, end: Column) -> Column:
    """Calendar months crossed between two days (not elapsed months)."""
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("int")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def utilization(balance: Column, limit: Column, cap: float | None = None) -> Column:
    """Drawn share of the limit; with ``cap`` the reporting rule: a zero limit counts as the
    cap when something is drawn and as missing when nothing is."""
    ratio = balance.cast("double") / F.nullif(limit.cast("double"), F.lit(0.0))
    if cap is None:
        return F.when(limit > 0, ratio)
    return (F.when((limit == 0) & (balance > 0), F.lit(cap))
            .when(ratio > cap, F.lit(cap)).otherwise(ratio))
