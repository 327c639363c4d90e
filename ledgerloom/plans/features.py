"""Rolling risk features per customer at an as-of date.

Only the newest row per customer is kept in the end, and no measure looks further back than
twelve rows. So the rows are first cut to the twelve newest per customer (before the
shuffle), and the moving windows become conditional aggregates over that short tail. A
customer owning a large part of the facts costs no more than any other.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.risk import month_boundaries
from ledgerloom.operators.dedup import newest_rows
from ledgerloom.sources.calendar import date_to_key, key_to_date, months_before

# Window lengths in rows.
ROWS_SHORT, ROWS_LONG, ROWS_DPD, LAG_DPD, LAG_SCORE = 3, 12, 6, 3, 6
_MONEY = "decimal(18,2)"


def lower_bound(as_of: date) -> int:
    """First date key of the twelve-month look-back, bound included."""
    return date_to_key(months_before(as_of, 12))


def exposure_tail(exposures: DataFrame, as_of: date, grain: str = "account_rows") -> DataFrame:
    """Exposure rows of the look-back window.

    ``account_rows`` keeps one row per account and date, so frames count account rows;
    ``customer_month`` adds the accounts of a customer up per date first.
    """
    window = exposures.where(F.col("date_key").between(lower_bound(as_of), date_to_key(as_of)))
    columns = ["customer_key", "date_key", "outstanding_balance", "credit_limit", "dpd_current"]
    if grain == "account_rows":
        return window.select(*columns, "account_source_id")
    if grain == "customer_month":
        return window.groupBy("customer_key", "date_key").agg(
            F.sum("outstanding_balance").cast(_MONEY).alias("outstanding_balance"),
            F.sum("credit_limit").cast(_MONEY).alias("credit_limit"), F.max("dpd_current").alias("dpd_current"))
    raise ValueError(f"unknown grain: {grain}")


def utilization_ratio() -> Column:
    """Balance over limit; NULL without a limit, and NULL where the ratio does not fit."""
    ratio = F.col("outstanding_balance") / F.nullif("credit_limit", F.lit(0).cast(_MONEY))
    return F.when(F.col("credit_limit") > 0, ratio.try_cast("decimal(6,4)"))


def _within(rows: int, value: str) -> Column:
    return F.when(F.col("_rank") <= rows, F.col(value))


def _at(rank: int, value: str) -> Column:
    return F.max(F.when(F.col("_rank") == rank, F.col(value)))


def balance_features(exposures: DataFrame, as_of: date, grain: str = "account_rows") -> DataFrame:
    tail = exposure_tail(exposures, as_of, grain)
    newest_by = ["date_key"] + (["account_source_id"] if "account_source_id" in tail.columns else [])
    ranked = newest_rows(tail, ["customer_key"], newest_by, ROWS_LONG)
    balance = "outstanding_balance"
    per_customer = ranked.groupBy("customer_key").agg(
        _at(1, balance).alias(balance), _at(1, "credit_limit").alias("credit_limit"),
        _at(1, "dpd_current").alias("dpd_current"),
        F.max(_within(ROWS_DPD, "dpd_current")).alias("dpd_max_last_6m"),
        (_at(1, "dpd_current") - _at(1 + LAG_DPD, "dpd_current")).alias("dpd_trend_3m"),
        F.avg(_within(ROWS_SHORT, balance)).alias("avg_balance_3m"),
        F.avg(_within(ROWS_LONG, balance)).alias("avg_balance_12m"),
        F.stddev_samp(_within(ROWS_DPD, balance).cast("double")).alias("payment_volatility_6m"))
    return per_customer.select(
        "customer_key", utilization_ratio().alias("utilization_ratio"), "dpd_current", "dpd_max_last_6m",
        F.col("dpd_trend_3m").cast("decimal(6,2)"), F.col("avg_balance_3m").cast(_MONEY),
        F.col("avg_balance_12m").cast(_MONEY), F.col("payment_volatility_6m").try_cast("decimal(10,4)"))


def bureau_features(ratings: DataFrame, as_of: date) -> DataFrame:
    """Current score and its distance to the score six reports earlier."""
    known = ratings.where(F.col("date_key") <= date_to_key(as_of)).select("customer_key", "date_key", "bureau_score")
    ranked = newest_rows(known, ["customer_key"], ["date_key"], 1 + LAG_SCORE)
    current = _at(1, "bureau_score")
    return ranked.groupBy("customer_key").agg(
        current.alias("bureau_score_current"),
        (current - _at(1 + LAG_SCORE, "bureau_score")).alias("bureau_score_delta_6m"))


def missed_payments(events: DataFrame, as_of: date, bound_to_as_of: bool = False) -> DataFrame:
    """Missed payments (not defaults) since twelve months before the as-of date. The window is
    open towards the present unless ``bound_to_as_of``."""
    kept = events.where((F.col("event_type") == "MISSED_PAYMENT") & (F.col("date_key") >= lower_bound(as_of)))
    if bound_to_as_of:
        kept = kept.where(F.col("date_key") <= date_to_key(as_of))
    return kept.groupBy("customer_key").agg(F.count("*").cast("int").alias("n_missed_payments_12m"))


def customer_risk_features(exposures: DataFrame, ratings: DataFrame, events: DataFrame, dim_customer: DataFrame,
                           as_of_key: int, batch_id: int, run_ts: Column, grain: str = "account_rows",
                           bound_to_as_of: bool = False) -> DataFrame:
    """One row per customer with exposure in the look-back window. All joins are between
    tables already reduced to one row per customer."""
    as_of = key_to_date(as_of_key)
    current = dim_customer.where("is_current").select("customer_key", "effective_date")
    return (balance_features(exposures, as_of, grain)
            .join(bureau_features(ratings, as_of), "customer_key", "left")
            .join(missed_payments(events, as_of, bound_to_as_of), "customer_key", "left")
            .join(current, "customer_key", "left")
            .select(F.lit(as_of_key).alias("date_key"), "customer_key", "utilization_ratio", "dpd_current",
                    "dpd_max_last_6m", "dpd_trend_3m", "avg_balance_3m", "avg_balance_12m",
                    "payment_volatility_6m",
                    F.coalesce("n_missed_payments_12m", F.lit(0)).alias("n_missed_payments_12m"),
                    "bureau_score_current", "bureau_score_delta_6m",
                    month_boundaries(F.col("effective_date"), run_ts).alias("months_since_onboarding"),
                    F.lit(False).alias("is_default_flag"), run_ts.alias("computed_at"),
                    F.lit(batch_id).cast("bigint").alias("batch_id")))


def moving_windows(monthly: DataFrame) -> DataFrame:
    """The moving measures at every row of a (customer_key, date_key) series.

    The input holds one row per customer and date, so a window never spans more rows than
    there are reporting dates.
    """
    series = Window.partitionBy("customer_key").orderBy("date_key")

    def last(rows: int):
        return series.rowsBetween(1 - rows, Window.currentRow)

    balance = F.col("outstanding_balance")
    return monthly.select(
        "customer_key", "date_key",
        F.avg(balance).over(last(ROWS_SHORT)).cast(_MONEY).alias("avg_balance_3m"),
        F.avg(balance).over(last(ROWS_LONG)).cast(_MONEY).alias("avg_balance_12m"),
        F.max("dpd_current").over(last(ROWS_DPD)).alias("dpd_max_last_6m"),
        (F.col("dpd_current") - F.lag("dpd_current", LAG_DPD).over(series)).alias("dpd_trend_3m"),
        F.stddev_samp(balance.cast("double")).over(last(ROWS_DPD)).alias("payment_volatility_6m"))


def utilization_by_date(exposures: DataFrame) -> DataFrame:
    """(date_key, customer_key, utilization_ratio): what the feature table holds for each
    reporting date, for a whole history at once."""
    rows = exposures.select("customer_key", "date_key", "account_source_id", "outstanding_balance", "credit_limit")
    newest = newest_rows(rows, ["date_key", "customer_key"], ["account_source_id"], 1)
    return newest.select("date_key", "customer_key", utilization_ratio().alias("utilization_ratio"))
