"""Data-quality report over staging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.convert import to_date, to_decimal, to_int
from ledgerloom.functions.risk import month_label

# The steps of a monthly run, in order, with the layers they connect.
RUN_STEPS = [
    ("cleanse_customers", "staging → cleansed"),
    ("cleanse_accounts", "staging → cleansed"),
    ("cleanse_transactions", "staging → cleansed"),
    ("cleanse_credit_bureau", "staging → cleansed"),
    ("merge_dim_customer_scd2", "cleansed → curated"),
    ("load_fact_exposure", "cleansed → curated"),
    ("load_fact_credit_event", "cleansed → curated"),
    ("load_fact_credit_rating_history", "cleansed → curated"),
    ("compute_customer_risk_features", "curated → feature_mart"),
]


def _failed_tests(table: str) -> list[Column]:
    """Each test counts on its own: a row failing two of them counts twice."""
    if table == "stg_customers":
        return [F.col("customer_source_id").isNull(), F.col("segment").isNull()]
    if table == "stg_accounts":
        limit = to_decimal(F.col("credit_limit"), 38, 6)
        return [limit.isNull() | (limit < 0)]
    if table == "stg_transactions":
        dpd = to_int(F.col("dpd_snapshot"))
        return [(dpd < 0) | (dpd > 999)]
    if table == "stg_credit_bureau":
        score = to_int(F.col("bureau_score"))
        return [(score < 0) | (score > 1000)]
    raise KeyError(table)


def quality_by_table(staged: dict[str, DataFrame]) -> DataFrame:
    """Rows checked, rows failed and pass rate per staged table; one scan per table."""
    parts = []
    for table, df in staged.items():
        failed = reduce(Column.__add__, [F.count_if(t) for t in _failed_tests(table)])
        parts.append(df.agg(F.count("*").alias("rows_checked"), failed.alias("rows_quarantined"))
                     .select(F.lit(table).alias("table_name"), "rows_checked", "rows_quarantined"))
    return reduce(DataFrame.unionByName, parts).withColumn("pass_rate_pct", _pass_rate("rows_quarantined", "rows_checked"))


def _pass_rate(failed: str, checked: str) -> Column:
    rate = F.try_divide(F.col(failed).cast("double"), F.col(checked).cast("double"))
    return F.bround(F.coalesce((1 - rate) * 100, F.lit(100.0)), 2)


def overall_quality(by_table: DataFrame) -> DataFrame:
    totals = by_table.agg(F.sum("rows_checked").alias("total_rows_checked"),
                          F.sum("rows_quarantined").alias("total_rows_quarantined"))
    return totals.withColumn("overall_pass_rate_pct", _pass_rate("total_rows_quarantined", "total_rows_checked"))


def transactions_by_month(staged_transactions: DataFrame) -> DataFrame:
    """Rows per calendar month of the transaction date; unreadable dates are left out."""
    day = to_date(F.col("transaction_date"))
    return (staged_transactions.select(month_label(day).alias("month")).where(F.col("month").isNotNull())
            .groupBy("month").agg(F.count("*").alias("n")).orderBy("month"))


def quality_report(staged: dict[str, DataFrame], rules: DataFrame) -> dict[str, DataFrame]:
    by_table = quality_by_table(staged)
    spark = rules.sparkSession
    steps = spark.createDataFrame([(i, *s) for i, s in enumerate(RUN_STEPS)], "ordinal int, step string, layer string")
    return {
        "rule_catalog": rules.select("target_table", "target_column", "rule_type", "rule_expression", "severity"),
        "quality_by_table": by_table,
        "overall": overall_quality(by_table),
        "txn_by_month": transactions_by_month(staged["stg_transactions"]),
        "steps": steps,
    }
