"""The business rules and views as SQL functions of a session.

Every function is plain SQL that the optimizer inlines; nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Scalar functions: name and arguments, type, body.
SCALARS = [
    ("ifrs9_stage(dpd INT)", "INT", "CASE WHEN dpd > 90 THEN 3 WHEN dpd > 30 THEN 2 ELSE 1 END"),
    ("score_band(score INT)", "STRING", "CASE WHEN score IS NULL THEN NULL WHEN score < 500 THEN '0-500' WHEN score < 600 THEN '500-600' "
                                        "WHEN score < 700 THEN '600-700' WHEN score < 750 THEN '700-750' ELSE '750+' END"),
    ("internal_rating(score INT)", "STRING", "CASE WHEN score >= 750 THEN 'AAA' WHEN score >= 700 THEN 'AA' WHEN score >= 600 THEN 'A' "
                                             "WHEN score >= 500 THEN 'BBB' ELSE 'SPECULATIVE' END"),
    ("signed_amount(kind STRING, amount DECIMAL(18,2))", "DECIMAL(18,2)", "CASE WHEN kind = 'REPAYMENT' THEN -amount ELSE amount END"),
    ("date_key(day DATE)", "INT", "year(day) * 10000 + month(day) * 100 + day(day)"),
]

# Table functions over the views `accounts`, `transactions` and `credit_bureau`.
TABLES = [
    ("exposure_at(as_of DATE)",
     "account_source_id STRING, customer_source_id STRING, product_code STRING, outstanding_balance DECIMAL(18,2), credit_limit DECIMAL(18,2), dpd_current INT",
     """SELECT a.account_source_id, a.customer_source_id, a.product_code, CAST(coalesce(t.balance, 0) AS DECIMAL(18,2)), a.credit_limit, coalesce(t.dpd, 0)
        FROM accounts a LEFT JOIN (
          SELECT account_source_id, sum(signed_amount(transaction_type, amount)) AS balance, max(dpd_snapshot) AS dpd
          FROM transactions WHERE transaction_date <= as_of GROUP BY account_source_id) t ON t.account_source_id = a.account_source_id"""),
    ("scores_at(as_of DATE)", "customer_source_id STRING, bureau_score INT, report_date DATE",
     """SELECT customer_source_id, max_by(bureau_score, report_date), max(report_date) FROM credit_bureau
        WHERE report_date <= as_of GROUP BY customer_source_id"""),
]


def register_sql(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """Make the views and functions available to ``spark.sql``; registering again replaces them."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    for signature, kind, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    for signature, columns, body in TABLES:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE ({columns}) RETURN {body}")
