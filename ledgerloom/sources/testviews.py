"""Staging-shaped views over the supplied order tables.

The SQL text runs unchanged on Spark and on DuckDB, so the same views feed the jobs and
their check queries. Raw values are damaged on purpose (unreadable dates and numbers,
missing segments, unknown owners, repeated keys).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.convert import empty_to_null

TABLES = ("nation", "customer", "orders", "lineitem", "events")

# Natural keys are padded to six digits but never cut when the number is longer.
_CUSTOMER_ID = "concat('CUST-', lpad(cast({0} AS string), cast(greatest(6, length(cast({0} AS string))) AS int), '0'))"


def _customer_id(column: str) -> str:
    return _CUSTOMER_ID.format(column)


STG_CUSTOMERS = f"""
SELECT c_custkey * 2 + 1 AS row_id, {_customer_id('c_custkey')} AS customer_source_id, c_name AS full_name,
       CASE WHEN c_custkey % 17 = 3 THEN 'not-a-date' WHEN c_custkey % 13 = 5 THEN NULL
            ELSE cast(DATE '1950-01-01' + cast(c_custkey * 11 % 18000 AS int) AS string) END AS birth_date,
       concat('NID', cast(c_custkey AS string)) AS national_id,
       CASE WHEN c_custkey % 23 = 7 THEN NULL ELSE c_mktsegment END AS segment,
       n_name AS country_code,
       cast(DATE '1990-01-01' + cast(c_custkey * 7 % 1800 AS int) AS string) AS onboarding_date,
       cast(1 AS bigint) AS batch_id, TIMESTAMP '2026-01-01 00:00:00' AS load_ts
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT c_custkey * 2 + 2, {_customer_id('c_custkey')}, concat(c_name, ' v2'), '1980-05-17',
       concat('NID', cast(c_custkey AS string)), 'Corporate', n_name, '1994-03-01',
       cast(1 AS bigint), TIMESTAMP '2026-01-02 00:00:00'
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 20 = 0
"""

# The same customers sent again a month later, some of them in another segment.
STG_CUSTOMERS_2 = f"""
SELECT row_id, customer_source_id, full_name, birth_date, national_id,
       CASE WHEN cast(substr(customer_source_id, 6) AS bigint) % 11 = 0 THEN 'SME' ELSE segment END AS segment,
       country_code, onboarding_date, cast(2 AS bigint) AS batch_id, load_ts
FROM ({STG_CUSTOMERS}) first_load
"""

STG_ACCOUNTS = f"""
SELECT o_orderkey + 1 AS row_id, concat('ACC-', cast(o_orderkey AS string)) AS account_source_id,
       CASE WHEN o_orderkey % 97 = 11 THEN 'CUST-UNKNOWN' ELSE {_customer_id('o_custkey')} END AS customer_source_id,
       CASE o_orderkey % 7 WHEN 0 THEN 'MTG-STD' WHEN 1 THEN 'CONS-PERS' WHEN 2 THEN 'CONS-AUTO' WHEN 3 THEN 'SME-WC'
            WHEN 4 THEN 'SME-EQUIP' WHEN 5 THEN 'CORP-LOC' ELSE 'NO-SUCH' END AS product_code,
       concat('BR-TUN-0', cast(o_custkey % 4 + 1 AS string)) AS branch_code,
       CASE WHEN o_orderkey % 101 = 13 THEN 'n/a' ELSE cast(cast(o_orderdate AS date) AS string) END AS opening_date,
       CASE WHEN o_orderkey % 89 = 17 THEN '-100.00' WHEN o_orderkey % 83 = 19 THEN 'abc'
            WHEN o_orderkey % 79 = 23 THEN '0.00'
            ELSE cast(cast(o_totalprice AS decimal(18,2)) AS string) END AS credit_limit,
       CASE WHEN o_orderkey % 5 = 0 THEN 'n.c.' ELSE '0.0525' END AS interest_rate,
       'TND' AS currency,
       CASE WHEN o_orderkey < 10 OR o_orderkey % 7 = 0 THEN NULL
            ELSE concat('ACC-', cast(cast(floor(o_orderkey / 10) AS bigint) AS string)) END AS parent_group_id,
       cast(1 AS bigint) AS batch_id, TIMESTAMP '2026-01-01 00:00:00' AS load_ts
FROM orders
"""

# row_id is arithmetic on the line's own columns: no window over an order's lines is needed.
STG_TRANSACTIONS = """
SELECT (l_orderkey * 10 + l_linenumber) * 1000000 + (l_partkey * 100 + l_suppkey % 100) % 1000000 AS row_id,
       concat('TXN-', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS transaction_id,
       concat('ACC-', cast(l_orderkey AS string)) AS account_source_id,
       CASE WHEN l_partkey % 71 = 5 THEN '' ELSE cast(cast(l_shipdate AS date) AS string) END AS transaction_date,
       CASE WHEN l_partkey % 73 = 6 THEN 'x1' ELSE cast(cast(l_extendedprice AS decimal(18,2)) AS string) END AS amount,
       CASE l_returnflag WHEN 'R' THEN 'REPAYMENT' WHEN 'A' THEN 'DRAWDOWN'
            ELSE CASE l_linestatus WHEN 'O' THEN 'FEE' ELSE 'INTEREST' END END AS transaction_type,
       CASE WHEN l_suppkey % 10 = 9 THEN 'unk' WHEN l_quantity <= 35 THEN '0'
            ELSE cast(cast((l_quantity - 35) * 8 AS int) AS string) END AS dpd_snapshot,
       CASE l_linestatus WHEN 'F' THEN cast(1 AS bigint) ELSE cast(2 AS bigint) END AS batch_id,
       cast(l_shipdate AS timestamp) AS load_ts
FROM lineitem
"""

STG_CREDIT_BUREAU = f"""
SELECT o_orderkey + 1 AS row_id, {_customer_id('o_custkey')} AS customer_source_id,
       CASE WHEN o_orderkey % 103 = 29 THEN '1200' WHEN o_orderkey % 107 = 31 THEN 'NA'
            ELSE cast(300 + o_orderkey * 37 % 600 AS string) END AS bureau_score,
       CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS external_default_flag,
       cast(o_orderkey % 7 AS string) AS inquiry_count_12m,
       cast(cast(o_orderdate AS date) AS string) AS report_date,
       cast(1 AS bigint) AS batch_id, TIMESTAMP '2026-01-01 00:00:00' AS load_ts
FROM orders
"""

# Monthly country figures counted from the orders; one rate is unreadable now and then.
STG_MACRO_INDICATORS = """
SELECT min(o_orderkey) AS row_id, cast(cast(date_trunc('month', o_orderdate) AS date) AS string) AS period_date,
       n_name AS country_code,
       concat(cast(count(*) % 5 AS string), '.', cast(count(*) % 10 AS string)) AS gdp_growth,
       CASE WHEN count(*) % 7 = 0 THEN 'n/a' ELSE concat('13.', cast(count(*) AS string)) END AS unemployment_rate,
       concat(cast(min(o_orderkey) % 9 AS string), '.25') AS inflation_rate,
       concat(' ', cast(max(o_orderkey) % 8 AS string), '.5 ') AS policy_rate,
       CASE WHEN min(o_orderkey) % 2 = 0 THEN 'BASELINE' END AS scenario_tag,
       cast(1 AS bigint) AS batch_id, TIMESTAMP '2026-01-01 00:00:00' AS load_ts
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY cast(date_trunc('month', o_orderdate) AS date), n_name
"""

VIEWS = {
    "stg_customers": STG_CUSTOMERS, "stg_customers_2": STG_CUSTOMERS_2, "stg_accounts": STG_ACCOUNTS,
    "stg_transactions": STG_TRANSACTIONS, "stg_credit_bureau": STG_CREDIT_BUREAU,
    "stg_macro_indicators": STG_MACRO_INDICATORS,
}


def supplied_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged_view(spark: SparkSession, view: str, table) -> DataFrame:
    """One staging-shaped view over the tables that ``table(name)`` returns. Empty text is NULL, as after ingestion; only
    the transaction date is ever empty in these views."""
    text = VIEWS[view]
    used = {t: table(t) for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", text)}
    for name in used:
        text = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
    staged = spark.sql(text, **used)
    if view == "stg_transactions":
        staged = staged.withColumn("transaction_date", empty_to_null(F.col("transaction_date")))
    return staged
