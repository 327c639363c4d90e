"""Table layouts of the five layers and the reference rows that seed the small dimensions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- staging: business columns stay raw text, in file order -------------------------------

STAGING_COLUMNS = {
    "stg_customers": ["customer_source_id", "full_name", "birth_date", "national_id", "segment",
                      "country_code", "onboarding_date"],
    "stg_accounts": ["account_source_id", "customer_source_id", "product_code", "branch_code",
                     "opening_date", "credit_limit", "interest_rate", "currency", "parent_group_id"],
    "stg_transactions": ["transaction_id", "account_source_id", "transaction_date", "amount",
                         "transaction_type", "dpd_snapshot"],
    "stg_credit_bureau": ["customer_source_id", "bureau_score", "external_default_flag",
                          "inquiry_count_12m", "report_date"],
    "stg_macro_indicators": ["period_date", "country_code", "gdp_growth", "unemployment_rate",
                             "inflation_rate", "policy_rate", "scenario_tag"],
}

# Originating system recorded on every staged row.
SOURCE_SYSTEM = {
    "stg_customers": "CORE_BANKING",
    "stg_accounts": "CORE_BANKING",
    "stg_transactions": "CORE_BANKING",
    "stg_credit_bureau": "BUREAU_CREDIT",
    "stg_macro_indicators": "MACRO_ECO",
}


def file_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in STAGING_COLUMNS[table]])


def staging_schema(table: str) -> T.StructType:
    """Raw columns plus the ingestion metadata."""
    meta = "row_id bigint, source_system string, batch_id bigint, load_ts timestamp"
    return T.StructType(file_schema(table).fields + _ddl(meta).fields)


_SIMPLE = {"binary": T.BinaryType, "string": T.StringType, "int": T.IntegerType, "bigint": T.LongType, "double": T.DoubleType,
           "boolean": T.BooleanType, "date": T.DateType, "timestamp": T.TimestampType}


def _ddl(text: str) -> T.StructType:
    """Column list to schema without needing a session."""
    fields = []
    for column in text.split(", "):
        name, kind = column.split()
        decimal = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
        data_type = T.DecimalType(*map(int, decimal.groups())) if decimal else _SIMPLE[kind]()
        fields.append(T.StructField(name, data_type))
    return T.StructType(fields)


# --- typed layers ---------------------------------------------------------------------------

CLEANSED = {
    "customers": "customer_source_id string, full_name string, birth_date date, national_id string, "
                 "segment string, country_code string, onboarding_date date, batch_id bigint, "
                 "updated_at timestamp",
    "accounts": "account_source_id string, customer_source_id string, product_code string, "
                "branch_code string, opening_date date, credit_limit decimal(18,2), "
                "interest_rate decimal(6,4), currency string, parent_group_id string, "
                "batch_id bigint, updated_at timestamp",
    "transactions": "transaction_id string, account_source_id string, transaction_date date, "
                    "amount decimal(18,2), transaction_type string, dpd_snapshot int, "
                    "batch_id bigint, updated_at timestamp",
    "credit_bureau": "customer_source_id string, report_date date, bureau_score int, "
                     "external_default_flag boolean, inquiry_count_12m int, batch_id bigint, "
                     "updated_at timestamp",
    "macro_indicators": "period_date date, country_code string, gdp_growth decimal(8,4), "
                        "unemployment_rate decimal(6,3), inflation_rate decimal(6,3), "
                        "policy_rate decimal(6,3), scenario_tag string, batch_id bigint, "
                        "updated_at timestamp",
}

CURATED = {
    "dim_date": "date_key int, full_date date, year int, quarter int, month int, "
                "month_name string, is_reporting_period_end boolean",
    "dim_customer": "customer_key bigint, customer_source_id string, full_name string, "
                    "segment string, country_code string, bureau_score_band string, "
                    "effective_date timestamp, expiry_date timestamp, is_current boolean, "
                    "version_number int",
    "dim_product": "product_key int, product_code string, product_name string, "
                   "product_family string, is_secured boolean",
    "dim_branch": "branch_key int, branch_code string, branch_name string, region string, "
                  "country_code string",
    "dim_macro_scenario": "scenario_key int, scenario_tag string, scenario_weight decimal(5,4), "
                          "valid_from date, valid_to date",
    "fact_exposure": "date_key int, customer_key bigint, product_key int, branch_key int, "
                     "scenario_key int, account_source_id string, "
                     "outstanding_balance decimal(18,2), credit_limit decimal(18,2), "
                     "dpd_current int, ifrs9_stage int, batch_id bigint",
    "fact_credit_event": "date_key int, customer_key bigint, product_key int, event_type string, "
                         "dpd_at_event int, amount_impacted decimal(18,2), batch_id bigint",
    "fact_credit_rating_history": "date_key int, customer_key bigint, bureau_score int, "
                                  "internal_rating string, batch_id bigint",
}

FEATURE_MART = {
    "customer_risk_features": "date_key int, customer_key bigint, utilization_ratio decimal(6,4), "
                              "dpd_current int, dpd_max_last_6m int, dpd_trend_3m decimal(6,2), "
                              "avg_balance_3m decimal(18,2), avg_balance_12m decimal(18,2), "
                              "payment_volatility_6m decimal(10,4), n_missed_payments_12m int, "
                              "bureau_score_current int, bureau_score_delta_6m int, "
                              "months_since_onboarding int, is_default_flag boolean, "
                              "computed_at timestamp, batch_id bigint",
    "portfolio_ecl_inputs": "date_key int, segment string, scenario_key int, "
                            "total_exposure decimal(20,2), avg_pd_12m decimal(8,6), "
                            "avg_lgd decimal(8,6), weighted_ead decimal(20,2), "
                            "stage_1_exposure decimal(20,2), stage_2_exposure decimal(20,2), "
                            "stage_3_exposure decimal(20,2), computed_ecl decimal(20,2), "
                            "batch_id bigint, computed_at timestamp",
}

GOVERNANCE = {
    "run_log": "batch_id bigint, pipeline_name string, event_ts timestamp, status string, "
               "rows_ingested bigint, rows_quarantined bigint, error_message string",
    "step_log": "batch_id bigint, step_name string, event_ts timestamp, row_count bigint, "
                "status string",
    "quarantine": "batch_id bigint, source_table string, source_row_id bigint, rule_id int, "
                  "failure_reason string, raw_payload string, quarantined_at timestamp, "
                  "is_resolved boolean",
    "drift_metrics": "batch_id bigint, feature_name string, reference_period string, "
                     "current_period string, reference_mean double, current_mean double, "
                     "population_stability_index double, drift_flag int, computed_at timestamp",
    "drift_states": "date_key int, feature_name string, rows bigint, state binary, batch_id bigint",
}


def table_schema(table: str) -> T.StructType:
    for layer in (CLEANSED, CURATED, FEATURE_MART, GOVERNANCE):
        if table in layer:
            return _ddl(layer[table])
    raise KeyError(table)


# --- seeds ----------------------------------------------------------------------------------

# Reference rows of the three small dimensions and the starting quality rules.
PRODUCTS = """
  (1, 'MTG-STD',   'Prêt immobilier standard',    'Mortgage',  true),
  (2, 'CONS-PERS', 'Crédit personnel',            'Consumer',  false),
  (3, 'CONS-AUTO', 'Crédit automobile',           'Consumer',  true),
  (4, 'SME-WC',    'Fonds de roulement PME',      'SME',       false),
  (5, 'SME-EQUIP', 'Financement équipement PME',  'SME',       true),
  (6, 'CORP-LOC',  'Ligne de crédit corporate',   'Corporate', false)
"""
BRANCHES = """
  (1, 'BR-TUN-01', 'Agence Tunis Centre', 'Grand Tunis', 'TN'),
  (2, 'BR-TUN-02', 'Agence Sfax',         'Sud',         'TN'),
  (3, 'BR-TUN-03', 'Agence Sousse',       'Centre-Est',  'TN'),
  (4, 'BR-TUN-04', 'Agence Médenine',     'Sud-Est',     'TN')
"""
SCENARIOS = """
  (1, 'BASELINE', CAST(0.6000 AS decimal(5,4)), DATE '2018-01-01', DATE '9999-12-31'),
  (2, 'UPSIDE',   CAST(0.2000 AS decimal(5,4)), DATE '2018-01-01', DATE '9999-12-31'),
  (3, 'DOWNSIDE', CAST(0.2000 AS decimal(5,4)), DATE '2018-01-01', DATE '9999-12-31')
"""
QUALITY_RULES = """
  (1, 'stg_customers',     'customer_source_id', 'NOT_NULL', NULL,                'ERROR',   true),
  (2, 'stg_accounts',      'credit_limit',       'RANGE',    '>= 0',              'ERROR',   true),
  (3, 'stg_transactions',  'dpd_snapshot',       'RANGE',    '>= 0 AND <= 999',   'WARNING', true),
  (4, 'stg_credit_bureau', 'bureau_score',       'RANGE',    'BETWEEN 0 AND 1000','ERROR',   true)
"""


def literal_table(spark: SparkSession, rows: str, columns: str) -> DataFrame:
    """Inline rows as a plan-local relation, so the optimizer knows their exact size."""
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


def dim_product(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PRODUCTS, "product_key, product_code, product_name, product_family, is_secured")


def dim_branch(spark: SparkSession) -> DataFrame:
    return literal_table(spark, BRANCHES, "branch_key, branch_code, branch_name, region, country_code")


def dim_macro_scenario(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SCENARIOS, "scenario_key, scenario_tag, scenario_weight, valid_from, valid_to")


def quality_rules(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark, QUALITY_RULES,
        "rule_id, target_table, target_column, rule_type, rule_expression, severity, is_active")
