"""Staging to cleansed: validate, quarantine, keep the newest row per key, convert.

Each table is described once (`CLEANSERS`); `classify` gives the verdict per staged row and
`typed` the converted winners. Both are lazy, so a caller that needs both sides writes the
classified rows once and reads each side from there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.convert import to_bit, to_date, to_decimal, to_int
from ledgerloom.operators.dedup import newest_row
from ledgerloom.operators.validation import REASON, Rule, flag_known, with_reason
from ledgerloom.schemas import STAGING_COLUMNS

_KNOWN = "_parent_known"
TYPED = "_typed_"
_META = ["row_id", "load_ts"]


def _typed(column: str) -> Column:
    return F.col(TYPED + column)


# Wording of the rejection reasons, in order of precedence per table.
def _customer_rules() -> list[Rule]:
    return [
        ("customer_source_id NULL", F.col("customer_source_id").isNull()),
        ("birth_date non convertible", F.col("birth_date").isNotNull() & _typed("birth_date").isNull()),
        ("segment manquant", F.col("segment").isNull()),
    ]


def _account_rules() -> list[Rule]:
    return [
        ("account_source_id NULL", F.col("account_source_id").isNull()),
        ("customer_source_id inconnu en cleansed.customers", ~F.col(_KNOWN)),
        ("credit_limit non convertible", _typed("credit_limit").isNull()),
        ("credit_limit négatif", _typed("credit_limit") < 0),
        ("opening_date non convertible", _typed("opening_date").isNull()),
    ]


def _transaction_rules() -> list[Rule]:
    return [
        ("transaction_id NULL", F.col("transaction_id").isNull()),
        ("account_source_id inconnu en cleansed.accounts", ~F.col(_KNOWN)),
        ("amount non convertible", _typed("amount").isNull()),
        ("transaction_date non convertible", _typed("transaction_date").isNull()),
    ]


def _bureau_rules() -> list[Rule]:
    score = _typed("bureau_score")
    return [
        ("customer_source_id inconnu en cleansed.customers", ~F.col(_KNOWN)),
        ("bureau_score hors plage [0,1000]", score.isNull() | ~score.between(0, 1000)),
        ("report_date non convertible", _typed("report_date").isNull()),
    ]


def _macro_rules() -> list[Rule]:
    return [
        ("period_date non convertible", _typed("period_date").isNull()),
        ("country_code NULL", F.col("country_code").isNull()),
    ]


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


@dataclass(frozen=True)
class Cleanser:
    source: str                                 # staging table
    target: str                                 # cleansed table
    keys: tuple[str, ...]
    rules: Callable[[], list[Rule]]
    convert: Callable[[], dict[str, Column]]    # columns whose value changes on the way
    parent: tuple[str, str] | None = None       # (cleansed parent table, key column)


CLEANSERS = {
    "customers": Cleanser(
        "stg_customers", "customers", ("customer_source_id",), _customer_rules,
        lambda: {"birth_date": to_date(F.col("birth_date")),
                 "onboarding_date": to_date(F.col("onboarding_date"))}),
    "accounts": Cleanser(
        "stg_accounts", "accounts", ("account_source_id",), _account_rules,
        lambda: {"opening_date": to_date(F.col("opening_date")),
                 "credit_limit": to_decimal(F.col("credit_limit"), 18, 2),
                 "interest_rate": to_decimal(F.col("interest_rate"), 6, 4)},
        ("customers", "customer_source_id")),
    "transactions": Cleanser(
        "stg_transactions", "transactions", ("transaction_id",), _transaction_rules,
        lambda: {"transaction_date": to_date(F.col("transaction_date")),
                 "amount": to_decimal(F.col("amount"), 18, 2),
                 "dpd_snapshot": _or_zero(to_int(F.col("dpd_snapshot")))},
        ("accounts", "account_source_id")),
    "credit_bureau": Cleanser(
        "stg_credit_bureau", "credit_bureau", ("customer_source_id", "report_date"), _bureau_rules,
        lambda: {"report_date": to_date(F.col("report_date")),
                 "bureau_score": to_int(F.col("bureau_score")),
                 "external_default_flag": F.coalesce(to_bit(F.col("external_default_flag")), F.lit(False)),
                 "inquiry_count_12m": _or_zero(to_int(F.col("inquiry_count_12m")))},
        ("customers", "customer_source_id")),
    "macro_indicators": Cleanser(
        "stg_macro_indicators", "macro_indicators", ("period_date", "country_code", "scenario_tag"),
        _macro_rules,
        lambda: {"period_date": to_date(F.col("period_date")),
                 "gdp_growth": to_decimal(F.col("gdp_growth"), 8, 4),
                 "unemployment_rate": to_decimal(F.col("unemployment_rate"), 6, 3),
                 "inflation_rate": to_decimal(F.col("inflation_rate"), 6, 3),
                 "policy_rate": to_decimal(F.col("policy_rate"), 6, 3),
                 "scenario_tag": F.coalesce("scenario_tag", F.lit("BASELINE"))}),
}


def staged_columns(table: str) -> list[str]:
    """Business columns plus what the ordering and the quarantine need."""
    return STAGING_COLUMNS[CLEANSERS[table].source] + _META


def classify(table: str, staged: DataFrame, parent: DataFrame | None = None) -> DataFrame:
    """Every staged row with its converted values (hidden columns) and its rejection reason,
    NULL when it may enter cleansed.

    Values are converted once, below the lookup of the parent: the rules and the cleansed row
    share the result, and the valid rows travel as numbers and dates instead of text.
    """
    spec = CLEANSERS[table]
    out = staged.withColumns({TYPED + c: value for c, value in spec.convert().items()})
    if spec.parent:
        out = flag_known(out, parent, spec.parent[1], _KNOWN)
    return with_reason(out, spec.rules()).drop(_KNOWN)


def valid_values(table: str, classified: DataFrame) -> DataFrame:
    """Valid rows in their cleansed form, before duplicates are dropped."""
    spec = CLEANSERS[table]
    changed = spec.convert().keys()
    values = [_typed(c).alias(c) if c in changed else F.col(c) for c in staged_columns(table)]
    return classified.where(F.col(REASON).isNull()).select(*values)


def converted_keys(table: str) -> dict[str, Column]:
    """The key columns of classified rows as the cleansed table spells them."""
    spec = CLEANSERS[table]
    changed = spec.convert().keys()
    return {k: _typed(k) if k in changed else F.col(k) for k in spec.keys}


def typed(table: str, classified: DataFrame, batch_id: int, run_ts: Column) -> DataFrame:
    """Valid rows converted, newest per key. Keys are compared after conversion, so two
    spellings of one report date count as the same key."""
    spec = CLEANSERS[table]
    newest = newest_row(valid_values(table, classified), list(spec.keys), ["load_ts", "row_id"])
    return newest.select(*STAGING_COLUMNS[spec.source], F.lit(batch_id).cast("bigint").alias("batch_id"),
                         run_ts.alias("updated_at"))


def cleanse(table: str, staged: DataFrame, batch_id: int, run_ts: Column,
            parent: DataFrame | None = None) -> DataFrame:
    """Cleansed rows of one table straight from staging."""
    return typed(table, classify(table, staged, parent), batch_id, run_ts)
