"""Table contracts that plain Parquet does not enforce: NOT NULL, key, reference, check."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    table: str
    not_null: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)  # name -> SQL condition that must hold
    references: tuple[tuple[str, str, str], ...] = ()     # (column, parent table, parent column)


CONTRACTS = {
    "customers": Contract(
        "customers", ("customer_source_id", "full_name", "segment", "country_code"),
        ("customer_source_id",)),
    "accounts": Contract(
        "accounts", ("account_source_id", "customer_source_id", "product_code", "branch_code",
                     "opening_date", "credit_limit", "currency"),
        ("account_source_id",), {"credit_limit >= 0": "credit_limit >= 0"},
        (("customer_source_id", "customers", "customer_source_id"),)),
    "transactions": Contract(
        "transactions", ("transaction_id", "account_source_id", "transaction_date", "amount",
                         "transaction_type", "dpd_snapshot"),
        ("transaction_id",), {}, (("account_source_id", "accounts", "account_source_id"),)),
    "credit_bureau": Contract(
        "credit_bureau", ("customer_source_id", "report_date", "bureau_score"),
        ("customer_source_id", "report_date"),
        {"bureau_score 0..1000": "bureau_score BETWEEN 0 AND 1000"},
        (("customer_source_id", "customers", "customer_source_id"),)),
    "macro_indicators": Contract(
        "macro_indicators", ("period_date", "country_code", "scenario_tag"),
        ("period_date", "country_code", "scenario_tag")),
    "dim_product": Contract("dim_product", ("product_code",), ("product_code",)),
    "dim_branch": Contract("dim_branch", ("branch_code",), ("branch_code",)),
    "fact_exposure": Contract(
        "fact_exposure", ("date_key", "customer_key", "product_key", "branch_key", "scenario_key",
                          "outstanding_balance", "credit_limit", "dpd_current", "ifrs9_stage"),
        (), {}, (("date_key", "dim_date", "date_key"),
                 ("customer_key", "dim_customer", "customer_key"))),
    "fact_credit_event": Contract(
        "fact_credit_event", ("date_key", "customer_key", "product_key", "event_type", "dpd_at_event"),
        (), {}, (("date_key", "dim_date", "date_key"),
                 ("customer_key", "dim_customer", "customer_key"))),
    "fact_credit_rating_history": Contract(
        "fact_credit_rating_history", ("date_key", "customer_key", "bureau_score"),
        (), {}, (("date_key", "dim_date", "date_key"),
                 ("customer_key", "dim_customer", "customer_key"))),
}


class ContractError(RuntimeError):
    """A layer may not be published; the message names each broken contract and its count."""


def _row_tests(contract: Contract) -> list[tuple[str, Column]]:
    """(name, broken) of the NOT NULL and CHECK contracts."""
    tests = [(f"not_null:{c}", F.col(c).isNull()) for c in contract.not_null]
    return tests + [(f"check:{name}", ~F.expr(condition)) for name, condition in contract.checks.items()]


def row_figures(contract: Contract) -> dict[str, Column]:
    """Violations of the row contracts, to be measured while the rows are written."""
    return {f"broken_{i}": F.count_if(test) for i, (_, test) in enumerate(_row_tests(contract))}


def enforce_figures(contract: Contract, found: dict) -> None:
    """Raise when measured row contracts are broken."""
    broken = [(name, found[f"broken_{i}"]) for i, (name, _) in enumerate(_row_tests(contract)) if found[f"broken_{i}"]]
    if broken:
        raise ContractError("contract violated: " + "; ".join(f"{contract.table} {name}: {n}" for name, n in broken))


def _row_level(df: DataFrame, contract: Contract) -> DataFrame | None:
    """NOT NULL and CHECK counts, all in one aggregation over one scan."""
    tests = _row_tests(contract)
    if not tests:
        return None
    counted = df.agg(*[F.count_if(test).alias(f"t{i}") for i, (_, test) in enumerate(tests)])
    pairs = F.array(*[F.struct(F.lit(name).alias("contract"), F.col(f"t{i}").alias("violations"))
                      for i, (name, _) in enumerate(tests)])
    return counted.select(F.inline(pairs))


def _key_level(df: DataFrame, contract: Contract) -> DataFrame | None:
    if not contract.key:
        return None
    repeated = df.groupBy(*contract.key).count().where("count > 1")
    return repeated.agg(F.count("*").alias("violations")).select(
        F.lit("unique:" + ",".join(contract.key)).alias("contract"), "violations")


def _reference_level(df: DataFrame, contract: Contract, parents: dict[str, DataFrame]) -> list[DataFrame]:
    out = []
    for column, parent, parent_column in contract.references:
        if parent not in parents:
            continue
        # Distinct child keys first: a hot key then weighs one row in the anti-join.
        child = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        known = parents[parent].select(F.col(parent_column).alias(column))
        orphans = child.join(known, column, "left_anti")
        out.append(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
            F.lit(f"reference:{column}->{parent}").alias("contract"), "violations"))
    return out


def contract_violations(df: DataFrame, contract: Contract,
                        parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """(table_name, contract, violations), one row per contract including the kept ones."""
    parts = [_row_level(df, contract), _key_level(df, contract),
             *_reference_level(df, contract, parents or {})]
    united = reduce(DataFrame.unionByName, [p for p in parts if p is not None])
    return united.select(F.lit(contract.table).alias("table_name"), "contract",
                         F.col("violations").cast("bigint").alias("violations"))


def enforce(df: DataFrame, contract: Contract, parents: dict[str, DataFrame] | None = None) -> None:
    """Raise when anything is broken. Only the few broken contracts reach the driver."""
    broken = contract_violations(df, contract, parents).where("violations > 0").collect()
    if broken:
        listing = "; ".join(f"{r.table_name} {r.contract}: {r.violations}" for r in broken)
        raise ContractError(f"contract violated: {listing}")
