"""Facts of the star schema."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.risk import event_type, ifrs9_stage, internal_rating, signed_amount
from ledgerloom.functions.text import folded
from ledgerloom.operators.temporal import latest_known, valid_at
from ledgerloom.sources.calendar import date_to_key, key_day

_BALANCE = "decimal(18,2)"


def _movements(transactions: DataFrame, last_day: date, first_day: date | None) -> DataFrame:
    moved = transactions.where(F.col("transaction_date") <= F.lit(last_day))
    if first_day:
        moved = moved.where(F.col("transaction_date") >= F.lit(first_day))
    return moved


_AMOUNT = ("transaction_type", "amount")


def account_state(transactions: DataFrame, as_of: date, first_day: date | None = None) -> DataFrame:
    """Balance and highest DPD ever per account at one date; summed map-side, so no account
    is too hot, and only rows up to the date are read."""
    return _movements(transactions, as_of, first_day).groupBy("account_source_id").agg(
        F.sum(signed_amount(*map(F.col, _AMOUNT))).alias("balance"), F.max("dpd_snapshot").alias("dpd"))


def period_index(day: Column, as_of: list[date]) -> Column:
    """Position of the first as-of date not before ``day`` (dates ascending)."""
    return reduce(Column.__add__, [(day > F.lit(d)).cast("int") for d in as_of[:-1]], F.lit(0))


def until_next(key: str, periods: int) -> Column:
    """Exclusive end of the stretch a row stands for: the key's next period with a row."""
    return F.lead("first", 1, periods).over(Window.partitionBy(key).orderBy("first"))


def account_spells(transactions: DataFrame, as_of: list[date], first_day: date | None = None,
                   everyone: DataFrame | None = None) -> DataFrame:
    """Balance and highest DPD per account over several as-of dates (ascending), as stretches.

    A row (account, first, until, balance, dpd) holds for the dates ``first .. until-1``; an
    account without movements between two dates needs no row for the second. Movements are
    summed per account and date first, so the running sums see at most one row per date.
    ``everyone`` starts each listed account at the first date with nothing.
    """
    rows = _movements(transactions, as_of[-1], first_day).select(
        "account_source_id", period_index(F.col("transaction_date"), as_of).alias("first"),
        signed_amount(*map(F.col, _AMOUNT)).cast(_BALANCE).alias("amount"), "dpd_snapshot")
    if everyone is not None:
        rows = rows.unionByName(everyone.select(
            "account_source_id", F.lit(0).alias("first"), F.lit(0).cast(_BALANCE).alias("amount"),
            F.lit(None).cast("int").alias("dpd_snapshot")))
    summed = rows.groupBy("account_source_id", "first").agg(
        F.sum("amount").alias("amount"), F.max("dpd_snapshot").alias("dpd"))
    so_far = Window.partitionBy("account_source_id").orderBy("first").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return summed.select("account_source_id", "first", until_next("account_source_id", len(as_of)).alias("until"),
                         F.sum("amount").over(so_far).alias("balance"), F.max("dpd").over(so_far).alias("dpd"))


def baseline_scenario(scenarios: DataFrame) -> DataFrame:
    """The newest BASELINE scenario: one row."""
    return (scenarios.where(F.col("scenario_tag") == "BASELINE").orderBy(F.desc("valid_from"), "scenario_key")
            .limit(1).select("scenario_key"))


_ACCOUNT = ("account_source_id", "customer_source_id", "product_code", "branch_code", "credit_limit")


def _with_key(rows: DataFrame, dimension: DataFrame, code: str, key: str, collation: str | None = None) -> DataFrame:
    """Rows with the ``key`` of their ``code``; those of an unknown code drop out. Codes are compared byte by byte, or under
    ``collation``."""
    known = dimension.select(folded(F.col(code), collation).alias("_code"), key)
    return rows.join(known, folded(F.col(code), collation) == F.col("_code")).drop("_code")


def _account_keys(accounts: DataFrame, products: DataFrame, branches: DataFrame, collation: str | None = None) -> DataFrame:
    return _with_key(_with_key(accounts, products, "product_code", "product_key", collation), branches, "branch_code", "branch_key", collation)


def _customer_keys(rows: DataFrame, dim_customer: DataFrame, collation: str | None = None) -> DataFrame:
    return _with_key(rows, dim_customer.where("is_current"), "customer_source_id", "customer_key", collation)


def _exposure_columns(df: DataFrame, date_key: Column, scenario_key: int, batch_id: int, carried: tuple[str, ...] = ()) -> DataFrame:
    dpd = F.coalesce("dpd", F.lit(0))
    return df.select(
        date_key.alias("date_key"), "customer_key", "product_key", "branch_key",
        F.lit(scenario_key).alias("scenario_key"), "account_source_id",
        F.coalesce("balance", F.lit(0)).cast(_BALANCE).alias("outstanding_balance"), "credit_limit",
        dpd.alias("dpd_current"), ifrs9_stage(dpd).alias("ifrs9_stage"),
        F.lit(batch_id).cast("bigint").alias("batch_id"), *carried)


def fact_exposure(accounts: DataFrame, transactions: DataFrame, dim_customer: DataFrame,
                  products: DataFrame, branches: DataFrame, scenario_key: int, as_of: date,
                  batch_id: int, calendar_start: date | None = None, collation: str | None = None) -> DataFrame:
    """One exposure row per account at one date. Limits and the customer version are those
    current now. ``account_source_id`` is kept as a degenerate dimension."""
    state = account_state(transactions, as_of, calendar_start)
    keyed = _customer_keys(_account_keys(accounts.select(*_ACCOUNT), products, branches, collation), dim_customer, collation)
    joined = keyed.join(state, "account_source_id", "left")
    return _exposure_columns(joined, F.lit(date_to_key(as_of)), scenario_key, batch_id)


def exposure_history(accounts: DataFrame, transactions: DataFrame, dim_customer: DataFrame,
                     products: DataFrame, branches: DataFrame, scenario_key: int,
                     as_of: list[date], batch_id: int, calendar_start: date | None = None,
                     carried: tuple[str, ...] = ()) -> DataFrame:
    """The exposure rows of several dates in one pass over the transactions; stretches are
    unfolded into dates only after the joins.

    The customer is joined last, so a customer's rows leave the same task and what sums them per customer shrinks
    before its shuffle. ``carried`` columns of the accounts are appended.
    """
    days = sorted(as_of)
    joined = exposure_stretches(accounts, transactions, dim_customer, products, branches, days, calendar_start, carried)
    keys = F.array(*[F.lit(date_to_key(d)) for d in days])
    dated = joined.withColumn("day", F.explode(F.slice(keys, F.col("first") + 1, F.col("until") - F.col("first"))))
    return _exposure_columns(dated, F.col("day"), scenario_key, batch_id, carried)


def exposure_stretches(accounts: DataFrame, transactions: DataFrame, dim_customer: DataFrame, products: DataFrame, branches: DataFrame,
                       days: list[date], calendar_start: date | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """What ``exposure_history`` unfolds: accounts with their keys and the stretches of dates over which their state holds."""
    spells = account_spells(transactions, days, calendar_start, accounts)
    columns = accounts.select(*dict.fromkeys([*_ACCOUNT, *carried]))
    # Merged also where customers would be few enough to broadcast: the rows leave in the order of their customers.
    return _customer_keys(_account_keys(columns, products, branches).join(spells, "account_source_id"), dim_customer.hint("merge"))


def exposures_by_date(stretches: DataFrame, scenario_key: int, as_of: list[date], batch_id: int) -> dict[int, DataFrame]:
    """The exposure rows of every date by itself, from stretches that are stored: date key -> rows."""
    days = sorted(as_of)
    at = {date_to_key(d): (F.col("first") <= i) & (F.col("until") > i) for i, d in enumerate(days)}
    return {key: _exposure_columns(stretches.where(holds), F.lit(key), scenario_key, batch_id) for key, holds in at.items()}


def point_in_time_exposure(exposures: DataFrame, accounts: DataFrame, dim_customer: DataFrame, versions: DataFrame,
                           columns: list[str], opened_only: bool = False) -> DataFrame:
    """Exposure rows with the customer version that was valid at their own date, not the one current now.

    ``versions`` has customer_source_id, effective_date, expiry_date (exclusive, NULL if open) and ``columns``, which are
    NULL before a customer's first version. ``opened`` tells whether the account existed at the date; ``opened_only`` leaves
    out rows of accounts opened later.

    Owner and opening date are looked up for every exposure row, unless the rows carry ``customer_source_id`` or
    ``opening_date`` already (see ``exposure_history``), where both were joined to stretches, many dates at once.
    """
    kept, rows = [c for c in exposures.columns if c not in ("customer_source_id", "opening_date")], exposures
    if "customer_source_id" not in exposures.columns:
        rows = rows.join(dim_customer.select("customer_key", "customer_source_id"), "customer_key")
    if "opening_date" not in exposures.columns:
        rows = rows.join(accounts.select("account_source_id", "opening_date"), "account_source_id")
    rows = rows.withColumn("day", key_day(F.col("date_key"))).withColumn("opened", F.col("opening_date") <= F.col("day"))
    found = valid_at(rows.where("opened") if opened_only else rows, versions, ["customer_source_id"], "day", "effective_date", "expiry_date", columns)
    return found.select(*kept, "customer_source_id", "opened", *columns)


def transaction_scores(transactions: DataFrame, accounts: DataFrame, bureau: DataFrame) -> DataFrame:
    """Every transaction with the newest bureau score its customer had at the transaction's own date."""
    owned = transactions.join(accounts.select("account_source_id", "customer_source_id"), "account_source_id")
    return latest_known(owned, bureau, ["customer_source_id"], "transaction_date", "report_date", ["bureau_score", "report_date"])


def _of_batch(batch_id: int | None) -> Column:
    return F.lit(True) if batch_id is None else F.col("batch_id") == batch_id


def fact_credit_event(transactions: DataFrame, accounts: DataFrame, dim_customer: DataFrame,
                      products: DataFrame, dim_date: DataFrame, batch_id: int) -> DataFrame:
    """Late payments and defaults among the batch's transactions.

    Account attributes are resolved first, so the event side is joined once.
    """
    current = dim_customer.where("is_current").select("customer_source_id", "customer_key")
    owner = (accounts.select("account_source_id", "customer_source_id", "product_code")
             .join(products.select("product_code", "product_key"), "product_code")
             .join(current, "customer_source_id").select("account_source_id", "customer_key", "product_key"))
    late = transactions.where(_of_batch(batch_id) & (F.col("dpd_snapshot") > 0))
    days = dim_date.select("date_key", F.col("full_date").alias("transaction_date"))
    return (late.join(days, "transaction_date").join(owner, "account_source_id")
            .select("date_key", "customer_key", "product_key",
                    event_type(F.col("dpd_snapshot")).alias("event_type"),
                    F.col("dpd_snapshot").alias("dpd_at_event"), F.col("amount").alias("amount_impacted"),
                    F.lit(batch_id).cast("bigint").alias("batch_id")))


def fact_rating_history(bureau: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, batch_id: int) -> DataFrame:
    """Internal rating per bureau report of the batch."""
    current = dim_customer.where("is_current").select("customer_source_id", "customer_key")
    days = dim_date.select("date_key", F.col("full_date").alias("report_date"))
    return (bureau.where(_of_batch(batch_id)).join(days, "report_date").join(current, "customer_source_id")
            .select("date_key", "customer_key", "bureau_score",
                    internal_rating(F.col("bureau_score")).alias("internal_rating"),
                    F.lit(batch_id).cast("bigint").alias("batch_id")))


def ecl_inputs(exposures: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Exposure per date, segment and scenario, in total and per stage. The model outputs
    (PD, LGD, EAD, ECL) stay empty: they come from outside.

    Exposures are summed per customer before the segment is looked up.
    """
    money = "decimal(20,2)"
    stages = {f"stage_{s}_exposure": F.sum(F.when(F.col("ifrs9_stage") == s, F.col("outstanding_balance")).otherwise(0))
              for s in (1, 2, 3)}
    per_customer = exposures.groupBy("date_key", "customer_key", "scenario_key").agg(
        F.sum("outstanding_balance").alias("total_exposure"), *[m.alias(n) for n, m in stages.items()])
    sums = ["total_exposure", *stages]
    return (per_customer.join(dim_customer.select("customer_key", "segment"), "customer_key")
            .groupBy("date_key", "segment", "scenario_key")
            .agg(*[F.sum(c).cast(money).alias(c) for c in sums])
            .withColumns({c: F.lit(None).cast("decimal(8,6)") for c in ("avg_pd_12m", "avg_lgd")})
            .withColumns({c: F.lit(None).cast(money) for c in ("weighted_ead", "computed_ecl")}))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
