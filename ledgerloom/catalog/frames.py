"""The layers derived from the supplied tables, built lazily and shared inside one query."""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.cleanse import cleanse
from ledgerloom.plans.customer_dim import dimension_source, initial_dimension, merge_scd2
from ledgerloom.plans.facts import (account_state, baseline_scenario, exposure_history, exposure_stretches, exposures_by_date,
                                    fact_credit_event, fact_exposure, fact_rating_history)
from ledgerloom.schemas import dim_branch, dim_macro_scenario, dim_product
from ledgerloom.session import materialize
from ledgerloom.sources.calendar import dim_date, month_ends
from ledgerloom.sources.testviews import staged_view, supplied_table

AS_OF = date(2000, 12, 31)
CALENDAR = ("1995-01-01", "2030-12-31")
CALENDAR_START = date(1995, 1, 1)
RUN_1, RUN_2 = datetime(2026, 1, 1), datetime(2026, 2, 1)
SNAPSHOTS = month_ends(AS_OF, 13)


class Frames:
    def __init__(self, spark: SparkSession, sf_dir: str):
        # Dates are derived from timestamps; the check engine works in UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir
        self.sharing = False
        self._only: dict[str, tuple[str, ...]] = {}
        self._views: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}
        self.run_1, self.run_2 = (F.lit(t).cast("timestamp") for t in (RUN_1, RUN_2))

    def staged(self, view: str) -> DataFrame:
        if view not in self._views:
            self._views[view] = staged_view(self.spark, view, self.table)
        return self._views[view]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = supplied_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    @cached_property
    def staging(self) -> dict[str, DataFrame]:
        return {t: self.staged(t) for t in ("stg_customers", "stg_accounts", "stg_transactions", "stg_credit_bureau")}

    # --- cleansed ---------------------------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        return self._shared(cleanse("customers", self.staged("stg_customers"), 1, self.run_1), "customers")

    @cached_property
    def customers_again(self) -> DataFrame:
        return cleanse("customers", self.staged("stg_customers_2"), 2, self.run_2)

    @cached_property
    def accounts(self) -> DataFrame:
        return self._shared(cleanse("accounts", self.staged("stg_accounts"), 1, self.run_1, self.customers), "accounts")

    @cached_property
    def transactions(self) -> DataFrame:
        return cleanse("transactions", self.staged("stg_transactions"), 1, self.run_1, self.accounts)

    @cached_property
    def bureau(self) -> DataFrame:
        return cleanse("credit_bureau", self.staged("stg_credit_bureau"), 1, self.run_1, self.customers)

    # --- tables a query reads several times are written once -----------------------------

    def _shared(self, df: DataFrame, label: str) -> DataFrame:
        return materialize(self._used(df, label), label) if self.sharing else df

    def _used(self, df: DataFrame, label: str) -> DataFrame:
        return df.select(*self._only[label]) if label in self._only else df

    def share(self, **only: tuple[str, ...]) -> None:
        """From here on customers and accounts are built once and read back by every user. ``only`` names the columns that the
        query reads of a layer; no others are written."""
        self.sharing = True
        self._only.update(only)

    def keep(self, name: str) -> DataFrame:
        """Write one layer, and nothing below it, and read it back from here on."""
        self.__dict__[name] = materialize(getattr(self, name), name)
        return self.__dict__[name]

    @cached_property
    def stored_accounts(self) -> DataFrame:
        self.share()
        return self.accounts

    @cached_property
    def stored_transactions(self) -> DataFrame:
        self.share()
        return materialize(self.transactions, "transactions")

    @cached_property
    def stored_bureau(self) -> DataFrame:
        return materialize(self._used(self.bureau, "bureau"), "bureau")

    @cached_property
    def month_end_transactions(self) -> DataFrame:
        """Movements dated at their month end: the reports expect monthly data. Written once, with these columns only."""
        self.share()
        moved = self.transactions.select(
            "account_source_id", F.last_day("transaction_date").alias("transaction_date"),
            "transaction_type", "amount", "dpd_snapshot")
        return materialize(moved, "month-end-transactions")

    # --- curated ----------------------------------------------------------------------

    @cached_property
    def dates(self) -> DataFrame:
        return dim_date(self.spark, *CALENDAR)

    @cached_property
    def products(self) -> DataFrame:
        return dim_product(self.spark)

    @cached_property
    def branches(self) -> DataFrame:
        return dim_branch(self.spark)

    @cached_property
    def scenario_key(self) -> int:
        return baseline_scenario(dim_macro_scenario(self.spark)).first()["scenario_key"]

    @cached_property
    def dim_customer(self) -> DataFrame:
        self.share()
        return initial_dimension(dimension_source(self.customers, self.bureau), self.run_1)

    @cached_property
    def dim_customer_after_second_load(self) -> DataFrame:
        return merge_scd2(self.dim_customer, dimension_source(self.customers_again, self.bureau), self.run_2)

    def exposure(self, stored: bool = False) -> DataFrame:
        accounts, transactions = self._book(stored)
        return fact_exposure(accounts, transactions, self.dim_customer, self.products, self.branches,
                             self.scenario_key, AS_OF, 1, CALENDAR_START)

    def exposures(self, stored: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
        accounts, transactions = self._book(stored)
        return exposure_history(accounts, transactions, self.dim_customer, self.products, self.branches,
                                self.scenario_key, SNAPSHOTS, 1, CALENDAR_START, carried)

    def exposures_by_date(self) -> dict[int, DataFrame]:
        """The same rows date by date, from stretches written once."""
        accounts, transactions = self._book(stored=True)
        stretches = exposure_stretches(accounts, transactions, self.dim_customer, self.products, self.branches, SNAPSHOTS, CALENDAR_START)
        return exposures_by_date(materialize(stretches, "stretches"), self.scenario_key, SNAPSHOTS, 1)

    def _book(self, stored: bool) -> tuple[DataFrame, DataFrame]:
        self.share()
        return self.accounts, self.stored_transactions if stored else self.transactions

    def events(self, stored: bool = False) -> DataFrame:
        accounts, transactions = self._book(stored)
        return fact_credit_event(transactions, accounts, self.dim_customer, self.products, self.dates, 1)

    def ratings(self) -> DataFrame:
        return fact_rating_history(self.bureau, self.dim_customer, self.dates, 1)

    def state(self) -> DataFrame:
        return account_state(self.transactions, AS_OF, CALENDAR_START)
