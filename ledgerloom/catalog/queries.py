"""One named query per operator; every one reads the supplied tables whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.frames import AS_OF, CALENDAR, CALENDAR_START, RUN_1, RUN_2, SNAPSHOTS, Frames
from ledgerloom.functions.convert import to_bit, to_date, to_decimal, to_int
from ledgerloom.functions.risk import ifrs9_stage, score_band
from ledgerloom.functions.text import SERVER
from ledgerloom.operators.contracts import CONTRACTS, contract_violations
from ledgerloom.operators.dedup import superseded_counts
from ledgerloom.operators.dense import dense_index, ntile
from ledgerloom.operators.hierarchy import expand_hierarchy
from ledgerloom.operators.hierarchy import unreached_nodes as find_unreached
from ledgerloom.operators.rules import rule_report
from ledgerloom.operators.upsert import upsert
from ledgerloom.operators.validation import REASON, quarantine_rows
from ledgerloom.plans import drift, facts, portfolio, published, quality
from ledgerloom.plans.cleanse import CLEANSERS, classify, converted_keys, staged_columns, typed, valid_values
from ledgerloom.plans.customer_dim import band_history, dimension_source, latest_score, merge_scd2
from ledgerloom.plans.drift_states import RANK_ERROR, value_states
from ledgerloom.plans.facts import ecl_inputs, point_in_time_exposure, transaction_scores, union_all
from ledgerloom.plans.features import (bureau_features, customer_risk_features, exposure_tail, missed_payments,
                                       moving_windows, utilization_by_date)
from ledgerloom.plans.groups import group_exposure, group_exposure_rollup
from ledgerloom.plans.monthly_run import run_full_etl, verify_run
from ledgerloom.plans.replay import judged_again
from ledgerloom.schemas import STAGING_COLUMNS, literal_table, quality_rules
from ledgerloom.session import materialize, work_dir
from ledgerloom.sources.calendar import date_to_key
from ledgerloom.sources.reports import write_json_document
from ledgerloom.sources.sql_surface import register_sql
from ledgerloom.sources.staging import staging_lines
from ledgerloom.sources.testviews import TABLES, staged_view
from ledgerloom.sources.warehouse import Warehouse, bucket_slot, month_slot
from ledgerloom.streaming.ingest import consume_once

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

AS_OF_KEY = date_to_key(AS_OF)


def query(build: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    """Register a function of the layers under its own name."""
    REGISTRY[build.__name__] = lambda spark, sf_dir: build(Frames(spark, sf_dir))
    return build


# --- validation and cleansing -------------------------------------------------------------

_PARENTS = {"accounts": "customers", "transactions": "accounts", "credit_bureau": "customers"}


def _classified(f: Frames, table: str) -> DataFrame:
    parent = getattr(f, _PARENTS[table]) if table in _PARENTS else None
    return classify(table, f.staged(CLEANSERS[table].source), parent)


def _rejections(f: Frames, table: str) -> DataFrame:
    return (_classified(f, table).where(F.col(REASON).isNotNull())
            .select(F.col("row_id").alias("source_row_id"), REASON))


@query
def quarantine_customers(f):
    return _rejections(f, "customers")


@query
def quarantine_accounts(f):
    return _rejections(f, "accounts")


@query
def quarantine_transactions(f):
    return _rejections(f, "transactions")


@query
def quarantine_bureau(f):
    return _rejections(f, "credit_bureau")


@query
def quarantine_payload(f):
    """Rejected customer rows read back out of their JSON payload."""
    columns = staged_columns("customers")
    rows = quarantine_rows(_classified(f, "customers"), "stg_customers", columns, 1, f.run_1)
    fields = STAGING_COLUMNS["stg_customers"]
    parsed = F.from_json("raw_payload", ", ".join(f"{c} string" for c in fields))
    return rows.select("batch_id", "source_table", "source_row_id", REASON, parsed.alias("p")).select(
        "batch_id", "source_table", "source_row_id", REASON, *[F.col(f"p.{c}").alias(c) for c in fields])


def _clean(df: DataFrame) -> DataFrame:
    return df.drop("updated_at")


@query
def clean_customers(f):
    return _clean(f.customers)


@query
def clean_accounts(f):
    return _clean(f.accounts)


@query
def clean_transactions(f):
    return _clean(f.transactions)


@query
def clean_bureau(f):
    return _clean(f.bureau)


@query
def macro_cleanse(f):
    staged = f.staged("stg_macro_indicators")
    return _clean(typed("macro_indicators", classify("macro_indicators", staged), 1, f.run_1))


@query
def typed_values(f):
    """Every tolerant conversion side by side on the raw bureau and account text."""
    bureau = f.staged("stg_credit_bureau").select(
        F.lit("credit_bureau").alias("source"), "row_id", to_int(F.col("bureau_score")).alias("as_int"),
        to_bit(F.col("external_default_flag")).cast("int").alias("as_bit"),
        F.lit(None).cast("decimal(18,2)").alias("as_decimal"), to_date(F.col("report_date")).alias("as_date"))
    accounts = f.staged("stg_accounts").select(
        F.lit("accounts").alias("source"), "row_id", to_int(F.col("credit_limit")).alias("as_int"),
        to_bit(F.col("interest_rate")).cast("int").alias("as_bit"),
        to_decimal(F.col("credit_limit"), 18, 2).alias("as_decimal"), to_date(F.col("opening_date")).alias("as_date"))
    return bureau.unionByName(accounts)


@query
def superseded_rows(f):
    """Valid transactions that lose to a newer row of the same id."""
    return superseded_counts(valid_values("transactions", _classified(f, "transactions")), ["transaction_id"])


@query
def row_conservation(f):
    """Per table: staged rows are either quarantined, upserted or superseded."""
    f.share()
    parts = []
    for table, spec in CLEANSERS.items():
        if table == "macro_indicators":
            continue
        judged = _classified(f, table)
        keys = [F.col(k) for k in spec.keys]
        if table == "credit_bureau":
            keys = [F.col("customer_source_id"), to_date(F.col("report_date")).alias("report_date")]
        per_key = (judged.select(*keys, F.col(REASON).isNotNull().alias("rejected"))
                   .groupBy(*spec.keys, "rejected").agg(F.count("*").alias("n")))
        parts.append(per_key.agg(
            F.sum("n").alias("staged"), F.sum(F.when(F.col("rejected"), F.col("n")).otherwise(0)).alias("quarantined"),
            F.count_if(~F.col("rejected")).alias("upserted"),
            F.sum(F.when(~F.col("rejected"), F.col("n") - 1).otherwise(0)).alias("superseded"))
            .select(F.lit(table).alias("table_name"), "staged", "quarantined", "upserted", "superseded"))
    return union_all(parts)


@query
def upsert_two_batches(f):
    """Transactions of the second load merged into those of the first."""
    f.share()
    staged = f.staged("stg_transactions")
    loads = [cleanse_load(f, staged.where(F.col("batch_id") == b), b) for b in (1, 2)]
    return _clean(upsert(loads[0], loads[1], ["transaction_id"]))


def cleanse_load(f: Frames, staged: DataFrame, batch_id: int) -> DataFrame:
    return typed("transactions", classify("transactions", staged, f.accounts), batch_id, f.run_1)


def _unchecked(f: Frames, table: str) -> DataFrame:
    """Staged rows converted without validation or deduplication."""
    spec = CLEANSERS[table]
    return f.staged(spec.source).select(*staged_columns(table)).withColumns(spec.convert())


@query
def contract_violations_raw(f):
    """What the table contracts would refuse if staging were published unchecked."""
    tables = {t: _unchecked(f, t) for t in ("customers", "accounts", "transactions", "credit_bureau")}
    return union_all([contract_violations(df, CONTRACTS[t], tables) for t, df in tables.items()])


@query
def contract_violations_clean(f):
    """The same contracts on the cleansed tables: all counts are zero."""
    f.share()
    tables = {"customers": f.customers, "accounts": f.accounts, "credit_bureau": f.stored_bureau,
              "transactions": f.stored_transactions}
    return union_all([contract_violations(df, CONTRACTS[t], tables) for t, df in tables.items()])


@query
def rules_evaluated(f):
    return rule_report(f.staging, quality_rules(f.spark))


# One rule of every type; the last two differ in the age they allow.
_RULES = """
  (1, 'stg_customers',    'customer_source_id', 'NOT_NULL',    NULL,                               'ERROR',   true),
  (2, 'stg_customers',    'birth_date',         'REGEX',       '[0-9]{4}-[0-9]{2}-[0-9]{2}',       'WARNING', true),
  (3, 'stg_accounts',     'credit_limit',       'RANGE',       '>= 0',                             'ERROR',   true),
  (4, 'stg_accounts',     'customer_source_id', 'REFERENTIAL', 'stg_customers.customer_source_id', 'ERROR',   true),
  (5, 'stg_transactions', 'load_ts',            'FRESHNESS',   '<= 5000 DAYS',                     'ERROR',   true),
  (6, 'stg_transactions', 'load_ts',            'FRESHNESS',   '<= 30 DAYS',                       'WARNING', true)
"""


@query
def rules_all_types(f):
    """Every rule type over staging; the age of the transactions comes from the manifest of a warehouse that staged them."""
    rules = literal_table(f.spark, _RULES, "rule_id, target_table, target_column, rule_type, rule_expression, severity, is_active")
    load = _new_warehouse(f).open_batch("STAGE", RUN_1)
    load.write("stg_transactions", f.staging["stg_transactions"].withColumn("source_system", F.lit("SUPPLIED")), "load1")
    slots = {"stg_transactions": [s for (t, _), s in load.state.items() if t == "stg_transactions"]}
    return rule_report(f.staging, rules, slots=slots, today=RUN_1.date())


@query
def quarantine_replay(f):
    """Accounts rejected for an unknown customer, judged again after the missing customer has come."""
    columns = staged_columns("accounts")
    records = quarantine_rows(_classified(f, "accounts"), "stg_accounts", columns, 1, f.run_1)
    arrived = f.customers.select("customer_source_id").union(f.spark.sql("SELECT 'CUST-UNKNOWN'"))
    again = judged_again(records, "accounts", arrived)
    key = converted_keys("accounts")["account_source_id"]
    return again.select(F.col("record.source_row_id").alias("source_row_id"), key.alias("account_source_id"),
                        to_date(F.col("opening_date")).alias("opening_date"), to_decimal(F.col("credit_limit"), 18, 2).alias("credit_limit"), REASON)


@query
def damaged_lines(f):
    """Customers written as CSV lines, some of them damaged, and read back: sound rows by name, damaged ones by their text."""
    key = F.col("c_custkey")
    line = F.concat_ws(",", key.cast("string"), F.when(key % 31 == 4, F.concat(F.lit('"'), "c_name")).otherwise(F.concat(F.lit('"'), "c_name", F.lit('"'))),
                       F.lit(""), F.lit("N"), "c_mktsegment", F.lit("TN"), F.lit("2020-01-01"))
    line = F.when(key % 29 == 3, F.concat(line, F.lit(",EXTRA"))).when(key % 37 == 5, key.cast("string")).otherwise(line)
    home = f"{work_dir(f.spark)}/lines-{uuid.uuid4().hex}"
    named = f.table("customer").select(line.alias(",".join(STAGING_COLUMNS["stg_customers"])))
    named.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(home)
    parsed = staging_lines(f.spark, home, "stg_customers")
    return parsed.select(F.when(F.col("damaged").isNull(), F.col("full_name")).alias("full_name"), "damaged")


@query
def slot_pruned_quarter(f):
    """The movements of one quarter out of a table with a slot a month, and how many slots were opened for them."""
    batch = _new_warehouse(f).open_batch("MONTHS", RUN_1)
    batch.write("transactions", f.transactions, month_slot(F.col("transaction_date")))
    rows = batch.read("transactions", days=(date(2000, 10, 1), date(2000, 12, 31)))
    opened = len({path.split("/slot=")[1].split("/")[0] for path in rows.inputFiles()})
    return (rows.groupBy("transaction_type").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(28,2)").alias("amount"))
            .withColumn("slots_opened", F.lit(opened)))


@query
def quality_by_table(f):
    return quality.quality_by_table(f.staging)


@query
def quality_overall(f):
    return quality.overall_quality(quality.quality_by_table(f.staging))


@query
def tx_by_month(f):
    return quality.transactions_by_month(f.staged("stg_transactions"))


@query
def dq_issues(f):
    return portfolio.dq_issues(f.staged("stg_accounts"), f.staged("stg_credit_bureau"))


# --- dimensions -------------------------------------------------------------------------

@query
def dim_date(f):
    """Calendar with the number of orders opened per day, so that it follows the data."""
    opened = (f.staged("stg_accounts").select(to_date(F.col("opening_date")).alias("full_date"))
              .groupBy("full_date").agg(F.count("*").alias("accounts_opened")))
    return f.dates.join(opened, "full_date", "left").withColumns({
        "accounts_opened": F.coalesce("accounts_opened", F.lit(0)),
        "is_reporting_period_end": F.col("is_reporting_period_end").cast("int")})


@query
def latest_score_band(f):
    scored = f.customers.select("customer_source_id").join(latest_score(f.bureau), "customer_source_id", "left")
    return scored.select("customer_source_id", "bureau_score", score_band(F.col("bureau_score")).alias("bureau_score_band"))


def _versions(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_key", "customer_source_id", "full_name", "segment", "country_code", "bureau_score_band",
        F.to_date("effective_date").alias("effective_date"), F.to_date("expiry_date").alias("expiry_date"),
        F.col("is_current").cast("int").alias("is_current"), "version_number")


@query
def scd2_two_batches(f):
    return _versions(f.dim_customer_after_second_load)


@query
def scd2_current(f):
    return _versions(f.dim_customer_after_second_load.where("is_current"))


@query
def scd2_collated(f):
    """The second load sent in other cases and with trailing blanks, merged as a server with such a collation does."""
    again = dimension_source(f.customers_again, f.bureau)
    sent = again.withColumns({"customer_source_id": F.concat(F.lower("customer_source_id"), F.lit(" ")), "segment": F.lower("segment"),
                              "full_name": F.concat(F.upper("full_name"), F.lit("  "))})
    return _versions(merge_scd2(f.dim_customer, sent, f.run_2, SERVER))


@query
def surrogate_keys(f):
    """Consecutive keys over the accounts in the order of customer and account."""
    rows = f.staged("stg_accounts").select("customer_source_id", "account_source_id")
    return dense_index(rows, ["customer_source_id", "account_source_id"], "surrogate_key", start=1)


# --- facts --------------------------------------------------------------------------------

@query
def flagship_stage_exposure(f):
    """Exposure and accounts per stage at the as-of date, from raw rows to the figure."""
    dpd = F.coalesce("dpd", F.lit(0))
    book = (f.keep("accounts").select("account_source_id", "product_code", "credit_limit")
            .join(f.products.select("product_code"), "product_code").join(f.state(), "account_source_id", "left"))
    return (book.groupBy(ifrs9_stage(dpd).alias("ifrs9_stage"))
            .agg(F.count("*").alias("n_accounts"),
                 F.sum(F.coalesce("balance", F.lit(0))).cast("decimal(28,2)").alias("outstanding_balance"),
                 F.sum("credit_limit").cast("decimal(28,2)").alias("credit_limit"))
            .orderBy("ifrs9_stage"))


@query
def fact_exposure(f):
    return f.exposure()


@query
def fact_exposure_collated(f):
    """Exposure of accounts whose codes differ from the dimensions' in case and trailing blanks."""
    sent = f.accounts.withColumns({c: F.concat(F.lower(c), F.lit(" ")) for c in ("product_code", "branch_code", "customer_source_id")})
    return facts.fact_exposure(sent, f.transactions, f.dim_customer, f.products, f.branches, f.scenario_key, AS_OF, 1, CALENDAR_START, SERVER)


@query
def fact_exposure_history(f):
    return f.exposures()


@query
def exposure_point_in_time(f):
    """Every exposure row with the score band its customer had at its date."""
    versions = materialize(band_history(f.stored_bureau), "band-history")
    rows = point_in_time_exposure(f.exposures(stored=True, carried=("customer_source_id", "opening_date")), f.accounts, f.dim_customer, versions, ["bureau_score_band", "version_number"])
    return rows.select("date_key", "account_source_id", "customer_source_id", "outstanding_balance", F.col("opened").cast("int").alias("opened"),
                       "bureau_score_band", "version_number")


@query
def transaction_score_asof(f):
    found = transaction_scores(f.stored_transactions, f.accounts, f.stored_bureau)
    return found.select("transaction_id", "customer_source_id", "transaction_date", "bureau_score", "report_date")


@query
def sql_stage_exposure(f):
    """Written in SQL only, over the registered functions and views."""
    register_sql(f.spark, {"accounts": f.stored_accounts, "transactions": f.stored_transactions, "credit_bureau": f.stored_bureau})
    return f.spark.sql("""
        SELECT ifrs9_stage(e.dpd_current) AS ifrs9_stage, score_band(s.bureau_score) AS bureau_score_band, count(*) AS n_accounts,
               CAST(sum(e.outstanding_balance) AS DECIMAL(28,2)) AS outstanding_balance
        FROM exposure_at(DATE '2000-12-31') e LEFT JOIN scores_at(DATE '2000-12-31') s ON s.customer_source_id = e.customer_source_id
        GROUP BY ALL""")


@query
def fact_credit_event(f):
    return f.events()


@query
def fact_rating_history(f):
    return f.ratings()


@query
def ecl_inputs_by_segment(f):
    return ecl_inputs(f.exposure(), f.dim_customer)


# --- features -----------------------------------------------------------------------------

def _features(f: Frames, grain: str) -> DataFrame:
    rows = customer_risk_features(f.exposures(stored=True), f.ratings(), f.events(stored=True), f.dim_customer,
                                  AS_OF_KEY, 1, f.run_2, grain)
    return rows.drop("computed_at", "is_default_flag").withColumns({
        "payment_volatility_6m": F.col("payment_volatility_6m").cast("double"),
        "utilization_ratio": F.col("utilization_ratio").cast("double")})


@query
def risk_features(f):
    return _features(f, "account_rows")


@query
def risk_features_customer_month(f):
    return _features(f, "customer_month")


@query
def missed_payments_12m(f):
    return missed_payments(f.events(), AS_OF)


@query
def bureau_delta(f):
    return bureau_features(f.ratings(), AS_OF)


@query
def moving_balance_windows(f):
    monthly = exposure_tail(f.exposures(), AS_OF, "customer_month")
    return moving_windows(monthly).withColumn("payment_volatility_6m", F.round("payment_volatility_6m", 4))


# --- groups ---------------------------------------------------------------------------------

@query
def group_hierarchy(f):
    links = f.stored_accounts.select("account_source_id", "customer_source_id", "parent_group_id")
    expanded = expand_hierarchy(links)
    return expanded.join(links.select("account_source_id", "customer_source_id"), "account_source_id")


@query
def unreached_nodes(f):
    """Accounts in a graph of made-up parents (each one function of the account's number): orphans, deep chains and cycles."""
    links = f.stored_accounts.select("account_source_id", F.substring("account_source_id", 5, 20).cast("bigint").alias("n"))
    parent = F.when(F.col("n") % 13 == 0, None).when(F.col("n") % 17 == 3, "ACC-NONE").when(F.col("n") % 3 == 1, F.concat(F.lit("ACC-"), (F.col("n") + 1).cast("string"))).otherwise(
        F.concat(F.lit("ACC-"), ((F.col("n") * 7 + 5) % 4001).cast("string")))
    return find_unreached(links.select("account_source_id", parent.alias("parent_group_id")))


@query
def group_exposure_view(f):
    accounts = f.stored_accounts
    return group_exposure(expand_hierarchy(accounts), accounts, f.dim_customer, f.exposures(stored=True))


@query
def group_exposure_total(f):
    accounts = f.stored_accounts
    return group_exposure_rollup(
        group_exposure(expand_hierarchy(accounts), accounts, f.dim_customer, f.exposure(stored=True)), AS_OF_KEY)


# --- drift ------------------------------------------------------------------------------------

@query
def ntile_buckets(f):
    """Accounts in ten equal groups by utilisation at the as-of date."""
    rows = f.exposure().where("credit_limit > 0").select(
        "account_source_id", (F.col("outstanding_balance").cast("double") / F.col("credit_limit").cast("double"))
        .alias("utilization"))
    return ntile(rows, ["utilization", "account_source_id"], 10).select("account_source_id", "bucket")


@query
def psi_ntile(f):
    """First against last quarter of the as-of year, on the customers' utilisation."""
    features = utilization_by_date(f.exposures())
    windows = (date(2000, 1, 1), date(2000, 3, 31)), (date(2000, 10, 1), date(2000, 12, 31))
    out = drift.detect_feature_drift(features, *windows, "2000-Q1", "2000-Q4", 1, f.run_1)
    return out.drop("computed_at").withColumns(
        {c: F.round(c, 6) for c in ("reference_mean", "current_mean", "population_stability_index")})


def _psi(f: Frames) -> DataFrame:
    f.share(customers=("customer_source_id",), accounts=("account_source_id", "credit_limit"),
            bureau=("customer_source_id", "report_date", "bureau_score"))
    return drift.psi_by_quarter(f.month_end_transactions, f.stored_accounts, f.stored_bureau)


@query
def psi_quantile_by_quarter(f):
    return _psi(f).withColumn("psi", F.round("psi", 6))


@query
def feature_drift_status(f):
    return drift.feature_drift_status(_psi(f))


@query
def drift_sketches(f):
    """Sketched utilisation per quarter: its number of values, and whether its median is within the stated rank error of the
    exact one."""
    first, quarters = drift.snapshot_dates(f.month_end_transactions)
    periods = [name for name, _ in quarters]
    spells = drift.utilization_spells(f.month_end_transactions, f.stored_accounts, [day for _, day in quarters])
    labels = F.array(*[F.lit(p) for p in periods])
    values = materialize(spells.select(F.explode(F.slice(labels, F.col("first") + 1, F.col("until") - F.col("first"))).alias("period"), "value"), "utilizations")
    states = value_states(values, ["period"], "value")
    median = F.kll_sketch_get_quantile_double("state", F.lit(0.5))
    found = values.join(states.select("period", median.alias("median")), "period").groupBy("period").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") < F.col("median")).alias("below"), F.count_if(F.col("value") <= F.col("median")).alias("upto"))
    half, slack = F.col("n") * 0.5, F.col("n") * RANK_ERROR + 1
    return found.select("period", "n", ((F.col("below") <= half + slack) & (F.col("upto") >= half - slack)).cast("int").alias("median_within_error"))


@query
def utilization_histogram(f):
    return drift.utilization_histogram(f.month_end_transactions, f.stored_accounts)


# --- portfolio --------------------------------------------------------------------------------

def _snapshot(f: Frames) -> DataFrame:
    day = portfolio.last_transaction_date(f.month_end_transactions)
    return portfolio.account_snapshot(f.stored_accounts, f.month_end_transactions, day, f.products, f.branches)


@query
def dpd_distribution(f):
    return portfolio.dpd_distribution(_snapshot(f))


@query
def score_distribution(f):
    return portfolio.score_distribution(f.bureau)


@query
def segment_distribution(f):
    return portfolio.segment_distribution(f.customers)


@query
def exposure_by_family(f):
    return portfolio.exposure_by(_snapshot(f), "product_family")


@query
def exposure_by_region(f):
    return portfolio.exposure_by(_snapshot(f), "region")


@query
def exposure_by_stage(f):
    return portfolio.stage_distribution(_snapshot(f))


@query
def portfolio_kpis(f):
    psi = portfolio.utilization_psi(f.month_end_transactions, f.stored_accounts)
    issues = portfolio.dq_issues(f.staged("stg_accounts"), f.staged("stg_credit_bureau"))
    kpis = portfolio.portfolio_kpis(_snapshot(f), f.customers, psi, issues)
    return kpis.withColumn("value", F.round("value", 4))


# --- runs ---------------------------------------------------------------------------------------

def _new_warehouse(f: Frames) -> Warehouse:
    return Warehouse(f.spark, f"{work_dir(f.spark)}/warehouse-{uuid.uuid4().hex}")


def _warehouse_run(f: Frames) -> Warehouse:
    """Stage the views as one load and run the month on it."""
    warehouse = _new_warehouse(f)
    load = warehouse.open_batch("STAGE_VIEWS", RUN_1)
    for table, df in f.staging.items():
        load.write(table, df.withColumn("source_system", F.lit("SUPPLIED")), "load1")
    load.publish()
    load.close("SUCCESS")
    run_full_etl(warehouse, AS_OF_KEY, "MONTHLY_CHECK", RUN_1, CALENDAR, buckets=4)
    return warehouse


@query
def run_log(f):
    runs = _warehouse_run(f).run_log().where(F.col("pipeline_name") == "MONTHLY_CHECK")
    return runs.select("batch_id", "pipeline_name", "status", "rows_ingested", "rows_quarantined")


@query
def step_log(f):
    return _warehouse_run(f).step_log().select("step_name", "row_count", "status")


@query
def verified_run(f):
    """The macro figures cleansed as a run and verified, twice: the second run finds nothing new, which verification refuses."""
    warehouse = _new_warehouse(f)
    load = warehouse.open_batch("STAGE_MACRO", RUN_1)
    load.write("stg_macro_indicators", f.staged("stg_macro_indicators").withColumn("source_system", F.lit("SUPPLIED")), "load1")
    load.publish()
    load.close("SUCCESS")
    verdicts = {}
    for _ in range(2):
        batch_id = published.cleanse_macro(warehouse, RUN_1)
        try:
            verdicts[batch_id] = f"{verify_run(warehouse, 'MACRO_CLEANSE')['rows_ingested']} rows"
        except RuntimeError as refused:
            verdicts[batch_id] = str(refused)
    verdict = F.coalesce(*[F.when(F.col("batch_id") == b, F.lit(v)) for b, v in verdicts.items()])
    runs = warehouse.run_log().where(F.col("pipeline_name") == "MACRO_CLEANSE")
    return runs.select("batch_id", "status", "rows_ingested", verdict.alias("verdict"))


@query
def consumed_loads(f):
    """The movements staged as two loads and consumed one after the other: what each of three runs finds unprocessed."""
    warehouse = _new_warehouse(f)
    load = warehouse.open_batch("STAGE_LOADS", RUN_1)
    staged = f.staged("stg_transactions").withColumn("source_system", F.lit("SUPPLIED"))
    load.write("stg_transactions", staged, F.concat(F.lit("load"), F.col("batch_id").cast("string")))
    load.publish()
    found = []
    for run, mine in enumerate((["load1"], ["load2"], [])):
        batch = warehouse.open_batch("CONSUME", RUN_1)
        rows, slots = batch.unprocessed("stg_transactions")
        found.append(rows.groupBy("batch_id").agg(F.count("*").alias("n"), F.max("row_id").alias("last_row"))
                     .withColumns({"run": F.lit(run + 1), "open_loads": F.lit(len(slots))}))
        batch.consume("stg_transactions", mine)
        batch.publish()
    return facts.union_all(found)


@query
def slots_after_cleanup(f):
    """Movements published as two loads, the second merged into the months of the first, then cleaned up: per month what
    the manifest says, what its files hold, and how many replaced months went."""
    warehouse = _new_warehouse(f)
    f.share()
    staged = f.staged("stg_transactions")
    for number, run_ts in enumerate((RUN_1, RUN_2), 1):
        batch = warehouse.open_batch("LOAD", run_ts)
        rows = cleanse_load(f, staged.where(F.col("batch_id") == number), number)
        batch.upsert("transactions", rows, ["transaction_id"], month_slot(F.col("transaction_date")), slots_move=True)
        batch.publish()
        batch.close("SUCCESS")
    removed = warehouse.clean(RUN_2 + timedelta(days=1))
    held = warehouse.read("transactions").groupBy("slot").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(28,2)").alias("amount"))
    return held.join(warehouse.slots("transactions"), "slot", "full").withColumn("replaced", F.lit(removed["slots"]))


@query
def published_group_view(f):
    """The group view over published tables, asked in SQL: accounts and exposure by level and date."""
    warehouse = _new_warehouse(f)
    batch = warehouse.open_batch("PUBLISH", RUN_1)
    batch.write("accounts", f.stored_accounts, bucket_slot(["account_source_id"], 4))
    batch.write("dim_customer", f.dim_customer, bucket_slot(["customer_source_id"], 4))
    for date_key, rows in f.exposures_by_date().items():
        batch.write("fact_exposure", rows, f"d{date_key}")
    batch.publish()
    published.group_exposure_view(warehouse, "published_groups")
    return f.spark.sql("""SELECT hierarchy_level, date_key, count(*) AS accounts, cast(sum(exposure_rows) AS bigint) AS exposure_rows,
        cast(sum(outstanding_balance) AS decimal(28,2)) AS outstanding_balance FROM published_groups GROUP BY hierarchy_level, date_key""")


@query
def report_document(f):
    """Two distributions written as one JSON document, and the document read back."""
    home = f"{work_dir(f.spark)}/report-{uuid.uuid4().hex}"
    write_json_document({"segments": portfolio.segment_distribution(f.customers), "scores": portfolio.score_distribution(f.bureau)}, home)
    text = f.spark.read.text(home, wholetext=True).where("length(trim(value)) > 0")
    document = text.select(F.from_json("value", "segments array<struct<segment string, n bigint>>, scores array<struct<label string, n bigint>>").alias("d"))
    segments = document.select(F.inline("d.segments")).select(F.lit("segments").alias("section"), F.lit(None).cast("int").alias("position"),
                                                              F.col("segment").alias("label"), "n")
    scores = document.select(F.posexplode("d.scores").alias("position", "s")).select(F.lit("scores").alias("section"), "position", "s.label", "s.n")
    return segments.union(scores)


@query
def incremental_ingest(f):
    """The event files consumed as a stream, drained twice; the second time nothing is left."""
    home = f"{work_dir(f.spark)}/ingest-{uuid.uuid4().hex}"
    schema = f.spark.read.parquet(f"{f.sf_dir}/events.parquet").schema
    files = (f.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
             .parquet(f.sf_dir))
    for _ in range(2):
        consume_once(files, f"{home}/staged", f"{home}/checkpoint")
    staged = f.spark.read.schema(schema).parquet(f"{home}/staged")
    return (staged.groupBy(F.to_date("ts").alias("day"), "event_type")
            .agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total_value")))
