"""Portfolio report: key figures, exposure splits, distributions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.convert import to_date, to_decimal, to_int
from ledgerloom.functions.risk import ifrs9_stage, utilization
from ledgerloom.operators.histogram import class_counts, right_closed_class
from ledgerloom.plans.drift import CAP, psi_by_quarter, quantile_psi, utilization_spells
from ledgerloom.plans.facts import account_state, union_all

# Classes of the two distributions (right-closed) and stage captions.
DPD_EDGES = [-1, 0, 30, 60, 90, 120, 1000]
DPD_LABELS = ["0 (à jour)", "1-30", "31-60", "61-90", "91-120", "120+"]
SCORE_EDGES = [0, 500, 600, 700, 750, 1000]
SCORE_LABELS = ["0-500", "500-600", "600-700", "700-750", "750+"]
STAGE_LABELS = {1: "Stage 1 (sain)", 2: "Stage 2 (dégradé)", 3: "Stage 3 (déprécié)"}


def last_transaction_date(transactions: DataFrame) -> date:
    return transactions.agg(F.max("transaction_date").alias("d")).first()["d"]


def account_snapshot(accounts: DataFrame, transactions: DataFrame, as_of: date,
                     products: DataFrame, branches: DataFrame) -> DataFrame:
    """Every account at ``as_of``: balance never below zero, DPD of that very date only.

    One row per account keeps all that the report needs, so each figure below is a single
    aggregation over it.
    """
    on_day = F.when(F.col("transaction_date") == F.lit(as_of), F.col("dpd_snapshot"))
    today = (transactions.where(F.col("transaction_date") == F.lit(as_of)).groupBy("account_source_id")
             .agg(F.max(on_day).alias("dpd_today")))
    state = account_state(transactions, as_of).select("account_source_id", "balance")
    dpd = F.coalesce("dpd_today", F.lit(0))
    floored = F.coalesce(F.when(F.col("balance") < 0, 0).otherwise(F.col("balance")), F.lit(0)).cast("decimal(18,2)")
    return (accounts.select("account_source_id", "product_code", "branch_code", "credit_limit")
            .join(state, "account_source_id", "left").join(today, "account_source_id", "left")
            .join(products.select("product_code", "product_family"), "product_code", "left")
            .join(branches.select("branch_code", "region"), "branch_code", "left")
            .select("account_source_id", "product_family", "region", "credit_limit",
                    floored.alias("outstanding_balance"), dpd.alias("dpd_current"),
                    ifrs9_stage(dpd).alias("ifrs9_stage"),
                    utilization(floored, F.col("credit_limit"), CAP).alias("utilization_ratio")))


def exposure_by(snapshot: DataFrame, column: str) -> DataFrame:
    """Exposure per class, largest first; accounts without a class are left out."""
    return (snapshot.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.sum("outstanding_balance").alias("exposure"), F.count("*").alias("n_accounts"))
            .orderBy(F.desc("exposure"), column))


def stage_distribution(snapshot: DataFrame) -> DataFrame:
    """Exposure and share per stage; all three stages are always listed."""
    totals = snapshot.agg(
        F.sum("outstanding_balance").alias("total"),
        *[F.sum(F.when(F.col("ifrs9_stage") == s, F.col("outstanding_balance")).otherwise(0)).alias(f"e{s}")
          for s in STAGE_LABELS],
        *[F.count_if(F.col("ifrs9_stage") == s).alias(f"n{s}") for s in STAGE_LABELS])
    share = {s: F.try_divide(F.col(f"e{s}").cast("double") * 100, F.col("total").cast("double")) for s in STAGE_LABELS}
    rows = F.array(*[
        F.struct(F.lit(s).alias("ifrs9_stage"), F.lit(text).alias("label"), F.col(f"e{s}").alias("exposure"),
                 F.bround(share[s], 1).alias("pct"), F.col(f"n{s}").alias("n_accounts"))
        for s, text in STAGE_LABELS.items()])
    return totals.select(F.inline(rows))


def dpd_distribution(snapshot: DataFrame) -> DataFrame:
    return class_counts(snapshot, right_closed_class(F.col("dpd_current"), DPD_EDGES), DPD_LABELS)


def score_distribution(bureau: DataFrame) -> DataFrame:
    """Latest score per customer in right-closed classes."""
    latest = bureau.groupBy("customer_source_id").agg(F.max_by("bureau_score", "report_date").alias("score"))
    return class_counts(latest, right_closed_class(F.col("score"), SCORE_EDGES), SCORE_LABELS)


def segment_distribution(customers: DataFrame) -> DataFrame:
    return (customers.where(F.col("segment").isNotNull()).groupBy("segment").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "segment"))


def dq_issues(staged_accounts: DataFrame, staged_bureau: DataFrame) -> DataFrame:
    """(source, issue, n, checked): named anomaly counts over the raw text of accounts and
    bureau reports, one scan each."""
    limit = to_decimal(F.col("credit_limit"), 38, 6)
    score = to_int(F.col("bureau_score"))
    # Captions of the four checks.
    account_checks = {
        "credit_limit négatif ou non numérique": limit < 0,
        "opening_date non convertible": to_date(F.col("opening_date")).isNull(),
        "clé compte manquante": F.col("account_source_id").isNull(),
    }
    bureau_checks = {"bureau_score hors [0,1000]": (score < 0) | (score > 1000)}

    def listing(df: DataFrame, source: str, checks: dict) -> DataFrame:
        counted = df.agg(F.count("*").alias("checked"),
                         *[F.count_if(test).alias(f"n{i}") for i, test in enumerate(checks.values())])
        rows = F.array(*[F.struct(F.lit(text).alias("issue"), F.col(f"n{i}").alias("n"))
                         for i, text in enumerate(checks)])
        return counted.select(F.lit(source).alias("source"), F.inline(rows), "checked")

    return listing(staged_accounts, "accounts", account_checks).unionByName(
        listing(staged_bureau, "credit_bureau", bureau_checks))


def reference_and_current_month(transactions: DataFrame) -> tuple[date, date]:
    """Twelfth distinct transaction date (the first when there are no more than twelve) and
    the last one. Thirteen dates at most are fetched, after a distinct."""
    days = [r["transaction_date"] for r in
            transactions.select("transaction_date").distinct().orderBy("transaction_date").limit(13).collect()]
    return (days[11] if len(days) > 12 else days[0]), last_transaction_date(transactions)


def utilization_psi(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """PSI of utilisation, last date against the reference date; repeated edges are kept."""
    reference, current = ({"utilization_ratio": utilization_spells(transactions, accounts, [day])}
                          for day in reference_and_current_month(transactions))
    return quantile_psi(current, ["current"], reference, unique_edges=False, min_values=0)


def portfolio_kpis(snapshot: DataFrame, customers: DataFrame, psi: DataFrame, issues: DataFrame) -> DataFrame:
    """(kpi, value) rows: totals, default rate, utilisation, drift and quality."""
    book = snapshot.agg(
        F.sum("outstanding_balance").cast("double").alias("total_exposure"),
        F.count("*").cast("double").alias("n_accounts"),
        F.try_divide(F.count_if(F.col("ifrs9_stage") == 3) * 100, F.count("*")).alias("default_rate_pct"),
        (F.avg("utilization_ratio") * 100).alias("avg_utilization_pct"))
    clients = customers.agg(F.count("*").cast("double").alias("n_customers"))
    drift = psi.agg(F.max("psi").alias("psi_utilization"))
    # A table repeats its row count on each of its checks, so it enters once per table.
    per_source = issues.groupBy("source").agg(F.max("checked").alias("checked"), F.sum("n").alias("failed"))
    quality = per_source.agg(
        ((1 - F.try_divide(F.sum("failed"), F.sum("checked"))) * 100).alias("dq_pass_rate_pct"))

    def rows(df: DataFrame) -> DataFrame:
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("kpi"), F.col(c).alias("value")) for c in df.columns])))

    return union_all([rows(book), rows(clients), rows(drift), rows(quality)])


def portfolio_report(customers: DataFrame, accounts: DataFrame, transactions: DataFrame, bureau: DataFrame,
                     staged_accounts: DataFrame, staged_bureau: DataFrame, products: DataFrame,
                     branches: DataFrame) -> dict[str, DataFrame]:
    """All sections of the portfolio document; every one is a few labelled rows."""
    as_of = last_transaction_date(transactions)
    snapshot = account_snapshot(accounts, transactions, as_of, products, branches)
    issues = dq_issues(staged_accounts, staged_bureau)
    series = psi_by_quarter(transactions, accounts, bureau, unique_edges=False, min_values=0,
                            features=("utilization_ratio",))
    return {
        "kpis": portfolio_kpis(snapshot, customers, utilization_psi(transactions, accounts), issues),
        "stage_distribution": stage_distribution(snapshot),
        "exposure_by_family": ranked(exposure_by(snapshot, "product_family"), "exposure"),
        "exposure_by_region": ranked(exposure_by(snapshot, "region"), "exposure"),
        "dpd_distribution": dpd_distribution(snapshot),
        "score_distribution": score_distribution(bureau),
        "segment_distribution": ranked(segment_distribution(customers), "n"),
        "psi_series": series.select("period", F.bround("psi", 4).alias("psi")),
        "dq_issues": issues,
    }


def ranked(df: DataFrame, measure: str) -> DataFrame:
    """Number an already aggregated handful of rows for display, largest first."""
    rows = df.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col(measure)).alias("_negative"), F.struct(*df.columns).alias("row")))).alias("rows"))
    return rows.select(F.posexplode("rows").alias("ordinal", "r")).select("ordinal", "r.row.*")
