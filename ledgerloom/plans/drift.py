"""Drift monitoring: equal-tile PSI between two windows, quantile PSI over time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.risk import drift_status, quarter_label, utilization
from ledgerloom.operators.dense import grouped_counts
from ledgerloom.operators.histogram import equal_width_class
from ledgerloom.operators.psi import DRIFT_THRESHOLD, counted_edges, edge_class, psi_by_period, tile_psi
from ledgerloom.plans.facts import account_spells, account_state, period_index, union_all, until_next
from ledgerloom.session import materialize
from ledgerloom.sources.calendar import date_to_key

CAP = 2.0            # fixed value: highest utilisation the reports distinguish
REFERENCE = "reference"

# Display names of the monitored features.
FEATURE_LABELS = {
    "utilization_ratio": "Ratio d'utilisation du crédit",
    "dpd_current": "Retard de paiement (DPD)",
    "bureau_score": "Score bureau de crédit",
}


# --- equal tiles -----------------------------------------------------------------------------

def detect_feature_drift(features: DataFrame, reference: tuple[date, date], current: tuple[date, date],
                         reference_period: str, current_period: str, batch_id: int, run_ts: Column,
                         feature: str = "utilization_ratio") -> DataFrame:
    """One metrics row comparing ``feature`` in two date windows; always one row, with a NULL
    index when a window is empty. Counts and means of both windows come from one scan."""
    value, key = F.col(feature), F.col("date_key")

    def inside(window):
        return key.between(date_to_key(window[0]), date_to_key(window[1]))

    measured = features.where(inside(reference) | inside(current)).agg(
        F.count(F.when(inside(reference), value)).alias("ref_n"),
        F.count(F.when(inside(current), value)).alias("cur_n"),
        F.avg(F.when(inside(reference), value.cast("double"))).alias("reference_mean"),
        F.avg(F.when(inside(current), value.cast("double"))).alias("current_mean"))
    index = F.when((F.col("ref_n") > 0) & (F.col("cur_n") > 0), tile_psi(F.col("ref_n"), F.col("cur_n")))
    return measured.withColumn("population_stability_index", index).select(
        F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(feature).alias("feature_name"),
        F.lit(reference_period).alias("reference_period"), F.lit(current_period).alias("current_period"),
        "reference_mean", "current_mean", "population_stability_index",
        F.coalesce((F.col("population_stability_index") > DRIFT_THRESHOLD).cast("int"), F.lit(0)).alias("drift_flag"),
        run_ts.alias("computed_at"))


# --- snapshots --------------------------------------------------------------------------------

def snapshot_dates(transactions: DataFrame) -> tuple[date, list[tuple[str, date]]]:
    """(first transaction date, [(quarter, last transaction date in it)]), oldest first.

    One row per quarter reaches the driver; the dates become literals of the next plans. Labels are made for each date, not for
    each movement.
    """
    rows = (transactions.select("transaction_date").distinct().groupBy(quarter_label(F.col("transaction_date")).alias("q"))
            .agg(F.min("transaction_date").alias("lo"), F.max("transaction_date").alias("hi"))
            .orderBy("hi").collect())
    return rows[0]["lo"], [(r["q"], r["hi"]) for r in rows]


# A feature frame holds (first, until, value): the value stands for the periods first .. until-1.

def utilization_spells(transactions: DataFrame, accounts: DataFrame, days: list[date]) -> DataFrame:
    """Utilisation of every account with a movement so far: negative balances count as zero
    and the ratio is capped."""
    if len(days) == 1:
        state = account_state(transactions, days[0]).withColumns({"first": F.lit(0), "until": F.lit(1)})
    else:
        state = account_spells(transactions, days)
    balance = F.col("balance")
    floored = F.when(balance < 0, 0).otherwise(balance)
    return (state.join(accounts.select("account_source_id", "credit_limit"), "account_source_id")
            .select("first", "until", utilization(floored, F.col("credit_limit"), CAP).alias("value"))
            .where(F.col("value").isNotNull()))


def dpd_spells(transactions: DataFrame, days: list[date]) -> DataFrame:
    """Highest DPD per account among the transactions of exactly each date."""
    on_day = transactions.where(F.col("transaction_date").isin(days))
    period = period_index(F.col("transaction_date"), days)
    return (on_day.groupBy("account_source_id", period.alias("first")).agg(F.max("dpd_snapshot").alias("value"))
            .where(F.col("value").isNotNull())
            .select("first", (F.col("first") + 1).alias("until"), F.col("value").cast("double").alias("value")))


def bureau_spells(bureau: DataFrame, days: list[date]) -> DataFrame:
    """Latest score known at each date, per customer."""
    known = bureau.where(F.col("report_date") <= F.lit(days[-1]))
    latest = known.groupBy("customer_source_id", period_index(F.col("report_date"), days).alias("first")).agg(
        F.max_by("bureau_score", "report_date").alias("value"))
    return (latest.select("first", until_next("customer_source_id", len(days)).alias("until"),
                          F.col("value").cast("double").alias("value"))
            .where(F.col("value").isNotNull()))


def feature_spells(transactions: DataFrame, accounts: DataFrame, bureau: DataFrame, days: list[date],
                   features: list[str]) -> dict[str, DataFrame]:
    """Feature frames for ascending ``days``."""
    build = {
        "utilization_ratio": lambda: utilization_spells(transactions, accounts, days),
        "dpd_current": lambda: dpd_spells(transactions, days),
        "bureau_score": lambda: bureau_spells(bureau, days),
    }
    return {name: build[name]() for name in features}


def class_counts_by_period(spells: DataFrame, class_of: Column, periods: list[str]) -> DataFrame:
    """(period, bin, n). Stretches are counted before they are unfolded into periods, so the
    unfolding touches a few rows per pair of periods, whatever the number of accounts."""
    counted = spells.groupBy("first", "until", class_of.alias("bin")).agg(F.count("*").alias("n"))
    labels = F.array(*[F.lit(p) for p in periods])
    span = F.slice(labels, F.col("first") + 1, F.col("until") - F.col("first"))
    return (counted.select(F.explode(span).alias("period"), "bin", "n")
            .groupBy("period", "bin").agg(F.sum("n").alias("n")))


# --- quantile PSI -----------------------------------------------------------------------------

def quantile_psi(current: dict[str, DataFrame], periods: list[str], reference: dict[str, DataFrame], bins: int = 10,
                 unique_edges: bool = True, min_values: int = 10) -> DataFrame:
    """(feature, period, psi) of every period against its feature's reference values.

    The reference quantiles of all features are found first, together, and reach the counting plan as
    literals, so values are classed without a join. Reference values are counted once, by value: the quantiles and the
    reference's classes both come from those counts.
    """
    named = union_all([reference[f].select(F.lit(f).alias("feature"), "value") for f in current])
    values = grouped_counts(named, "feature", "value")
    found, edges, counts = counted_edges(values, "feature", "value", bins, unique_edges), {}, []
    for feature, spells in current.items():
        edges[feature] = found.get(feature) or [float("-inf"), float("inf")]
        class_of = edge_class(F.col("value"), edges[feature])
        base = (values.where(F.col("feature") == feature).groupBy(class_of.alias("bin")).agg(F.sum("n").alias("n"))
                .select(F.lit(REFERENCE).alias("period"), "bin", "n"))
        for counted in (class_counts_by_period(spells, class_of, periods), base):
            counts.append(counted.select(F.lit(feature).alias("feature"), "period", "bin", "n"))
    return psi_by_period(union_all(counts), edges, REFERENCE, min_values)


def psi_by_quarter(transactions: DataFrame, accounts: DataFrame, bureau: DataFrame, unique_edges: bool = True,
                   min_values: int = 10, features: tuple[str, ...] = tuple(FEATURE_LABELS)) -> DataFrame:
    """PSI of each quarter's last date against the first transaction date."""
    first, quarters = snapshot_dates(transactions)
    current = feature_spells(transactions, accounts, bureau, [day for _, day in quarters], list(features))
    reference = feature_spells(transactions, accounts, bureau, [first], list(features))
    return quantile_psi(current, [name for name, _ in quarters], reference,
                        unique_edges=unique_edges, min_values=min_values)


def feature_drift_status(psi: DataFrame) -> DataFrame:
    """Latest PSI per feature with its status."""
    latest = psi.groupBy("feature").agg(F.max_by("psi", "period").alias("current_psi"))
    label = F.lit(None).cast("string")
    for key, text in FEATURE_LABELS.items():
        label = F.when(F.col("feature") == key, text).otherwise(label)
    shown = F.bround("current_psi", 4)
    return latest.select("feature", label.alias("label"), shown.alias("current_psi"), drift_status(shown).alias("status"))


def utilization_histogram(transactions: DataFrame, accounts: DataFrame, classes: int = 12, top: float = 1.2) -> DataFrame:
    """Reference and current utilisation in equal classes from 0 to ``top``; higher values
    count in the last class."""
    first, quarters = snapshot_dates(transactions)
    parts = []
    for period, day in ((REFERENCE, first), ("current", quarters[-1][1])):
        clipped = F.least("value", F.lit(top))
        bins = equal_width_class(clipped, 0.0, top, classes)
        parts.append(class_counts_by_period(utilization_spells(transactions, accounts, [day]), bins, [period]))
    counted = union_all(parts).agg(
        *[F.coalesce(F.sum(F.when((F.col("period") == p) & (F.col("bin") == i), F.col("n"))), F.lit(0)).alias(f"{p}_{i}")
          for p in (REFERENCE, "current") for i in range(classes)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(f"{top * i / classes:.2f}").alias("label"),
                 F.col(f"{REFERENCE}_{i}").alias("reference"), F.col(f"current_{i}").alias("current"))
        for i in range(classes)])
    return counted.select(F.inline(rows))


def drift_report(transactions: DataFrame, accounts: DataFrame, bureau: DataFrame) -> dict[str, DataFrame]:
    """Sections of the drift document. The PSI table is a few rows and is written once, since
    two sections read it."""
    psi = materialize(psi_by_quarter(transactions, accounts, bureau), "psi")
    return {
        "feature_status": feature_drift_status(psi),
        "feature_series": psi.select("feature", "period", F.bround("psi", 4).alias("psi")),
        "utilization_distribution": utilization_histogram(transactions, accounts),
    }
