from datetime import date, datetime
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import drift, portfolio, quality
from ledgerloom.plans.cleanse import classify, cleanse
from ledgerloom.plans.customer_dim import initial_dimension, merge_scd2
from ledgerloom.plans.facts import (account_state, ecl_inputs, exposure_history, exposure_stretches, exposures_by_date, fact_exposure,
                                    point_in_time_exposure)
from ledgerloom.plans.features import balance_features, bureau_features, missed_payments
from ledgerloom.plans.groups import group_exposure, group_exposure_by_account, group_exposure_rollup
from ledgerloom.schemas import dim_branch, dim_product, table_schema
from ledgerloom.sources.calendar import dim_date, month_ends, months_before
from ledgerloom.sources.reports import json_document


def ts(text="2026-01-01"):
    return F.lit(text).cast("timestamp")



def test_bureau_spellings_of_one_date_are_one_key(spark):
    customers = spark.createDataFrame([("c1",)], "customer_source_id string")
    staged = spark.createDataFrame(
        [("c1", "600", "1", None, "2026-01-05", 1, datetime(2026, 1, 6)), ("c1", "610", "x", "2", "20260105", 2, datetime(2026, 1, 7)),
         ("c2", "600", "1", "1", "2026-01-05", 3, datetime(2026, 1, 6))],
        "customer_source_id string, bureau_score string, external_default_flag string, inquiry_count_12m string, "
        "report_date string, row_id bigint, load_ts timestamp")
    rows = cleanse("credit_bureau", staged, 7, ts(), customers).collect()
    assert [(r.customer_source_id, r.bureau_score, r.external_default_flag, r.inquiry_count_12m, r.report_date, r.batch_id)
            for r in rows] == [("c1", 610, False, 2, date(2026, 1, 5), 7)]
    reasons = {r.row_id: r.failure_reason for r in classify("credit_bureau", staged, customers).collect()}
    assert reasons == {1: None, 2: None, 3: "customer_source_id inconnu en cleansed.customers"}


def _source(spark, rows):
    return spark.createDataFrame(rows, "customer_source_id string, full_name string, segment string, country_code string, bureau_score_band string")


def test_scd2_versions(spark):
    first = initial_dimension(_source(spark, [
        ("same", "n", "s", "TN", "0-500"), ("band", "n", "s", "TN", "0-500"), ("null-empty", "n", "s", "TN", None),
        ("seg", "n", "s", "TN", "750+"), ("absent", "n", "s", "TN", None)]), ts())
    second = merge_scd2(first, _source(spark, [
        ("same", "n", "s", "TN", "0-500"), ("band", "n", "s", "TN", "500-600"), ("null-empty", "n", "s", "TN", ""),
        ("seg", "n", "other", "TN", "750+"), ("new", "n", "s", "TN", None)]), ts("2026-02-01"))
    third = merge_scd2(second, _source(spark, [("seg", "n", "s", "TN", "750+")]), ts("2026-03-01"))
    versions = {}
    for r in third.orderBy("version_number").collect():
        versions.setdefault(r.customer_source_id, []).append((r.version_number, r.is_current, r.segment, r.bureau_score_band))
    assert versions["same"] == [(1, True, "s", "0-500")]
    assert versions["null-empty"] == [(1, True, "s", None)]
    assert versions["band"] == [(1, False, "s", "0-500"), (2, True, "s", "500-600")]
    assert versions["seg"] == [(1, False, "s", "750+"), (2, False, "other", "750+"), (3, True, "s", "750+")]
    assert versions["new"] == [(1, True, "s", None)] and versions["absent"] == [(1, True, "s", None)]
    keys = [r.customer_key for r in third.collect()]
    assert sorted(keys) == list(range(1, 10)) and len(set(keys)) == len(keys)
    overlaps = third.alias("a").join(third.alias("b"), F.expr(
        "a.customer_source_id = b.customer_source_id AND a.version_number < b.version_number AND a.expiry_date > b.effective_date"))
    assert overlaps.count() == 0
    assert third.where("is_current").groupBy("customer_source_id").count().where("count > 1").count() == 0


def _book(spark):
    accounts = spark.createDataFrame(
        [("a1", "c1", "MTG-STD", "BR-TUN-01", Decimal("100.00")), ("a2", "c1", "CONS-PERS", "BR-TUN-02", Decimal("0.00")),
         ("a3", "c2", "NO-SUCH", "BR-TUN-01", Decimal("50.00")), ("a4", "gone", "MTG-STD", "BR-TUN-01", Decimal("50.00")),
         ("a5", "c2", "SME-WC", "BR-TUN-04", Decimal("80.00"))],
        "account_source_id string, customer_source_id string, product_code string, branch_code string, credit_limit decimal(18,2)")
    moves = spark.createDataFrame(
        [("t1", "a1", date(2026, 1, 1), Decimal("70.00"), "DRAWDOWN", 0, 1), ("t2", "a1", date(2026, 2, 1), Decimal("20.00"), "REPAYMENT", 95, 1),
         ("t3", "a1", date(2026, 3, 1), Decimal("5.00"), "FEE", 10, 2), ("t4", "a2", date(2026, 2, 1), Decimal("7.00"), "INTEREST", 40, 1),
         ("t5", "a5", date(2026, 1, 1), Decimal("30.00"), "REPAYMENT", 0, 1)],
        "transaction_id string, account_source_id string, transaction_date date, amount decimal(18,2), transaction_type string, dpd_snapshot int, batch_id bigint")
    dim = spark.createDataFrame([(1, "c1", "Retail", True), (2, "c2", "SME", True), (3, "c2", "Retail", False)],
                                "customer_key bigint, customer_source_id string, segment string, is_current boolean")
    return accounts, moves, dim.withColumn("effective_date", ts())


def test_exposure_history(spark):
    accounts, moves, dim = _book(spark)
    days = [date(2026, 1, 31), date(2026, 2, 28), date(2026, 3, 31)]
    rows = exposure_history(accounts, moves, dim, dim_product(spark), dim_branch(spark), 1, days, 9).collect()
    got = {(r.account_source_id, r.date_key): (r.customer_key, float(r.outstanding_balance), r.dpd_current, r.ifrs9_stage) for r in rows}
    assert got == {
        ("a1", 20260131): (1, 70.0, 0, 1), ("a1", 20260228): (1, 50.0, 95, 3), ("a1", 20260331): (1, 55.0, 95, 3),
        ("a2", 20260131): (1, 0.0, 0, 1), ("a2", 20260228): (1, 7.0, 40, 2), ("a2", 20260331): (1, 7.0, 40, 2),
        ("a5", 20260131): (2, -30.0, 0, 1), ("a5", 20260228): (2, -30.0, 0, 1), ("a5", 20260331): (2, -30.0, 0, 1)}
    single = fact_exposure(accounts, moves, dim, dim_product(spark), dim_branch(spark), 1, days[1], 9).collect()
    assert sorted(map(tuple, single)) == sorted(tuple(r) for r in rows if r.date_key == 20260228)


def test_account_state_reads_only_what_it_needs(spark, tmp_path, plan_text):
    _, moves, _ = _book(spark)
    moves.write.parquet(str(tmp_path / "moves"))
    text = plan_text(account_state(spark.read.parquet(str(tmp_path / "moves")), date(2026, 2, 1)))
    assert "LessThanOrEqual(transaction_date,2026-02-01)" in text
    assert "transaction_id" not in text.split("ReadSchema")[1]


def test_ecl_inputs_balance(spark):
    accounts, moves, dim = _book(spark)
    facts = exposure_history(accounts, moves, dim, dim_product(spark), dim_branch(spark), 1, [date(2026, 3, 31)], 9)
    rows = {r.segment: r for r in ecl_inputs(facts, dim).collect()}
    assert float(rows["Retail"].total_exposure) == 62.0 and float(rows["Retail"].stage_3_exposure) == 55.0
    assert float(rows["Retail"].stage_2_exposure) == 7.0 and float(rows["SME"].stage_1_exposure) == -30.0
    assert rows["SME"].avg_lgd is None


# --- features against a row-by-row computation ----------------------------------------------------

def _exposure_rows():
    import random
    rng = random.Random(11)
    rows = []
    for customer, (months, accounts) in enumerate([(1, 1), (2, 1), (3, 1), (7, 1), (13, 1), (12, 3), (4, 2), (15, 2)]):
        for day in month_ends(date(2026, 6, 30), months):
            for a in range(accounts):
                rows.append((customer, day.year * 10000 + day.month * 100 + day.day, f"acc{a}",
                             Decimal(rng.randrange(-500, 90000)) / 100, Decimal(rng.choice([0, 100, 500])), rng.randrange(0, 120)))
    return rows


@pytest.mark.parametrize("grain", ["account_rows", "customer_month"])
def test_features_match_row_by_row_windows(spark, grain):
    schema = "customer_key bigint, date_key int, account_source_id string, outstanding_balance decimal(18,2), credit_limit decimal(18,2), dpd_current int"
    rows = _exposure_rows()
    got = {r.customer_key: r for r in balance_features(spark.createDataFrame(rows, schema).repartition(3), date(2026, 6, 30), grain).collect()}
    frame = pd.DataFrame(rows, columns=["k", "d", "acc", "bal", "lim", "dpd"])
    frame = frame[frame.d >= 20250630]
    if grain == "customer_month":
        frame = frame.groupby(["k", "d"], as_index=False).agg(acc=("acc", "min"), bal=("bal", "sum"), lim=("lim", "sum"), dpd=("dpd", "max"))
    for key, part in frame.sort_values(["d", "acc"]).groupby("k"):
        part = part.assign(bal=part.bal.astype(float), lim=part.lim.astype(float))
        last = part.iloc[-1]
        row = got[key]
        assert float(row.avg_balance_3m) == pytest.approx(part.bal.tail(3).mean(), abs=0.0051)
        assert float(row.avg_balance_12m) == pytest.approx(part.bal.tail(12).mean(), abs=0.0051)
        assert (row.dpd_current, row.dpd_max_last_6m) == (last.dpd, part.dpd.tail(6).max())
        assert row.dpd_trend_3m == (None if len(part) < 4 else int(last.dpd - part.iloc[-4].dpd))
        spread = part.bal.tail(6).std()
        assert row.payment_volatility_6m is None if len(part) < 2 else float(row.payment_volatility_6m) == pytest.approx(spread, abs=1e-3)
        assert row.utilization_ratio is None if last.lim == 0 else float(row.utilization_ratio) == pytest.approx(last.bal / last.lim, abs=1e-3)
    assert set(got) == set(frame.k)


def test_bureau_lag_counts_rows(spark):
    days = [20250101 + 100 * i for i in range(8)]
    rows = [(1, d, 600 + i) for i, d in enumerate(days)] + [(2, days[0], 500)] + [(1, 20270101, 1)]
    out = {r.customer_key: (r.bureau_score_current, r.bureau_score_delta_6m)
           for r in bureau_features(spark.createDataFrame(rows, "customer_key bigint, date_key int, bureau_score int"), date(2026, 1, 1)).collect()}
    assert out == {1: (607, 6), 2: (500, None)}


def test_missed_payments_window(spark):
    rows = [(1, 20250630, "MISSED_PAYMENT"), (1, 20250629, "MISSED_PAYMENT"), (1, 20260801, "MISSED_PAYMENT"), (1, 20260101, "DEFAULT")]
    events = spark.createDataFrame(rows, "customer_key bigint, date_key int, event_type string")
    assert missed_payments(events, date(2026, 6, 30)).first().n_missed_payments_12m == 2
    assert missed_payments(events, date(2026, 6, 30), bound_to_as_of=True).first().n_missed_payments_12m == 1
    assert months_before(date(2024, 2, 29), 12) == date(2023, 2, 28)


# --- groups: totals equal those of the row-by-row pairing ---------------------------------------

def test_group_totals_equal_row_pairing(spark):
    accounts, moves, dim = _book(spark)
    facts = exposure_history(accounts, moves, dim, dim_product(spark), dim_branch(spark), 1, [date(2026, 3, 31)], 9)
    tree = spark.createDataFrame([("a1", "a1", 0, "a1"), ("a2", "a1", 1, "a1 > a2"), ("a3", "a3", 0, "a3"), ("a4", "a4", 0, "a4")],
                                 "account_source_id string, root_group_id string, hierarchy_level int, hierarchy_path string")
    view = group_exposure(tree, accounts, dim, facts)
    pairs = (tree.join(accounts.select("account_source_id", "customer_source_id"), "account_source_id")
             .join(dim.where("is_current").select("customer_source_id", "customer_key"), "customer_source_id")
             .join(facts.select("customer_key", "date_key", "outstanding_balance"), "customer_key", "left"))
    expected = {(r.root_group_id, float(r.s), r.n) for r in pairs.groupBy("root_group_id").agg(
        F.sum("outstanding_balance").alias("s"), F.count("outstanding_balance").alias("n")).collect()}
    got = {(r.root_group_id, float(r.s), r.n) for r in view.groupBy("root_group_id").agg(
        F.sum("outstanding_balance").alias("s"), F.sum("exposure_rows").alias("n")).collect()}
    assert got == expected
    assert [(r.root_group_id, float(r.total_group_exposure)) for r in group_exposure_rollup(view).collect()] == [("a1", 124.0), ("a3", -30.0)]
    own = {r.account_source_id: r.outstanding_balance for r in group_exposure_by_account(tree, facts).collect()}
    assert float(own["a1"]) == 55.0 and float(own["a2"]) == 7.0 and own["a4"] is None


# --- drift and reports ---------------------------------------------------------------------------

def test_drift_row_for_empty_window(spark):
    features = spark.createDataFrame([(20260101, 0.5), (20260102, None), (20260103, 0.7)], "date_key int, utilization_ratio double")
    row = drift.detect_feature_drift(features, (date(2026, 1, 1), date(2026, 1, 31)), (date(2027, 1, 1), date(2027, 1, 31)),
                                     "a", "b", 1, ts()).collect()
    assert len(row) == 1 and row[0].population_stability_index is None and row[0].drift_flag == 0
    assert row[0].reference_mean == pytest.approx(0.6) and row[0].current_mean is None


def test_quality_counts(spark):
    staged = {
        "stg_customers": spark.createDataFrame([(None, None), ("c", "s")], "customer_source_id string, segment string"),
        "stg_accounts": spark.createDataFrame([("x",), ("-1",), ("5",)], "credit_limit string"),
        "stg_transactions": spark.createDataFrame([("unk", "2026-01-05"), ("1000", "bad"), ("-3", "2026-01-06")], "dpd_snapshot string, transaction_date string"),
        "stg_credit_bureau": spark.createDataFrame([], "bureau_score string"),
    }
    rows = {r.table_name: (r.rows_checked, r.rows_quarantined, r.pass_rate_pct) for r in quality.quality_by_table(staged).collect()}
    assert rows == {"stg_customers": (2, 2, 0.0), "stg_accounts": (3, 2, 33.33), "stg_transactions": (3, 2, 33.33), "stg_credit_bureau": (0, 0, 100.0)}
    assert [tuple(r) for r in quality.transactions_by_month(staged["stg_transactions"]).collect()] == [("2026-01", 2)]


def test_portfolio_stage_shares_and_document(spark):
    accounts, moves, _ = _book(spark)
    day = portfolio.last_transaction_date(moves)
    snapshot = portfolio.account_snapshot(accounts, moves, day, dim_product(spark), dim_branch(spark))
    rows = {r.account_source_id: r for r in snapshot.collect()}
    assert float(rows["a5"].outstanding_balance) == 0.0 and rows["a2"].utilization_ratio == 2.0
    assert rows["a1"].dpd_current == 10 and rows["a3"].product_family is None
    stages = portfolio.stage_distribution(snapshot).collect()
    assert [float(r.exposure) for r in stages] == [62.0, 0.0, 0.0] and sum(r.pct for r in stages) == pytest.approx(100)
    import json
    text = json_document({"stages": portfolio.stage_distribution(snapshot),
                          "families": portfolio.ranked(portfolio.exposure_by(snapshot, "product_family"), "exposure")}).first().value
    document = json.loads(text)
    assert [r["ifrs9_stage"] for r in document["stages"]] == [1, 2, 3]
    assert [r["product_family"] for r in document["families"]][0] == "Mortgage"


def test_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 4748 and days.where("is_reporting_period_end").count() == 156
    row = days.where("date_key = 20240229").first()
    assert (row.month_name, row.quarter, row.is_reporting_period_end) == ("February", 1, True)
    assert days.schema.names == table_schema("dim_date").names


def test_exposures_meet_their_customer_last(spark, plan_text):
    """Rows are unfolded where a customer's accounts are together, and date by date they are the same rows."""
    accounts, moves, dim = _book(spark)
    days = [date(2026, 1, 31), date(2026, 2, 28), date(2026, 3, 31)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exposure_history(accounts, moves, dim, dim_product(spark), dim_branch(spark), 1, days, 9)
        text = plan_text(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    last_join = next(line for line in text.splitlines() if "Join" in line)
    assert text.index("Generate") < text.index(last_join) and "customer_source_id" in last_join
    assert "Exchange" not in text[:text.index("Generate")]
    stretches = exposure_stretches(accounts, moves, dim, dim_product(spark), dim_branch(spark), days)
    by_date = exposures_by_date(stretches, 1, days, 9)
    assert list(by_date) == [20260131, 20260228, 20260331]
    assert sorted(str(r) for rows in by_date.values() for r in rows.collect()) == sorted(map(str, found.collect()))


def test_carried_owner_and_opening_need_no_lookup(spark):
    accounts, moves, dim = _book(spark)
    accounts = accounts.withColumn("opening_date", F.lit(date(2026, 2, 1)))
    versions = spark.createDataFrame([("c1", date(2026, 2, 15), None, "x")], "customer_source_id string, effective_date date, expiry_date date, band string")
    days = [date(2026, 1, 31), date(2026, 2, 28)]
    history = lambda *carried: exposure_history(accounts, moves, dim, dim_product(spark), dim_branch(spark), 1, days, 9, None, carried)
    plain = point_in_time_exposure(history(), accounts, dim, versions, ["band"])
    carried = point_in_time_exposure(history("customer_source_id", "opening_date"), accounts, dim, versions, ["band"])
    assert carried.columns == plain.columns
    assert sorted(map(str, carried.collect())) == sorted(map(str, plain.collect())) and plain.count() == 6
    joins = [df._jdf.queryExecution().optimizedPlan().toString().count("Join ") for df in (carried, plain)]
    assert joins[0] == joins[1] - 2
