import csv
import json
import math
import shutil
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.contracts import ContractError
from ledgerloom.operators.rules import RuleError, rule_report
from ledgerloom.plans.monthly_run import MonthlyRun, load_staging, run_full_etl, verify_run
from ledgerloom.plans.published import (build_ecl_inputs, cleanse_macro, contract_report, detect_drift, group_totals,
                                            write_reports)
from ledgerloom.plans.replay import replay_quarantine
from ledgerloom.schemas import STAGING_COLUMNS, table_schema
from ledgerloom.sources.warehouse import Warehouse
from ledgerloom.streaming.ingest import ingest_landing

T1, T2 = datetime(2026, 7, 31), datetime(2026, 8, 31)


def write_csv(directory, table, rows):
    directory.mkdir(exist_ok=True, parents=True)
    with open(directory / f"{table}.csv", "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerow(STAGING_COLUMNS[table])
        writer.writerows(rows)


def first_load(directory):
    write_csv(directory, "stg_customers", [
        ["C1", "Ann, A", "1980-01-01", "N1", "Retail", "TN", "2020-01-01"],
        ["C2", "Bob", "", "N2", "SME", "TN", "20200101"],
        ["C3", "Cyd", "31/12/1980", "N3", "Retail", "TN", "2020-01-01"],
        ["C4", "Dee", "1980-01-01", "N4", "", "TN", "2020-01-01"]])
    write_csv(directory, "stg_accounts", [
        ["A1", "C1", "MTG-STD", "BR-TUN-01", "2020-01-01", "1000.00", "0.05", "TND", ""],
        ["A2", "C2", "SME-WC", "BR-TUN-02", "2020-01-01", "500", "n.c.", "TND", "A1"],
        ["A3", "C3", "SME-WC", "BR-TUN-02", "2020-01-01", "500", "0.05", "TND", ""],
        ["A4", "C1", "SME-WC", "BR-TUN-02", "2020-01-01", "-5", "0.05", "TND", ""]])
    write_csv(directory, "stg_transactions", [
        ["T1", "A1", "2026-06-01", "300.00", "DRAWDOWN", "0"], ["T2", "A1", "2026-07-01", "50.00", "REPAYMENT", "12"],
        ["T3", "A2", "2026-07-01", "80.50", "FEE", "oops"], ["T4", "A3", "2026-07-01", "80.50", "FEE", "0"],
        ["T5", "A2", "2026-07-02", "x", "FEE", "0"]])
    write_csv(directory, "stg_credit_bureau", [["C1", "640", "0", "1", "2026-06-01"], ["C2", "1200", "0", "1", "2026-06-01"]])


def second_load(directory):
    write_csv(directory, "stg_customers", [["C1", "Ann, A", "1980-01-01", "N1", "Corporate", "TN", "2020-01-01"]])
    # T1 is corrected and moves to another month; T6 is new.
    write_csv(directory, "stg_transactions", [["T1", "A1", "2026-08-01", "310.00", "DRAWDOWN", "95"], ["T6", "A2", "2026-08-02", "1.00", "FEE", "0"]])


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("wh")
    first_load(home / "in1")
    second_load(home / "in2")
    wh = Warehouse(spark, str(home / "warehouse"))
    load_staging(wh, str(home / "in1"), T1)
    run_full_etl(wh, 20260731, "M", T1, buckets=2)
    return wh, home


def test_two_monthly_runs(warehouse):
    wh, home = warehouse
    outcome = verify_run(wh, "M")
    assert (outcome["batch_id"], outcome["rows_ingested"], outcome["rows_quarantined"]) == (2, 2, 2 + 2 + 2 + 1)
    steps = [(r.step_name, r.row_count) for r in wh.step_log().where("batch_id = 2 AND status = 'SUCCESS' AND started_at <= ended_at").collect()]
    assert dict(steps)["cleanse_transactions"] == 5 and len(steps) == 9
    reasons = {(r.source_table, r.failure_reason) for r in wh.read("quarantine").collect()}
    assert ("stg_customers", "segment manquant") in reasons and ("stg_accounts", "credit_limit négatif") in reasons
    payload = wh.read("quarantine").where("source_table = 'stg_customers' AND failure_reason = 'segment manquant'").first().raw_payload
    assert '"full_name":"Dee"' in payload and "segment" not in payload
    exposure = {r.account_source_id: float(r.outstanding_balance) for r in wh.read("fact_exposure").collect()}
    assert exposure == {"A1": 250.0, "A2": 80.5}

    load_staging(wh, str(home / "in2"), T2)
    run_full_etl(wh, 20260831, "M", T2, buckets=2)
    moves = {r.transaction_id: (str(r.transaction_date), float(r.amount), r.batch_id) for r in wh.read("transactions").collect()}
    assert moves == {"T1": ("2026-08-01", 310.0, 4), "T2": ("2026-07-01", 50.0, 2), "T3": ("2026-07-01", 80.5, 2), "T6": ("2026-08-02", 1.0, 4)}
    assert not any(s == "m202606" for (t, s) in wh.live() if t == "transactions")   # emptied month
    dim = {(r.customer_source_id, r.version_number): (r.is_current, r.segment, r.customer_key) for r in wh.read("dim_customer").collect()}
    assert dim == {("C1", 1): (False, "Retail", 1), ("C1", 2): (True, "Corporate", 3), ("C2", 1): (True, "SME", 2)}
    by_date = {(r.date_key, r.account_source_id): float(r.outstanding_balance) for r in wh.read("fact_exposure").collect()}
    assert by_date[20260731, "A1"] == 250.0 and by_date[20260831, "A1"] == 260.0
    assert wh.read("fact_credit_event").where("event_type = 'DEFAULT'").count() == 1


def test_rerun_replaces_the_same_date_and_consumes_nothing(warehouse):
    wh, _ = warehouse
    before = wh.read("transactions").count()
    batch = run_full_etl(wh, 20260831, "AGAIN", T2, buckets=2)
    assert wh.read("fact_exposure").groupBy("date_key", "account_source_id").count().where("count > 1").count() == 0
    assert wh.read("customer_risk_features").where("date_key = 20260831").select("batch_id").distinct().first()[0] == batch
    assert wh.read("transactions").count() == before
    counts = {r.step_name: r.row_count for r in wh.step_log().where(F.col("batch_id") == batch).collect()}
    assert counts["cleanse_customers"] == 0 and counts["load_fact_credit_event"] == 0


def test_jobs_on_published_tables(warehouse):
    wh, home = warehouse
    build_ecl_inputs(wh, 20260831, T2)
    inputs = {r.segment: (float(r.total_exposure), float(r.stage_3_exposure), r.avg_pd_12m) for r in wh.read("portfolio_ecl_inputs").collect()}
    assert inputs == {"Corporate": (260.0, 260.0, None), "SME": (81.5, 0.0, None)}
    july, august = (date(2026, 7, 1), date(2026, 7, 31)), (date(2026, 8, 1), date(2026, 8, 31))
    detect_drift(wh, july, august, "2026-07", "2026-08", T2)
    metrics = wh.read("drift_metrics").collect()
    # Two customer keys in July; in August the closed version of C1 still has a row, so three.
    assert len(metrics) == 1 and metrics[0].drift_flag == 0
    assert metrics[0].population_stability_index == pytest.approx(2 * (1 / 3 - 1 / 2) * math.log(2 / 3))
    assert metrics[0].reference_mean == pytest.approx((0.25 + 0.161) / 2)
    totals = {r.root_group_id: float(r.total_group_exposure) for r in group_totals(wh).collect()}
    assert totals == {"A1": 341.5}

    write_csv(home / "macro", "stg_macro_indicators", [
        ["2026-07-01", "TN", "1.25", "15", "n/a", "7.5", ""], ["2026-07-01", "TN", "1.30", "15", "6", "7.5", "UPSIDE"], ["July", "TN", "1", "1", "1", "1", ""]])
    load_staging(wh, str(home / "macro"), T2)
    cleanse_macro(wh, T2)
    macro = {r.scenario_tag: (float(r.gdp_growth), r.inflation_rate) for r in wh.read("macro_indicators").collect()}
    assert macro["BASELINE"] == (1.25, None) and set(macro) == {"BASELINE", "UPSIDE"}
    assert wh.read("quarantine").where("source_table = 'stg_macro_indicators'").count() == 1

    write_reports(wh, str(home / "reports"))
    documents = {n: json.loads("\n".join(r.value for r in wh.spark.read.text(str(home / "reports" / n)).collect()))
                 for n in ("portfolio", "quality", "drift")}
    kpis = {r["kpi"]: r["value"] for r in documents["portfolio"]["kpis"]}
    assert (kpis["n_accounts"], kpis["n_customers"], kpis["total_exposure"]) == (2, 2, 341.5)
    assert [s["step"] for s in documents["quality"]["steps"]][0] == "cleanse_customers"
    assert {r["key"] if "key" in r else r["feature"] for r in documents["drift"]["feature_status"]} >= {"utilization_ratio", "dpd_current"}


def test_failed_run_publishes_nothing(spark, tmp_path):
    first_load(tmp_path / "in")
    write_csv(tmp_path / "in", "stg_customers", [["C1", "", "1980-01-01", "N1", "Retail", "TN", "2020-01-01"]])  # name missing
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    load_staging(wh, str(tmp_path / "in"), T1)
    before = wh.live()
    with pytest.raises(ContractError, match="not_null:full_name: 1"):
        run_full_etl(wh, 20260731, "BAD", T1, buckets=2)
    assert wh.live() == before and wh.read("quarantine").count() == 0
    with pytest.raises(RuntimeError, match="FAILED"):
        verify_run(wh, "BAD")
    assert wh.step_log().where("status = 'FAILED'").first().step_name == "cleanse_customers"


def test_stream_consumes_each_file_once(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    header = STAGING_COLUMNS["stg_customers"]

    def land(name, ident):
        landing.mkdir(exist_ok=True)
        with open(landing / name, "w", newline="") as f:
            csv.writer(f).writerows([header, [ident, "n", "", "N", "Retail", "TN", "2020-01-01"]])

    land("a.csv", "C1")
    ingest_landing(spark, wh, str(landing), "stg_customers", checkpoint, T1)
    land("b.csv", "C2")
    ingest_landing(spark, wh, str(landing), "stg_customers", checkpoint, T1)
    ingest_landing(spark, wh, str(landing), "stg_customers", checkpoint, T1)
    assert sorted(r.customer_source_id for r in wh.read("stg_customers").collect()) == ["C1", "C2"]
    batch = wh.open_batch("PROBE", T1)
    _, slots = batch.unprocessed("stg_customers")
    assert len(slots) == 2
    batch.consume("stg_customers", slots)
    batch.publish()
    assert wh.open_batch("PROBE", T1).unprocessed("stg_customers")[1] == []


def test_streams_of_two_folders_and_a_new_checkpoint_lose_nothing(spark, tmp_path):
    """A second landing folder, with a run between them, and then a checkpoint made anew in the same place."""
    wh = Warehouse(spark, str(tmp_path / "warehouse"))

    def consume():
        batch = wh.open_batch("PROBE", T1)
        rows, slots = batch.unprocessed("stg_customers")
        found = sorted(r.customer_source_id for r in rows.collect())
        batch.consume("stg_customers", slots)
        batch.publish()
        return found

    for k, name in enumerate(["one", "two", "three"]):
        write_csv(tmp_path / name, "stg_customers", [[f"C{k}", "n", "", "N", "Retail", "TN", "2020-01-01"]])
    ingest_landing(spark, wh, str(tmp_path / "one"), "stg_customers", str(tmp_path / "cp1"), T1)
    assert consume() == ["C0"]
    ingest_landing(spark, wh, str(tmp_path / "two"), "stg_customers", str(tmp_path / "cp2"), T1)
    assert consume() == ["C1"] and consume() == []
    shutil.rmtree(tmp_path / "cp1")
    ingest_landing(spark, wh, str(tmp_path / "three"), "stg_customers", str(tmp_path / "cp1"), T1)
    assert consume() == ["C2"]
    assert sorted(r.customer_source_id for r in wh.read("stg_customers").collect()) == ["C0", "C1", "C2"]


def test_contracts_of_the_published_tables(warehouse):
    """What the run measured row by row holds for the tables as a whole: keys and references too."""
    wh, _ = warehouse
    found = {(r.table_name, r.contract): r.violations for r in contract_report(wh).collect()}
    assert ("transactions", "unique:transaction_id") in found and ("fact_exposure", "reference:customer_key->dim_customer") in found
    assert set(found.values()) == {0}


def test_steps_are_visible_while_they_run(spark, tmp_path):
    first_load(tmp_path / "in")
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    load_staging(wh, str(tmp_path / "in"), T1)
    run = MonthlyRun(wh, 20260731, "M", T1, ("2018-01-01", "2030-12-31"), 2, "account_rows")
    seen = {}

    def stop():
        seen.update({r.step_name: (r.status, r.ended_at is None) for r in wh.step_log().collect()})
        raise RuntimeError("stopped")

    run.plan = lambda: [("cleanse_customers", lambda: run.cleanse("customers")), ("hangs", stop)]
    with pytest.raises(RuntimeError, match="stopped"):
        run.execute()
    assert seen == {"cleanse_customers": ("SUCCESS", False), "hangs": ("RUNNING", True)}
    assert {r.step_name: r.status for r in wh.step_log().collect()} == {"cleanse_customers": "SUCCESS", "hangs": "FAILED"}


def test_an_as_of_date_outside_the_calendar_is_refused(spark, tmp_path):
    first_load(tmp_path / "in")
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    load_staging(wh, str(tmp_path / "in"), T1)
    with pytest.raises(ContractError, match="reference:date_key->dim_date"):
        run_full_etl(wh, 20260731, "M", T1, calendar=("2018-01-01", "2026-06-30"), buckets=2)


def test_slots_know_their_days_and_a_range_opens_only_those(warehouse):
    wh, _ = warehouse
    live = wh.live()
    slots = {name: (s.rows, str(s.low), str(s.high)) for (t, name), s in live.items() if t == "transactions"}
    assert slots == {"m202607": (2, "2026-07-01", "2026-07-01"), "m202608": (2, "2026-08-01", "2026-08-02")}
    for table, (name, s) in ((t, (n, s)) for (t, n), s in live.items() if s.rows is not None and not t.startswith("consumed")):
        assert s.rows == wh.read(table, live, lambda n, name=name: n == name).count()
    july = wh.read("transactions", live, days=(date(2026, 7, 1), date(2026, 7, 31)))
    assert {p.split("/slot=")[1].split("/")[0] for p in july.inputFiles()} == {"m202607"} and july.count() == 2
    assert wh.read("transactions", live, days=(date(2026, 8, 2), date(2026, 8, 9))).count() == 1
    assert wh.read("transactions", live, days=(date(2030, 1, 1), date(2030, 1, 2))).count() == 0
    august = wh.read("fact_exposure", live, days=(date(2026, 8, 1), date(2026, 8, 31)))
    assert {p.split("/slot=")[1].split("/")[0] for p in august.inputFiles()} == {"d20260831"}


def test_damaged_lines_are_quarantined_with_their_text(spark, tmp_path):
    sound = ["C1,\"Ann, \"\"A\"\"\",1980-01-01,N1,Retail,TN,2020-01-01", "C2,Bob,,N2,SME,TN,"]
    damaged = ["C3,Cyd,1980-01-01,N3,Retail,TN,2020-01-01,EXTRA", "C4,\"Dee,1980-01-01,N4,Retail,TN,2020-01-01", "C5,Eve",
               "C6,Fay,1980-01-01,N6,Retail,TN,\"2020-01-01"]
    (tmp_path / "in").mkdir()
    text = "\r\n".join([",".join(STAGING_COLUMNS["stg_customers"]), *sound[:1], *damaged, "", *sound[1:]])
    (tmp_path / "in" / "stg_customers.csv").write_text(text + "\r\n", newline="")
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    load = load_staging(wh, str(tmp_path / "in"), T1)
    assert [(r.customer_source_id, r.full_name, r.onboarding_date) for r in wh.read("stg_customers").orderBy("row_id").collect()] == [
        ("C1", 'Ann, "A"', "2020-01-01"), ("C2", "Bob", None)]
    records = wh.read("quarantine").collect()
    assert sorted(json.loads(r.raw_payload)["line"] for r in records) == sorted(damaged)
    assert {(r.source_table, r.failure_reason, r.batch_id, r.is_resolved) for r in records} == {("stg_customers", "damaged line", load, False)}
    logged = wh.run_log().where(F.col("batch_id") == load).first()
    assert (logged.rows_ingested, logged.rows_quarantined) == (len(sound), len(damaged))
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(text, newline="")
    ingest_landing(spark, wh, str(landing), "stg_customers", str(tmp_path / "cp"), T1)
    assert wh.read("stg_customers").count() == 4 and wh.read("quarantine").count() == 8
    (tmp_path / "in" / "stg_customers.csv").write_text("wrong,header\nC1,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_staging(wh, str(tmp_path / "in"), T1)


def test_quarantined_rows_enter_once_their_parent_has_come(spark, tmp_path):
    """C9 and its account come late; the account's movements follow it, a corrected one is not undone, and nothing enters twice."""
    write_csv(tmp_path / "in1", "stg_customers", [["C1", "Ann", "1980-01-01", "N1", "Retail", "TN", "2020-01-01"]])
    write_csv(tmp_path / "in1", "stg_accounts", [
        ["A1", "C1", "MTG-STD", "BR-TUN-01", "2020-01-01", "1000", "0.05", "TND", ""], ["A9", "C9", "SME-WC", "BR-TUN-02", "2020-01-01", "900.50", "", "TND", ""],
        ["A8", "C9", "SME-WC", "BR-TUN-02", "2020-01-01", "bad", "", "TND", ""], ["A7", "C7", "SME-WC", "BR-TUN-02", "2020-01-01", "1", "", "TND", ""]])
    write_csv(tmp_path / "in1", "stg_transactions", [["T1", "A1", "2026-07-01", "5", "FEE", "0"], ["T9", "A9", "2026-07-02", "80.25", "FEE", "3"],
                                                     ["T8", "A9", "2026-06-02", "10", "FEE", "0"]])
    write_csv(tmp_path / "in1", "stg_credit_bureau", [["C9", "640", "1", "", "20260601"]])
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    load_staging(wh, str(tmp_path / "in1"), T1)
    run_full_etl(wh, 20260731, "M", T1, buckets=2)
    assert wh.read("quarantine").count() == 6 and replay_quarantine(wh, T1, buckets=2) == {"accounts": 0, "transactions": 0, "credit_bureau": 0}
    write_csv(tmp_path / "in2", "stg_customers", [["C9", "Zoe", "", "N9", "SME", "TN", "2020-01-01"]])
    write_csv(tmp_path / "in2", "stg_transactions", [["T8", "A1", "2026-08-02", "11", "FEE", "0"]])
    load_staging(wh, str(tmp_path / "in2"), T2)
    run_full_etl(wh, 20260831, "M", T2, buckets=2)
    assert replay_quarantine(wh, T2, buckets=2) == {"accounts": 1, "transactions": 2, "credit_bureau": 1}
    accounts = {r.account_source_id: (float(r.credit_limit), r.parent_group_id) for r in wh.read("accounts").collect()}
    assert accounts == {"A1": (1000.0, None), "A9": (900.5, None)}
    moves = {r.transaction_id: (str(r.transaction_date), float(r.amount), r.dpd_snapshot) for r in wh.read("transactions").collect()}
    assert moves == {"T1": ("2026-07-01", 5.0, 0), "T9": ("2026-07-02", 80.25, 3), "T8": ("2026-08-02", 11.0, 0)}
    assert [(r.customer_source_id, r.bureau_score, str(r.report_date)) for r in wh.read("credit_bureau").collect()] == [("C9", 640, "2026-06-01")]
    records = {json.loads(r.raw_payload).get("transaction_id") or json.loads(r.raw_payload).get("account_source_id") or "bureau":
               (r.is_resolved, r.failure_reason) for r in wh.read("quarantine").collect()}
    assert len(records) == 6 == wh.read("quarantine").count()
    assert {k: v[0] for k, v in records.items()} == {"A9": True, "A8": False, "A7": False, "T9": True, "T8": True, "bureau": True}
    assert records["A8"][1] == "credit_limit non convertible" and records["A7"][1].startswith("customer_source_id inconnu")
    assert replay_quarantine(wh, T2, buckets=2) == {"accounts": 0, "transactions": 0, "credit_bureau": 0}


def test_error_rules_block_and_warnings_are_logged(spark, tmp_path):
    first_load(tmp_path / "in")
    write_csv(tmp_path / "in", "stg_customers", [["C1", "Ann", "1980-01-01", "N1", "Retail", "TN", "2020-01-01"], ["C2", "Bob", "", "X2", "SME", "TN", "2020-01-01"]])
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    load_staging(wh, str(tmp_path / "in"), T1)
    kinds = "rule_id int, target_table string, target_column string, rule_type string, rule_expression string, severity string, is_active boolean"
    catalogue = [
        (1, "stg_customers", "national_id", "REGEX", "N[0-9]+", "ERROR", True), (2, "stg_accounts", "parent_group_id", "REFERENTIAL", "customers.customer_source_id", "WARNING", True),
        (3, "stg_transactions", "dpd_snapshot", "RANGE", "<= 10", "ERROR", True), (4, "stg_customers", "load_ts", "FRESHNESS", "<= 5 DAYS", "ERROR", True),
        (5, "stg_accounts", "load_ts", "FRESHNESS", "<= 1 DAYS", "WARNING", True), (6, "stg_customers", "segment", "NOT_NULL", None, "ERROR", False)]
    rules = spark.createDataFrame(catalogue, kinds)
    run_full_etl(wh, 20260731, "M", T1 + timedelta(days=3), buckets=2, rules=rules)
    blocked = {(json.loads(r.raw_payload).get("transaction_id") or json.loads(r.raw_payload)["customer_source_id"], r.rule_id, r.failure_reason)
               for r in wh.read("quarantine").where("rule_id IS NOT NULL").collect()}
    assert blocked == {("C2", 1, "rule 1: national_id REGEX N[0-9]+"), ("T2", 3, "rule 3: dpd_snapshot RANGE <= 10")}
    warned = {r.step_name: r.row_count for r in wh.step_log().where("status = 'WARNING'").collect()}
    assert warned == {"warning_rule_2": 1, "warning_rule_5": 1}
    with pytest.raises(RuleError, match="stg_customers rule 4"):
        run_full_etl(wh, 20260831, "LATE", T2, buckets=2, rules=rules)
    # Freshness from the manifest alone: no staged table is given, and the reported rows are the manifest's.
    live = wh.live()
    slots = {t: [s for (name, _), s in live.items() if name == t] for t in ("stg_customers", "stg_accounts")}
    found = {r.rule_id: (r.rows_checked, r.rows_failed) for r in rule_report({}, rules, slots=slots, today=T2.date()).collect()}
    assert found == {4: (2, 1), 5: (4, 1)}
    assert {r.rule_id: r.rows_failed for r in rule_report({}, rules, slots=slots, today=T1.date()).collect()} == {4: 0, 5: 0}
    with pytest.raises(ValueError, match="unsupported rule expression"):
        rule_report({}, spark.createDataFrame([(9, "stg_customers", "x", "FRESHNESS", "soon", "ERROR", True)], kinds), slots=slots, today=T1.date())
    with pytest.raises(ValueError, match="table.column"):
        rule_report({"stg_customers": wh.read("stg_customers")}, spark.createDataFrame([(9, "stg_customers", "segment", "REFERENTIAL", "x", "ERROR", True)], kinds))


def _folders(root):
    return {str(p.relative_to(root)) for p in root.glob("[!_]*/load=*/slot=*")}


def test_clean_up_keeps_what_readers_need(spark, tmp_path):
    root = tmp_path / "warehouse"
    wh = Warehouse(spark, str(root))
    first_load(tmp_path / "in1")
    second_load(tmp_path / "in2")
    assert wh.clean(T1) == {"slots": 0, "runs": 0, "files": 0}  # nothing yet
    load_staging(wh, str(tmp_path / "in1"), T1)
    run_full_etl(wh, 20260731, "M", T1, buckets=2)
    early = wh.live()
    load_staging(wh, str(tmp_path / "in2"), T2)
    with pytest.raises(ContractError):  # writes, then fails: nothing of it is published
        run_full_etl(wh, 20260831, "M", T2, calendar=("2018-01-01", "2026-06-30"), buckets=2)
    lost = wh.open_batch("KILLED", T2)
    lost.write("accounts", wh.read("accounts"), "b00000")
    run_full_etl(wh, 20260831, "M", T2, buckets=2)

    live, had = wh.live(), _folders(root)
    rows = {t: sorted(map(str, wh.read(t).collect())) for t in ("transactions", "customers", "dim_customer", "fact_exposure", "quarantine")}
    replaced = {s.path for k, s in early.items() if live.get(k) != s and not k[0].startswith("consumed")}
    assert replaced and wh.clean(T1)["slots"] == 0 and wh.live() == live and _folders(root) == had  # they were replaced at T2
    wh.read("transactions", early).collect()  # so a reader of the earlier state still finds its files

    assert wh.clean(T2 + timedelta(days=1)) == {"slots": len(replaced), "runs": 1, "files": 1}
    failed = {f for f in had if f.split("/")[1] == "load=4"}
    killed = {"accounts/load=5/slot=b00000"}
    # The failed run ended by the clock, later than the time asked for.
    assert had - _folders(root) == {p.removeprefix(f"{root}/") for p in replaced} | killed and failed <= _folders(root)
    assert wh.clean(datetime.now() + timedelta(days=3650)) == {"slots": 0, "runs": 1, "files": 1}
    assert failed and not failed & _folders(root)
    assert len(list((root / "_manifest").glob("*.parquet"))) == 1 and wh.live() == live
    assert rows == {t: sorted(map(str, wh.read(t).collect())) for t in rows}
    assert {p.removeprefix(f"{root}/") for p in (s.path for (t, _), s in live.items() if not t.startswith("consumed"))} == _folders(root)

    again = run_full_etl(wh, 20260930, "M", T2, buckets=2)  # runs go on after a clean-up, and consume nothing twice
    assert again == 7 and wh.step_log().where(f"batch_id = {again} and step_name like 'cleanse%' and row_count > 0").count() == 0
    assert rows["transactions"] == sorted(map(str, wh.read("transactions").collect()))


def test_a_clean_up_cut_short_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    for n in (1, 2, 3):
        batch = wh.open_batch("M", T1 + timedelta(days=n))
        rows = spark.range(n).select(F.lit("2026-07-01").cast("date").alias("period_date"), F.concat(F.lit("T"), "id").alias("country_code"))
        empty = [F.lit(None).alias(c) for c in table_schema("macro_indicators").names if c not in rows.columns]
        batch.write("macro_indicators", rows.select("*", *empty), "b00000")
        if n == 2:
            batch.write("macro_indicators", rows.limit(0).select("*", *empty), "b00000")  # emptied
        batch.publish()
        batch.close("SUCCESS")
        assert wh.slots("macro_indicators").count() == (0 if n == 2 else 1)
    live = wh.live()

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr("ledgerloom.sources.warehouse.remove", fails)
        with pytest.raises(OSError):
            wh.clean(T2)
    assert wh.live() == live and wh.read("macro_indicators").count() == 3
    assert wh.clean(T2)["slots"] == 1 and wh.live() == live and wh.read("macro_indicators").count() == 3
    assert wh.clean(T2) == {"slots": 0, "runs": 0, "files": 1}


def test_events_are_read_whole_and_in_the_session_time(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    assert wh.run_log().count() == 0 and wh.step_log().count() == 0
    wh.log_run(1, "M", T1, "RUNNING", None, None, None)
    wh.log_run(1, "M", datetime(2026, 7, 31, 1, 2, 3, 456789), "FAILED", 5, 2, "line\nbreak, \"quote\" é")
    got = wh.run_log().first()
    assert (got.started_at, got.ended_at, got.status, got.rows_ingested) == (T1, datetime(2026, 7, 31, 1, 2, 3, 456789), "FAILED", 5)
    assert got.error_message == "line\nbreak, \"quote\" é" and got.rows_quarantined == 2
    (tmp_path / "warehouse" / "_run_log" / ".half.json").write_text("{")  # an event that is being written
    assert wh.run_log().count() == 1
