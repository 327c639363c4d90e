import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks import rows_of
from ledgerloom.catalog.oracle import ORACLE
from ledgerloom.catalog.queries import REGISTRY
from ledgerloom.sources.testviews import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["quarantine_payload", "clean_transactions", "macro_cleanse", "row_conservation", "surrogate_keys", "fact_exposure",
        "risk_features", "group_hierarchy", "psi_ntile", "incremental_ingest", "exposure_point_in_time", "transaction_score_asof",
        "quarantine_replay", "unreached_nodes", "verified_run", "consumed_loads", "report_document", "published_group_view",
        "slots_after_cleanup"]
NAMES = list(REGISTRY) if os.environ.get("ALL_QUERIES") else FAST


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return con


def test_every_query_has_check_sql():
    assert set(REGISTRY) == set(ORACLE) and set(REGISTRY) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_check_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    result = duck.execute(contract.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [(r.ifrs9_stage, r.n_accounts) for r in rows] == [(1, 642), (2, 289), (3, 187)]


@pytest.mark.parametrize("name", ["clean_transactions", "fact_exposure_history", "risk_features", "psi_ntile", "group_exposure_view",
                                  "portfolio_kpis", "scd2_two_batches", "exposure_point_in_time", "transaction_score_asof", "sql_stage_exposure"])
def test_plans_stay_distributed(spark, plan_text, name):
    text = plan_text(contract.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
    for line in text.splitlines():   # a window without partitions would gather everything in one task
        if " Window [" in line:
            assert "], []" not in line.split("windowspecdefinition")[-1]
