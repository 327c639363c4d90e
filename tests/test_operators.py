import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.contracts import CONTRACTS, ContractError, contract_violations, enforce
from ledgerloom.operators.dedup import newest_row, newest_rows, superseded_counts
from ledgerloom.operators.dense import dense_index, exact_quantiles, ntile
from ledgerloom.operators.hierarchy import expand_hierarchy
from ledgerloom.operators.histogram import class_counts, equal_width_class, right_closed_class
from ledgerloom.operators.psi import edge_class, psi_by_period, quantile_edges, tile_psi
from ledgerloom.operators.rules import range_condition, rule_report
from ledgerloom.operators.upsert import upsert
from ledgerloom.plans.drift import quantile_psi
from ledgerloom.schemas import quality_rules


# --- newest rows -----------------------------------------------------------------------------

def test_newest_row_prefers_time_then_row_id(spark):
    rows = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 1, 1, "w")],
                                 "k string, load_ts int, row_id int, v string")
    assert {(r.k, r.v) for r in newest_row(rows, ["k"], ["load_ts", "row_id"]).collect()} == {("a", "z"), ("b", "w")}
    assert [(r.k, r.superseded_rows) for r in superseded_counts(rows, ["k"]).collect()] == [("a", 2)]


def test_newest_rows_are_cut_before_the_shuffle(spark, plan_text):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan_text(newest_rows(rows, ["k"], ["id"], 5))
    before_shuffle = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle


def test_upsert_replaces_and_extends(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(map(tuple, upsert(target, source, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]


# --- consecutive numbers and quantiles --------------------------------------------------------

@pytest.mark.parametrize("rows", [0, 1, 7, 5003])
def test_dense_index_is_consecutive_and_ordered(spark, rows):
    df = spark.range(rows).select(F.xxhash64("id").alias("h"), "id").repartition(7)
    out = dense_index(df, ["h"], "n", start=5).orderBy("h").collect()
    assert [r.n for r in out] == list(range(5, 5 + rows))


@pytest.mark.parametrize("rows,tiles", [(3, 10), (10, 10), (1003, 10), (57, 4)])
def test_ntile_equals_the_window_function(spark, rows, tiles):
    # one value holds half of the rows
    df = spark.range(rows).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.xxhash64("id")).alias("v"), "id").repartition(5)
    expected = df.withColumn("bucket", F.ntile(tiles).over(Window.orderBy("v", "id")))
    assert sorted(map(tuple, ntile(df, ["v", "id"], tiles).collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("values", [
    [float(i) for i in range(11)], [1.0], [0.0] * 90 + [float(i) for i in range(30)],
    [random.Random(3).random() for _ in range(997)], [random.Random(4).choice([0.1, 0.2, 5.5]) for _ in range(100)]])
def test_quantiles_equal_the_array_library(spark, values):
    steps = [i * 0.1 for i in range(10)] + [1.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(6)
    assert exact_quantiles(df, "v", steps) == list(np.quantile(values, np.linspace(0, 1, 11)))


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]) == []


# --- hierarchy ----------------------------------------------------------------------------------

def _brute_hierarchy(links, max_level=10):
    parent = dict(links)
    out = set()
    for node in parent:
        chain, at = [node], node
        while parent.get(at) is not None and len(chain) <= max_level + 1:
            at = parent[at]
            if at not in parent:
                break
            chain.append(at)
        if at in parent and parent[at] is None and len(chain) - 1 <= max_level:
            out.add((node, chain[-1], len(chain) - 1, " > ".join(reversed(chain))))
    return out


def _links():
    chain = [chr(ord("A") + i) for i in range(12)]
    edges = [(chain[0], None)] + list(zip(chain[1:], chain[:-1]))
    edges += [("X", "X"), ("P", "Q"), ("Q", "P"), ("child", "unknown"), ("grandchild", "child"), ("lone", None)]
    edges += [(f"leaf{i}", "lone") for i in range(200)]
    rng = random.Random(1)
    edges += [(f"n{i}", None if i < 3 else f"n{rng.randrange(max(0, i - 40), i)}") for i in range(300)]
    return edges


def test_hierarchy_matches_brute_force(spark):
    df = spark.createDataFrame(_links(), "account_source_id string, parent_group_id string").repartition(4)
    got = {(r.account_source_id, r.root_group_id, r.hierarchy_level, r.hierarchy_path) for r in expand_hierarchy(df).collect()}
    expected = _brute_hierarchy(_links())
    assert got == expected
    levels = {node: level for node, _, level, _ in got}
    assert levels["K"] == 10 and "L" not in levels            # depth limit
    assert not {"X", "P", "Q", "child", "grandchild"} & set(levels)


# --- histograms and PSI ---------------------------------------------------------------------------

def test_right_closed_classes_keep_empty_labels(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 500, 501, 1000, 1001)], "v int")
    counts = class_counts(df, right_closed_class(F.col("v"), [0, 500, 600, 700, 1000]), ["a", "b", "c", "d"])
    assert [(r.label, r.n) for r in counts.orderBy("ordinal").collect()] == [("a", 2), ("b", 1), ("c", 0), ("d", 1)]


def test_equal_width_last_class_is_closed(spark):
    values = [0.0, 0.05, 0.1, 0.6, 0.7, 1.15, 1.2, 0.3, 0.2]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.c for r in df.select(equal_width_class(F.col("v"), 0.0, 1.2, 12).alias("c")).collect()]
    expected, _ = np.histogram(values, bins=[1.2 * i / 12 for i in range(13)])
    assert [got.count(i) for i in range(12)] == list(expected)


def _numpy_psi(ref, cur, unique=True, min_values=10):
    if len(ref) < min_values or len(cur) < min_values:
        return 0.0
    edges = np.quantile(ref, np.linspace(0, 1, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    if unique:
        edges = np.unique(edges)
    share = [np.clip(np.histogram(x, bins=edges)[0] / len(x), 1e-4, None) for x in (ref, cur)]
    return float(np.sum((share[1] - share[0]) * np.log(share[1] / share[0])))


@pytest.mark.parametrize("unique", [True, False])
def test_psi_matches_the_array_formula(spark, unique):
    rng = np.random.default_rng(5)
    ref = rng.gamma(2.0, size=400).round(3)
    frames = {"same": ref, "shifted": ref + 0.7, "flat": np.full(50, 1.0), "few": ref[:9], "zeros": np.zeros(40)}
    ref_zeros = np.concatenate([np.zeros(300), rng.random(20)])
    rows = [("f", "reference", float(v)) for v in ref] + [("f", p, float(v)) for p, vs in frames.items() for v in vs]
    rows += [("z", "reference", float(v)) for v in ref_zeros] + [("z", p, float(v)) for p, vs in frames.items() for v in vs]
    df = spark.createDataFrame(rows, "feature string, period string, value double").repartition(4)
    edges, parts = {}, []
    for feature in ("f", "z"):
        mine = df.where(F.col("feature") == feature)
        edges[feature] = quantile_edges(mine.where("period = 'reference'"), "value", 10, unique)
        parts.append(mine.select("feature", "period", edge_class(F.col("value"), edges[feature]).alias("bin")))
    counts = parts[0].unionByName(parts[1]).groupBy("feature", "period", "bin").agg(F.count("*").alias("n"))
    got = {(r.feature, r.period): r.psi for r in psi_by_period(counts, edges, "reference", 10).collect()}
    for feature, base in (("f", ref), ("z", ref_zeros)):
        for period, values in frames.items():
            assert got[feature, period] == pytest.approx(_numpy_psi(base, values, unique), abs=1e-12), (feature, period)
    assert got["f", "same"] == 0.0 and got["f", "few"] == 0.0


def test_reference_values_are_computed_once(spark, plan_text):
    """Their classes come from the counts that gave the quantiles: the last plan holds stored counts, not the reference's own rows."""
    ref, cur = [float(i * 37 % 97) for i in range(400)], [float(i * 11 % 50) for i in range(300)]
    reference = spark.range(400).select(F.lit(0).alias("first"), F.lit(1).alias("until"), (F.col("id") * 37 % 97).cast("double").alias("value"))
    rows = [(0, 2, v) for v in cur[:200]] + [(1, 2, v) for v in cur[200:]]
    current = spark.createDataFrame(rows, "first int, until int, value double")
    found = quantile_psi({"f": current, "unmeasured": current}, ["a", "b"], {"f": reference, "unmeasured": reference.where("id < 0")})
    assert "Range (" in plan_text(reference) and "Range (" not in plan_text(found)
    got = {(r.feature, r.period): r.psi for r in found.collect()}
    assert got == {("f", "a"): pytest.approx(_numpy_psi(ref, cur[:200]), abs=1e-12), ("f", "b"): pytest.approx(_numpy_psi(ref, cur), abs=1e-12)}


@pytest.mark.parametrize("ref_n,cur_n", [(1003, 57), (10, 10), (7, 25), (0, 5), (3, 2)])
def test_tile_psi_equals_tiles_from_the_window_function(spark, ref_n, cur_n):
    def sizes(n):
        return {b: n // 10 + (b <= n % 10) for b in range(1, 11) if n // 10 + (b <= n % 10)}
    ref, cur = sizes(ref_n), sizes(cur_n)
    shared = ref.keys() & cur.keys()
    expected = sum((cur[b] / cur_n - ref[b] / ref_n) * math.log((cur[b] / cur_n) / (ref[b] / ref_n)) for b in shared) if shared else None
    got = spark.range(1).select(tile_psi(F.lit(ref_n).cast("bigint"), F.lit(cur_n).cast("bigint"))).first()[0]
    assert got == (pytest.approx(expected, abs=1e-15) if shared else None)


# --- contracts and rules ----------------------------------------------------------------------------

def test_contract_counts(spark):
    customers = spark.createDataFrame([("c1", None, "s", "TN"), ("c1", "n", "s", "TN"), ("c2", "n", "s", "TN")],
                                      "customer_source_id string, full_name string, segment string, country_code string")
    counts = {r.contract: r.violations for r in contract_violations(customers, CONTRACTS["customers"]).collect()}
    assert counts == {"not_null:customer_source_id": 0, "not_null:full_name": 1, "not_null:segment": 0,
                      "not_null:country_code": 0, "unique:customer_source_id": 1}
    bureau = spark.createDataFrame([("c1", "2026-01-01", 1001), ("c9", "2026-01-01", 10), ("c9", "2026-01-02", 10)],
                                   "customer_source_id string, report_date string, bureau_score int")
    with pytest.raises(ContractError, match=r"bureau_score 0..1000: 1; .*reference:customer_source_id->customers: 2"):
        enforce(bureau, CONTRACTS["credit_bureau"], {"customers": customers})
    enforce(bureau.where("bureau_score = 10"), CONTRACTS["credit_bureau"])


def test_rule_catalogue(spark):
    staged = {
        "stg_customers": spark.createDataFrame([("c1",), (None,)], "customer_source_id string"),
        "stg_accounts": spark.createDataFrame([("-1",), ("x",), (None,), ("0",)], "credit_limit string"),
        "stg_transactions": spark.createDataFrame([("999",), ("1000",)], "dpd_snapshot string"),
        "stg_credit_bureau": spark.createDataFrame([("1000",), ("1001",), ("0",)], "bureau_score string"),
    }
    report = {r.rule_id: (r.rows_checked, r.rows_failed, r.severity) for r in rule_report(staged, quality_rules(spark)).collect()}
    assert report == {1: (2, 1, "ERROR"), 2: (4, 2, "ERROR"), 3: (2, 1, "WARNING"), 4: (3, 1, "ERROR")}
    with pytest.raises(ValueError):
        range_condition(F.col("x"), ">= 0; DROP TABLE t")
