"""Left-out nodes, drift states, SQL functions and collated comparison."""

import random
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.text import SERVER
from ledgerloom.operators.dense import exact_quantiles, grouped_quantiles
from ledgerloom.operators.hierarchy import expand_hierarchy, unreached_nodes
from ledgerloom.plans import drift_states
from ledgerloom.plans.customer_dim import classify_customers
from ledgerloom.sources.sql_surface import register_sql
from ledgerloom.sources.warehouse import Warehouse


def plain_unreached(parents, max_level=10):
    out = {}
    for node in parents:
        seen, at = [node], parents[node]
        while at is not None and at in parents and at not in seen:
            seen.append(at)
            at = parents[at]
        if at is None:
            if len(seen) - 1 > max_level:
                out[node] = ("too deep", None)
        elif at not in parents:
            out[node] = ("orphan", None)
        else:
            turn = seen[seen.index(at):]
            out[node] = ("cycle" if node in turn else "below a cycle", min(turn))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_unreached_nodes_equal_a_walk(spark, seed):
    rng = random.Random(seed)
    ids = [f"n{i:03d}" for i in range(160)]
    parents = {i: rng.choice([None, "nowhere", *rng.choices(ids, k=40 if seed == 1 else 9)]) for i in ids}
    parents |= {f"c{i:02d}": f"c{i + 1:02d}" if i < 40 else None for i in range(41)}             # a long chain
    parents |= {f"z{i:02d}": f"z{(i + 1) % 23:02d}" for i in range(23)} | {"tail1": "tail2", "tail2": "z05", "self": "self"}
    links = spark.createDataFrame([*parents.items(), (None, "n001")], "account_source_id string, parent_group_id string")
    want = plain_unreached(parents)
    assert {r[0]: (r[1], r[2]) for r in unreached_nodes(links).collect()} == want
    reached = {r[0] for r in expand_hierarchy(links).select("account_source_id").collect()}
    assert reached == parents.keys() - want.keys()
    assert unreached_nodes(links.limit(0)).count() == 0


def test_grouped_quantiles_equal_those_of_each_group(spark):
    rng = np.random.default_rng(1)
    rows = [("a", float(v)) for v in rng.normal(size=500)] + [("b", float(v)) for v in rng.integers(0, 4, 300)] + [("c", 1.5), ("a", None), ("none", None)]
    df = spark.createDataFrame(rows, "feature string, value double")
    steps = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = grouped_quantiles(df, "feature", "value", steps)
    assert found == {g: exact_quantiles(df.where(F.col("feature") == g), "value", steps) for g in "abc"}
    assert found["a"] == pytest.approx(np.quantile([v for g, v in rows if g == "a" and v is not None], steps))


def test_states_answer_ranks_within_the_stated_error(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(size=60_000), rng.integers(0, 3, 40_000)])
    df = spark.createDataFrame([(int(i % 40), float(v)) for i, v in enumerate(rng.permutation(values))], "part int, value double")
    parts = drift_states.value_states(df, ["part"], "value")
    whole = drift_states.merged(parts.withColumn("g", F.lit(1)), ["g"])
    edges = [-1.5, -0.3, 0.0, 0.4, 1.0, 2.0, 9.0]
    row = whole.select("rows", drift_states.share_below(F.col("state"), edges).alias("below"), F.length("state").alias("size")).first()
    assert row["rows"] == len(values) and row["size"] < 50_000
    assert max(abs(b - (values < e).mean()) for b, e in zip(row["below"], edges)) < drift_states.RANK_ERROR


def test_drift_of_a_new_month_reads_its_own_features_only(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    rng = np.random.default_rng(3)
    features = {}

    def publish(key, shift):
        features[key] = [(float(np.round(abs(rng.normal()) / 4 + shift, 4)), int(rng.integers(0, 120)), int(rng.integers(300, 900))) for _ in range(3_000)]
        rows = spark.createDataFrame([(key, i, *f) for i, f in enumerate(features[key])],
                                     "date_key int, customer_key long, utilization_ratio double, dpd_current int, bureau_score_current int")
        batch = wh.open_batch("FEATURES", datetime(2026, 1, 1))
        missing = [c for c in wh.read("customer_risk_features").columns if c not in rows.columns and c != "slot"]
        batch.write("customer_risk_features", rows.withColumns({c: F.lit(None) for c in missing}), f"d{key}")
        batch.publish()

    opened = []
    read = Warehouse.read

    def spy(self, table, *args, **kwargs):
        df = read(self, table, *args, **kwargs)
        opened.extend(path.split("/slot=")[1].split("/")[0] for path in df.inputFiles() if table == "customer_risk_features")
        return df

    for key, shift in ((20260131, 0.0), (20260228, 0.0), (20260331, 0.2)):
        publish(key, shift)
    monkeypatch.setattr(Warehouse, "read", spy)
    for key in features:
        opened.clear()
        drift_states.store_drift_states(wh, key, datetime(2026, 4, 1))
        assert set(opened) == {f"d{key}"}
    drift_states.store_drift_states(wh, 20260331, datetime(2026, 4, 1))                        # again: replaced
    opened.clear()
    found = {r.feature_name: r for r in drift_states.drift_from_states(wh, (20260101, 20260228), (20260331, 20260331)).collect()}
    assert not opened and {(r.reference_rows, r.rows) for r in found.values()} == {(6_000, 3_000)}

    def exact(i):
        ref, cur = (np.array([f[i] for k in keys for f in features[k]]) for keys in ((20260131, 20260228), (20260331,)))
        edges = np.unique(np.quantile(ref, np.arange(1, 10) / 10))
        shares = [np.maximum(np.bincount(np.searchsorted(edges, v, side="right"), minlength=len(edges) + 1) / len(v), 1e-4) for v in (ref, cur)]
        return float(((shares[1] - shares[0]) * np.log(shares[1] / shares[0])).sum())

    assert found["utilization_ratio"].psi == pytest.approx(exact(0), rel=0.08) and found["utilization_ratio"].drift_flag == 1
    assert found["dpd_current"].psi == pytest.approx(exact(1), abs=0.01) and found["bureau_score_current"].drift_flag == 0
    same = drift_states.drift_from_states(wh, (20260131, 20260131), (20260131, 20260131)).collect()
    assert all(abs(r.psi) < 1e-9 for r in same)


def test_sql_functions_follow_the_column_functions_and_run_in_no_python(spark, plan_text):
    from ledgerloom.functions.risk import ifrs9_stage, internal_rating, score_band, signed_amount
    accounts = spark.createDataFrame([("a", "c", "p", 10), ("b", "c", "p", 20)], "account_source_id string, customer_source_id string, product_code string, credit_limit int")
    moves = spark.createDataFrame([("a", date(2020, 1, 1), "FEE", 5, 40), ("a", date(2020, 1, 2), "REPAYMENT", 2, 95), ("a", date(2021, 1, 1), "FEE", 50, 0)],
                                  "account_source_id string, transaction_date date, transaction_type string, amount int, dpd_snapshot int")
    bureau = spark.createDataFrame([("c", date(2020, 1, 1), 640), ("c", date(2020, 6, 1), 720)], "customer_source_id string, report_date date, bureau_score int")
    register_sql(spark, {"accounts": accounts.withColumn("credit_limit", F.col("credit_limit").cast("decimal(18,2)")),
                         "transactions": moves.withColumn("amount", F.col("amount").cast("decimal(18,2)")), "credit_bureau": bureau})
    found = spark.sql("SELECT *, ifrs9_stage(dpd_current) AS stage FROM exposure_at(DATE '2020-12-31')")
    assert "Python" not in plan_text(found)
    assert {r.account_source_id: (float(r.outstanding_balance), r.dpd_current, r.stage) for r in found.collect()} == {"a": (3.0, 95, 3), "b": (0.0, 0, 1)}
    days = spark.sql("SELECT d.day, s.bureau_score FROM VALUES (DATE '2020-03-01'), (DATE '2020-07-01') AS d(day), LATERAL scores_at(d.day) s")
    assert sorted(tuple(r) for r in days.collect()) == [(date(2020, 3, 1), 640), (date(2020, 7, 1), 720)]
    numbers = spark.range(0, 1000, 7).select(F.col("id").cast("int").alias("n"), F.lit("REPAYMENT").alias("k"), F.lit(1).cast("decimal(18,2)").alias("m"))
    numbers.union(spark.sql("SELECT CAST(NULL AS INT), 'FEE', CAST(2 AS DECIMAL(18,2))")).createOrReplaceTempView("numbers")
    both = spark.sql("SELECT n, k, m, ifrs9_stage(n) AS a, score_band(n) AS b, internal_rating(n) AS c, signed_amount(k, m) AS d FROM numbers")
    n = F.col("n")
    differ = both.where(~F.col("a").eqNullSafe(ifrs9_stage(n)) | ~F.col("b").eqNullSafe(score_band(n)) | ~F.col("c").eqNullSafe(internal_rating(n))
                        | ~F.col("d").eqNullSafe(signed_amount(F.col("k"), F.col("m"))))
    assert differ.count() == 0 and both.count() == 144


def test_collation_is_off_by_default(spark):
    tracked = "full_name string, segment string, country_code string, bureau_score_band string"
    old = spark.createDataFrame([("C1", "Ann", "Retail", "TN", None, True, 1)], f"customer_source_id string, {tracked}, is_current boolean, version_number int")
    new = spark.createDataFrame([("C1", "ANN ", "Retail", "TN", None), ("c1 ", "ann", "RETAIL", "tn", ""), ("C1", "Anne", "Retail", "TN", None)],
                                f"customer_source_id string, {tracked}")
    actions = lambda collation: [r.action for r in classify_customers(new, old, collation).orderBy("full_name").collect()]
    assert actions(None) == ["CHANGED", "CHANGED", "NEW"] and actions(SERVER) == ["SAME", "CHANGED", "SAME"]
