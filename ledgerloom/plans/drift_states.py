"""Drift from mergeable states: one quantile sketch per feature and date, kept in the warehouse.

The exact figures of ``plans.drift`` read all values of both windows. Here a new date costs one pass over its own features,
and any two windows are compared from the stored states alone, merged per window. A sketch answers a rank within
``RANK_ERROR`` of the exact one (with 99 % confidence at ``K``), so the shares of classes, and with them the index, are
estimates.
"""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.psi import DRIFT_THRESHOLD, psi_terms
from ledgerloom.plans.published import one_batch
from ledgerloom.sources.warehouse import Warehouse

K = 1000             # size parameter of the sketches: about eight kilobytes per thousand
RANK_ERROR = 0.005   # stated for K; the published error of the method is 2.3 / K ** 0.91
FEATURES = ("utilization_ratio", "dpd_current", "bureau_score_current")


def value_states(values: DataFrame, keys: list[str], value: str, k: int = K) -> DataFrame:
    """(keys, rows, state) of the values per key, missing ones left out; combined before the shuffle."""
    number = F.col(value).cast("double")
    return values.where(number.isNotNull()).groupBy(*keys).agg(F.count("*").alias("rows"), F.kll_sketch_agg_double(number, F.lit(k)).alias("state"))


def merged(states: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    return states.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("state", F.lit(k)).alias("state"))


def share_below(state: Column, edges: list[float]) -> Column:
    """Estimated share of values under each edge; the edge itself is not below it."""
    return F.kll_sketch_get_rank_double(state, F.array(*[F.lit(math.nextafter(e, -math.inf)) for e in edges]))


def state_psi(reference: DataFrame, current: DataFrame, key: str, bins: int = 10, min_values: int = 10) -> DataFrame:
    """(key, psi, reference_rows, rows) of ``current`` states against ``reference`` ones, on the reference's quantiles as edges.

    Equal edges are merged and both ends are open, as in the exact index; populations under ``min_values`` give 0. The
    edges, a few numbers per key, reach the plan as literals.
    """
    steps = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = {r[key]: sorted(set(r["edges"])) for r in reference.select(key, F.kll_sketch_get_quantile_double("state", steps).alias("edges")).collect()}
    both = reference.select(key, F.col("rows").alias("reference_rows"), F.col("state").alias("_ref")).join(current, key)

    def shares(state: str) -> Column:
        below = F.lit(None).cast("array<double>")
        for name, cuts in edges.items():
            below = F.when(F.col(key) == name, share_below(F.col(state), cuts)).otherwise(below)
        ends = F.concat(F.array(F.lit(0.0)), below, F.array(F.lit(1.0)))
        return F.transform(F.sequence(F.lit(1), F.size(ends) - 1), lambda i: F.get(ends, i) - F.get(ends, i - 1))

    one = F.lit(1.0)
    terms = F.zip_with(shares("_ref"), shares("state"), lambda r, c: psi_terms(r, one, c, one))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    few = (F.col("reference_rows") < min_values) | (F.col("rows") < min_values)
    return both.select(key, F.when(few, 0.0).otherwise(total).alias("psi"), "reference_rows", "rows")


def store_drift_states(warehouse: Warehouse, as_of_key: int, run_ts: datetime) -> int:
    """Keep the states of one date's features; only that date's slot is read, and running it again replaces them."""
    def work(batch, ts):
        features = batch.read("customer_risk_features", slots=lambda s: s == f"d{as_of_key}")
        long = features.select("date_key", F.explode(F.array(*[F.struct(F.lit(n).alias("feature_name"), F.col(n).cast("double").alias("value"))
                                                               for n in FEATURES])).alias("f")).select("date_key", "f.*")
        states = value_states(long, ["date_key", "feature_name"], "value").withColumn("batch_id", F.lit(batch.batch_id))
        return batch.write("drift_states", states, f"d{as_of_key}")["rows"]

    return one_batch(warehouse, "DRIFT_STATES", run_ts, work)


def drift_from_states(warehouse: Warehouse, reference: tuple[int, int], current: tuple[int, int]) -> DataFrame:
    """(feature_name, psi, reference_rows, rows, drift_flag) between two windows of date keys (ends included), from states alone."""
    live = warehouse.live()

    def window(low: int, high: int) -> DataFrame:
        return merged(warehouse.read("drift_states", live, slots=lambda s: low <= int(s[1:9]) <= high), ["feature_name"])

    return state_psi(window(*reference), window(*current), "feature_name").withColumn("drift_flag", (F.col("psi") > DRIFT_THRESHOLD).cast("int"))
