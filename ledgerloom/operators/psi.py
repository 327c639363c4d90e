"""Population stability index."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.dense import counted_quantiles, exact_quantiles, grouped_counts

FLOOR = 1e-4  # fixed value: smallest share a class may have
DRIFT_THRESHOLD = 0.25


def _steps(bins: int) -> list[float]:
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def _open_ended(edges: list[float], unique: bool) -> list[float]:
    if not edges:
        return []
    edges[0], edges[-1] = -math.inf, math.inf
    return sorted(set(edges)) if unique else edges


def quantile_edges(reference: DataFrame, value: str, bins: int = 10, unique: bool = True) -> list[float]:
    """Class edges at the reference quantiles, open at both ends. ``unique`` merges equal edges."""
    return _open_ended(exact_quantiles(reference, value, _steps(bins)), unique)


def grouped_edges(reference: DataFrame, group: str, value: str, bins: int = 10, unique: bool = True) -> dict[str, list[float]]:
    """``quantile_edges`` of every group, searched together; groups without values are missing."""
    return counted_edges(grouped_counts(reference, group, value), group, value, bins, unique)


def counted_edges(counted: DataFrame, group: str, value: str, bins: int = 10, unique: bool = True) -> dict[str, list[float]]:
    """``grouped_edges`` from rows already counted by ``grouped_counts``."""
    return {g: _open_ended(edges, unique) for g, edges in counted_quantiles(counted, group, value, _steps(bins)).items()}


def edge_class(value: Column, edges: list[float]) -> Column:
    """Zero-based class of ``[edges[i], edges[i+1])``; repeated edges leave empty classes."""
    tests = [(value >= F.lit(e)).cast("int") for e in edges[1:-1]]
    return reduce(Column.__add__, tests, F.lit(0))


def psi_terms(reference_n: Column, reference_total: Column, n: Column, total: Column) -> Column:
    ref = F.greatest(reference_n / F.greatest(reference_total, F.lit(1)), F.lit(FLOOR))
    cur = F.greatest(n / F.greatest(total, F.lit(1)), F.lit(FLOOR))
    return (cur - ref) * F.ln(cur / ref)


def psi_by_period(counts: DataFrame, edges: dict[str, list[float]], reference_period: str,
                  min_values: int = 0) -> DataFrame:
    """(feature, period, psi) from class counts (feature, period, bin, n).

    The input is a handful of rows already; they become one row per feature and period with
    an array of counts. ``min_values`` returns 0 when either population is smaller.
    """
    width = max(len(e) - 1 for e in edges.values())
    in_class = [F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)) for i in range(width)]
    per_period = counts.groupBy("feature", "period").agg(F.array(*in_class).alias("counts"), F.sum("n").alias("total"))
    reference = per_period.where(F.col("period") == reference_period).select(
        "feature", F.col("counts").alias("ref_counts"), F.col("total").alias("ref_total"))
    classes = reduce(lambda chain, item: chain.when(F.col("feature") == item[0], len(item[1]) - 1),
                     edges.items(), F.when(F.lit(False), 0))
    joined = per_period.where(F.col("period") != reference_period).join(reference, "feature")
    terms = F.transform(
        F.sequence(F.lit(0), classes - 1),
        lambda i: psi_terms(F.get("ref_counts", i), F.col("ref_total"), F.get("counts", i), F.col("total")))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    too_few = (F.col("total") < min_values) | (F.col("ref_total") < min_values)
    return joined.select("feature", "period", F.when(too_few, 0.0).otherwise(total).alias("psi"))


def tile_psi(reference_n: Column, current_n: Column, tiles: int = 10) -> Column:
    """PSI when each window is cut into its own equal tiles.

    Tile sizes follow from the row counts alone, so no ordering is needed. Tiles empty in
    either window are left out; without a common tile the result is NULL.
    """
    def size(n, b):
        return F.floor(n / tiles) + (b <= n % tiles).cast("bigint")

    tile = F.sequence(F.lit(1), F.lit(tiles))
    shared = F.filter(tile, lambda b: (size(reference_n, b) > 0) & (size(current_n, b) > 0))
    terms = F.transform(
        shared, lambda b: (size(current_n, b) / current_n - size(reference_n, b) / reference_n)
        * F.ln((size(current_n, b) / current_n) / (size(reference_n, b) / reference_n)))
    return F.when(F.size(shared) > 0, F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x))
