"""Distributed consecutive numbering, equal-size tiles and exact quantiles.

None of them uses a window without partitions: rows are range-partitioned, each partition
numbers its own rows, and only one count per partition is gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def _running_offsets(sizes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out, total = [], 0
    for part, size in sorted(sizes):
        out.append((part, total))
        total += size
    return out


def dense_index(df: DataFrame, order_by: list[str], name: str = "row_index", start: int = 0) -> DataFrame:
    """Number rows start, start+1, ... in the order of ``order_by`` (which must be a total order).

    The range boundaries come from sampling and may differ between executions, so the
    partitioned rows are written once before they are counted.
    """
    spark = df.sparkSession
    ranged = (df.repartitionByRange(*[F.col(c) for c in order_by])
              .sortWithinPartitions(*order_by)
              .withColumn("_slot", F.monotonically_increasing_id()))
    stored = materialize(ranged, "dense")
    part = F.shiftright("_slot", _ROW_BITS)
    sizes = [(r.part, r.n) for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()]
    position = F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1)
    if len(sizes) <= 1:
        return stored.withColumn(name, position + F.lit(start).cast("bigint")).drop("_slot")
    offsets = spark.createDataFrame(_running_offsets(sizes), "_part bigint, _offset bigint")
    # One row per partition of the written frame, whatever the size of the data.
    return (stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + position + F.lit(start).cast("bigint"))
            .drop("_slot", "_part", "_offset"))


def tile_of(index: Column, rows: Column, tiles: int) -> Column:
    """NTILE from a zero-based position: the first ``rows mod tiles`` tiles hold one row more."""
    small = F.floor(rows / tiles)
    larger = rows % tiles
    head = larger * (small + 1)
    in_head = F.floor(index / (small + 1)) + 1
    in_tail = larger + F.floor((index - head) / F.nullif(small, F.lit(0))) + 1
    return F.when(index < head, in_head).otherwise(in_tail).cast("int")


def ntile(df: DataFrame, order_by: list[str], tiles: int, name: str = "bucket") -> DataFrame:
    """NTILE over the whole table without gathering it in one task."""
    indexed = dense_index(df, order_by, "_index")
    total = indexed.count()
    return indexed.withColumn(name, tile_of(F.col("_index"), F.lit(total), tiles)).drop("_index")


def order_statistics(df: DataFrame, value: str, ranks_for) -> tuple[int, dict[int, float]]:
    """Exact values at chosen zero-based ranks of ``value`` (NULLs ignored).

    ``ranks_for(n)`` names the ranks once the row count is known. Equal values are counted
    before anything is ordered, so one value holding most rows stays one row; only the few
    partitions containing a wanted rank are read again.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    ranged = materialize(
        counted.repartitionByRange(F.col(value)).withColumn("_part", F.spark_partition_id()), "values")
    sizes = [(r["_part"], r.n) for r in ranged.groupBy("_part").agg(F.sum("n").alias("n")).collect()]
    total = sum(n for _, n in sizes)
    if not total:
        return 0, {}
    ends = {part: (offset, offset + n) for (part, offset), (_, n)
            in zip(_running_offsets(sizes), sorted(sizes))}
    wanted: dict[int, list[int]] = {}
    for rank in ranks_for(total):
        part = next(p for p, (low, high) in ends.items() if low <= rank < high)
        wanted.setdefault(part, []).append(rank)
    upto = F.sum("n").over(Window.partitionBy("_part").orderBy(value)
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hit = F.lit(False)
    for part, ranks in wanted.items():
        for rank in ranks:
            local = rank - ends[part][0]
            hit = hit | ((F.col("_part") == part) & (F.col("_upto") > local)
                         & (F.col("_upto") - F.col("n") <= local))
    rows = (ranged.where(F.col("_part").isin(list(wanted))).withColumn("_upto", upto).where(hit)
            .select("_part", value, "n", "_upto").collect())
    found = {}
    for part, ranks in wanted.items():
        for rank in ranks:
            local = rank - ends[part][0]
            found[rank] = next(float(r[value]) for r in rows
                               if r["_part"] == part and r["_upto"] - r["n"] <= local < r["_upto"])
    return total, found


def grouped_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n, _part): how often each value occurs, NULLs left out, written once in ranges of both."""
    counted = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    return materialize(
        counted.repartitionByRange(group, value).withColumn("_part", F.spark_partition_id()), "values")


def grouped_order_statistics(ranged: DataFrame, group: str, value: str, ranks_for) -> dict[str, tuple[int, dict[int, float]]]:
    """``order_statistics`` of every group of ``grouped_counts`` at once: two collects however many groups there are.

    To the driver go one count per group and range, and the values at the wanted ranks. Groups
    without values are missing.
    """
    sizes: dict[str, list[tuple[int, int]]] = {}
    for r in ranged.groupBy(group, "_part").agg(F.sum("n").alias("n")).collect():
        sizes.setdefault(r[group], []).append((r["_part"], r.n))
    totals = {g: sum(n for _, n in parts) for g, parts in sizes.items()}
    wanted: dict[tuple[str, int, int], list[int]] = {}  # (group, range, rank within it) -> ranks
    for g, parts in sizes.items():
        for (part, offset), (_, n) in zip(_running_offsets(parts), sorted(parts)):
            for rank in ranks_for(totals[g]):
                if offset <= rank < offset + n:
                    wanted.setdefault((g, part, rank - offset), []).append(rank)
    if not wanted:
        return {}
    upto = F.sum("n").over(Window.partitionBy(group, "_part").orderBy(value)
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    tests: dict[str, list[str]] = {}  # numbers only, parsed at once: a Column for each takes the driver seconds
    for g, part, local in wanted:
        tests.setdefault(g, []).append(f"(_part = {part} AND _upto > {local} AND _upto - n <= {local})")
    hit = F.lit(False)
    for g, of_group in tests.items():
        hit = hit | ((F.col(group) == g) & F.expr(" OR ".join(of_group)))
    rows = (ranged.where(F.col("_part").isin(sorted({p for _, p, _ in wanted}))).withColumn("_upto", upto).where(hit)
            .select(group, "_part", value, "n", "_upto").collect())
    found: dict[str, tuple[int, dict[int, float]]] = {g: (n, {}) for g, n in totals.items()}
    for (g, part, local), ranks in wanted.items():
        at = next(float(r[value]) for r in rows if r[group] == g and r["_part"] == part and r["_upto"] - r["n"] <= local < r["_upto"])
        found[g][1].update(dict.fromkeys(ranks, at))
    return found


def _quantile_ranks(probabilities: list[float]):
    def ranks(n: int) -> set[int]:
        out = set()
        for p in probabilities:
            low = math.floor((n - 1) * p)
            out |= {low, min(low + 1, n - 1)}
        return out

    return ranks


def _interpolated(n: int, at: dict[int, float], probabilities: list[float]) -> list[float]:
    result = []
    for p in probabilities:
        position = (n - 1) * p
        low = math.floor(position)
        a, b, share = at[low], at[min(low + 1, n - 1)], position - low
        result.append(b - (b - a) * (1 - share) if share >= 0.5 else a + (b - a) * share)
    return result


def exact_quantiles(df: DataFrame, value: str, probabilities: list[float]) -> list[float]:
    """Linear-interpolated quantiles, rounding like the usual array libraries do."""
    n, at = order_statistics(df, value, _quantile_ranks(probabilities))
    return _interpolated(n, at, probabilities) if n else []


def grouped_quantiles(df: DataFrame, group: str, value: str, probabilities: list[float]) -> dict[str, list[float]]:
    """``exact_quantiles`` of every group; groups without values are missing."""
    return counted_quantiles(grouped_counts(df, group, value), group, value, probabilities)


def counted_quantiles(counted: DataFrame, group: str, value: str, probabilities: list[float]) -> dict[str, list[float]]:
    """``grouped_quantiles`` from rows already counted by ``grouped_counts``."""
    found = grouped_order_statistics(counted, group, value, _quantile_ranks(probabilities))
    return {g: _interpolated(n, at, probabilities) for g, (n, at) in found.items()}
