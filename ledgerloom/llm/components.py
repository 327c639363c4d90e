"""Connected components of an edge table, for the operators that link rows into classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(node, root))")).first())


def connected_components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); the root is its component's smallest node.

    Alternates two moves until nothing changes: every node's larger neighbours are hung on its smallest neighbour,
    then every node and its smaller neighbours on the smallest of them. Chains shorten by about half each round, and a
    row is one edge, so a node with very many neighbours is only a skewed join, which adaptive execution splits.
    Self-loops and edges with a null end are ignored; an empty table gives an empty result.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    pairs = materialize(pairs, f"{label}-edges")
    before = _state(pairs)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = pairs.union(pairs.select(F.col("root"), F.col("node")))
        least = both.groupBy("node").agg(F.min("root").alias("low"))
        large = (pairs.select(F.col("root").alias("node"), F.col("node").alias("other")).join(least, "node")
                 .select(F.col("other").alias("node"), F.least("low", "node").alias("root"))
                 .union(pairs.join(least, "node").where("root > node").select("root", F.least("low", "node")))
                 .where("node <> root").distinct())
        large = materialize(large, f"{label}-large")
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = (large.join(low, "node").select(F.col("root").alias("node"), F.col("low").alias("root"))
                 .union(low).where("node <> root").distinct())
        pairs = materialize(small, f"{label}-small")
        after = _state(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components of {label} did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("root").alias("node"), F.col("root")).distinct()
    return materialize(pairs.union(roots), label)
