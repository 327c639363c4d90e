"""Keyed upsert as a pure function of two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` replace or extend ``target`` on ``keys``; ``source`` must be unique
    per key. The replaced rows leave through an anti-join on the key columns alone."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))
