"""Newest-row-per-key selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_first(df: DataFrame, keys: list[str], newest_by: list[str]) -> list:
    """Total order inside a key: the given columns, then the rest of the row, all descending,
    so equal timestamps cannot make two runs disagree."""
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    return [F.col(c).desc() for c in [*newest_by, *rest]]


def newest_rows(df: DataFrame, keys: list[str], newest_by: list[str], n: int = 1,
                rank: str = "_rank") -> DataFrame:
    """The ``n`` newest rows of every key, numbered from 1 in column ``rank``.

    The bound on the row number lets Spark cut every key to ``n`` rows per input partition
    before the shuffle, so a key that owns a third of the table reaches its reducer as at most
    ``n`` rows per map task.
    """
    order = newest_first(df, keys, newest_by)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def newest_row(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    return newest_rows(df, keys, newest_by, 1).drop("_rank")


def superseded_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys sent more than once and how many of their rows lose to the newest one."""
    return (df.groupBy(*keys).agg((F.count("*") - 1).alias("superseded_rows"))
            .where("superseded_rows > 0"))
