"""Labelled and fixed-width histograms with empty classes kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def right_closed_class(value: Column, edges: list[float]) -> Column:
    """Zero-based class of ``(edges[i], edges[i+1]]``; NULL outside the outer edges."""
    inner = reduce(Column.__add__, [(value > e).cast("int") for e in edges[1:-1]])
    return F.when((value > edges[0]) & (value <= edges[-1]), inner)


def equal_width_class(value: Column, low: float, high: float, classes: int) -> Column:
    """Zero-based class of equal width, the last one closed on the right."""
    edges = [low + (high - low) * i / classes for i in range(classes + 1)]
    inner = reduce(Column.__add__, [(value >= F.lit(e)).cast("int") for e in edges[1:-1]])
    return F.when((value >= low) & (value <= high), inner)


def class_counts(df: DataFrame, class_of: Column, labels: list[str]) -> DataFrame:
    """(ordinal, label, n) for every label. All labels are counted in one aggregation, which
    yields the zero classes without joining a label table."""
    counted = df.select(class_of.alias("c")).agg(
        *[F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(len(labels))])
    rows = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(label).alias("label"), F.col(f"n{i}").alias("n"))
        for i, label in enumerate(labels)])
    return counted.select(F.inline(rows))
