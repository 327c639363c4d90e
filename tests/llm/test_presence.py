"""Bit maps in front of exact joins: nothing that is in the set is held back, and results do not depend on the map."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import presence


def test_members_are_never_held_back(spark):
    keys = spark.createDataFrame([(i * 7, f"k{i}") for i in range(3000)] + [(None, "x"), (5, None), (5, None)], "a long, b string")
    found = presence.bit_map(keys, ["a", "b"], "test-bits")
    assert found.size == 1 << 16 and found.pieces.count() <= found.size // presence.PIECE
    assert presence.flagged(keys, ["a", "b"], found, "hit").where("NOT hit").count() == 0
    others = spark.range(20_000).select((F.col("id") * 7 + 1).alias("a"), F.lit("z").alias("b"), F.lit(1).alias("extra"))
    seen = presence.flagged(others, ["a", "b"], found, "hit")
    assert seen.columns == ["a", "b", "extra", "hit"] and seen.count() == 20_000
    assert 0.01 < seen.where("hit").count() / 20_000 < 0.09                    # 3002 of 65536 bits
    none = presence.bit_map(keys.limit(0), ["a", "b"], "test-bits")
    assert presence.flagged(keys, ["a", "b"], none, "hit").where("hit").count() == 0
    assert presence.flagged(others.limit(0), ["a", "b"], found, "hit").count() == 0


@pytest.mark.parametrize("most", [presence.MOST, 15, 3])
def test_dropping_does_not_depend_on_the_map(spark, monkeypatch, most):
    """Even a map of eight bits, which every key hits, gives the same rows."""
    monkeypatch.setattr(presence, "MOST", most)
    monkeypatch.setattr(presence, "LEAST", min(most, presence.LEAST))
    rng = random.Random(1)
    rows = [(f"k{i}", rng.random() < 0.6) for i in range(2000)] + [("twice", True), ("twice", False), ("bare", True), ("bare", False), ("bare", False)]
    verdicts = spark.createDataFrame(rows, "__own string, kept boolean")
    marked = verdicts.select(F.struct(F.col("__own").alias("id"), (F.col("__own") != "bare").alias("worded")).alias("__row"), "__own").repartition(7)
    left = presence.left_after(marked, verdicts, F.col("__row.worded"))
    want = sorted([k for k, kept in rows if kept and k != "bare"] + ["bare"] * 3)
    assert sorted(r["__own"] for r in left.collect()) == want
    assert left.columns == ["__row", "__own"]
