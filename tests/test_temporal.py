"""Joins on time against plain loops, with long histories, hot keys and odd rows."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import temporal

DAY0 = date(2020, 1, 1)


def day(n):
    return None if n is None else DAY0 + timedelta(days=n)


@pytest.fixture(scope="module")
def histories():
    """(key, region, start, end, value): one key with 10,000 versions, many with a few, ranges that overlap, are open or empty."""
    rng = random.Random(1)
    out = [("hot", "r", n, n + 1, n) for n in range(9_999)] + [("hot", "r", 9_999, None, 9_999)]
    for k in range(200):
        at = rng.randrange(50)
        for v in range(rng.randrange(1, 6)):
            until = at + rng.randrange(1, 40)
            out.append((f"k{k}", "r", at, None if v == 4 else until, v))
            at = until + rng.randrange(3)
    out += [("over", "r", 0, 10, 1), ("over", "r", 5, 20, 2), ("odd", "r", None, 10, 3), ("odd", "r", 9, 9, 4), ("odd", "r", 9, 3, 5),
            (None, "r", 0, 99, 6), ("k1", None, 0, 99, 7)]
    return out


def test_valid_at_equals_a_plain_lookup(spark, histories):
    rng = random.Random(2)
    facts = [("hot", "r", rng.randrange(-50, 12_000), i) for i in range(3_000)]
    facts += [(f"k{rng.randrange(220)}", "r", rng.randrange(-10, 250), i) for i in range(2_000)]
    facts += [("over", "r", 7, 1), ("over", "r", 7, 1), ("odd", "r", 9, 2), (None, "r", 5, 3), ("k1", None, 5, 4), ("k1", "r", None, 5)]
    versions = spark.createDataFrame([(k, r, day(a), day(b), v) for k, r, a, b, v in histories], "key string, region string, start date, end date, value int")
    left = spark.createDataFrame([(k, r, day(d), i) for k, r, d, i in facts], "key string, region string, day date, start int")
    by_key = {}
    for k, r, a, b, v in histories:
        by_key.setdefault((k, r), []).append((a, b, v))
    want = []
    for k, r, d, i in facts:
        hits = [v for a, b, v in by_key.get((k, r), []) if None not in (k, r, d, a) and a <= d and (b is None or d < b)]
        want += [(k, r, day(d), i, v) for v in hits or [None]]
    found = temporal.valid_at(left, versions, ["key", "region"], "day", "start", "end", ["value"])
    assert found.columns == ["key", "region", "day", "start", "value"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    inner = temporal.valid_at(left, versions, ["key", "region"], "day", "start", "end", ["value"], how="inner")
    assert inner.count() == sum(w[-1] is not None for w in want)
    assert temporal.valid_at(left, versions.limit(0), ["key", "region"], "day", "start", "end", ["value"]).where("value IS NULL").count() == len(facts)


def test_a_long_history_is_cut_and_no_loop_is_planned(spark, histories, plan_text):
    versions = spark.createDataFrame([(k, r, day(a), day(b), v) for k, r, a, b, v in histories], "key string, region string, start date, end date, value int")
    left = spark.createDataFrame([("hot", "r", day(i % 9_000)) for i in range(9_000)], "key string, region string, day date")
    found = temporal.valid_at(left, versions, ["key", "region"], "day", "start", "end", ["value"])
    text = plan_text(found)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
    # Of 10,000 versions a fact meets those of its stretch only.
    join = next(line for line in text.splitlines() if "__stretch" in line and "Join" in line)
    assert "__part" in join
    assert found.where("value IS NULL").count() == 0


def plain_latest(facts, events, exact):
    out = []
    for k, t, i in facts:
        known = [(et, v) for ek, et, v in events if None not in (k, t, ek, et) and ek == k and (et <= t if exact else et < t)]
        best = max(known, key=lambda e: (e[0], e[1] is not None, e[1])) if known else (None, None)
        out.append((k, t, i, best[1], best[0]))
    return out


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("partitions", [None, 7])
def test_latest_known_equals_a_plain_search(spark, exact, partitions):
    rng = random.Random(3)
    at = lambda n: None if n is None else datetime(2020, 1, 1) + timedelta(hours=n)
    events = [("hot", at(rng.randrange(3_000)), rng.randrange(900)) for _ in range(150)]
    events += [(f"k{rng.randrange(30)}", at(rng.randrange(200)), rng.randrange(900)) for _ in range(80)]
    events += [(None, at(1), 1), ("k1", None, 2), ("k2", at(5), None), ("only", at(5), 9), ("tie", at(5), 1), ("tie", at(5), 4), ("tie", at(5), 3)]
    facts = [("hot", at(rng.randrange(-20, 3_100)), i) for i in range(900)] + [(f"k{rng.randrange(33)}", at(rng.randrange(-5, 220)), i) for i in range(300)]
    facts += [("tie", at(5), 0), ("tie", at(5), 0), ("tie", at(6), 1), (None, at(9), 2), ("k1", None, 3), ("same", at(5), 4)] + [("same", at(5), 4)] * 400
    left = spark.createDataFrame(facts, "key string, at timestamp, score int")
    right = spark.createDataFrame(events, "key string, seen timestamp, value int")
    found = temporal.latest_known(left, right, ["key"], "at", "seen", ["value", "seen"], exact, partitions)
    assert found.columns == ["key", "at", "score", "value", "seen"]
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == sorted(plain_latest(facts, events, exact), key=str)
    assert temporal.latest_known(left, right.limit(0), ["key"], "at", "seen", ["value", "seen"], exact, partitions).where("value IS NULL").count() == len(facts)
    assert temporal.latest_known(left.limit(0), right, ["key"], "at", "seen", ["value"], exact, partitions).count() == 0


def test_a_hot_key_is_split_over_ranges(spark, plan_text, monkeypatch):
    """One key, and half of its facts at one instant: every range gets a share, and a late range inherits an early event."""
    facts = spark.range(20_000).select(F.lit("hot").alias("key"), F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(7_000).cast("timestamp").alias("at"), "id")
    events = spark.createDataFrame([("hot", datetime(1970, 1, 1, 0, 0, 1), 5)], "key string, seen timestamp, value int")
    stored = {}
    write = temporal.materialize

    def keep(df, label, *rest):
        stored[label] = write(df, label, *rest)
        return stored[label]

    monkeypatch.setattr(temporal, "materialize", keep)
    found = temporal.latest_known(facts, events, ["key"], "at", "seen", ["value"], partitions=8)
    shares = [r["count"] for r in stored["as-of-ranges"].groupBy("__range").count().collect()]
    assert len(shares) >= 6 and max(shares) < 5_000
    assert found.where("value = 5").count() == 19_999 and found.where("value IS NULL").count() == 1
    text = plan_text(found)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
