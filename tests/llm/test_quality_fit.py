"""The quality model is fitted on every labelled document."""

import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import pairwise_quality


def plain_quantile(values, weights, share):
    order = np.argsort(values, kind="stable")
    reached = np.cumsum(weights[order]) / weights.sum()
    k = min(int(np.searchsorted(reached, share)), len(values) - 1)
    return float((values[order[k]] + values[order[min(k + 1, len(values) - 1)]]) / 2.0)


def test_the_threshold_counts_every_row(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.7), rng.gauss(0, 1)) for _ in range(9_000)] + [(0, 7.5)] * 3_000
    frame = spark.createDataFrame(rows, "label int, worth double")
    size = {k: sum(r[0] == k for r in rows) for k in (0, 1)}
    for bad in (0.1, 0.35, 0.9):
        weights = {0: bad / size[0], 1: (1 - bad) / size[1]}
        want = plain_quantile(np.array([r[1] for r in rows]), np.array([weights[r[0]] for r in rows]), bad)
        assert abs(pairwise_quality.weighted_quantile(frame, weights, bad, cells=16, few=50) - want) < 1e-9


def test_every_labelled_document_is_learned_from(spark, monkeypatch):
    """More documents of a class than the 4,000 that a sample used to hold."""
    docs = spark.range(11_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.concat_ws(
        " ", F.lit("A fair sentence stands here."), F.col("id").cast("string"))).otherwise(F.lit("## !! ##")).alias("text"))
    labels = docs.select("doc_id", ((F.col("doc_id") + 1) % 2).cast("int").alias("quality"))
    seen = {}
    paired = pairwise_quality.preference_pairs
    monkeypatch.setattr(pairwise_quality, "preference_pairs", lambda rows, good, bad: seen.update(n=rows.count(), pairs=(p := paired(rows, good, bad)).count(), good=good, bad=bad) or p)
    found = pairwise_quality.scored(docs, labels)
    learned = docs.where(pairwise_quality.learning(F.col("doc_id"))).count()
    assert learned > 8_000 and seen["n"] == learned == seen["good"] + seen["bad"]
    assert seen["pairs"] == 8 * max(seen["good"], seen["bad"])
    assert found.where((F.col("predicted") == 1) == (F.col("doc_id") % 2 == 0)).count() == 11_000


def test_pairs_follow_the_strides(spark):
    """The pairs of rows at hand, whichever class is larger."""
    for good, bad in ((7, 5), (4, 9), (3, 1)):
        rows = [(i, 1, [float(i)]) for i in range(good)] + [(100 + i, 0, [float(1000 * (i + 1))]) for i in range(bad)]
        frame = spark.createDataFrame(rows, "doc_id long, label int, values array<double>")
        found = sorted(r["values"][0] for r in pairwise_quality.preference_pairs(frame, good, bad).collect())
        most = max(good, bad)
        assert found == sorted(k % good - 1000.0 * ((k * 7919 + k // most) % bad + 1) for k in range(8 * most))
