"""Document quality by pairwise ranking (operator 3): a Bradley-Terry model on text features.

A document's worth is a weighted sum of features of its whole text; of two documents the better one is preferred with probability
``sigmoid(worth difference)``. Preference pairs put a labelled good document against a labelled bad one; the weights maximise
the likelihood of all drawn preferences, which is logistic loss on feature differences (ridge-penalised, Newton steps).

The threshold is a quantile of worth: the share of bad labels, taken over all labelled documents with each class weighted to its share of
all labels. Scores shift worth so that the quantile lies at ``THRESHOLD``.

Fitting covers every labelled document that may be learned from: their features are summed, paired and counted by Spark, and sums of a
fixed size reach the driver. Texts are read once; their features are stored for the fit and the scores.

Rows: null and empty texts have all features 0 and are scored; labels that are null are not learned from, contradicting
labels of one doc_id count as good; repeated rows are scored alike; extra columns are kept; an empty table gives no rows; without
labels of both classes every score is the share of good labels (1 without labels).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.toxicity import learning
from ledgerloom.operators.dense import dense_index
from ledgerloom.session import materialize

PAIRS_PER_DOCUMENT = 8
THRESHOLD, RIDGE = 0.3, 1e-3
CAPITALS, CAPITAL_START, SENTENCE_END, SYMBOLS, NUMBERS, NO_LETTERS, LONG, MIXED = (1 << k for k in range(8))
_SYMBOL_RUN = re.compile(r"[^\w\s.,;:!?'\"()\-]|[!?]{2}")
_MARKS = ".,;:!?'\"()-|"
FEATURES = ["log_words", "distinct", "commonest", "adjacent_repeats", "capital_words", "capital_starts", "sentence_ends", "symbol_words",
            "number_words", "no_letters", "long_words", "mixed_words", "word_length", "log_line_words", "repeated_lines", "bars",
            "compressed", "few_distinct", "many_symbols", "many_capitals", "no_sentences", "short"]


class Shapes(dict):
    """Flags of each distinct word, kept up to a bound."""

    MOST = 300_000

    def __missing__(self, word: str) -> int:
        core = word.strip(_MARKS)
        flags = (CAPITALS * (len(core) > 1 and core.isupper()) | CAPITAL_START * word[:1].isupper() | SENTENCE_END * (word[-1] in ".!?")
                 | SYMBOLS * bool(_SYMBOL_RUN.search(word)) | NUMBERS * any(c.isdigit() for c in word)
                 | NO_LETTERS * (not any(c.isalpha() for c in word)) | LONG * (len(core) > 20) | MIXED * (core != "" and not core.isalpha()))
        if len(self) < self.MOST:
            self[word] = flags
        return flags


def features(text: str | None, shapes: Shapes) -> list[float]:
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    flags = np.frombuffer(bytes(map(shapes.__getitem__, words)), dtype=np.uint8)
    share = [float(np.count_nonzero(flags & (1 << k))) / n for k in range(8)]
    distinct = dict.fromkeys(words)
    # Distinct words fall off with length alone; the root makes lengths comparable.
    spread = len(distinct) / min(n, 20.0 * math.sqrt(n))
    repeats = sum(map(eq, words, words[1:])) / n
    ordered = sorted(words) if n > 1 else words
    commonest = _longest_run(ordered) / n
    lines = [x for x in (y.strip() for y in text.split("\n")) if x]
    repeated = 1.0 - len(set(lines)) / max(len(lines), 1)
    data = text.encode("utf-8", "surrogatepass")
    compressed = len(zlib.compress(data, 1)) / len(data)
    return [math.log1p(n), spread, commonest, repeats, share[0], share[1], share[2], share[3], share[4], share[5], share[6], share[7],
            len(text) / n, math.log1p(n / max(len(lines), 1)), repeated, text.count("|") / n, compressed,
            float(spread < 0.3), float(share[3] > 0.3), float(share[0] > 0.5), float(share[2] < 0.01), 1.0 / (1.0 + n / 10.0)]


def _longest_run(ordered: list[str]) -> int:
    longest = run = 1
    for same in map(eq, ordered, ordered[1:]):
        run = run + 1 if same else 1
        if run > longest:
            longest = run
    return longest


class Ranking:
    """Worth = weights . standardised features; ``cut`` is the worth at the threshold."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float):
        self.mean, self.scale, self.weights, self.cut = mean, scale, weights, cut

    def worth(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8.0, 8.0) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        lifted = self.worth(rows) - self.cut + math.log(THRESHOLD / (1.0 - THRESHOLD))
        return 1.0 / (1.0 + np.exp(-np.clip(lifted, -60.0, 60.0)))


def wrong_preference(pairs: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(np.clip(pairs @ weights, -60.0, 60.0)))


def newton(moments, width: int, ridge: float = RIDGE, steps: int = 40) -> np.ndarray:
    """Weights of the largest penalised likelihood. ``moments(weights)`` gives the number of pairs, the sum of their gradients
    and that of their curvatures."""
    weights = np.zeros(width)
    for _ in range(steps):
        n, slope, bend = moments(weights)
        step = np.linalg.solve(bend / n + ridge * np.eye(width), ridge * weights - slope / n)
        weights = weights - step / max(1.0, float(np.abs(step).max()))
        if float(np.abs(step).max()) < 1e-8:
            break
    return weights


def pair_moments(pairs: np.ndarray, weights: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    chance = wrong_preference(pairs, weights)
    return len(pairs), pairs.T @ chance, (pairs * (chance * (1.0 - chance))[:, None]).T @ pairs


def bradley_terry(good: np.ndarray, bad: np.ndarray, per_document: int = PAIRS_PER_DOCUMENT, ridge: float = RIDGE, steps: int = 40) -> np.ndarray:
    """Weights from preference pairs of rows at hand: every document of the larger class meets ``per_document`` of the other, at fixed strides."""
    most = max(len(good), len(bad))
    k = np.arange(most * per_document)
    pairs = good[k % len(good)] - bad[(k * 7919 + k // most) % len(bad)]
    return newton(lambda weights: pair_moments(pairs, weights), pairs.shape[1], ridge, steps)


def labelled_features(described: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, label, values) of every labelled document that may be learned from, one row of each (written)."""
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & learning(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("label")))
    # Of rows that repeat a doc_id the one with the smallest hash of its text.
    first = described.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("hash", "values")).alias("first"))
    return materialize(first.select("doc_id", "label", F.col("first.values").alias("values")), "quality-labelled")


def summed(rows: DataFrame, figures) -> np.ndarray:
    """Sum over all rows of the vectors that ``figures(label, values)`` returns for a batch: one vector per task reaches the
    driver, of a length that does not depend on the rows."""
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                found = figures(batch["label"].to_numpy(), np.array(batch["values"].tolist(), dtype=float))
                total = found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"total": [total.tolist()]})

    found = [r["total"] for r in rows.select("label", "values").mapInPandas(measure, "total array<double>").collect()]
    return np.array([math.fsum(column) for column in zip(*found)])


def preference_pairs(rows: DataFrame, good: int, bad: int, per_document: int = PAIRS_PER_DOCUMENT) -> DataFrame:
    """(label 1, values): feature differences, good less bad. Every labelled document takes part: each of the larger class meets
    ``per_document`` of the other, at fixed strides through its numbering."""
    larger, smaller, most = (1, 0, good) if good >= bad else (0, 1, bad)
    stride = next(s for s in (7919, 7907, 7901, 7883, 7879) if bad % s)  # prime to the number of bad ones, so that all are met
    number = lambda label: dense_index(rows.where(F.col("label") == label), ["doc_id"], "i").select("i", "values")

    def opponent(j):
        """Pair k puts good k mod ``good`` against bad (k * stride + k div most) mod ``bad``; here from the larger class's side."""
        if larger == 1:
            return ((F.col("i") + j * most) * stride + j) % bad
        return (F.pmod((F.col("i") - j) * pow(stride, -1, bad), F.lit(bad)) + j * most) % good

    one = number(larger).select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(per_document - 1)), opponent)).alias("other"), F.col("values").alias("one"))
    met = one.join(number(smaller).select(F.col("i").alias("other"), F.col("values").alias("two")), "other")
    sign = 1.0 if larger == 1 else -1.0
    return materialize(met.select(F.lit(1).alias("label"), F.transform(
        F.arrays_zip("one", "two"), lambda x: (x["one"] - x["two"]) * sign).alias("values")), "quality-pairs")


def weighted_quantile(worth: DataFrame, weights: dict[int, float], share: float, cells: int = 512, few: int = 2000) -> float:
    """The value of ``worth`` (label, worth) at which the rows up to it, each with its label's weight, reach ``share``, halfway to
    the next one. All rows are counted: a histogram is narrowed to the cell that holds the value, and only the values of
    the last one, few or all equal, are counted one by one."""
    low, high = worth.agg(F.min("worth"), F.max("worth")).first()
    below = 0.0
    while True:
        inside = worth.where(F.col("worth").between(low, high))
        width = (high - low) / cells
        edges = sorted({low + k * width for k in range(1, cells)} - {low, high})
        if inside.count() <= few or not edges:
            break
        cell = F.array_size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col("worth")))
        found = inside.groupBy(cell.alias("cell")).agg(F.min("worth").alias("low"), F.max("worth").alias("high"), *[
            F.count_if(F.col("label") == k).alias(f"n{k}") for k in weights]).orderBy("cell").collect()
        for r in found:
            here = sum(w * r[f"n{k}"] for k, w in weights.items())
            if below + here >= share or r is found[-1]:
                break
            below += here
        if (r["low"], r["high"]) == (low, high):
            break
        low, high = r["low"], r["high"]
    counted = worth.where(F.col("worth").between(low, high)).groupBy("worth").agg(*[
        F.count_if(F.col("label") == k).alias(f"n{k}") for k in weights]).orderBy("worth").collect()
    for r in counted:
        last, below = below, below + sum(w * r[f"n{k}"] for k, w in weights.items())
        if below >= share:
            break
    # Rows of equal value follow one another, so the next value counts only where this is the last of its rows.
    following = worth.where(F.col("worth") > r["worth"]).agg(F.min("worth")).first()[0]
    lightest = min(w for k, w in weights.items() if r[f"n{k}"])
    return r["worth"] if following is None or below - lightest >= share else (r["worth"] + following) / 2.0


def fit_described(described: DataFrame, labels: DataFrame) -> Ranking | float:
    """The ranking, or the share of good labels where the labels hold one class only. ``described`` (doc_id, hash of the text, values)
    is stored; means, preferences and the threshold cover every labelled document."""
    counts = {r[0]: r[1] for r in labels.where(F.col("quality").isNotNull() & learning(F.col("doc_id"))).groupBy("quality").agg(F.count("*")).collect()}
    rows, width = labelled_features(described, labels), len(FEATURES)
    size = {r[0]: r[1] for r in rows.groupBy("label").agg(F.count("*")).collect()}
    if len(size) < 2:
        return counts.get(1, 0) / sum(counts.values()) if counts else 1.0
    n = size[0] + size[1]
    mean = summed(rows, lambda _, v: v.sum(axis=0)) / n
    scale = np.maximum(np.sqrt(summed(rows, lambda _, v: ((v - mean) ** 2).sum(axis=0)) / n), 1e-6)
    ranking = Ranking(mean, scale, np.zeros(width), 0.0)

    @F.pandas_udf("array<double>")
    def standard(values: pd.Series) -> pd.Series:
        return pd.Series(list(np.clip((np.array(values.tolist(), dtype=float).reshape(-1, width) - mean) / scale, -8.0, 8.0)))

    pairs = preference_pairs(rows.withColumn("values", standard("values")), size[1], size[0])

    def moments(weights: np.ndarray):
        def figures(_, v):
            count, slope, bend = pair_moments(v, weights)
            return np.concatenate(([count], slope, bend.ravel()))

        total = summed(pairs, figures)
        return total[0], total[1:1 + width], total[1 + width:].reshape(width, width)

    ranking.weights = newton(moments, width)

    @F.pandas_udf("double")
    def worth(values: pd.Series) -> pd.Series:
        return pd.Series(ranking.worth(np.array(values.tolist(), dtype=float).reshape(-1, width)))

    bad = counts[0] / (counts[0] + counts[1])
    ranked = materialize(rows.select("label", worth("values").alias("worth")), "quality-worth")
    ranking.cut = weighted_quantile(ranked, {0: bad / size[0], 1: (1.0 - bad) / size[1]}, bad)
    return ranking


def described_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, hash of the text, values) of every row (written): texts are read once, for the fit and the scores."""
    return materialize(docs.select("doc_id", F.xxhash64("text").alias("hash"), feature_column().alias("values")), "quality-features")


def fit(docs: DataFrame, labels: DataFrame) -> Ranking | float:
    return fit_described(described_rows(docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")), labels)


def feature_column():
    @F.pandas_udf("array<double>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shapes = Shapes()
        for texts in batches:
            yield pd.Series([features(t, shapes) for t in texts])

    return compute(F.col("text"))


def with_quality(docs: DataFrame, model: Ranking | float) -> DataFrame:
    """``docs`` with ``__quality`` from 0 to 1."""
    return _with_score(docs.withColumn("__values", feature_column()), "__values", model).drop("__values")


def _with_score(rows: DataFrame, values: str, model: Ranking | float) -> DataFrame:
    @F.pandas_udf("double")
    def score(found: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(found.tolist(), dtype=float).reshape(len(found), -1)), dtype=float)

    return rows.withColumn("__quality", F.lit(model) if isinstance(model, float) else score(values))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text)."""
    described = described_rows(docs)
    found = _with_score(described, "values", fit_described(described, labels))
    return found.select("doc_id", (~learning(F.col("doc_id"))).alias("held_out"), F.col("__quality").alias("score"),
                        (F.col("__quality") >= THRESHOLD).cast("int").alias("predicted"))
