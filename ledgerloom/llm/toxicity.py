"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration (operator 7).

1. A lexicon is learned from labelled rows: words, and word beginnings of 4 to 6 letters, that keep toxic company. A unit counts once
   per preceding word (64 hash places of it), so copies of one text do not count twice, and must pass a likelihood-ratio test.
2. Every whole text becomes a dozen features: lexicon densities (plain, and only after undoing look-alike characters), their
   closeness to second-person words, capitals, punctuation, obfuscation and stretched letters.
3. Spark's gradient-boosted trees are fitted on these features, and an isotonic regression on a fold that the trees
   have not seen turns their output into a probability.

Fitting reads a bounded sample: at most ``PER_CLASS`` labelled documents of each class, chosen by a hash of doc_id. Scoring is one pass
over the texts without a shuffle.

Rows: null and empty texts have all features 0; labels that are null are not learned from, contradicting labels of one doc_id
count as toxic; repeated rows are scored alike and one row of a doc_id is learned from; extra columns are kept; an empty table gives no rows; without labels of both
classes every score is 0.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialize

PER_CLASS = 4000
THRESHOLD = 0.5
EVIDENCE, PURITY, PREFIXES = 12.0, 0.9, (4, 5, 6)
TREES, DEPTH = 15, 3
FEATURES = ["log_words", "log_hits", "hit_density", "disguised_density", "near_person", "densest_window", "capital_words", "marks", "exclamations",
            "odd_shapes", "stretched", "single_letters"]
#: Second-person words of the corpus languages.
PERSON = frozenset("you your yours yourself yourselves ur u tu te toi ton ta tes vous votre vos du dich dir dein deine deiner ihr euch euer "
                   "eure sie ihnen ihre tú ti tus usted ustedes vosotros os".split())
#: Characters that stand in for letters.
LOOKALIKES = str.maketrans("013457@$!|€", "oieastasiie")
_NOT_LETTER = re.compile(r"[\W\d_]+")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
HIT, DISGUISED, PERSONAL, CAPITAL, MARKED, ODD, STRETCHED, SINGLE = (1 << k for k in range(8))


def learning(doc_id: Column) -> Column:
    """Rows that labels may be learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def word_of(token: str) -> str:
    return _NOT_LETTER.sub("", token.lower())


def undisguised(token: str) -> str:
    """Look-alikes undone inside the token, letters repeated three times or more once, everything else dropped."""
    core = token.lower().strip(".,;:?!\"'()[]{}")
    return _NOT_LETTER.sub("", _STRETCHED.sub(r"\1", core.translate(LOOKALIKES)))


def units(word: str) -> Iterator[str]:
    yield f"={word}"
    for size in PREFIXES:
        if len(word) >= size:
            yield word[:size]


class Tokens(dict):
    """Flags of each distinct token, kept for the worker's next texts up to a bound."""

    MOST = 300_000

    def __init__(self, lexicon: frozenset[str]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: str) -> int:
        word = word_of(token)
        hit = bool(word) and any(u in self.lexicon for u in units(word))
        plain = token.isalpha()
        clear = word if plain and not _STRETCHED.search(token) else undisguised(token)
        disguised = not hit and clear != word and bool(clear) and any(u in self.lexicon for u in units(clear))
        letters, inner = len(word), token.strip(".,;:?!\"'()[]{}-|")
        flags = (HIT * hit | DISGUISED * disguised | PERSONAL * (word in PERSON) | CAPITAL * (letters > 1 and token.isupper())
                 | MARKED * (len(token) - len(token.rstrip("!?*#%$&.")) > 1) | ODD * (letters > 0 and not plain and not inner.isalpha())
                 | STRETCHED * bool(_STRETCHED.search(token)) | SINGLE * (letters == 1))
        if len(self) < self.MOST:
            self[token] = flags
        return flags


def features(text: str | None, tokens: Tokens) -> list[float]:
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    flags = np.frombuffer(bytes(map(tokens.__getitem__, words)), dtype=np.uint8)
    share = lambda flag: float(np.count_nonzero(flags & flag)) / n
    if (flags & SINGLE).sum() > 3 * SINGLE:  # words spelled with blanks
        spelled = _spelled(words, flags, tokens.lexicon)
    else:
        spelled = 0
    hits = np.flatnonzero(flags & (HIT | DISGUISED))
    count = len(hits) + spelled
    near, densest = 0.0, 0.0
    if len(hits):
        persons = np.flatnonzero(flags & PERSONAL)
        if len(persons):
            k = np.searchsorted(persons, hits)
            gap = np.minimum(np.abs(hits - persons[np.minimum(k, len(persons) - 1)]), np.abs(hits - persons[np.maximum(k - 1, 0)]))
            near = float(np.mean(gap <= 5))
        densest = float((np.searchsorted(hits, hits + 40) - np.arange(len(hits))).max())
    return [math.log1p(n), math.log1p(count), 100.0 * count / n, 100.0 * (share(DISGUISED) + spelled / n), near, densest, share(CAPITAL), share(MARKED),
            text.count("!") / n, share(ODD), share(STRETCHED), share(SINGLE)]


def _spelled(words: list[str], flags: np.ndarray, lexicon: frozenset[str]) -> int:
    single = np.concatenate(([0], (flags & SINGLE > 0).astype(np.int8), [0]))
    edges = np.flatnonzero(np.diff(single))
    runs = [(a, b) for a, b in zip(edges[::2], edges[1::2]) if b - a >= 4]
    # A neighbouring one-letter word may stand before or behind the spelled one.
    spans = [[(a, b), (a + 1, b), (a, b - 1)] for a, b in runs]
    return sum(any(u in lexicon for a, b in span for u in units(undisguised("".join(words[a:b])))) for span in spans)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of each class (written, so read many times)."""
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learning(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")))
    some = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    # Broadcast: 2 * per_class rows.
    rows = docs.select("doc_id", "text").join(F.broadcast(some[0].union(some[1])), "doc_id")
    # Of rows that repeat a doc_id the one with the smallest hash of its text.
    first = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    return materialize(first.select("doc_id", F.col("first.text").alias("text"), "label"), f"{label}-sample")


def learn_lexicon(sample: DataFrame) -> frozenset[str]:
    """Units whose company is toxic by the likelihood ratio (a bounded sample gives a bounded lexicon)."""
    def company(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, label in zip(batch["text"], batch["label"]):
                before = 0
                for token in (text or "").split():
                    word = word_of(token)
                    if word:
                        for unit in units(word):
                            seen.setdefault(unit, [0, 0])[label] |= before
                        before = 1 << (hash_of(word) % 63)
            masks = np.array(list(seen.values()), dtype=np.int64).reshape(-1, 2)
            yield pd.DataFrame({"unit": pd.Series(list(seen), dtype=object), "clean": masks[:, 0], "toxic": masks[:, 1]})

    masks = (sample.select("text", "label").mapInPandas(company, "unit string, clean long, toxic long")
             .groupBy("unit").agg(F.expr("bit_or(clean)").alias("clean"), F.expr("bit_or(toxic)").alias("toxic")))
    size = {r["label"]: float(r["n"]) for r in sample.groupBy("label").agg(F.sum(F.length("text")).alias("n")).collect() if r["n"]}
    if len(size) < 2:
        return frozenset()
    base = size[1] / (size[0] + size[1])
    places = lambda c: -63.0 * F.log(1.0 - F.least(F.bit_count(c), F.lit(62)) / 63.0)
    found = masks.select("unit", places("clean").alias("b"), places("toxic").alias("a")).where("a > 0")
    share = F.col("a") / (F.col("a") + F.col("b"))
    evidence = F.col("a") * F.log(share / base) + F.when(F.col("b") > 0, F.col("b") * F.log((1.0 - share) / (1.0 - base))).otherwise(0.0)
    return frozenset(r[0] for r in found.where((share >= PURITY) & (evidence >= EVIDENCE)).select("unit").collect())


def hash_of(word: str) -> int:
    import zlib

    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def feature_column(lexicon: frozenset[str]):
    @F.pandas_udf("array<double>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = Tokens(lexicon)
        for texts in batches:
            yield pd.Series([features(t, tokens) for t in texts])

    return compute(F.col("text"))


class Toxicity:
    def __init__(self, lexicon, trees, calibration):
        self.lexicon, self.trees, self.calibration = lexicon, trees, calibration

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``__toxicity`` from 0 to 1."""
        if self.trees is None:
            return docs.withColumn("__toxicity", F.lit(0.0))
        # Columns of the rows are kept in a struct, out of the way of the names that the models add.
        found = docs.select("text", F.struct("*").alias("__row")).withColumn("__features", array_to_vector(feature_column(self.lexicon)))
        found = self.trees.transform(found).select("__row", vector_to_array("probability")[1].alias("__raw"))
        if self.calibration is None:
            found = found.withColumnRenamed("__raw", "__toxicity")
        else:
            found = self.calibration.transform(found)
        return found.select("__row.*", F.least(F.greatest("__toxicity", F.lit(0.0)), F.lit(1.0)).alias("__toxicity"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Toxicity:
    sample = labelled_sample(docs, labels, "toxic", per_class)
    lexicon = learn_lexicon(sample)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    described = materialize(sample.select("label", fold.alias("fold"), feature_column(lexicon).alias("values")), "toxic-features")
    described = described.coalesce(2).select("fold", F.col("label").cast("double").alias("label"), array_to_vector("values").alias("__features"))
    grown, held = described.where("fold <> 4"), described.where("fold = 4")
    if grown.agg(F.countDistinct("label")).first()[0] < 2:
        return Toxicity(lexicon, None, None)
    trees = GBTClassifier(featuresCol="__features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(grown)
    seen = trees.transform(held).withColumn("__raw", vector_to_array("probability")[1])
    calibration = None
    if held.agg(F.countDistinct("label")).first()[0] == 2:
        calibration = IsotonicRegression(featuresCol="__raw", labelCol="label", predictionCol="__toxicity").fit(seen)
    return Toxicity(lexicon, trees, calibration)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text)."""
    found = fit(docs, labels).score(docs.select("doc_id", "text"))
    return found.select("doc_id", (~learning(F.col("doc_id"))).alias("held_out"), F.col("__toxicity").alias("score"),
                        (F.col("__toxicity") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    return fit(docs, labels).score(docs).where(F.col("__toxicity") < threshold).select(*docs.columns)
