"""Language identification by nearest centroid (operator 10).

Texts become TF-IDF vectors of letter 1- to 3-grams (hashed to 4096 places, unit length). Each language has a few centroids,
found by spherical k-means over its sample; a text takes the language of the centroid with the largest cosine and
is rejected (``und``) when even that one is farther than ``reject``.

Fitting reads a bounded sample: at most ``PER_LANGUAGE`` documents of each language, chosen by a hash of doc_id. Everything that
goes to the driver is per language or per hash place. Scoring is one pass over the texts without a shuffle.

Rows: null text and text without letters is ``und`` with score 0; rows with a null language are not learned from; repeated rows
are scored as they are, and one row of a doc_id and language is learned from; extra columns are ignored; an empty table, or one without labelled rows, gives ``und``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialize

DIMENSIONS, GRAMS = 4096, (1, 2, 3)
PER_LANGUAGE, CENTROIDS = 400, 3
#: Cosine below which a text with letters is rejected by ``predict``; the registered query asks for a learned language and passes 0.
REJECT = 0.05
UNKNOWN = "und"
_MIX = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters; one megabyte per worker."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Hash places and counts of the text's letter n-grams (a blank stands for everything between words); None without letters."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32).astype(np.uint32)
    blank = ~letter
    codes = np.concatenate(([32], codes[~(blank & np.concatenate(([True], blank[:-1])))], [32])).astype(np.uint32)
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    for n in GRAMS:
        if len(codes) < n:
            continue
        mixed = np.full(len(codes) - n + 1, n, dtype=np.uint32)
        for k in range(n):
            mixed = (mixed ^ codes[k: len(codes) - n + 1 + k]) * _MIX[k]
            mixed ^= mixed >> np.uint32(15)
        total += np.bincount(mixed % DIMENSIONS, minlength=DIMENSIONS)
    places = np.flatnonzero(total)
    return places, total[places]


def _vectors(texts, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors, and which texts have letters."""
    out, has = np.zeros((len(texts), DIMENSIONS), dtype=np.float32), np.zeros(len(texts), dtype=bool)
    for row, text in enumerate(texts):
        if (found := gram_counts(text)) is not None:
            weights = (1.0 + np.log(found[1])) * idf[found[0]]
            out[row, found[0]] = weights / max(np.linalg.norm(weights), 1e-12)
            has[row] = True
    return out, has


def _clustered(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts are spread by farthest point, so the result is the same every time."""
    centres = [points.mean(axis=0)]
    while len(centres) < min(k, len(points)) + 1:
        centres.append(points[int(np.argmin(np.max(points @ np.array(centres).T, axis=1)))])
    centre = np.array(centres[1:])
    for _ in range(rounds):
        nearest = np.argmax(points @ centre.T, axis=1)
        fresh = np.array([points[nearest == c].mean(axis=0) if (nearest == c).any() else centre[c] for c in range(len(centre))])
        centre = fresh / np.maximum(np.linalg.norm(fresh, axis=1, keepdims=True), 1e-12)
    return centre


class Centroids:
    """A fitted model: idf, languages and their centroids (a few megabytes at a hundred languages)."""

    def __init__(self, idf: np.ndarray, languages: list[str], centres: np.ndarray):
        self.idf, self.languages, self.centres = idf, languages, centres

    def predict(self, texts: list[str | None], reject: float) -> tuple[list[str], list[float]]:
        """Languages, and scores from 0 to 1: the cosine to the chosen centroid, as a share of the two best languages' sum."""
        names = [UNKNOWN] * len(texts)
        scores = [0.0] * len(texts)
        if not len(self.centres):
            return names, scores
        kinds = sorted(set(self.languages))
        owner = np.array([kinds.index(x) for x in self.languages])
        for lo in range(0, len(texts), 256):
            points, has = _vectors(texts[lo: lo + 256], self.idf)
            cosine = points @ self.centres.T
            best = np.stack([cosine[:, owner == k].max(axis=1) for k in range(len(kinds))], axis=1)
            first = np.argmax(best, axis=1)
            top = np.take_along_axis(best, first[:, None], axis=1)[:, 0]
            second = np.partition(best, -2, axis=1)[:, -2] if len(kinds) > 1 else np.zeros(len(top))
            for row in np.flatnonzero(has & (top >= reject)):
                names[lo + row] = kinds[first[row]]
                scores[lo + row] = float(np.clip(top[row] / max(top[row] + second[row], 1e-12), 0.0, 1.0))
        return names, scores


def language_sample(docs: DataFrame, learn: Column, per_language: int) -> DataFrame:
    """(doc_id, lang, text) of at most ``per_language`` rows of each language, one of a doc_id (written, so read many times)."""
    ids = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang")
    # The first by hash of each of 256 shares of a language, then of the language, whose last choice sees seven rows a share.
    hashed = ids.withColumns({"hash": F.xxhash64("doc_id"), "share": F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(256))})
    for keys, most in ((["lang", "share"], per_language // 64 + 1), (["lang"], per_language)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("hash", "doc_id"))
        hashed = hashed.withColumn("place", place).where(F.col("place") <= most).drop("place")
    chosen = hashed.select("doc_id", "lang").distinct()
    # Broadcast: per_language rows for each language.
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    # Of rows that repeat a doc_id the one with the smallest hash of its text.
    first = rows.groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    return materialize(first.select("doc_id", "lang", F.col("first.text").alias("text")), "language-sample")


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Centroids:
    """Learn from the rows of ``docs`` (doc_id, text, lang) for which ``learn`` holds."""
    sample = language_sample(docs, learn, per_language)

    def places(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows:
            found = [x[0] for x in map(gram_counts, batch["text"]) if x is not None]
            yield pd.DataFrame({"place": np.concatenate(found) if found else np.array([], dtype=np.int64)})

    known = sample.select("text").mapInPandas(places, "place long").groupBy("place").agg(F.count("*").alias("n")).collect()
    frequency = np.zeros(DIMENSIONS)
    for place, n in known:
        frequency[place] = n
    idf = (np.log((1.0 + sample.count()) / (1.0 + frequency)) + 1.0).astype(np.float32)

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        points, has = _vectors(rows.sort_values(["doc_id", "text"])["text"].tolist(), idf)
        if not has.any():
            return pd.DataFrame({"lang": [], "centre": []})
        centre = _clustered(points[has], centroids)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centre": [c.tolist() for c in centre]})

    learned = sample.groupBy("lang").applyInPandas(cluster, "lang string, centre array<float>").collect()
    learned.sort(key=lambda r: (r["lang"], r["centre"]))
    return Centroids(idf, [r["lang"] for r in learned], np.array([r["centre"] for r in learned], dtype=np.float32))


def predict(docs: DataFrame, model: Centroids, reject: float = REJECT) -> DataFrame:
    """``docs`` (with text) plus lang_pred and score."""
    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = model.predict(texts.tolist(), reject)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.withColumn("__judged", judge("text")).select(*docs.columns, "__judged.lang_pred", "__judged.score")
