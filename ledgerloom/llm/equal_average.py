"""Vector code compression with equal-average search (operator 12).

Vectors of whole numbers are cut into equal consecutive parts, and every part is replaced by the number of the nearest entry of its
position's codebook, so a vector becomes a short code.

1. Search. A codebook's entries are sorted by their component sum. From a part's own sum the search goes outward, always to the
   side whose next sum is nearer, and ends when the squared gap of sums over the part's width is strictly more than the best squared
   distance: by Cauchy-Schwarz no entry further out can be as near. Entries as near as the best one are therefore all seen, and
   the lowest number wins. All rows of a batch go outward together; those that have ended leave.
2. Codebooks start as the parts of the smallest vec_ids. In a round every partition searches its rows and sends one row
   of sums and counts per entry and position, which are added before they reach the driver; an entry becomes the floor of its mean,
   and entries that nothing chose stay. The driver holds codebooks only: parts x entries x width numbers.
3. Everything is whole numbers, in longs where no product can overflow and in Python's unbounded integers otherwise, so results do not
   depend on the order of rows or partitions.

Rows: vectors that are null or hold null or non-finite components (or ones whose whole number is no long) are dropped. Vectors of
another length are a population of their own, with codebooks and digest of that length; a length that the number of parts does
not divide is filled up with zeros at its end, and an empty vector has only zero-width parts, code 0 and error 0. Repeated rows count as
often as they occur; the first entries go by vec_id (nulls last), then by the vector. Fewer rows than entries make smaller
codebooks. Equal labels share their error sum, nulls together. An error or error sum that does not fit a long is null. Extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.integer_vectors import by_size, fits_long, matrix, whole_vectors
from ledgerloom.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256

#: By vector length: the codebooks as an array (parts, entries, width) of longs or, where those could overflow, of Python integers.
Codebooks = dict[int, np.ndarray]


def _exact(*arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays (last axis: components) in a type in which squared sums of differences cannot overflow."""
    width = max(arrays[0].shape[-1], 1)
    most = max((int(max(a.max(), -a.min())) for a in arrays if a.size), default=0)
    kind = np.int64 if 2 * most * width < 1 << 28 else object
    return tuple(a.astype(kind) for a in arrays)


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the entry of ``book`` nearest to each row, ties to the lower number."""
    rows, book = _exact(rows, book)
    sums, own, width = book.sum(axis=1), rows.sum(axis=1), max(rows.shape[1], 1)
    if not rows.shape[1]:
        return np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
    order = np.argsort(sums, kind="stable")
    ranked, last = sums[order], len(book) - 1
    right = np.searchsorted(ranked, own).astype(np.int64)
    left = right - 1
    best, chosen = np.full(len(rows), -1, dtype=rows.dtype), np.zeros(len(rows), dtype=np.int64)
    at = np.arange(len(rows))
    while at.size:
        lo, hi = left[at], right[at]
        gap_lo, gap_hi = own[at] - ranked[np.maximum(lo, 0)], ranked[np.minimum(hi, last)] - own[at]
        down = (lo >= 0) & ((hi > last) | (gap_lo <= gap_hi))
        gap = np.where(down, gap_lo, gap_hi)
        goes_on = ((lo >= 0) | (hi <= last)) & ((best[at] < 0) | (gap * gap <= best[at] * width))
        at, down, entry = at[goes_on], down[goes_on], order[np.where(down, lo, hi)[goes_on]]
        off = rows[at] - book[entry]
        distance = (off * off).sum(axis=1)
        nearer = (best[at] < 0) | (distance < best[at]) | ((distance == best[at]) & (entry < chosen[at]))
        best[at[nearer]], chosen[at[nearer]] = distance[nearer], entry[nearer]
        left[at[down]] -= 1
        right[at[~down]] += 1
    return chosen, best


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, width), filled up with zeros."""
    width = -(-x.shape[1] // parts)
    return np.pad(x, ((0, 0), (0, width * parts - x.shape[1]))).reshape(len(x), parts, width)


def _assign(batch: pa.RecordBatch, size: int, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the rows' parts, their codes, their distances), the last two by row and part."""
    cut = _cut(matrix(batch.column("x"), size), len(book))
    codes, distances = zip(*(nearest(cut[:, p], book[p]) for p in range(len(book))))
    return cut, np.stack(codes, axis=1), np.stack(distances, axis=1)  # unbounded as soon as one of them is


def first_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the smallest vec_ids of each length; at most ``entries`` rows of a length reach the driver."""
    rank = F.row_number().over(Window.partitionBy("size").orderBy(F.col("vec_id").asc_nulls_last(), "x"))
    rows = kept.withColumn("rank", rank).where(F.col("rank") <= entries).select("size", "rank", "x").collect()
    books: Codebooks = {}
    for size in sorted({r["size"] for r in rows}):
        mine = sorted((r for r in rows if r["size"] == size), key=lambda r: r["rank"])
        books[size] = _cut(np.array([r["x"] for r in mine], dtype=np.int64).reshape(len(mine), size), parts).transpose(1, 0, 2)
    return books


def moved_codebooks(kept: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round: every chosen entry at the floor of the mean of its parts."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {s: np.zeros(b.shape[:2], dtype=np.int64) for s, b in books.items()}
        totals = {s: np.zeros(b.shape, dtype=object) for s, b in books.items()}
        for whole in batches:
            for size, batch in by_size(whole):
                cut, codes, _ = _assign(batch, size, books[size])
                for p in range(len(books[size])):
                    for entry in np.unique(codes[:, p]):
                        mine = cut[codes[:, p] == entry, p]
                        counts[size][p, entry] += len(mine)
                        # Halves of 31 bits: their sums cannot overflow within a batch.
                        high, low = mine >> 31, mine & ((1 << 31) - 1)
                        totals[size][p, entry] += high.sum(axis=0).astype(object) * (1 << 31) + low.sum(axis=0).astype(object)
        for size, count in counts.items():
            part, entry = np.nonzero(count)
            if not len(part) or not books[size].shape[2]:
                continue
            width = books[size].shape[2]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(part) * width, size, dtype=np.int32)), pa.array(np.repeat(part, width).astype(np.int32)),
                pa.array(np.repeat(entry, width).astype(np.int32)), pa.array(np.tile(np.arange(width, dtype=np.int32), len(part))),
                pa.array(np.repeat(count[part, entry], width)),
                pa.array([Decimal(int(v)) for v in totals[size][part, entry].ravel()], pa.decimal128(38, 0))],
                names=["size", "part", "entry", "place", "n", "total"])

    keys = ["size", "part", "entry", "place"]
    added = kept.select("size", "x").mapInArrow(sums, "size int, part int, entry int, place int, n long, total decimal(38,0)")
    moved = {s: b.astype(object) for s, b in books.items()}
    for r in added.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # one row per number of a codebook
        moved[r["size"]][r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return {s: b.astype(np.int64) for s, b in moved.items()}  # a mean is no larger than the largest long


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    books = first_codebooks(kept, parts, entries)
    for _ in range(rounds):
        books = moved_codebooks(kept, books)
    return books


def digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def encoded(kept: DataFrame, books: Codebooks) -> DataFrame:
    """``kept`` (vec_id, size, x and others) with code, error and codebooks_sha256 in the place of size and x."""
    others = [f for f in kept.schema.fields if f.name not in ("x", "size")]
    digests = {size: digest(book) for size, book in books.items()}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for size, batch in by_size(whole):
                _, codes, distances = _assign(batch, size, books[size])
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(f.name) for f in others), pa.array([c.tobytes().hex() for c in codes.astype(np.uint8)], pa.string()),
                    fits_long(distances.sum(axis=1)), pa.array([digests[size]] * len(batch), pa.string())],
                    names=[*(f.name for f in others), "code", "error", "codebooks_sha256"])

    new = [T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), T.StructField("codebooks_sha256", T.StringType())]
    return kept.mapInArrow(encode, T.StructType([*others, *new]))


def decoded(codes: DataFrame, books: Codebooks, size: int) -> DataFrame:
    """``codes`` with ``approx``, the whole numbers of the entries that a code of that length names."""
    book = books[size]

    @F.pandas_udf("array<long>")
    def entries(column):
        return column.map(lambda c: np.concatenate([book[p, i] for p, i in enumerate(bytes.fromhex(c))])[:size].astype(np.int64))

    return codes.withColumn("approx", entries("code"))


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every valid row of ``vectors`` (vec_id, embedding, label)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    kept = materialize(whole_vectors(vectors, scale, 0, "label"), "whole-vectors")
    coded = materialize(encoded(kept, fit(kept, parts, entries, rounds)), "vector-codes")
    whole = F.count("*") == F.count("error")
    sums = coded.groupBy("label").agg(F.when(whole, F.sum(F.col("error").cast("decimal(38,0)"))).try_cast("long").alias("label_error"))
    return (coded.join(sums.withColumnRenamed("label", "__label"), F.col("label").eqNullSafe(F.col("__label")))
            .select("vec_id", "code", "error", "label_error", "codebooks_sha256"))


def _oracle(width: int = 4) -> str:
    """Check SQL for vectors of 64 components: two rounds written out."""
    distance = " + ".join(f"(c.piece[{i}] - b.piece[{i}]) * (c.piece[{i}] - b.piece[{i}])" for i in range(1, width + 1))
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS (
  SELECT row, part, min(struct_pack(d := distance, e := entry)) AS best FROM (
    SELECT c.row, c.part, b.entry, ({distance})::BIGINT AS distance FROM cut c JOIN book{r} b ON c.part = b.part) t
  GROUP BY row, part)""")
        if r < ROUNDS:
            means = ", ".join(f"floor(sum(c.piece[{i}]) / count(*)::DOUBLE)::BIGINT" for i in range(1, width + 1))
            steps.append(f"""book{r + 1} AS (
  SELECT b.part, b.entry, coalesce(m.piece, b.piece) AS piece FROM book{r} b LEFT JOIN (
    SELECT n.part, n.best.e AS entry, [{means}] AS piece FROM near{r} n JOIN cut c ON n.row = c.row AND n.part = c.part
    GROUP BY n.part, n.best.e) m ON b.part = m.part AND b.entry = m.entry)""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS row, vec_id, label, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
cut AS (SELECT row, p.part, x[p.part * {width} + 1 : p.part * {width} + {width}] AS piece FROM kept, (SELECT unnest(range({PARTS})) AS part) p),
book0 AS (SELECT part, row - 1 AS entry, piece FROM cut WHERE row <= {ENTRIES}),
{", ".join(steps)},
codes AS (
  SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near{ROUNDS} GROUP BY row),
books AS (
  SELECT sha256(string_agg(array_to_string(piece, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, codebooks_sha256
FROM kept k JOIN codes c USING (row), books
"""


ORACLE = _oracle()
