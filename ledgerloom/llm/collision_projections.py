"""Embedding near-duplicates by counting collisions of one-dimensional projections (operator 4).

Equal vectors are one vector with a number of copies throughout (told by a 128-bit digest of their components), so a large group of
copies costs one row, and its members' links to each other are counted without being looked for.

1. Every unit vector is projected on many random directions. Of each sorted projection only the upper tail can hold query
   windows: two vectors collide on a direction when both lie in its tail, and a query's window reaches ``WINDOW`` to both sides.
   A tail is a small share of all rows, but vectors at cosine 0.9 meet in about two thirds of the tails of either one.
2. ``calibrate`` chooses the number of directions and the tail's bound so that a pair at exactly the threshold collides
   ``COLLISIONS`` times or more with the wanted probability; projections of two unit vectors are jointly normal with the cosine as
   correlation, so that does not depend on the data. Directions grow and tails narrow with the root of the rows (until ``most``
   directions), so that projecting a vector and comparing it within its tails stay about as dear as one another.
3. Rows of one tail come together, sorted by projection; small tails come in bundles, one after the other. A tail of more than
   ``BLOCK`` rows is cut into blocks and each pair of blocks is a task, so a frequent vector is spread. A link is a pair that
   meets in its query window, collides often enough (bit counts over the tails that both are in) and has the cosine in double precision. All
   of these must hold, so the order is free, and a matrix product in single precision comes first: it drops pairs that are below the
   threshold by more than its rounding error, and collisions are counted for the others. A
   pair is taken in the first tail both share only, so links are counted once, copies included, and never emitted: a task returns, per
   vector, its number of links and the smallest vector that it is connected with.

Vectors of one length are compared with one another: directions, bounds and tails are those of the length.

Rows: vectors that are null, empty, zero or hold null or non-finite components link with nothing; rows that repeat a vec_id are vectors of their own (a component's id is its smallest vec_id);
a component without any vec_id has none and is kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ledgerloom.llm.components import connected_components
from ledgerloom.session import materialize

COSINE, COLLISIONS, MEAN_COLLISIONS, WINDOW = 0.9, 2, 10.0, 1.8
BLOCK, SEED = 8192, 20260717
#: Tails come in bundles of about so many rows, but in no fewer than so many bundles.
BUNDLE, BUNDLES = 8192, 256


def both_above(bound: float, correlation: float) -> float:
    """Probability that two standard normals of this correlation are both above ``bound``."""
    x = np.linspace(bound, bound + 8.0, 4001)
    rest = np.array([0.5 * math.erfc((bound - correlation * v) / math.sqrt(2.0 * (1.0 - correlation ** 2))) for v in x])
    density = np.exp(-x * x / 2.0) / math.sqrt(2.0 * math.pi) * rest
    return float(np.sum((density[1:] + density[:-1]) / 2.0) * (x[1] - x[0]))


def calibrate(rows: int, cosine: float = COSINE, mean: float = MEAN_COLLISIONS, tail_rows: int | None = None, least: int = 512, most: int = 65536) -> tuple[int, float]:
    """(directions, bound): a pair at the threshold collides ``mean`` times on average; tails hold about ``tail_rows`` rows.

    With a mean of 10, two collisions or more have probability 0.9995 (the count is binomial). By default tails hold 400 rows, or the
    root of twice the rows if that is more: then a vector has about as many directions as rows to be compared with.
    """
    tail_rows = tail_rows or max(400, math.isqrt(2 * rows))
    low, high = 0.0, 6.0
    for _ in range(40):
        bound = (low + high) / 2.0
        if 0.5 * math.erfc(bound / math.sqrt(2.0)) * rows > tail_rows:
            low = bound
        else:
            high = bound
    directions = int(min(most, max(least, math.ceil(mean / max(both_above(low, cosine), 1e-12)))))
    low, high = 0.0, 6.0
    for _ in range(40):
        bound = (low + high) / 2.0
        low, high = (bound, high) if both_above(bound, cosine) * directions > mean else (low, bound)
    return directions, low


def tails_in_bundle(rows: int, directions: int, bound: float) -> int:
    expected = max(1.0, 0.5 * math.erfc(bound / math.sqrt(2.0)) * rows)
    return max(1, min(int(BUNDLE / expected), directions // BUNDLES))


def directions_of(count: int, size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((count, size))


def _units(raw: np.ndarray) -> np.ndarray:
    """Rows as doubles of unit length; NaN where a row is zero or not finite."""
    out = raw.astype(np.float64)
    out[~(np.isfinite(out).all(axis=1) & out.any(axis=1))] = np.nan
    # By the largest component first: squares of very small or very large ones would leave the range of doubles.
    out /= np.abs(out).max(axis=1, keepdims=True, initial=0.0)
    out /= np.linalg.norm(out, axis=1, keepdims=True)
    return out


def _code(directions: int) -> np.dtype:
    """What the number of a tail is written as."""
    return np.dtype("<u2" if directions <= 1 << 16 else "<u4")


def _binary(edges: np.ndarray, values: np.ndarray) -> pa.Array:
    """The values between two edges each, as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.ChunkedArray, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(edges, values) of a column that ``_binary`` has made."""
    column = pa.concat_arrays([x.cast(pa.large_binary()) for x in column.chunks])
    edges = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:][: len(column) + 1]
    return (edges - edges[0]) // dtype.itemsize, np.frombuffer(column.buffers()[2], dtype=dtype, count=(edges[-1] - edges[0]) // dtype.itemsize, offset=int(edges[0]))


def _digests(rows: DataFrame) -> DataFrame:
    """(row, vec_id, embedding, digest) of every row; no digest where the vector or a component is null."""
    kind = rows.schema["embedding"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (x.values if x.is_valid else None for x in batch.column("embedding"))
            digests = [None if v is None or v.null_count else xxhash.xxh3_128_digest(v.to_numpy(zero_copy_only=False).tobytes()) for v in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], names=[*batch.schema.names, "digest"])

    return rows.mapInArrow(digest, f"row long, vec_id long, embedding {kind}, digest binary")


def tails(distinct: DataFrame, plan: dict[int, tuple[int, float, int]]) -> DataFrame:
    """(row, digest, copies, size, tails in a bundle, vector and tails that it is in as bytes, these tails, values there) of every valid vector.

    ``plan`` has the directions, the bound and the tails in a bundle of each vector length.
    """
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = pc.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
            for size in (int(x) for x in np.unique(lengths) if int(x) in plan):
                count, bound, bundled = plan[size]
                if size not in axes:
                    if sum(x.nbytes for x in axes.values()) >= 1 << 27:
                        axes.clear()
                    axes[size] = directions_of(count, size).T.astype(np.float32)
                mine = batch.take(pa.array(np.flatnonzero(lengths == size)))
                step = max(16, min(1024, (1 << 22) // max(count, size)))
                for lo in range(0, len(mine), step):
                    part = mine.slice(lo, step)
                    raw = part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                    unit = _units(raw)
                    kept = np.flatnonzero(np.isfinite(unit[:, 0]))
                    values = unit[kept].astype(np.float32) @ axes[size]
                    flat = np.flatnonzero(values > bound)
                    at, tail = np.divmod(flat, max(count, 1))
                    edges = np.searchsorted(at, np.arange(len(kept) + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        *(part.column(c).take(pa.array(kept)) for c in ("row", "digest", "copies")), *(pa.array(np.full(len(kept), x, dtype=np.int32)) for x in (size, bundled)),
                        _binary(np.arange(len(kept) + 1) * size, raw[kept]), _binary(edges, tail.astype(_code(count))),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(tail.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(values.ravel()[flat]))], names=["row", "digest", "copies", "size", "bundled", "vector", "codes", "tails", "at"])

    return distinct.select("row", "digest", "copies", "embedding").mapInArrow(
        project, "row long, digest binary, copies long, size int, bundled int, vector binary, codes binary, tails array<int>, at array<float>")


def _tails_of(edges: np.ndarray, codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``rows``, tail) of all tails that these rows are in."""
    lengths = np.diff(edges)[rows]
    owner = np.repeat(np.arange(len(rows)), lengths)
    return owner, codes[np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths - edges[rows], lengths)].astype(np.int64)


def _bits(owner: np.ndarray, tails: np.ndarray, rows: int) -> np.ndarray:
    """The tails of every row as bit sets: by 512 tails, then by row, eight words each."""
    bits = np.zeros((int(tails.max()) // 512 + 1) * rows * 8, dtype=np.uint64)
    np.add.at(bits, (tails // 512 * rows + owner) * 8 + tails % 512 // 64, np.uint64(1) << (tails % 64).astype(np.uint64))  # no tail comes twice
    return bits.reshape(-1, rows, 8)


def _frequent_before(owner: np.ndarray, tails: np.ndarray, rows: int, tail: int) -> np.ndarray | None:
    """Zeros and ones: which rows are in the tails before ``tail`` that most of them are in. Nothing if no group of rows meets before."""
    early = tails < tail
    counts = np.bincount(tails[early], minlength=1)
    often = np.argsort(counts)[-64:]
    often = often[counts[often] >= 32]
    if not len(often):
        return None
    place = np.full(len(counts), -1)
    place[often] = np.arange(len(often))
    owner, at = owner[early], place[tails[early]]
    out = np.zeros((rows, len(often)), dtype=np.float32)
    out[owner[at >= 0], at[at >= 0]] = 1.0
    return out


def _first_collisions(bits: np.ndarray, i: np.ndarray, j: np.ndarray, tail: int, collisions: int) -> np.ndarray:
    """Which of the pairs share ``collisions`` tails or more, ``tail`` being the first of them."""
    left, here = np.arange(len(i)), tail // 512
    for some in bits[:here]:  # most pairs go with the first of them
        left = left[~(some[i[left]] & some[j[left]]).any(axis=1)]
    below = np.where(np.arange(8) < tail % 512 // 64, ~np.uint64(0), np.uint64(0))
    below[tail % 512 // 64] = (np.uint64(1) << np.uint64(tail % 64)) - np.uint64(1)
    left = left[~(bits[here][i[left]] & bits[here][j[left]] & below).any(axis=1)]
    shared, few = np.zeros(len(left), dtype=np.int64), np.arange(len(left))
    for some in bits[here:]:  # counted on while they are too few
        shared[few] += np.bitwise_count(some[i[left[few]]] & some[j[left[few]]]).sum(axis=1, dtype=np.int64)
        few = few[shared[few] < collisions]
    return left[shared >= collisions]


def _near_pairs(single: np.ndarray, value: np.ndarray, side: np.ndarray | None, before: np.ndarray | None, cosine: float, window: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a query window (rows are sorted by value) whose cosine may be ``cosine``, a few at a time.

    Rows of one side are compared with those of the other, without sides all with one another. Pairs with a common column in ``before``
    meet in an earlier tail; a product drops them together, so a group of near copies is not taken apart pair by pair in every tail.
    """
    # No sum of so many products in single precision is further from the exact one.
    least = np.float32(cosine - (single.shape[1] + 8) * 1.2e-7)
    a, b = (np.arange(len(value)),) * 2 if side is None else (np.flatnonzero(side == x) for x in (0, 1))
    others, there = (single, value) if side is None else (single[b], value[b])
    found, many = [], 0
    for lo in range(0, len(a), 256):  # queries, against the rows of their windows
        mine = a[lo:lo + 256]
        start = lo if side is None else int(np.searchsorted(there, value[mine[0]] - window, side="left"))
        reach = int(np.searchsorted(there, value[mine[-1]] + window, side="right"))
        near = single[mine] @ others[start:reach].T >= least
        if before is not None and near.any():
            near &= before[mine] @ before[b[start:reach]].T == 0
        flat = np.flatnonzero(near)
        for at in range(0, len(flat), 1 << 16):
            i, j = np.divmod(flat[at:at + (1 << 16)], reach - start)
            i, j = mine[i], b[start + j]
            good = np.abs(value[j] - value[i]) <= window
            if side is None:
                good &= i < j
            found.append((i[good], j[good]))
            many += len(found[-1][0])
            if many >= 1 << 16:
                yield tuple(np.concatenate(x) for x in zip(*found))
                found, many = [], 0
    if many:
        yield tuple(np.concatenate(x) for x in zip(*found))


def _joined(low: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels, each the smallest row of its component, after the pairs have joined some."""
    i, j = low[i], low[j]
    i, j = i[i != j], j[i != j]
    top = np.arange(len(low))
    while len(i):
        label = top.copy()
        np.minimum.at(label, i, top[j]), np.minimum.at(label, j, top[i])
        label = label[label]
        if (label == top).all():
            break
        top = label
    return top[low]


def _count_links(cosine: float, collisions: int, window: float, plan: dict[int, tuple[int, float, int]], kind: np.dtype):
    def tail_links(tail: int, row: np.ndarray, side: np.ndarray | None, value: np.ndarray, copies: np.ndarray, raw: np.ndarray, owner: np.ndarray, tails: np.ndarray) -> pa.Table:
        unit = _units(raw)
        count, low = np.zeros(len(row), dtype=np.int64), np.arange(len(row))
        bits, before = None, _frequent_before(owner, tails, len(row), tail)
        for i, j in _near_pairs(unit.astype(np.float32), value, side, before, cosine, window):
            bits = _bits(owner, tails, len(row)) if bits is None else bits
            first = _first_collisions(bits, i, j, tail, collisions)
            i, j = i[first], j[first]
            linked = [np.einsum("ij,ij->i", unit[i[k:k + 8192]], unit[j[k:k + 8192]]) >= cosine for k in range(0, len(i), 8192)]
            if linked:
                i, j = (x[np.concatenate(linked)] for x in (i, j))
                np.add.at(count, i, copies[j]), np.add.at(count, j, copies[i])
                low = _joined(low, i, j)
        kept = np.flatnonzero(count)
        return pa.table({"row": pa.array(row[kept]), "links": pa.array(count[kept]), "low": pa.array(row[low[kept]])})

    def links(table: pa.Table) -> pa.Table:
        size, split = table["size"][0].as_py(), table["i"][0] != table["j"][0]
        row, side, value, copies, tail = (table[c].to_numpy() for c in ("row", "side", "value", "copies", "tail"))
        raw = _values(table["vector"], kind)[1].reshape(-1, size)
        edges, codes = _values(table["codes"], _code(plan[size][0]))
        order = np.lexsort((row, value, tail))
        return pa.concat_tables([
            tail_links(int(tail[mine[0]]), row[mine], side[mine] if split else None, value[mine], copies[mine], raw[mine], *_tails_of(edges, codes, mine))
            for mine in np.split(order, np.flatnonzero(np.diff(tail[order])) + 1)])

    return links


def near_vectors(vectors: DataFrame, cosine: float = COSINE, collisions: int = COLLISIONS, block: int = BLOCK, **calibration) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding)."""
    given = vectors.schema["embedding"].dataType
    kind = "float" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "double"
    rows = materialize(_digests(vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                                               F.col("embedding").cast(f"array<{kind}>").alias("embedding"))), "vectors")
    firsts = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("row"), F.count("*").alias("copies"))
    distinct = materialize(rows.select("row", "embedding").join(firsts, "row"), "distinct-vectors")
    # One row per length of vectors. A length's only vector has nothing to be compared with and needs no directions.
    lengths = distinct.where("size(embedding) > 0").groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).collect()
    plan = {}
    for size, n in (tuple(r) for r in lengths):
        most = max(4096, min(1 << 16, (1 << 24) // size))  # directions of long vectors must fit in memory
        directions, bound = calibrate(n, cosine, **{"most": most, **calibration}) if n > 1 else (0, 0.0)
        plan[size] = (directions, bound, tails_in_bundle(n, directions, bound))
    projected = materialize(tails(distinct, plan), "tails")
    # One row per direction, ``most`` at most for each length. A tail of one block comes in a bundle, here numbered from -1 down.
    blocks = projected.select("size", "bundled", F.explode("tails").alias("tail")).groupBy("size", "tail").agg(
        F.ceil(F.count("*") / F.least(F.lit(block), F.greatest(F.lit(800), F.floor(F.lit(1 << 20) / F.col("size"))))).cast("int").alias("blocks"), F.min("bundled").alias("bundled"))
    blocks = blocks.select("size", "tail", "blocks", F.when(F.col("blocks") > 1, F.col("tail")).otherwise(-1 - F.floor(F.col("tail") / F.col("bundled")).cast("int")).alias("bundle"))
    found = projected.withColumn("__", F.explode(F.arrays_zip("tails", "at"))).select(
        "row", "copies", "size", "vector", "codes", F.col("__.tails").alias("tail"), F.col("__.at").alias("value")).join(F.broadcast(materialize(blocks, "tail-blocks")), ["size", "tail"])
    own = found.withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "size", "bundle", "tail", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "row", "copies", "vector", "codes", "value")
    count_links = _count_links(cosine, collisions, WINDOW, plan, np.dtype("<f4" if kind == "float" else "<f8"))
    local = materialize(pairs.groupBy("size", "bundle", "i", "j").applyInArrow(count_links, "row long, links long, low long"), "links")
    components = connected_components(local.select(F.col("row").alias("a"), F.col("low").alias("b")), "vector-components")
    links = local.groupBy("row").agg(F.sum("links").alias("n_links"))
    known = (projected.select("row", "digest", "copies").join(links, "row", "left").join(components.withColumnRenamed("node", "row"), "row", "left")
             .select("digest", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "row").alias("root")))
    named = rows.select("row", "vec_id", "digest").join(known, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "row").alias("root"))
    least = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return named.join(least, "root").select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = f"""
WITH RECURSIVE numbered AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda c: c::DOUBLE) AS e FROM embeddings),
valid AS (
  SELECT row, len(e) AS size, e, sqrt(list_dot_product(e, e)) AS norm FROM numbered
  WHERE e IS NOT NULL AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(e, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.row AS a, b.row AS b FROM valid a JOIN valid b ON a.size = b.size AND a.row <> b.row
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {COSINE}),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counted AS (SELECT a AS row, count(*) AS n_links FROM links GROUP BY a),
least AS (SELECT r.a AS row, min(n.vec_id) AS low FROM reach r JOIN numbered n ON n.row = r.b GROUP BY r.a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM numbered LEFT JOIN counted USING (row) LEFT JOIN least USING (row)
"""
