"""Near-duplicate documents by DartMinHash signatures and banded joining (operator 2).

Documents are sets of five-word shingles (lower case, words between white space); two are linked when the sets' Jaccard similarity
is 0.8 or more, and classes are connected components of links.

1. Signatures. Every element throws hashed darts: inside a weight band they arrive along the rank axis as a Poisson process whose
   gaps come from hashes of (element, band, number). A document takes the darts below its element's weight; each dart falls
   on one coordinate, and the earliest per coordinate stays. About t log t darts are drawn per document however many
   shingles it has. Shingles weigh 1 here; ``signature`` takes any weights.
2. Bands of rows of the signature are joined: equal bands hang every text on the smallest of its bucket, and components of
   these unverified edges are the *candidate clusters*. At similarity 0.8, 32 bands of 6 miss 1 pair in 17,000. Texts with
   equal shingle sets are one node throughout, so copies are never paired with one another.
3. Texts of clusters of two or more move once, as shingle sets; a bit map of their keys (``presence``) keeps the other texts where
   they are. A cluster is cut into blocks of a few hundred texts, and a few pivots
   of the cluster stand in each of them. In a block, pairs whose signatures agree on enough coordinates (four standard deviations
   below 0.8) are verified on the whole shingle sets, unless they are connected already; only edges of a spanning forest
   leave the task. A large group of near copies is one class after this pass, whose work grows with the group.
4. Where a cluster of several blocks still has several classes, pairs of different classes are left. Each of them has a text outside the
   cluster's largest class, so blocks of those texts meet one another and the largest class, and that class never meets itself.
   With this, no pair of a cluster is skipped unless it is connected already.

Rows: null and empty texts have no shingles and link with nothing; texts of one to four words have one shingle, all their words;
repeated rows and copies share a class; ``kept`` marks the row with the smallest doc_id (nulls last) of its class, one of equal
ids; extra columns are ignored by ``near_classes`` and kept by ``drop_near_copies``; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.presence import bit_map, flagged, left_after
from ledgerloom.session import materialize

WORDS, SIMILARITY, BANDS, ROWS = 5, 0.8, 32, 6
BLOCK, PIVOTS = 400, 16
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (multiply and shift, twice)."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> _U(32))


@functools.lru_cache(4)
def _powers(size: int, base: int) -> np.ndarray:
    return np.concatenate((np.ones(1, dtype=_U), np.full(size - 1, base, dtype=_U))).cumprod(dtype=_U)


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word: differences of a running polynomial over the bytes, shifted back to the word's start."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    inside = ~_SPACES[data]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=_U)
    size = 1 << max(12, int(len(data)).bit_length())
    running = np.concatenate((np.zeros(1, dtype=_U), ((data.astype(_U) + _U(1)) * _powers(size, _BASE)[: len(data)]).cumsum(dtype=_U)))
    return mix((running[ends] - running[starts]) * _powers(size, _INVERSE)[starts])


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of runs of ``words`` words; all words as one if there are fewer; none without words."""
    hashed = word_hashes(text) if text else np.zeros(0, dtype=_U)
    if not len(hashed):
        return hashed
    run = min(words, len(hashed))
    total = np.zeros(len(hashed) - run + 1, dtype=_U)
    for k in range(run):
        total = mix(total + hashed[k: len(hashed) - run + 1 + k]) + _U(k + 1)
    return np.unique(total)


def signature(elements: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` coordinates a 32-bit name of the earliest dart; equal with probability the weighted Jaccard similarity."""
    reach = size * (np.log(size) + 2.0) / float(weights.sum())
    while True:
        ranks, names = _darts(elements, weights, reach)
        place = (names >> _U(40)) % _U(size)
        order = np.argsort(-ranks, kind="stable")
        found = np.full(size, -1, dtype=np.int64)
        found[place[order].astype(np.int64)] = (names[order] & _U(0xFFFFFFFF)).astype(np.int64)
        if (found >= 0).all():
            return found.astype(np.uint32)
        reach *= 1.5  # rarely: the same darts, and later ones


def _darts(elements: np.ndarray, weights: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and names of all darts below ``reach`` that the weights take."""
    ranks, names = [], []
    low, high, band = 0.0, 1.0, 0
    while True:
        inside = weights > low
        if not inside.any():
            return np.concatenate(ranks), np.concatenate(names)
        element, weight = elements[inside], weights[inside]
        start, count, mean = np.zeros(len(element)), 0, reach * (high - low)
        step = int(mean + 2.0 * np.sqrt(mean)) + 1
        while len(element):
            number = np.arange(count, count + step, dtype=_U) * _U(_BASE) + _U(band)
            name = mix(element[:, None] + mix(number)[None, :])
            rank = start[:, None] - np.log(((name >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53).cumsum(axis=1) / (high - low)
            name = mix(name)
            hit = rank < reach
            if weight.min() < high:
                hit &= low + (name & _U(0xFFFFFF)).astype(np.float64) * 2.0 ** -24 * (high - low) < weight[:, None]
            ranks.append(rank[hit])
            names.append(mix(name[hit]))
            more = rank[:, -1] < reach
            element, weight, start, count = element[more], weight[more], rank[more, -1], count + step
            step = max(1, step // 2)
        low, high, band = high, 2 * high, band + 1


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    key = np.arange(bands, dtype=_U)
    for column in sig.reshape(bands, rows).T:
        key = mix(key + column.astype(_U))
    return key.view(np.int64)


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, digest of the text, fp of the shingle set or null, node, band keys) of every row."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, nodes, bands = [], [], []
            for value in batch.column(2):
                found = shingles(value.as_py())
                if len(found):
                    fp = xxhash.xxh3_128_digest(found.tobytes())
                    keys = band_keys(signature(found, np.ones(len(found)), BANDS * ROWS))
                    fps.append(fp), nodes.append(int.from_bytes(fp[:8], "little", signed=True)), bands.append(keys)
                else:
                    fps.append(None), nodes.append(None), bands.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.binary()), pa.array(nodes, pa.int64()),
                                              pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "digest", "fp", "node", "bands"])

    return _with_digest(docs).mapInArrow(build, "doc_id long, digest long, fp binary, node long, bands array<long>")


def _with_digest(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text")


def candidate_edges(listed: DataFrame) -> DataFrame:
    """(a, b): every node with the smallest node of each of its buckets that has more than one."""
    keyed = listed.where("node IS NOT NULL").select("node", F.explode("bands").alias("key")).repartition("key")
    buckets = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    return keyed.join(buckets, "key").where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))


def _verify(similarity: float):
    """The links between a task's texts of side 0 and side 1 (among those of side 0 if that is all) as edges of a spanning forest."""
    size = BANDS * ROWS
    least = size * similarity - 4.0 * np.sqrt(size * similarity * (1.0 - similarity))

    def links(table: pa.Table) -> pa.Table:
        fps, sides = table["fp"].to_pylist(), np.array(table["side"])
        sigs = np.stack([np.frombuffer(x, dtype=np.uint32) for x in table["sig"].to_pylist()])
        sets = [np.frombuffer(x, dtype=_U) for x in table["shingles"].to_pylist()]
        left = np.flatnonzero(sides == 0)
        right = np.flatnonzero(sides == 1) if (sides == 1).any() else left
        agree = np.zeros((len(left), len(right)), dtype=np.int16)
        for k in range(size):
            agree += sigs[left, k][:, None] == sigs[right, k][None, :]
        i, j = np.nonzero(agree >= least)
        order = np.argsort(-agree[i, j], kind="stable")
        first: dict[bytes, int] = {}
        parent = [first.setdefault(c, k) for k, c in enumerate(table["class"].to_pylist())]

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        for x, y in zip(left[i[order]].tolist(), right[j[order]].tolist()):
            p, q = top(x), top(y)
            if p != q:
                smaller, larger = sorted((len(sets[x]), len(sets[y])))
                if smaller >= similarity * larger:
                    common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if common >= similarity * (smaller + larger - common):
                        parent[max(p, q)] = min(p, q)
                        out.append((fps[x], fps[y]))
        return pa.table({"root": pa.array([table["root"][0].as_py()] * len(out), pa.int64()),
                         "a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    return links


def _members(listed: DataFrame, block: int) -> DataFrame:
    """(fp, root, __id, __digest, blocks, own, pivot): the distinct shingle sets of clusters, with a row to read each from and its block."""
    clusters = connected_components(candidate_edges(listed), "near-candidates")
    reps = (listed.where("node IS NOT NULL").groupBy("node", "fp").agg(F.min(F.struct("doc_id", "digest")).alias("rep")).join(clusters, "node")
            .select("fp", "root", F.col("rep.doc_id").alias("__id"), F.col("rep.digest").alias("__digest")))
    reps = materialize(reps, "near-clustered")
    sizes = reps.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    place = F.row_number().over(Window.partitionBy("root").orderBy(F.xxhash64("fp"), "fp"))
    pivots = (reps.select("root", "fp").withColumn("place", place).where(F.col("place") <= PIVOTS)
              .select("fp", F.lit(True).alias("pivot")))
    return materialize(reps.join(sizes, "root").join(pivots, "fp", "left").select(
        "fp", "root", "__id", "__digest", "blocks", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("own"),
        (F.coalesce("pivot", F.lit(False)) & (F.col("blocks") > 1)).alias("pivot")), "near-members")


def _sketches(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(fp, root, blocks, own, pivot, sig, shingles) of every member; its text is read and moved once."""
    known = bit_map(members, ["__id", "__digest"], "near-member-bits")
    texts = flagged(_with_digest(docs), ["doc_id", "digest"], known, "__member").where("__member").drop("__member")
    # The members grow with the corpus, so they are merged with it at every size and never broadcast.
    texts = texts.join(members.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay, sigs, sets = [], [], []
            for text, fp in zip(batch.column("text"), batch.column("fp")):
                found = shingles(text.as_py())
                same = xxhash.xxh3_128_digest(found.tobytes()) == fp.as_py()  # else another text with this digest
                stay.append(same)
                if same:
                    sigs.append(signature(found, np.ones(len(found)), BANDS * ROWS).tobytes()), sets.append(found.tobytes())
            named = batch.select(["fp", "root", "blocks", "own", "pivot"]).filter(pa.array(stay, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*named.columns, pa.array(sigs, pa.binary()), pa.array(sets, pa.binary())],
                                             names=[*named.schema.names, "sig", "shingles"])

    found = texts.select("text", "fp", "root", "blocks", "own", "pivot").mapInArrow(
        sketch, "fp binary, root long, blocks int, own int, pivot boolean, sig binary, shingles binary")
    return materialize(found, "near-sketches")


def verified_edges(docs: DataFrame, listed: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between shingle sets whose components are the classes."""
    members = _members(listed, block)
    sketches = _sketches(docs, members)
    links, schema = _verify(similarity), "root long, a binary, b binary"
    everywhere = F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))
    inside = sketches.select("root", F.explode(everywhere).alias("i"), F.lit(0).alias("side"), "fp", F.col("fp").alias("class"), "sig", "shingles")
    inside = materialize(inside.groupBy("root", "i").applyInArrow(links, schema), "near-links")
    wide = members.where("blocks > 1").select("fp", "root")
    if wide.isEmpty():
        return inside.select("a", "b")

    # What is left: texts outside the largest class of their cluster, against one another and that class.
    so_far = connected_components(inside.join(wide.select("root").distinct(), "root", "left_semi"), "near-blocks")
    standing = materialize(wide.join(so_far.select(F.col("node").alias("fp"), F.col("root").alias("class")), "fp", "left")
                           .withColumn("class", F.coalesce("class", "fp")), "near-standing")
    counts = standing.groupBy("root", "class").agg(F.count("*").alias("n"))
    open_ = (counts.groupBy("root").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.max("n").alias("most"),
                                        F.sum("n").alias("all"), F.count("*").alias("classes")).where("classes > 1")
             .select("root", "main", F.ceil((F.col("all") - F.col("most")) / block).cast("int").alias("rest_blocks"),
                     F.ceil(F.col("most") / block).cast("int").alias("main_blocks")))
    main = F.col("class") == F.col("main")
    spread = F.xxhash64("fp", F.lit(1))
    dealt = standing.join(open_, "root").select(
        "fp", "class", "rest_blocks",
        F.when(main, F.col("rest_blocks") + F.pmod(spread, F.col("main_blocks"))).otherwise(F.pmod(spread, F.col("rest_blocks"))).cast("int").alias("at"),
        F.when(main, F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("main_blocks")).alias("meets"))
    pairs = (sketches.where("blocks > 1").select("root", "fp", "sig", "shingles").join(dealt, "fp")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("meets") - 1)))
             .select("root", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"),
                     F.when(F.col("at") <= F.col("other"), 0).otherwise(1).alias("side"), "fp", "class", "sig", "shingles"))
    between = pairs.groupBy("root", "i", "j").applyInArrow(links, schema)
    return inside.select("a", "b").union(between.select("a", "b"))


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, class_size, kept, digest) of every row of ``docs`` (doc_id, text)."""
    listed = materialize(described(docs).withColumn("row", F.monotonically_increasing_id()), "near-signatures")
    classes = connected_components(verified_edges(docs, listed, similarity, block), "near-classes")
    own = F.concat(F.lit("row "), F.col("row").cast("string")).cast("binary")
    named = (listed.select("doc_id", "digest", "row", "fp").join(classes.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("class", F.coalesce("root", "fp", own)))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    groups = named.groupBy("class").agg(first.alias("first"), F.count("*").alias("class_size"))
    return named.join(groups, "class").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("first.row")).alias("kept"), "digest")


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each class.

    Rows without words are classes of their own and all stay; of equal rows with words (doc_id and text) one stays.
    """
    own = lambda doc_id, digest: F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), digest.cast("string"))
    verdicts = materialize(near_classes(docs, similarity).select(own(F.col("doc_id"), F.col("digest")).alias("__own"), "kept"), "near-verdicts")
    marked = docs.select(F.struct("*").alias("__row"), own(F.col("doc_id"), F.xxhash64("text")).alias("__own"))
    stay = left_after(marked, verdicts, F.coalesce(F.col("__row.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return stay.select(*(F.col("__row")[c].alias(c) for c in docs.columns))
