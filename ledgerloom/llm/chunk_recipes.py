"""Exact deduplication through content-defined chunk recipes (operator 6).

1. Inside tasks every text is cut where a hash of the last eight bytes ends in zeros, so equal passages give equal chunks
   wherever they stand. A document's *recipe* is the list of its chunks' digests and sizes, in order: 20 bytes for each
   few kilobytes of text.
2. Digests are verified by a second, independent one, the chunk's SHA-256: both are brought together, and their bytes stay where
   they are. A digest with one proof names one content. Should a digest have several, it is no identifier, and the recipes are
   made of the proofs instead. (With 128-bit digests this does not happen by chance; shorter ones are for tests.)
3. Documents with equal recipes have equal texts. From here on only recipes move: one aggregation (which combines before
   the shuffle, so a recipe shared by a third of all rows costs one row per task) and one join.

Rows: null text counts as empty text; empty texts equal each other; a repeated row is a document of its own, and one row stays
per group: that with the largest doc_id (nulls last), then any one of equal ids, the same on every run over the same
files; extra columns are ignored by ``dedup`` and kept by ``drop_copies``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.presence import left_after
from ledgerloom.session import materialize

LEAST, MEAN_BITS, MOST = 1024, 12, 16384
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def chunk_ends(data: bytes, least: int = LEAST, mean_bits: int = MEAN_BITS, most: int = MOST) -> list[int]:
    """End offsets of the chunks of ``data``; one end at 0 for empty data. Depends on the bytes alone."""
    size, ends, at = len(data), [], 0
    if size > least:
        windows = np.ndarray(shape=(size - 7,), dtype="<u8", buffer=data, strides=(1,))
        marks = np.flatnonzero((windows * _MULTIPLIER) >> np.uint64(64 - mean_bits) == 0) + 8
        while size - at > least:
            k = int(np.searchsorted(marks, at + least))
            end = min(int(marks[k]) if k < len(marks) else size, at + most)
            if end >= size:
                break
            ends.append(end)
            at = end
    return [*ends, size]


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    for end in chunk_ends(data):
        yield data[at:end]
        at = end


def _digest(piece: bytes, digest_bytes: int) -> bytes:
    return xxhash.xxh3_128_digest(piece)[:digest_bytes] + len(piece).to_bytes(4, "little")


def _as_bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def recipes(docs: DataFrame, digest_bytes: int = 16, proofs: bool = False) -> DataFrame:
    """(doc_id, text_sha256, recipe) of every row; the recipe is made of digests, or of their proofs."""
    name = (lambda piece: hashlib.sha256(piece).digest()) if proofs else (lambda piece: _digest(piece, digest_bytes))

    def build(batches):
        for batch in batches:
            sha, recipe = [], []
            for value in batch.column(1):
                data = _as_bytes(value)
                sha.append(hashlib.sha256(data).hexdigest())
                recipe.append(b"".join(map(name, _pieces(data))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sha, pa.string()), pa.array(recipe, pa.binary())],
                                             names=["doc_id", "text_sha256", "recipe"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, "doc_id long, text_sha256 string, recipe binary")


def ambiguous_digests(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """Digests that stand for more than one content."""
    def build(batches):
        for batch in batches:
            found = [(_digest(piece, digest_bytes), hashlib.sha256(piece).digest()) for value in batch.column(0) for piece in _pieces(_as_bytes(value))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)] or [pa.array([], pa.binary())] * 2, names=["digest", "proof"])

    chunks = docs.select("text").mapInArrow(build, "digest binary, proof binary")
    return chunks.groupBy("digest").agg(F.min("proof").alias("least"), F.max("proof").alias("most")).where("least <> most").select("digest")


def dedup(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs`` (doc_id, text)."""
    proofs = not ambiguous_digests(docs, digest_bytes).isEmpty()
    listed = materialize(recipes(docs, digest_bytes, proofs).withColumn("row", F.monotonically_increasing_id()), "recipes")
    groups = listed.groupBy("recipe").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    return listed.join(groups, "recipe").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without exact copies, all columns kept; equal rows with one doc_id count as copies too."""
    own = lambda doc_id, digest: F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), digest)
    verdicts = materialize(dedup(docs).select(own(F.col("doc_id"), F.col("text_sha256")).alias("__own"), "kept"), "exact-verdicts")
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    marked = docs.select(F.struct("*").alias("__row"), own(F.col("doc_id"), digest).alias("__own"))
    return left_after(marked, verdicts).select(*(F.col("__row")[c].alias(c) for c in docs.columns))


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
