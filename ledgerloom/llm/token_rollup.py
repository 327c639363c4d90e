"""Token totals kept up to date by signed deltas (operator 8).

A batch of changes says which documents came (insert), went (delete) or were counted anew (revise), with the counts before and
after. ``signed`` turns that into additive rows; ``Rollup.commit`` sums a batch by source, language and tokenizer version, writes
the sums to a folder of this attempt, and then publishes the attempt by one row in a small marker table. Readers follow the newest marker of each
batch, so a batch committed again (after a lost executor, a lost driver or a repeated delivery) replaces itself instead of counting
twice, and an attempt that ended before its marker was written is never seen: totals are those before or those after.

Rows: before the first commit there are no rows; null source, language or counts are values of their own and zero; a revision without a count before counts as new tokens
of a known document; empty batches publish an empty folder; repeated rows in a batch are separate changes; extra columns are ignored.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import RANK_FILE, TOKENIZER_FILE, byte_bpe
from ledgerloom.session import materialize
from ledgerloom.sources.staging import read_if_present

KEYS = ("source", "lang", "tokenizer")


def signed(changes: DataFrame) -> DataFrame:
    """(source, lang, tokenizer, docs, tokens) per change (change, source, lang, tokenizer, tokens, tokens_before)."""
    before, now = F.coalesce("tokens_before", F.lit(0)), F.coalesce("tokens", F.lit(0))
    delta = F.when(F.col("change") == "insert", now).when(F.col("change") == "delete", -before).otherwise(now - before)
    sign = F.when(F.col("change") == "insert", 1).when(F.col("change") == "delete", -1).otherwise(0)
    return changes.select(*KEYS, sign.cast("long").alias("docs"), delta.cast("long").alias("tokens"))


class Rollup:
    """Additive totals in a folder: sums by batch and attempt under ``data``, the published attempts in ``published``."""

    SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"
    _MARKER = "batch string, attempt string, at long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def prepare(self, batch: str, changes: DataFrame) -> str:
        """Write the sums of a batch where no reader looks, and return the attempt's name."""
        return self.prepare_signed(batch, signed(changes))

    def prepare_signed(self, batch: str, deltas: DataFrame) -> str:
        """``prepare`` for changes that are signed already, and perhaps summed (source, lang, tokenizer, docs, tokens)."""
        attempt = uuid.uuid4().hex
        sums = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.withColumn("batch", F.lit(batch)).write.parquet(f"{self.path}/data/{attempt}")
        return attempt

    def publish(self, batch: str, attempt: str) -> None:
        """Make an attempt the one that counts for its batch: a single new file."""
        marker = self.spark.createDataFrame([(batch, attempt, time.time_ns())], self._MARKER)
        marker.coalesce(1).write.mode("append").parquet(f"{self.path}/published")

    def commit(self, batch: str, changes: DataFrame) -> None:
        self.publish(batch, self.prepare(batch, changes))

    def deltas(self) -> DataFrame:
        """The published rows, each with its batch."""
        markers = read_if_present(self.spark, lambda: self.spark.read.schema(self._MARKER).parquet(f"{self.path}/published"), self._MARKER)
        newest = markers.groupBy("batch").agg(F.max_by("attempt", F.struct("at", "attempt")).alias("attempt")).collect()  # one row per batch
        schema = f"{self.SCHEMA}, batch string"
        if not newest:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{r['attempt']}" for r in newest))

    def totals(self) -> DataFrame:
        """Documents and tokens by key; keys whose documents are all gone drop out."""
        return (self.deltas().groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .where("docs <> 0 OR tokens <> 0"))


def token_counts(docs: DataFrame, tokenizer_file: str = TOKENIZER_FILE, rank_file: str = RANK_FILE) -> DataFrame:
    """``docs`` with ``tokens``, the count by the tokenizer file; a null text has none."""
    @F.pandas_udf("long")
    def count(texts):
        bpe = byte_bpe(tokenizer_file, rank_file)
        return texts.map(lambda t: len(bpe.ids(t)) if t else 0).astype("int64")

    return docs.withColumn("tokens", count("text"))


def _committed(docs: DataFrame, path: str, tokenizer: str, estimate: str) -> Rollup:
    """Three batches of changes of ``docs`` (doc_id, text, source, lang).

    ``load`` inserts every document under both counters with an estimate of a token per four characters; ``count`` revises the
    tokenizer's counts to the real ones, and is committed twice; ``copies`` deletes every document whose text another
    one with a larger doc_id has: as all rows of a text less its last one, both summed per text, source and language first, so
    that a text of many copies is a few rows.
    """
    counted = token_counts(docs.select("doc_id", "text", "source", "lang"))
    counted = materialize(counted.select(
        "doc_id", "source", "lang", "tokens", F.floor((F.coalesce(F.length("text"), F.lit(0)) + 3) / 4).cast("long").alias("estimate"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("sha"), F.monotonically_increasing_id().alias("row")), "counted")
    rollup = Rollup(docs.sparkSession, path)
    both = counted.withColumn("tokenizer", F.explode(F.array(F.lit(tokenizer), F.lit(estimate))))
    none = F.lit(None).cast("long")
    rollup.commit("load", both.select(F.lit("insert").alias("change"), *KEYS, F.col("estimate").alias("tokens"), none.alias("tokens_before")))
    revision = counted.select(F.lit("revise").alias("change"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), "tokens",
                              F.col("estimate").alias("tokens_before"))
    for _ in range(2):
        rollup.commit("count", revision)
    texts = materialize(counted.groupBy("sha", "source", "lang").agg(
        F.count("*").alias("n"), F.max("tokens").alias("tokens"), F.max("estimate").alias("estimate"), F.max(F.struct("doc_id", "row")).alias("last")), "texts")
    last = texts.groupBy("sha").agg(F.max(F.struct("last", "source", "lang", "tokens", "estimate")).alias("k")).select("k.*")
    counters = lambda n: F.array(*(F.struct(F.lit(name).alias("tokenizer"), n.alias("docs"), (n * F.col(c)).alias("tokens"))
                                   for name, c in ((tokenizer, "tokens"), (estimate, "estimate"))))
    deltas = texts.select("source", "lang", F.inline(counters(-F.col("n")))).union(last.select("source", "lang", F.inline(counters(F.lit(1).cast("long")))))
    rollup.publish("copies", rollup.prepare_signed("copies", deltas))
    return rollup


def whole_totals(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k", estimate: str = "four_chars") -> DataFrame:
    """Totals by key: docs and tokens of every row of ``docs``, unique_docs and unique_tokens without the ``copies`` batch's rows.

    A key that holds copies alone stays, with 0 unique ones. Rows under ``estimate`` are not counted by a tokenizer.
    """
    kept = F.col("batch") != "copies"
    return _committed(docs, path, tokenizer, estimate).deltas().groupBy(*KEYS).agg(
        *(F.sum(F.when(kept, F.col(c)).otherwise(0)).alias(c) for c in ("docs", "tokens")),
        *(F.sum(c).alias(f"unique_{c}") for c in ("docs", "tokens")))


def corpus_totals(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k", estimate: str = "four_chars") -> DataFrame:
    """Totals after all batches: of rows with equal texts only the one with the largest doc_id counts."""
    return _committed(docs, path, tokenizer, estimate).totals()
