"""Mixing sources to target weights on a low-discrepancy schedule (operator 1).

1. Sizes (words) are counted once; every row gets a number that stays. Targets come from a table with one row per source.
2. Each source's documents are shuffled by the md5 of their id and laid end to end. Their places are sums over 4096 equal hash
   ranges plus a running sum inside a range, so no task holds a whole source. A source below its target is read again.
3. That stream is cut into blocks of equal size. Blocks of words [from, to) of a document are ``spans``.
4. The schedule: slot i is the point frac(i * golden ratio), mapped through the sources' cumulative shares. Slots are ranked
   per source (ranks inside chunks of slots, plus counts of earlier chunks), and the k-th slot of a source takes its k-th block.
   Point sets of this kind miss a share by a few slots at most; those are dropped or put at the end, so every source gets
   exactly the blocks that its target asks for.

Rows: a null or empty text has no words and is never taken; a null source is a source, sorted last; repeated rows are separate
documents; extra columns are ignored by ``mix`` and kept by ``mixed_documents`` and ``whole_documents``; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialize

BLOCK, WEIGHTS, MOST_REPEATS = 1024, (1, 2, 3), 3
GOLDEN = 0.6180339887498949
_CHUNK, _LOW = 8192, 1 << 20
#: What separates words; everything else belongs to one.
SPACE = r"[\x20\x09-\x0D]"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, weight, target): shares of all words by weight, none above ``most`` times its source.

    Filling up to one common level per unit of weight: of the levels that result when the k sources with the smallest
    ``most * size / weight`` are capped, the largest holds.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))  # one row per source
    order = (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = sums.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (order + 1).cast("int")))
    capped = F.col("source_size") * most
    upto = Window.partitionBy(F.lit(0)).orderBy(capped / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    level = ((F.sum("source_size").over(every) - F.sum(capped).over(upto) + capped)
             / (F.sum("weight").over(every) - F.sum("weight").over(upto) + F.col("weight")))
    return (weighted.withColumn("level", level)
            .select("source", "source_size", "weight", F.least(capped.cast("double"), F.col("weight") * F.max("level").over(every)).alias("target")))


def _placed(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Every row with words, and where it stands in its source's shuffled stream."""
    hashed = (sized.where("size > 0").withColumn("hash", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
              .withColumn("range", F.substring("hash", 1, 3))
              .join(F.broadcast(plan.select(F.col("source").alias("__s"), "k", "want")), F.col("source").eqNullSafe(F.col("__s"))))
    # Broadcast: one row per source of the mix, as long as the weight list that a user writes.
    sums = hashed.groupBy("k", "range").agg(F.sum("size").alias("words"))
    before = sums.select("k", "range", (F.sum("words").over(Window.partitionBy("k").orderBy("range")) - F.col("words")).alias("before"))
    inside = F.sum("size").over(Window.partitionBy("k", "range").orderBy("hash", "row")) - F.col("size")
    return (hashed.withColumn("inside", inside).join(before, ["k", "range"])
            .select("row", "doc_id", "k", "want", "size", (F.col("before") + F.col("inside")).alias("at")))


def _slots(spark, wanted: list[int], block: int) -> DataFrame:
    """(k, block, slot): which place of the schedule takes which block of which source."""
    blocks = np.array([-(-w // block) for w in wanted], dtype=np.int64)
    total = int(blocks.sum())
    edges = np.cumsum(blocks) / max(total, 1)

    def source_of(points: pd.Series) -> pd.Series:
        return pd.Series(np.minimum(np.searchsorted(edges, points.to_numpy(), side="right"), len(edges) - 1).astype("int32"))

    low, high = F.col("id") % _LOW, F.floor(F.col("id") / _LOW)
    point = F.pmod(low * F.lit(GOLDEN) + high * F.lit(_LOW * GOLDEN % 1.0), F.lit(1.0))
    drawn = spark.range(total).select(F.col("id").alias("slot"), F.floor(F.col("id") / _CHUNK).alias("chunk"),
                                      F.pandas_udf(source_of, "int")(point).alias("k"))
    drawn = materialize(drawn, "slots")
    counts = drawn.groupBy("k", "chunk").agg(F.count("*").alias("n"))
    before = counts.select("k", "chunk", (F.sum("n").over(Window.partitionBy("k").orderBy("chunk")) - F.col("n")).alias("before"))
    ranked = (drawn.withColumn("rank", F.row_number().over(Window.partitionBy("k", "chunk").orderBy("slot")) - 1)
              .join(before, ["k", "chunk"]).select("k", (F.col("rank") + F.col("before")).alias("block"), "slot"))
    need = spark.createDataFrame([(k, int(n)) for k, n in enumerate(blocks)], "k int, need long")
    had = counts.groupBy("k").agg(F.sum("n").alias("had"))
    missing = (need.join(had, "k", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("need > had")
               .select("k", F.explode(F.sequence("had", F.col("need") - 1)).alias("block")))
    return (ranked.join(F.broadcast(need), "k").where("block < need").select("k", "block", "slot")
            .union(missing.select("k", "block", F.lit(total) + F.col("block"))))


def mix(docs: DataFrame, block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sized rows (row, size, doc_id, source and, in the struct ``doc``, all columns of ``docs``), the targets, and the mix.

    A row of the mix is a run of words of one document in one block: (slot, source number k, block, pass, row, doc_id,
    word_from, word_to). Ordered by slot and place, it is the training order.
    """
    sized = _sized_documents(docs, "doc")
    return (sized, *_mix_sized(sized.drop("doc"), block, weights, most))


def _sized_documents(docs: DataFrame, name: str) -> DataFrame:
    return materialize(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("row"),
                                   F.struct("*").alias(name)), "sized")


def _readings(sized: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, list, DataFrame]:
    """The numbered targets, also as a list, and every reading of a row: words [first, last) of its source's ``want``."""
    spark = sized.sparkSession
    plan = materialize(targets(sized, weights, most).select("*", F.floor(F.col("target") + 0.5).cast("long").alias("want")), "targets")
    listed = plan.orderBy(F.col("source").asc_nulls_last()).collect()  # one row per source
    numbered = spark.createDataFrame([(k, *r) for k, r in enumerate(listed)], "k int, source string, source_size long, weight int, target double, want long")
    placed = _placed(sized, numbered.select("k", "source", "want")).join(F.broadcast(numbered.select("k", "source_size")), "k")
    first = F.col("source_size") * F.col("pass") + F.col("at")
    readings = (placed.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most))))
                .withColumn("first", first).where("first < want").withColumn("last", F.least(F.col("first") + F.col("size"), F.col("want"))))
    return numbered, listed, readings


def _mix_sized(sized: DataFrame, block: int, weights: tuple[int, ...], most: int) -> tuple[DataFrame, DataFrame]:
    numbered, listed, readings = _readings(sized, weights, most)
    cut = readings.withColumn("block", F.explode(F.expr(f"sequence(first div {block}, (last - 1) div {block})")))
    start, end = F.greatest("first", F.col("block") * block), F.least("last", (F.col("block") + 1) * block)
    spans = cut.select("k", "block", "pass", "row", "doc_id", (start - F.col("first")).alias("word_from"), (end - F.col("first")).alias("word_to"))
    mixed = spans.join(_slots(sized.sparkSession, [r["want"] for r in listed], block), ["k", "block"])
    return numbered, mixed.select("slot", "k", "block", "pass", "row", "doc_id", "word_from", "word_to")


def taken(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs`` (doc_id, source, text)."""
    sized = materialize(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"),
                                    F.monotonically_increasing_id().alias("row")), "sizes")
    plan, mixed = _mix_sized(sized, block, WEIGHTS, MOST_REPEATS)
    words = mixed.groupBy("row").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    named = sized.join(F.broadcast(plan.select(F.col("source").alias("__s"), "source_size", "target")), F.col("source").eqNullSafe(F.col("__s")), "left")
    return named.join(words, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def schedule(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source, block, pass, doc_id, word_from, word_to): the words that each place of the training order takes."""
    sized = materialize(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"),
                                    F.monotonically_increasing_id().alias("row")), "sizes")
    plan, mixed = _mix_sized(sized, block, WEIGHTS, MOST_REPEATS)
    return mixed.join(F.broadcast(plan.select("k", "source")), "k").select("slot", "source", "block", "pass", "doc_id", "word_from", "word_to")


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as documents with the columns of ``docs``: one row per document and reading.

    A reading that the target ends within keeps its first words (joined by blanks), one document per source at most.
    """
    columns = docs.columns
    sized = _sized_documents(docs, "__all")
    _, mixed = _mix_sized(sized.drop("__all"), block, WEIGHTS, MOST_REPEATS)
    readings = mixed.groupBy("row", "pass").agg(F.max("word_to").alias("words"))
    words = F.split(F.regexp_replace(F.col("__all.text"), f"^{SPACE}+", ""), f"{SPACE}+")
    part = F.concat_ws(" ", F.slice(words, 1, F.col("words").cast("int")))
    whole = F.col("words") >= F.col("size")
    values = {c: F.col("__all")[c] for c in columns} | {"text": F.when(whole, F.col("__all.text")).otherwise(part)}
    if "n_chars" in columns:
        values["n_chars"] = F.when(whole, F.col("__all")["n_chars"]).otherwise(F.length(part).cast("long"))
    return sized.join(readings, "row").select(*(v.alias(c) for c, v in values.items()))


def whole_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as whole documents with the columns of ``docs``, in the order of the schedule: one row per document and reading.

    A reading stands where the slot stands that takes the block in which it begins; readings of one block keep their order. A
    reading without such a slot is not taken, and one that the target ends within only if that comes nearer to the target than
    leaving it out, or if it is the source's only one. Sources stray from their targets by half a document, or by the rest of their
    only one. Written, the rows are in training order within and across the files.
    """
    sized = _sized_documents(docs, "__all")
    _, listed, readings = _readings(sized.drop("__all"), WEIGHTS, MOST_REPEATS)
    nearer = 2 * (F.col("last") - F.col("first")) >= F.col("size")
    begin = readings.where(nearer | (F.col("first") == 0)).select("k", "row", "first", F.floor(F.col("first") / block).cast("long").alias("block"))
    placed = begin.join(_slots(sized.sparkSession, [r["want"] for r in listed], block), ["k", "block"]).select("row", "slot", "first")
    return sized.select("row", "__all").join(placed, "row").orderBy("slot", "first").select(*(F.col("__all")[c].alias(c) for c in docs.columns))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sized GROUP BY source),
levels AS (
  SELECT *, ((sum(source_size) OVER () - sum(3 * source_size) OVER up + 3 * source_size)::DOUBLE)
            / ((sum(weight) OVER () - sum(weight) OVER up + weight)::DOUBLE) AS level
  FROM sums WINDOW up AS (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
plan AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * max(level) OVER ()) AS target FROM levels),
placed AS (
  SELECT s.*, p.source_size, p.target, floor(p.target + 0.5)::BIGINT AS want,
         (sum(size) OVER (PARTITION BY s.source ORDER BY md5(doc_id::VARCHAR) ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start_word
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (want // source_size) * size
            + greatest(0, least(start_word + size, want % source_size) - least(start_word, want % source_size)) END::BIGINT AS taken
FROM placed
"""
