"""Joins on time: the version valid at a date, and the last row known at a date.

Neither pairs a key's rows with all of the other side's, and neither needs a key to fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialize

DENSE = 64  # versions of one key that may stand in one bucket


def _instant(value: Column) -> Column:
    """Dates and timestamps as microseconds."""
    return F.unix_micros(value.cast("timestamp"))


def valid_at(facts: DataFrame, versions: DataFrame, keys: list[str], at: str, start: str, end: str,
             columns: list[str], how: str = "left", dense: int = DENSE) -> DataFrame:
    """``facts`` with ``columns`` of the version of its key in whose range [start, end) the date ``at`` falls.

    A point-in-time lookup as an equi-join: the history of a key with more than ``dense`` versions is cut into equal
    stretches of time, about ``dense`` versions each. A version is listed under every stretch it touches, a fact looks into one
    stretch, and the bounds are checked there. Versions of a history follow one another, so the list is longer than
    the history only by one row per stretch. Keys with few versions have one stretch; a hot key of the facts is a skewed join on
    the streamed side, which adaptive execution splits.

    A missing ``end`` is open. Versions that overlap all match. A fact without a key or date, or outside every range, gets
    NULLs (``how`` = "left") or goes ("inner"). Versions without a start or with an end before it match nothing.
    """
    begins, ends = _instant(F.col("__start")), _instant(F.col("__end"))
    renamed = versions.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(start).alias("__start"),
                              F.col(end).alias("__end"), F.struct(*columns).alias("__version"))
    known = [f"__k{i}" for i in range(len(keys))]
    ranged = renamed.where(F.col("__start").isNotNull() & (F.col("__end").isNull() | (F.col("__end") > F.col("__start"))))
    spans = ranged.groupBy(*known).agg(F.count("*").alias("__n"), F.min(begins).alias("__low"), F.max(begins).alias("__high"))
    cut = spans.where(F.col("__n") > dense).select(
        *known, F.ceil(F.col("__n") / dense).alias("__parts"), "__low",
        F.greatest(F.ceil((F.col("__high") - F.col("__low") + 1) / F.ceil(F.col("__n") / dense)), F.lit(1)).alias("__width"))
    # One row per key with a long history, read by both sides.
    cut = materialize(cut, "long-histories")

    def stretch(instant: Column) -> Column:
        part = F.floor((instant - F.col("__low")) / F.col("__width"))
        return F.coalesce(F.least(F.greatest(part, F.lit(0)), F.col("__parts") - 1), F.lit(0))

    # The last instant of a range lies just before its end; an open one reaches into the last stretch.
    last = F.coalesce(ends - 1, F.lit(2 ** 62))
    listed = ranged.join(cut, known, "left").withColumn("__part", F.explode(F.sequence(stretch(begins), stretch(last))))
    listed = listed.select(*known, "__part", "__start", "__end", "__version")
    cut_of = cut.select(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(known)], "__parts", "__low", "__width")
    same = [F.col(key) == F.col(f"__c{i}") for i, key in enumerate(keys)]
    looked = facts.join(cut_of, same, "left").withColumn("__stretch", stretch(_instant(F.col(at))))
    inside = ((F.col("__stretch") == F.col("__part")) & (F.col(at) >= F.col("__start"))
              & (F.col("__end").isNull() | (F.col(at) < F.col("__end"))))
    on = [F.col(key) == F.col(k) for key, k in zip(keys, known)]
    joined = looked.join(listed, [*on, inside], how)
    return joined.select(*facts.columns, *[F.col(f"__version.{c}").alias(c) for c in columns])


def latest_known(facts: DataFrame, events: DataFrame, keys: list[str], at: str, event_at: str, columns: list[str],
                 exact: bool = True, partitions: int | None = None) -> DataFrame:
    """``facts`` with ``columns`` of the newest event of its key not after ``at`` (before it, unless ``exact``).

    An as-of join by sorting: both sides are put in the order of key and time and cut into ranges, so a hot key lies in as many
    ranges as its rows need. Inside a range a running window carries the last event forward. What a range's first key
    may have inherited comes from a table with two rows per range: the last event of each range's last key, carried on.

    Events of equal key and time: the one with the largest ``columns`` counts. Facts without key or date, or before every
    event, get NULLs; events without key or date count for nothing; repeated facts stay repeated. ``partitions`` is the number of
    ranges (by default what adaptive execution makes of the shuffle partitions).
    """
    key = F.struct(*[F.col(f"__k{i}") for i in range(len(keys))])
    order = 0 if exact else 2  # where events stand among the facts (1) of the same time
    left = facts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], _instant(F.col(at)).alias("__t"), F.lit(1).alias("__order"),
                        F.struct(*facts.columns).alias("__fact"), F.lit(None).cast(events.select(F.struct(*columns)).schema[0].dataType).alias("__event"))
    right = events.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], _instant(F.col(event_at)).alias("__t"), F.lit(order).alias("__order"),
                          F.lit(None).cast(left.schema["__fact"].dataType).alias("__fact"), F.struct(*columns).alias("__event"))
    known = [f"__k{i}" for i in range(len(keys))]
    for name in [*known, "__t"]:
        right = right.where(F.col(name).isNotNull())
    # The hash spreads facts of one key and time over ranges as well.
    sides = left.unionByName(right).withColumn("__tie", F.when(F.col("__order") == 1, F.xxhash64("__fact")).otherwise(0))
    by = [*known, "__t", "__order", "__tie"]
    ranged = sides.repartitionByRange(partitions, *by) if partitions else sides.repartitionByRange(*by)
    stored = materialize(ranged.withColumn("__range", F.spark_partition_id()), "as-of-ranges")

    so_far = (Window.partitionBy("__range", *known).orderBy("__t", "__order", "__event")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = stored.withColumn("__last", F.last("__event", ignorenulls=True).over(so_far))
    newest = F.max(F.when(F.col("__event").isNotNull(), F.struct("__t", "__event")))
    per_key = stored.groupBy("__range", *known).agg(newest.alias("__newest"))
    # Of a range only its first key can continue one, and only its last key can be continued.
    border = per_key.groupBy("__range").agg(F.min(key).alias("__first"), F.max(F.struct(key.alias("key"), F.col("__newest.__event").alias("event"))).alias("__end"))
    border = materialize(border, "as-of-borders")
    given = border.select(F.col("__end.key").alias("key"), "__range", F.lit(1).alias("__kind"), F.col("__end.event").alias("event"))
    asked = border.select(F.col("__first").alias("key"), "__range", F.lit(0).alias("__kind"), F.lit(None).cast(given.schema["event"].dataType).alias("event"))
    before = Window.partitionBy("key").orderBy("__range", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inherited = (given.union(asked).withColumn("__inherited", F.last("event", ignorenulls=True).over(before))
                 .where((F.col("__kind") == 0) & F.col("__inherited").isNotNull())
                 .select(F.col("__range").alias("__r"), *[F.col(f"key.{k}").alias(f"{k}r") for k in known], "__inherited"))
    same = [F.col("__range") == F.col("__r"), *[F.col(k) == F.col(f"{k}r") for k in known]]
    joined = carried.where("__order = 1").join(inherited, same, "left")
    found = F.coalesce("__last", "__inherited")
    return joined.select(*[F.col("__fact")[c].alias(c) for c in facts.columns], *[found[c].alias(c) for c in columns])
