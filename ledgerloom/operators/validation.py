"""Row validation with a stated reason, and the quarantine record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "failure_reason"

Rule = tuple[str, Column]


def flag_known(staged: DataFrame, parent: DataFrame, key: str, flag: str) -> DataFrame:
    """Mark rows whose ``key`` exists in ``parent``.

    One outer join serves both the reason and the split. Rows of a hot key sit on the
    streamed side, which adaptive execution may cut into several tasks.
    """
    known = parent.select(key).distinct().withColumn(flag, F.lit(True))
    return staged.join(known, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def with_reason(staged: DataFrame, rules: list[Rule]) -> DataFrame:
    """Attach the first rule a row breaks; NULL means the row is valid."""
    (first_reason, first_test), *others = rules
    chain = F.when(first_test, F.lit(first_reason))
    for reason, test in others:
        chain = chain.when(test, F.lit(reason))
    return staged.withColumn(REASON, chain)


def quarantine_rows(classified: DataFrame, source_table: str, columns: list[str],
                    batch_id: int, run_ts: Column) -> DataFrame:
    """Rejected rows with the reason, the number of the rule if one rejected them, and the raw row as JSON
    (NULL fields left out)."""
    rule = F.col("rule_id") if "rule_id" in classified.columns else F.lit(None)
    return classified.where(F.col(REASON).isNotNull()).select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(source_table).alias("source_table"),
        F.col("row_id").cast("bigint").alias("source_row_id"),
        rule.cast("int").alias("rule_id"),
        F.col(REASON),
        F.to_json(F.struct(*columns)).alias("raw_payload"),
        run_ts.alias("quarantined_at"),
        F.lit(False).alias("is_resolved"),
    )
