"""Quarantine replay: rows rejected for an unknown parent are judged again once the parent may have arrived."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.contracts import CONTRACTS, enforce_figures, row_figures
from ledgerloom.operators.measure import Measure
from ledgerloom.operators.validation import REASON
from ledgerloom.plans.cleanse import CLEANSERS, classify, converted_keys, typed
from ledgerloom.schemas import GOVERNANCE, STAGING_COLUMNS
from ledgerloom.session import materialize
from ledgerloom.sources.warehouse import Warehouse, bucket_slot, month_slot

REPLAYED = ("accounts", "transactions", "credit_bureau")  # tables with a parent, parents first
_RECORD = [c.split()[0] for c in GOVERNANCE["quarantine"].split(", ")]
_IDENTITY = ["batch_id", "source_table", "source_row_id", "raw_payload"]  # row ids start anew with every load, payloads name it


def parent_reason(table: str) -> str:
    """The reason under which ``table`` rejects rows of an unknown parent."""
    parent, key = CLEANSERS[table].parent
    return f"{key} inconnu en cleansed.{parent}"


def restored(quarantine: DataFrame, table: str) -> DataFrame:
    """The staged rows of open records that lacked their parent, out of their payloads, with the record as ``record``."""
    source = CLEANSERS[table].source
    open_rows = quarantine.where((F.col("source_table") == source) & ~F.col("is_resolved") & (F.col(REASON) == parent_reason(table)))
    kinds = {**{c: "string" for c in STAGING_COLUMNS[source]}, "row_id": "bigint", "load_ts": "timestamp"}
    read = open_rows.select(F.struct(*open_rows.columns).alias("record"), F.parse_json("raw_payload").alias("v"))
    return read.select("record", *[F.try_variant_get("v", f"$.{c}", kind).alias(c) for c, kind in kinds.items()])


def judged_again(quarantine: DataFrame, table: str, parent: DataFrame) -> DataFrame:
    """Open records of an unknown parent with the verdict of today: the reason is NULL where the row may enter now."""
    return classify(table, restored(quarantine, table), parent)


def replay_quarantine(warehouse: Warehouse, run_ts: datetime, buckets: int = 8, pipeline_name: str = "QUARANTINE_REPLAY") -> dict[str, int]:
    """Let in what can enter now and return the number of records resolved per table.

    A record is resolved by a new version of it in its own slot, published together with the rows, so it enters at most
    once. A row whose key the table has meanwhile received in the same run or a later one is resolved without
    entering, since the table's row is not older. Records that fail for another reason now stay open under that one.
    ``buckets`` is that of the monthly runs.
    """
    batch = warehouse.open_batch(pipeline_name, run_ts)
    ts, resolved = F.lit(run_ts).cast("timestamp"), {}
    try:
        for table in REPLAYED:
            spec = CLEANSERS[table]
            records = batch.read("quarantine", slots=lambda s: s.endswith(f"-{table}"))
            counted = Measure(rows=F.count("*"), accepted=F.count_if(F.col(REASON).isNull()),
                              changed=F.count_if(F.coalesce(F.col(REASON), F.lit("")) != F.col(f"record.{REASON}")))
            verdict = materialize(counted.on(judged_again(records, table, batch.read(spec.parent[0]))), f"replay-{table}")
            resolved[table] = counted["accepted"]
            if not counted["changed"]:
                continue
            if counted["accepted"]:
                keys = list(spec.keys)
                have = batch.read(table).select(*[F.col(k).alias(f"_have_{k}") for k in keys], F.col("batch_id").alias("_have_batch"))
                same = [key == F.col(f"_have_{k}") for k, key in converted_keys(table).items()]
                newer = [*same, F.col("_have_batch") >= F.col("record.batch_id")]
                entering = verdict.where(F.col(REASON).isNull()).join(have, newer, "left_anti")
                moves = table == "transactions"
                slot = month_slot(F.col("transaction_date")) if moves else bucket_slot(keys, buckets)
                enforce_figures(CONTRACTS[table], batch.upsert(table, typed(table, entering, batch.batch_id, ts), keys, slot, moves,
                                                               **row_figures(CONTRACTS[table])))
            changed = verdict.where(F.coalesce(F.col(REASON), F.lit("")) != F.col(f"record.{REASON}"))
            versions = changed.select(*[F.col(f"record.{c}").alias(c) for c in (*_RECORD, "slot") if c not in (REASON, "is_resolved")],
                                      F.coalesce(F.col(REASON), F.col(f"record.{REASON}")).alias(REASON), F.col(REASON).isNull().alias("is_resolved"))
            batch.upsert("quarantine", versions, _IDENTITY, F.col("slot"), slots_move=False)
        batch.publish()
    except Exception as problem:
        batch.close("FAILED", error=str(problem)[:4000])
        raise
    batch.close("SUCCESS", sum(resolved.values()))
    return resolved
