"""Consume-once ingestion with Structured Streaming.

A file is staged exactly once across any number of runs: the checkpoint remembers what was
read, and a micro-batch that is tried again overwrites its own directory.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.staging import parse_lines, raw_lines
from ledgerloom.sources.warehouse import Warehouse, stage_lines


def drain(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Process everything that has arrived and stop; failures surface here."""
    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def consume_once(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append the new rows of a file stream under ``target``, one directory per micro-batch."""
    def stage(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    drain(stream, checkpoint, stage)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when its checkpoint was made."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()["value"])["id"]


def ingest_landing(spark: SparkSession, warehouse: Warehouse, landing_dir: str, table: str, checkpoint: str,
                   load_ts: datetime, files_per_batch: int = 1000) -> None:
    """Stage new CSV files of one table. Each micro-batch becomes a staged load of the
    warehouse, which the next monthly run finds unprocessed.

    The slot name carries the stream's id, which its checkpoint keeps, and the number of the micro-batch: a replayed
    micro-batch replaces its slot instead of adding rows, and no other landing folder or checkpoint can meet it. A new
    checkpoint is a new stream and reads its folder from the start.
    """
    files = raw_lines(spark.readStream.option("maxFilesPerTrigger", files_per_batch), landing_dir, table)

    def stage(lines: DataFrame, epoch: int) -> None:
        batch = warehouse.open_batch(f"INGEST_{table}", load_ts)
        stage_lines(batch, parse_lines(lines, table), table, f"stream-{stream_id(spark, checkpoint)}-{epoch}", load_ts)
        batch.publish()
        batch.close("SUCCESS")

    drain(files, checkpoint, stage)
