"""Session settings and the shared working area for intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Plans here hold hundreds of expressions; recording a call site for each slows the driver.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "ledgerloom", master: str | None = None, **conf) -> SparkSession:
    """Create (or fetch) a session with the settings the jobs are written for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one named in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine; on a cluster the
    other hosts could not read it, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_fallback(spark.sparkContext.applicationId)


@functools.cache
def _local_fallback(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"ledgerloom-{application_id}-")


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a reader over it.

    Cuts the lineage like a reliable checkpoint does, but stays columnar: later steps prune
    columns and partitions, get size statistics, and survive the loss of any executor. The
    files live as long as the folder's own retention keeps them.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/tables/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
