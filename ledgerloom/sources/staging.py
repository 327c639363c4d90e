"""CSV files into staging: text columns kept as they are, ingestion metadata added.

Files are read line by line and parsed as an expression, so that a damaged line is still there, as it was, to be quarantined. Fields
do not hold line breaks; a quote inside a quoted field is doubled.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.convert import empty_to_null
from ledgerloom.schemas import SOURCE_SYSTEM, STAGING_COLUMNS, table_schema

DAMAGED = "damaged line"


def read_if_present(spark: SparkSession, read, schema) -> DataFrame:
    """Run ``read()``; a path that does not exist gives an empty table instead of an error."""
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def add_ingest_columns(raw: DataFrame, table: str, batch_id: int, load_ts: datetime) -> DataFrame:
    """Empty text becomes NULL; ``row_id`` is unique inside the batch, without a shuffle."""
    business = [empty_to_null(F.col(c)).alias(c) for c in STAGING_COLUMNS[table]]
    return raw.select(
        *business, F.monotonically_increasing_id().alias("row_id"),
        F.lit(SOURCE_SYSTEM[table]).alias("source_system"),
        F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(load_ts).cast("timestamp").alias("load_ts"))


def raw_lines(reader, path: str, table: str) -> DataFrame:
    """The lines of a table's CSV files (without each file's header, which must be the list of the columns) as ``line``.

    ``reader`` is a batch or stream reader. No quote and no separator: a line stays as it is.
    """
    header = ",".join(STAGING_COLUMNS[table])
    lines = (reader.schema(T.StructType([T.StructField(header, T.StringType())])).option("header", True)
             .option("enforceSchema", False).option("encoding", "UTF-8").option("sep", "\u0001").option("quote", "").csv(path))
    return lines.toDF("line")


def parse_lines(lines: DataFrame, table: str) -> DataFrame:
    """The business columns of every line, and ``damaged``: the line itself if its number of fields is wrong or a quote
    stays open, so that its values cannot be trusted."""
    schema = ", ".join(f"{c} string" for c in [*STAGING_COLUMNS[table], "damaged"])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "damaged", "escape": '"', "encoding": "UTF-8"}
    read = lines.select("line", F.from_csv("line", schema, options).alias("r"))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    damaged = F.coalesce("r.damaged", F.when(quotes % 2 == 1, F.col("line")))
    return read.select(*[F.col(f"r.{c}").alias(c) for c in STAGING_COLUMNS[table]], damaged.alias("damaged"))


def damaged_rows(parsed: DataFrame, table: str, batch_id: int, load_ts: datetime) -> DataFrame:
    """Quarantine records of the damaged lines, their raw text as payload."""
    columns = {"batch_id": F.lit(batch_id), "source_table": F.lit(table), "source_row_id": F.monotonically_increasing_id(),
               "rule_id": F.lit(None), "failure_reason": F.lit(DAMAGED), "raw_payload": F.to_json(F.struct(F.col("damaged").alias("line"))),
               "quarantined_at": F.lit(load_ts), "is_resolved": F.lit(False)}
    kinds = table_schema("quarantine")
    return parsed.where(F.col("damaged").isNotNull()).select(*[c.cast(kinds[name].dataType).alias(name) for name, c in columns.items()])


def staging_lines(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Parsed lines of one table's file (or directory of files); a missing path gives none."""
    lines = read_if_present(spark, lambda: raw_lines(spark.read, path, table), "line string")
    return parse_lines(lines, table)


def read_staging_csv(spark: SparkSession, path: str, table: str, batch_id: int, load_ts: datetime) -> DataFrame:
    """The sound lines of one table's file (or directory of files) as staged rows; a missing path gives none."""
    return add_ingest_columns(staging_lines(spark, path, table).where(F.col("damaged").isNull()), table, batch_id, load_ts)
