"""Customer dimension with history (type 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.risk import score_band
from ledgerloom.functions.text import folded
from ledgerloom.operators.dense import dense_index
from ledgerloom.sources.calendar import OPEN_END

TRACKED = ["full_name", "segment", "country_code", "bureau_score_band"]
COLUMNS = ["customer_key", "customer_source_id", *TRACKED, "effective_date", "expiry_date",
           "is_current", "version_number"]


def latest_score(bureau: DataFrame) -> DataFrame:
    """Newest bureau score per customer, whatever its date; combined map-side."""
    return bureau.groupBy("customer_source_id").agg(
        F.max_by("bureau_score", "report_date").alias("bureau_score"))


def dimension_source(customers: DataFrame, bureau: DataFrame) -> DataFrame:
    """Customers with the band of their latest score."""
    return (customers.select("customer_source_id", "full_name", "segment", "country_code")
            .join(latest_score(bureau), "customer_source_id", "left")
            .withColumn("bureau_score_band", score_band(F.col("bureau_score"))).drop("bureau_score"))


def _changed(collation: str | None = None) -> Column:
    """Any tracked attribute differs; for the band, missing and empty are the same."""
    differs = F.lit(False)
    for name in TRACKED[:-1]:
        differs = differs | (folded(F.col(f"old.{name}"), collation) != folded(F.col(f"new.{name}"), collation))
    band = TRACKED[-1]
    return F.coalesce(differs, F.lit(False)) | (
        F.coalesce(f"old.{band}", F.lit("")) != F.coalesce(f"new.{band}", F.lit("")))


def classify_customers(source: DataFrame, dimension: DataFrame, collation: str | None = None) -> DataFrame:
    """Source rows with `previous_version` and what to do: NEW, CHANGED or SAME.

    Versions and the current row come out of one aggregation over the dimension. Customers and their attributes are
    compared byte by byte, or under ``collation``.
    """
    current = F.when(F.col("is_current"), F.struct(*TRACKED))
    key = folded(F.col("customer_source_id"), collation).alias("_key")
    known = dimension.groupBy(key).agg(F.max("version_number").alias("previous_version"), F.max(current).alias("old"))
    matched = (source.select(key, "customer_source_id", F.struct(*TRACKED).alias("new"))
               .join(known, "_key", "left").drop("_key"))
    action = (F.when(F.col("old").isNull(), "NEW").when(_changed(collation), "CHANGED").otherwise("SAME"))
    return matched.select("customer_source_id", "new.*", F.coalesce("previous_version", F.lit(0)).alias("previous_version"),
                          action.alias("action"))


def new_versions(source: DataFrame, dimension: DataFrame, run_ts: Column, collation: str | None = None) -> DataFrame:
    """Rows to insert, with keys continuing after the highest one in use."""
    inserted = classify_customers(source, dimension, collation).where(F.col("action") != "SAME")
    highest = dimension.agg(F.max("customer_key").alias("k")).first()["k"] or 0
    keyed = dense_index(inserted, ["customer_source_id"], "customer_key", start=highest + 1)
    return keyed.select(
        "customer_key", "customer_source_id", *TRACKED, run_ts.alias("effective_date"),
        F.lit(OPEN_END).cast("timestamp").alias("expiry_date"), F.lit(True).alias("is_current"),
        (F.col("previous_version") + 1).cast("int").alias("version_number"))


def split_versions(current: DataFrame, inserted: DataFrame, run_ts: Column, collation: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that stay current, rows to close) among the current rows."""
    key = folded(F.col("customer_source_id"), collation)
    touched, keyed = inserted.select(key.alias("_key")), current.withColumn("_key", key)
    stays = keyed.join(touched, "_key", "left_anti")
    closes = (keyed.join(touched, "_key", "left_semi")
              .withColumns({"expiry_date": run_ts, "is_current": F.lit(False)}))
    return stays.select(*COLUMNS), closes.select(*COLUMNS)


def merge_scd2(dimension: DataFrame, source: DataFrame, run_ts: Column, collation: str | None = None) -> DataFrame:
    """The dimension after this run: history untouched, changed versions closed, new ones added."""
    inserted = new_versions(source, dimension, run_ts, collation)
    stays, closes = split_versions(dimension.where("is_current"), inserted, run_ts, collation)
    history = dimension.where(~F.col("is_current")).select(*COLUMNS)
    return history.unionByName(closes).unionByName(stays).unionByName(inserted.select(*COLUMNS))


def initial_dimension(source: DataFrame, run_ts: Column) -> DataFrame:
    """First load: every customer is new, so the comparison with an empty table is skipped."""
    keyed = dense_index(source, ["customer_source_id"], "customer_key", start=1)
    return keyed.select(
        "customer_key", "customer_source_id", *TRACKED, run_ts.alias("effective_date"),
        F.lit(OPEN_END).cast("timestamp").alias("expiry_date"), F.lit(True).alias("is_current"),
        F.lit(1).alias("version_number"))


def band_history(bureau: DataFrame) -> DataFrame:
    """A customer's score bands as versions in the reports' own time: a version begins with the report that changes the
    band and ends where the next one begins; the last one is open (``expiry_date`` NULL)."""
    by_date = Window.partitionBy("customer_source_id").orderBy("report_date")
    banded = bureau.select("customer_source_id", "report_date", score_band(F.col("bureau_score")).alias("bureau_score_band"))
    first, before = F.row_number().over(by_date) == 1, F.lag("bureau_score_band").over(by_date)
    starts = banded.withColumn("_new", first | ~F.col("bureau_score_band").eqNullSafe(before)).where("_new")
    return starts.select("customer_source_id", "bureau_score_band", F.col("report_date").alias("effective_date"),
                         F.lead("report_date").over(by_date).alias("expiry_date"), F.row_number().over(by_date).alias("version_number"))
