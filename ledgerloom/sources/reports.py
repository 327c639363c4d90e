"""Metric documents as JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_document(sections: dict[str, DataFrame]) -> DataFrame:
    """One row holding one JSON object: section name -> list of that section's rows.

    Meant for sections that are already aggregated to a few labelled rows each; a column
    ``ordinal`` fixes their order and is not printed.
    """
    parts = []
    for i, (name, df) in enumerate(sections.items()):
        ordinal = F.col("ordinal") if "ordinal" in df.columns else F.lit(0)
        shown = [c for c in df.columns if c != "ordinal"]
        parts.append(df.select(F.lit(i).alias("i"), F.lit(name).alias("section"),
                               F.struct(ordinal.cast("int").alias("ordinal"),
                                        F.to_json(F.struct(*shown)).alias("json")).alias("row")))
    rows = reduce(DataFrame.unionByName, parts)
    lists = rows.groupBy("i", "section").agg(
        F.transform(F.array_sort(F.collect_list("row")), lambda r: r["json"]).alias("rows"))
    body = lists.agg(F.array_sort(F.collect_list(F.struct("i", F.concat(
        F.lit('"'), "section", F.lit('": ['), F.array_join("rows", ", "), F.lit("]")).alias("text")))).alias("all"))
    return body.select(F.concat(F.lit("{"), F.array_join(F.transform("all", lambda s: s["text"]), ",\n "),
                                F.lit("}")).alias("value"))


def write_json_document(sections: dict[str, DataFrame], path: str) -> None:
    json_document(sections).write.mode("overwrite").text(path)
