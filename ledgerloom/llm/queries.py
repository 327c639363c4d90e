"""One query per operator, over whole tables. ``ORACLE`` holds check SQL where SQL can express the result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (bin_completion, centroid_language, chunk_recipes, collision_projections, dart_minhash, disclosure,
                            equal_average, mixing, pairwise_quality, token_rollup, toxicity, url_rules, whitening)
from ledgerloom.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def mix_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_classes(table(spark, sf_dir, "documents")).drop("digest")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_projections.near_vectors(table(spark, sf_dir, "embeddings"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark)).drop("reason")


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.dedup(table(spark, sf_dir, "documents"))


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollup.whole_totals(table(spark, sf_dir, "documents"), f"{work_dir(spark)}/tables/token-rollup-{uuid.uuid4().hex}")


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_completion.pack(table(spark, sf_dir, "documents"))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = centroid_language.fit(docs, ~held_out)
    # The contract wants a learned language for every text with a letter, so nothing is rejected by distance.
    found = centroid_language.predict(docs.select("doc_id", "text"), model, reject=-1.0)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equal_average.compressed(table(spark, sf_dir, "embeddings"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.report(table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Query] = {
    "op1_mix_to_weights": mix_to_weights,
    "op1_mix_schedule": mix_schedule,
    "op2_near_duplicates": near_duplicates,
    "op3_quality": quality,
    "op4_near_embeddings": near_embeddings,
    "op5_url_verdicts": url_verdicts,
    "op6_exact_duplicates": exact_duplicates,
    "op7_toxicity": toxic_documents,
    "op8_token_totals": token_totals,
    "op9_packed_sequences": packed_sequences,
    "op10_language": language,
    "op11_whitened_embeddings": whitened_embeddings,
    "op12_vector_codes": vector_codes,
    "op13_personal_data": personal_data,
}
ORACLE: dict[str, str] = {
    "op1_mix_to_weights": mixing.ORACLE,
    "op4_near_embeddings": collision_projections.ORACLE,
    "op5_url_verdicts": url_rules.ORACLE,
    "op6_exact_duplicates": chunk_recipes.ORACLE,
    "op12_vector_codes": equal_average.ORACLE,
}
