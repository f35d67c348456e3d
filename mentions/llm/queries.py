"""One query per operator over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentions.llm import (alignment, decontaminate, divergence, itq, linededup, minhash, packing, pfor, pii, quality, sharding, substring,
                          toxicity)
from mentions.llm.common import table
from mentions.llm.oracles import ORACLES  # noqa: F401
from mentions.session import scratch_dir


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [pii.kind_count(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                        pii.joined(F.col("spans")).alias("spans"))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    pfor.write_tokens(table(spark, sf_dir, "documents"), path)
    return pfor.read_tokens(spark, path)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_audit(table(spark, sf_dir, "documents"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    # without tokens there is nothing to hash
    digest = alignment.align(table(spark, sf_dir, "documents"), render=lambda g: F.when(g == "", "").otherwise(F.sha2(g, 256)))
    return digest.withColumnRenamed("groups", "groups_sha256")


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_pii, op3_token_ids, op4_toxicity, op5_embedding_dedup, op6_minhash_dedup, op7_substring_dedup,
    op8_line_dedup, op9_packing, op10_sharding, op11_source_divergence, op12_quality, op13_alignment)}
