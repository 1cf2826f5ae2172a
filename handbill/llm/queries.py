"""The operators bound to the test tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    exact, jaccard, langid, lm, middle, mixing, packing, postings, resampling, substrings, tokens, toxicity,
    vectors,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = tokens.write_token_files(
        table(spark, sf_dir, "documents"), tokens.vocabulary("byte_bpe_50k.json"))
    return written.read(spark)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out_languages(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokens.vocabulary("word_bpe_49k.json"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source", "position")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.held_out_scores(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.withColumn("output_sha256", F.sha2("output", 256)).withColumn(
        "restored_sha256", F.sha2(middle.restored(), 256)).drop("output")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = postings.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_substring_dedup, op3_token_files, op4_language_id, op5_packing,
    op6_ngram_jaccard, op7_mixing, op8_toxicity,
    op9_embedding_near_dedup, op10_lm_scoring, op11_fill_in_middle, op12_decontamination,
    op13_importance_resampling)}
