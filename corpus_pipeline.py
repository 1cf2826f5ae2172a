"""From raw documents to packed sequences: toxicity, exact and near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; its result is written
as Parquet to the shared folder and read again. All but the last return the columns of ``documents``.

- toxicity: documents with a score of 0.5 or more go; clean ones stay as they are.
- exact dedup: of equal texts (white space aside) the row with the smallest doc_id stays, once.
- n-gram Jaccard join: of each group of near duplicates the document with the smallest doc_id stays.
- mixing: a document comes as often as the mix takes it; one taken in part has its first words, and n_chars
  is theirs. Documents without words are in no mix.
- packing: one row per piece of a document, with its sequence and place.

Rows without doc_id pass the first three stages unless toxic or equal to another text. Empty tables give
empty results; columns besides those of ``documents``, whatever their names, pass through all but the last stage.
Of rows that share an id but not a text, the near copy stays if the other one does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from handbill.llm import exact, jaccard, mixing, packing, tokens, toxicity
from handbill.llm.common import saved, unused
from handbill.llm.lm import fold


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold("doc_id", 5) != 0)
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    doc_id, sha, own = unused(docs, "_id", "_sha", "_own")
    kept = exact.exact_duplicates(docs).where("kept").select(
        F.col("doc_id").alias(doc_id), F.col("text_sha256").alias(sha))
    rows = docs.withColumn(own, F.sha2(exact.normalised("text"), 256))
    return (
        rows.join(kept, F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col(own) == F.col(sha)), "left_semi")
        .dropDuplicates(["doc_id", own]).drop(own)
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (doc_id,) = unused(docs, "_id")
    kept = jaccard.similar_documents(docs).where("kept").select(F.col("doc_id").alias(doc_id))
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(doc_id)), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokens.vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned scores and minimum hashes have no SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
