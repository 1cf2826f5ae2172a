"""The listing view over ``documents`` and the source registry derived from it.

One SQL text per view serves both engines; only type names and array functions differ.
Titles are whole first lines and descriptions are whole texts.
"""

from __future__ import annotations

from datetime import datetime
from itertools import product

from pyspark.sql import DataFrame, SparkSession, functions as F

from handbill.config import RunConfig, default_rules
from handbill.session import spread

RUN_TS = datetime(2024, 2, 1, 12, 0)
ORDERS_RUN_TS = datetime(1996, 6, 5, 12, 0)

# Keyword lists that occur in the invented prose of the test tables.
TEST_RULES = {
    **default_rules(),
    "tricity_surroundings": ["gdansk", "gdynia", "sopot", "rumia"],
    "major_cities": ["warszawa", "krakow", "gdansk"],
    "large_event": {"min_days": 2, "known_brands": ["bleed", "data"]},
    "world_class": {
        "large_venues": ["ergo arena"], "allowlist": ["tour"],
        "trusted_sources": ["src2", "src13"],
    },
    "exclusions": {
        "keywords": ["mente", " la "], "subcategories": ["de"], "adult_only": ["onsh"],
    },
    "family": {"kids_keywords": ["eau", "wh"]},
    "classify": {
        "ai_digital": ["ai", "data", "bleed"],
        "culture_family": ["eau", "cion", "wh"],
        "concert": ["tour", "and", "ver"],
    },
    "source_trust": {"src0": 0.9, "src1": 0.85, "src2": 0.8, "src3": 0.7, "src4": 0.6},
}

# A list too long for one expression a word: all three-letter words over a part of the alphabet.
MANY_KEYWORDS = ["".join(word) for word in product("etaoinsrhldcu", repeat=3)]

RUN = RunConfig(RUN_TS, TEST_RULES)
CAPPED_RUN = RunConfig(RUN_TS, TEST_RULES, max_per_stream=10)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _hex(expression: str, place: int) -> str:
    return f"(position(substr(md5({expression}), {place}, 1) IN '0123456789abcdef') - 1)"


def listing_sql(documents: str, text_type: str, time_type: str) -> str:
    return f"""
SELECT doc_id AS seq, source,
  'https://' || source || '.example/' || CAST(doc_id AS {text_type}) AS source_url,
  CASE WHEN doc_id % 2 = 0
       THEN 'https://' || source || '.example/' || CAST(doc_id AS {text_type}) END AS ticket_url,
  title,
  CASE h2 % 8 WHEN 0 THEN NULL
       ELSE CAST(DATE '2024-01-15' + CAST(h1*4+h2 AS INT) AS {time_type}) END AS start_datetime,
  CASE WHEN h3 >= 12 AND h2 % 8 <> 0
       THEN CAST(DATE '2024-01-15' + CAST(h1*4+h2+h3-12 AS INT) AS {time_type}) END AS end_datetime,
  CASE h1 % 6 WHEN 0 THEN 'Gdańsk' WHEN 1 THEN 'Gdynia, Galeria' WHEN 2 THEN 'Warszawa'
       WHEN 3 THEN 'Kraków' WHEN 4 THEN NULL ELSE 'Rumia' END AS city,
  CASE WHEN h2 % 3 = 0 THEN 'Ergo Arena' WHEN h2 % 3 = 1 THEN 'Klub B90' END AS venue_name,
  CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 0.0e0
       ELSE CAST(n_chars % 300 AS DOUBLE) END AS price_min,
  CASE doc_id % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_free,
  CASE WHEN h3 % 4 = 0 THEN title END AS artist,
  lang AS subcategory, text AS description
FROM (SELECT *, {_hex('title', 1)} AS h1, {_hex('title', 2)} AS h2, {_hex('title', 3)} AS h3
      FROM (SELECT doc_id, source, lang, n_chars, text,
                   trim(split_part(text, chr(10), 1)) AS title FROM {documents}) t
      WHERE title <> '') h"""


def registry_sql(documents: str, split: str) -> str:
    return f"""
SELECT source AS source_id,
  {split}(CASE h1 % 4 WHEN 0 THEN 'ai_digital,concert' WHEN 1 THEN 'culture_family,concert'
            WHEN 2 THEN 'concert,other,culture_family,ai_digital' END, ',') AS streams,
  h2 < 12 AS enabled,
  CASE WHEN h3 < 3 THEN 'concert' END AS force_category
FROM (SELECT source, {_hex('source', 1)} AS h1, {_hex('source', 2)} AS h2,
             {_hex('source', 3)} AS h3
      FROM (SELECT DISTINCT source FROM {documents}) d) h"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed listing view."""
    return spark.sql(
        listing_sql("{documents}", "STRING", "TIMESTAMP_NTZ"),
        documents=spread(table(spark, sf_dir, "documents")),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        registry_sql("{documents}", "split"), documents=table(spark, sf_dir, "documents")
    )


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing view as a feed would send it: padded titles, several date and price
    layouts, links under either key."""
    seq = F.col("seq")
    start, end = F.col("start_datetime"), F.col("end_datetime")
    price = F.col("price_min").cast("decimal(12,2)").cast("string")
    start_text = (
        F.when(seq % 4 == 0, F.date_format(start, "yyyy-MM-dd"))
        .when(seq % 4 == 1, F.date_format(start, "yyyy-MM-dd HH:mm"))
        .when(seq % 4 == 2, F.date_format(start, "dd.MM.yyyy"))
        .otherwise(
            F.date_format(start - F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss'.000Z'")
        )
    )
    return listings(spark, sf_dir).select(
        "seq", "source",
        F.when(seq % 3 == 0, F.concat(F.lit("  "), "title", F.lit("\t "))).otherwise(
            F.col("title")
        ).alias("title"),
        F.when(seq % 2 == 0, F.col("source_url")).alias("url"),
        F.when(seq % 2 == 1, F.col("source_url")).alias("source_url"),
        F.when(seq % 5 == 0, F.lit("")).otherwise(start_text).alias("start"),
        F.when(seq % 5 == 0, start_text).alias("start_datetime"),
        F.date_format(end, "yyyy-MM-dd HH:mm").alias("end"),
        "city", "venue_name", "subcategory", "artist", "is_free",
        F.when(seq % 3 == 0, F.replace(price, F.lit("."), F.lit(",")))
        .when(seq % 3 == 1, F.concat(price, F.lit(" zl")))
        .otherwise(price)
        .alias("price_min"),
        F.concat(F.lit("\n "), F.col("description"), F.lit(" \n")).alias("description"),
    )


def duck_listing() -> str:
    return listing_sql("documents", "VARCHAR", "TIMESTAMP")


def duck_registry() -> str:
    return registry_sql("documents", "string_split")
