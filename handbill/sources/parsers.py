"""Parser names of the source registry, each a function from landed pages to raw records."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from handbill.schema import RAW_SCHEMA, with_raw_columns
from handbill.sources import jsonld, pages as page_rows
from handbill.sources.listings import registry_frame

Parser = Callable[[DataFrame, datetime], DataFrame]

# Pages given to a parser carry these registry columns next to page_id, url and html.
PAGE_COLUMNS = [
    "page_id", "url", "source", "source_name", "base_url", "default_city", "force_default_city",
    "force_category", "subcategory",
]
_IDENTITY = ["page_id", "source", "force_category"]


def place(*numbers: Column) -> Column:
    """Where a record stands in its page, from the outermost count to the innermost."""
    return F.array(*[n.cast("bigint") for n in numbers])


def _table(pages: DataFrame, run_ts: datetime) -> DataFrame:
    return page_rows.html_rows(
        pages.select(*_IDENTITY, "base_url", "html"), run_ts
    ).withColumn("place", place(F.col("row_no")))


def _cards(pages: DataFrame, run_ts: datetime) -> DataFrame:
    return page_rows.html_cards(
        pages.select(*_IDENTITY, "base_url", "html"), run_ts
    ).withColumn("place", place(F.col("row_no")))


def _walk(pages: DataFrame, run_ts: datetime) -> DataFrame:
    city = F.coalesce(F.nullif("default_city", F.lit("")), F.lit("Trojmiasto"))
    found = jsonld.jsonld_walk(
        pages.withColumn("_city", city), [*_IDENTITY, "_city"], F.col("_city")
    )
    firsts = jsonld.listing_dedup(found, ["page_id"], ["block_no", "hit_no"])
    return firsts.withColumn("place", place(F.col("block_no"), F.col("hit_no")))


def _item_list(pages: DataFrame, run_ts: datetime) -> DataFrame:
    records = jsonld.jsonld_itemlist(pages, _IDENTITY)
    return records.withColumn("place", place(F.col("item_no")))


def _extracted(pages: DataFrame, run_ts: datetime) -> DataFrame:
    documents = pages.withColumn("_page_subcategory", F.coalesce("subcategory", F.lit("")))
    return (
        jsonld.json_events(documents, "html", [*_IDENTITY, "_page_subcategory"], run_ts)
        .withColumn("subcategory", F.col("_page_subcategory"))
        .withColumn("place", place(F.col("entry_no")))
    )


def _stub(pages: DataFrame, run_ts: datetime) -> DataFrame:
    stubs = page_rows.page_stub(
        pages, F.col("source_name"), page_rows.visible_text(F.col("html"))
    )
    return stubs.withColumn("place", place(F.lit(0)))


# Parser names that existing source lists use.
ALIASES = {
    "python_crossweb": "table_rows", "python_trojmiasto": "cards", "python_meetup": "jsonld_walk",
    "python_ebilet": "jsonld_itemlist", "firecrawl_json_events": "json_events",
    "generic_firecrawl": "page_stub",
}

PARSERS: dict[str, Parser] = {
    "table_rows": _table,
    "cards": _cards,
    "jsonld_walk": _walk,
    "jsonld_itemlist": _item_list,
    "json_events": _extracted,
    "page_stub": _stub,
}


def parser_name(source: dict) -> str | None:
    """The parser of a source: its own or the alias's, the stub for a metered source without one."""
    name = source.get("parser") or source.get("parse")
    if not name and source.get("method") == "firecrawl":
        return "page_stub"
    return ALIASES.get(name, name)


def parse_pages(pages: DataFrame, sources: list[dict], run_ts: datetime,
                parsers: dict[str, Parser] | None = None) -> DataFrame:
    """Raw records of landed pages (``page_id``, ``source``, ``url``, ``html``).

    Each page goes through the parser its source names in the configured list. A parser
    reads only the pages of its sources: land pages partitioned by ``source``, and each
    branch scans its own folders instead of everything. Sources without a known parser give
    no records. Add a layout by adding a named function to ``parsers``.

    Next to the raw columns, records carry ``page_id`` and ``place``, which order them within their
    source; ``seq`` is NULL until all sources are numbered together.
    """
    available = parsers or PARSERS
    by_parser: dict[str, list[str]] = {}
    for source in sources:
        name = parser_name(source)
        if name in available:
            by_parser.setdefault(name, []).append(source["id"])
    known = registry_frame(pages.sparkSession, sources).select(
        F.col("source_id").alias("source"), F.col("name").alias("source_name"),
        F.col("base_url").alias("_base"), "default_city", "force_default_city",
        "force_category", "subcategory",
    )
    base = F.coalesce("_base", F.regexp_extract("url", r"^(https?://[^/?#]+)", 1))
    frames = []
    for name, ids in by_parser.items():
        own = (
            pages.where(F.col("source").isin(ids))
            .join(F.broadcast(known), "source")  # one row per configured source
            .withColumn("base_url", base)
            .select(*PAGE_COLUMNS, "html")
        )
        frames.append(with_raw_columns(available[name](own, run_ts), "page_id", "place"))
    if not frames:
        schema = T.StructType(RAW_SCHEMA.fields + [
            T.StructField("page_id", T.LongType()), T.StructField("place", T.ArrayType(T.LongType()))])
        return pages.sparkSession.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), frames)
