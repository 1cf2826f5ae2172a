"""Events in JSON: structured-data blocks of pages and extraction results."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from handbill.functions.dates import fix_year
from handbill.functions.text import first_of, strip

_BLOCK = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"


def jsonld_blocks(pages: DataFrame, keep: list[str]) -> DataFrame:
    """One row per readable block: kept columns, ``block_no``, ``json`` text, ``doc`` variant.
    Blocks that are no JSON are skipped."""
    return jsonld_attempts(pages, keep).where(F.col("doc").isNotNull())


def jsonld_attempts(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Like :func:`jsonld_blocks`, with a NULL ``doc`` for unreadable blocks."""
    found = F.transform(
        F.regexp_extract_all("html", F.lit(_BLOCK), F.lit(1)),
        lambda json: F.struct(json.alias("json"), F.try_parse_json(json).alias("doc")),
    )
    return pages.select(*keep, F.posexplode(found).alias("block_no", "block")).select(
        *keep, "block_no", "block.json", "block.doc"
    )


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _is_text(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING"


def _has_name(v: Column) -> Column:
    return F.coalesce(_is_text(v, "$.name") & (_text(v, "$.name") != ""), F.lit(False))


def _has_start(v: Column) -> Column:
    return F.coalesce(~_text(v, "$.startDate").isin("", "0", "false", "{}", "[]"), F.lit(False))


def walk_events(doc: Column, json: Column) -> Column:
    """All objects with a name and a start date in a document, at any depth.

    A fold that opens one nesting level per step and stops adding when a level is empty; the
    number of opening brackets bounds the depth, so nothing is cut off. Each hit carries its
    path (child numbers; members of an object by key), which orders hits inside a block.
    """
    node = "array<struct<path:array<int>,v:variant>>"
    hit = (
        "array<struct<path:array<int>,name:string,start:string,"
        "city:string,venue:string,url:string>>"
    )
    brackets = F.length(json) - F.length(F.translate(json, "{[", ""))
    root = F.array(F.struct(F.array().cast("array<int>").alias("path"), doc.alias("v")))
    start = F.struct(root.cast(node).alias("level"), F.array().cast(hit).alias("hits"))

    def children(parent: Column) -> Column:
        def numbered(values: Column) -> Column:
            return F.transform(
                values,
                lambda child, i: F.struct(
                    F.concat(parent["path"], F.array(i)).alias("path"), child.alias("v")
                ),
            )

        return F.coalesce(
            numbered(F.map_values(F.try_variant_get(parent["v"], "$", "map<string,variant>"))),
            numbered(F.try_variant_get(parent["v"], "$", "array<variant>")),
            F.array().cast(node),
        ).cast(node)

    def describe(n: Column) -> Column:
        v = n["v"]
        return F.struct(
            n["path"].alias("path"),
            _text(v, "$.name").alias("name"),
            _text(v, "$.startDate").alias("start"),
            _text(v, "$.location.address.addressLocality").alias("city"),
            _text(v, "$.location.name").alias("venue"),
            _text(v, "$.url").alias("url"),
        )

    def step(acc: Column, _: Column) -> Column:
        found = F.filter(acc["level"], lambda n: _has_name(n["v"]) & _has_start(n["v"]))
        return F.when(F.size(acc["level"]) == 0, acc).otherwise(
            F.struct(
                F.flatten(F.transform(acc["level"], children)).cast(node).alias("level"),
                F.concat(acc["hits"], F.transform(found, describe).cast(hit))
                .cast(hit)
                .alias("hits"),
            )
        )

    return F.aggregate(
        F.sequence(F.lit(0), brackets), start, step, lambda acc: acc["hits"]
    )


def jsonld_walk(pages: DataFrame, keep: list[str], default_city: Column,
                subcategory: str = "meetup") -> DataFrame:
    """Raw records of every event object in a page's blocks, copies included."""
    hits = F.array_sort(walk_events(F.col("doc"), F.col("json")))
    return (
        jsonld_blocks(pages, keep)
        .select(*keep, "block_no", F.posexplode(hits).alias("hit_no", "hit"))
        .select(
            *keep, "block_no", "hit_no",
            F.col("hit.name").alias("title"),
            F.col("hit.start").alias("start"),
            F.coalesce(F.nullif("hit.city", F.lit("")), default_city).alias("city"),
            F.col("hit.venue").alias("venue"),
            F.col("hit.url").alias("url"),
            F.lit(subcategory).alias("subcategory"),
        )
    )


def listing_dedup(records: DataFrame, listing: list[str], order: list[str],
                  title: str = "title", start: str = "start") -> DataFrame:
    """The first record per listing, title and day, in the given order; partial aggregation
    leaves one row per group and task before the exchange."""
    day = F.coalesce(F.substring(F.col(start).cast("string"), 1, 10), F.lit(""))
    first = F.min_by(F.struct(*records.columns), F.struct(*order))
    return (
        records.groupBy(*listing, F.col(title).alias("_title"), day.alias("_day"))
        .agg(first.alias("_first"))
        .select("_first.*")
    )


def jsonld_itemlist(pages: DataFrame, keep: list[str], subcategory: str = "koncert") -> DataFrame:
    """Raw records of the first item list of a page. Narrow: no exchange."""
    docs = F.transform(F.regexp_extract_all("html", F.lit(_BLOCK), F.lit(1)), F.try_parse_json)
    lists = F.filter(docs, lambda d: F.coalesce(_text(d, "$.@type") == "ItemList", F.lit(False)))
    items = F.try_variant_get(
        F.try_element_at(lists, F.lit(1)), "$.itemListElement", "array<variant>"
    )
    element = F.coalesce(F.try_variant_get("element", "$.item", "variant"), F.col("element"))
    place = _text(F.col("item"), "$.location.name")
    city = F.coalesce(
        F.nullif(_text(F.col("item"), "$.location.address.addressLocality"), F.lit("")),
        F.when(place != "", strip(F.split_part(place, F.lit(","), F.lit(1)))),
    )
    return (
        pages.select(*keep, F.posexplode(items).alias("item_no", "element"))
        .withColumn("item", element)
        .where(_has_name(F.col("item")))
        .select(
            *keep, "item_no",
            _text(F.col("item"), "$.name").alias("title"),
            _text(F.col("item"), "$.startDate").alias("start"),
            city.alias("city"),
            F.lit(None).cast("string").alias("venue"),
            _text(F.col("item"), "$.url").alias("url"),
            _text(F.col("item"), "$.url").alias("ticket_url"),
            _text(F.col("item"), "$.name").alias("artist"),
            F.lit(subcategory).alias("subcategory"),
        )
    )


_EXTRACTED = (
    "events ARRAY<STRUCT<name: STRING, date: STRING, city: STRING, venue: STRING, url: STRING>>"
)


def json_events(documents: DataFrame, json: str, keep: list[str], run_ts: datetime,
                subcategory: str = "") -> DataFrame:
    """Raw records of extraction results ``{"events": [...]}``.

    ``documents`` carries ``default_city``, ``force_default_city`` and ``base_url``. Nameless
    entries are skipped, past dates moved to the current year, unreadable results give none.
    """
    events = F.from_json(F.col(json), _EXTRACTED)["events"]
    settings = ["default_city", "force_default_city", "base_url"]
    extra = [c for c in settings if c not in keep]
    return (
        documents.select(*keep, *extra, F.posexplode(events).alias("entry_no", "e"))
        .where(F.coalesce(F.col("e.name"), F.lit("")) != "")
        .select(
            *keep, "entry_no",
            F.col("e.name").alias("title"),
            fix_year(F.col("e.date"), run_ts).alias("start"),
            F.when(F.col("force_default_city"), F.col("default_city"))
            .otherwise(first_of(F.col("e.city"), F.col("default_city")))
            .alias("city"),
            F.col("e.venue").alias("venue"),
            F.col("e.name").alias("artist"),
            F.lit(subcategory).alias("subcategory"),
            first_of(F.col("e.url"), F.col("base_url")).alias("url"),
        )
    )
