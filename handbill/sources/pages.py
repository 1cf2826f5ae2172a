"""Records from landed web pages: stubs, repeated listing rows, cards, links, candidates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from handbill.functions.dates import parse_date_range, roll_calendar_icon, roll_day_month
from handbill.functions.text import strip
from handbill.sources.markup import Cell, Element, RowLayout, layout_rows

# Title prefix and text length of a page kept for later extraction.
STUB_PREFIX = "[do ekstrakcji] "
STUB_CHARS = 2000

_NOT_TEXT = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"

def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages (``page_id``, ``url``, ``html``) with scheme-and-host and host of the url."""
    return spark.read.parquet(path).select(
        "page_id", "url",
        F.regexp_extract("url", r"^(https?://[^/?#]+)", 1).alias("base_url"),
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("domain"),
        "html",
    )


def visible_text(html: Column) -> Column:
    """Whole readable text of a page: scripts, styles, comments and tags out."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, _NOT_TEXT, " "), r"\s+", " "))


def absolute_link(href: Column, base: Column) -> Column:
    """Absolute links as they are, others joined to the base with one slash."""
    joined = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.ltrim(href, F.lit("/")))
    return F.when(href.startswith("http"), href).otherwise(joined)


def page_stub(pages: DataFrame, name: Column, body: Column, max_chars: int = STUB_CHARS) -> DataFrame:
    """One stub record per non-empty page, flagged for extraction."""
    return (
        pages.withColumn("_body", body)
        .where(F.length("_body") > 0)
        .select(
            *[c for c in pages.columns if c not in ("html", "url")],
            F.concat(F.lit(STUB_PREFIX), name).alias("title"),
            "url",
            F.substring("_body", 1, max_chars).alias("description"),
            F.lit(True).alias("needs_extraction"),
        )
    )


def _class(name: str) -> dict[str, str]:
    """A class attribute that names this class."""
    return {"class": rf"(?:^|\s){name}(?:\s|$)"}


def _classed(name: str) -> Cell:
    return Cell(Element("", _class(name)))


def _column(name: str, without: Element | None = None) -> Cell:
    both = rf"^(?=.*\bcolTab\b).*(?<![\w-]){name}(?![\w-])"
    return Cell(Element("", {"class": rf"(?s){both}"}), without=without)


# Markup of the two listing layouts.
TABLE_ROWS = RowLayout(
    Element("a", {"class": r"\bclearfix\b", "href": "/wydarzenia/"}),
    {
        "href": Cell(attribute="href"),
        "title": _column("title", without=Element("", _class("topics"))),
        "topics": _classed("topics"),
        "date": _column("date"),
        "num": _classed("num"),
        "city": _column("city"),
        "cost": _column("cost"),
        "type": _column("type"),
    },
)

CARDS = RowLayout(
    Element("div", _class("event__item")),
    {
        "block": Cell(),
        "title_name": _classed("event__item__title__name"),
        "title": _classed("event__item__title"),
        "href": Cell(Element("a", {**_class("event__item__title"), "href": ""}), "href"),
        "ticket_href": Cell(Element("a", {"href": "/impreza/"}), "href"),
        "month": _classed("calendar-icon__icon__month"),
        "day": _classed("calendar-icon__icon__day"),
        "hour": _classed("event__item__date__hour"),
        "calendar": Cell(Element("", {"class": "info__calendar"})),
        "city": _classed("event__item__location__city"),
        "place": _classed("event__item__location__place"),
        "price": _classed("event__price__info"),
        "price_label": _classed("event__price__label"),
    },
)


def html_rows(pages: DataFrame, run_ts: datetime, layout: RowLayout = TABLE_ROWS) -> DataFrame:
    """Table layout: link, title without topics, day and month, city, cost, type.

    ``pages`` carries ``source``, ``base_url`` and ``html``; rows without a title are skipped.
    """
    keep = [c for c in pages.columns if c != "html"]
    topics = F.col("topics")
    date_text = F.when(F.col("date") != "", F.col("date")).otherwise(F.col("num"))
    return (
        layout_rows(pages, layout, keep)
        .where((F.col("href") != "") & (F.col("title") != ""))
        .select(
            *keep, "row_no", "title",
            absolute_link(F.col("href"), F.col("base_url")).alias("url"),
            roll_day_month(date_text, run_ts).alias("start"),
            F.nullif(F.col("city"), F.lit("")).alias("city"),
            F.concat(
                F.col("type"),
                F.when(topics != "", F.concat(F.lit(" | "), topics)).otherwise(F.lit("")),
            ).alias("subcategory"),
            topics.alias("description"),
            F.contains(F.lower("cost"), F.lit("bezp")).alias("is_free"),
        )
    )


def html_cards(pages: DataFrame, run_ts: datetime, layout: RowLayout = CARDS,
               default_city: str = "Trojmiasto") -> DataFrame:
    """Card layout: title without the opinion count, calendar icon or date range, place, price."""
    keep = [c for c in pages.columns if c not in ("html", "force_category")]
    force = F.col("force_category") if "force_category" in pages.columns else F.lit(None)
    cells = layout_rows(
        pages.withColumn("force_category", force.cast("string")), layout, [*keep, "force_category"])
    raw_title = F.when(F.col("title_name") != "", F.col("title_name")).otherwise(F.col("title"))
    title = strip(F.regexp_replace(raw_title, r"(?U)\s*\(\s*\d+\s*opini[ae]\w*\s*\)", ""))
    href = F.when(F.col("href") != "", F.col("href")).otherwise(F.col("ticket_href"))
    icon = roll_calendar_icon(F.col("month"), F.col("day"), F.col("hour"), run_ts)
    first, last = parse_date_range(
        F.when(F.col("calendar") != "", F.col("calendar")).otherwise(F.col("block")))
    price, label = F.lower("price"), F.lower("price_label")
    city = F.rtrim(F.col("city"), F.lit(","))
    free = F.lit(False)
    for text, word in ((price, "wolny"), (label, "wolny"), (F.concat(price, label), "bezp")):
        free = free | F.contains(text, F.lit(word))
    return (
        cells.withColumn("_title", title)
        .where((F.col("_title") != "") & (F.lower("_title") != "kup bilety"))
        .select(
            *keep, "row_no",
            F.col("_title").alias("title"),
            absolute_link(href, F.col("base_url")).alias("url"),
            F.coalesce(icon, first).alias("start"),
            F.when(icon.isNull(), last).alias("end"),
            F.when(city != "", city).otherwise(F.lit(default_city)).alias("city"),
            F.col("place").alias("venue"),
            F.nullif(F.regexp_extract(price, r"(\d+)", 1), F.lit("")).alias("price_min"),
            free.alias("is_free"),
            "force_category",
        )
    )


def discover_candidates(results: DataFrame, registry_domains: DataFrame) -> DataFrame:
    """Search hits (``stream``, ``web`` array of title, url, description) on hosts that the
    registry does not have yet, for a person to look at."""
    hits = results.select("stream", F.inline("web")).select(
        F.coalesce("title", F.lit("")).alias("name"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.substring(F.coalesce("description", F.lit("")), 1, 160).alias("why"),
        F.col("stream").alias("suggested_stream"),
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("domain"),
    )
    return hits.join(registry_domains.select("domain"), "domain", "left_anti").drop("domain")
