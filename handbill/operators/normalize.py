"""Raw record to canonical event, and the text columns the rules read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from handbill.functions.dates import parse_trimmed_dt
from handbill.functions.keys import dedup_key, parse_price
from handbill.functions.text import first_of, is_home_city, known_city, norm, strip
from handbill.schema import with_raw_columns


def normalize(raw: DataFrame, run_ts: datetime) -> DataFrame:
    """Alias keys, trim, parse and drop untitled records.

    Page stubs that still need extraction are no events and are left out; the source report
    counts them. A price of 0 makes an event free when the feed does not say.
    """
    r = with_raw_columns(raw)
    title = strip(F.col("title"))
    # Trimmed in a step of their own: the parser refers to its input many times.
    r = r.withColumns(
        {
            "start": strip(first_of(F.col("start"), F.col("start_datetime"))),
            "end": strip(first_of(F.col("end"), F.col("end_datetime"))),
        }
    )
    parsed = (
        r.where((F.coalesce(title, F.lit("")) != "") & ~F.coalesce("needs_extraction", F.lit(False)))
        .select(
            "seq",
            "source",
            F.coalesce(first_of(F.col("url"), F.col("source_url")), F.lit("")).alias("source_url"),
            title.alias("title"),
            parse_trimmed_dt(F.col("start"), run_ts).alias("start_datetime"),
            parse_trimmed_dt(F.col("end"), run_ts).alias("end_datetime"),
            "city",
            first_of(F.col("venue"), F.col("venue_name")).alias("venue_name"),
            "address",
            F.nullif(strip(F.col("description")), F.lit("")).alias("description"),
            parse_price(F.col("price_min")).alias("price_min"),
            parse_price(F.col("price_max")).alias("price_max"),
            "is_free",
            first_of(F.col("ticket_url"), F.col("url")).alias("ticket_url"),
            "artist",
            "subcategory",
            F.nullif("force_category", F.lit("")).alias("force_category"),
            "source_streams",
        )
    )
    price_is_zero = F.coalesce((F.col("price_min") == 0) | (F.col("price_max") == 0), F.lit(False))
    return parsed.withColumns(
        {
            "is_free": F.coalesce("is_free", F.when(price_is_zero, F.lit(True))),
            "category": F.lit(None).cast("string"),
            "national_scope": F.lit(False),
            "scope_reason": F.lit(""),
            "family_suitable": F.lit(None).cast("boolean"),
            "relevance_score": F.lit(0.0),
            "scraped_at": F.lit(run_ts).cast("timestamp_ntz"),
        }
    )


def with_text(events: DataFrame, fold_stroke: bool = False) -> DataFrame:
    """Folded texts, each computed once: title, place, the classified text and the full text."""
    folded = events.withColumns(
        {
            "title_norm": norm(F.col("title"), fold_stroke),
            "subcategory_norm": norm(F.col("subcategory"), fold_stroke),
            "description_norm": norm(F.col("description"), fold_stroke),
            "venue_norm": norm(F.col("venue_name"), fold_stroke),
            "address_norm": norm(F.col("address"), fold_stroke),
            "artist_norm": norm(F.col("artist"), fold_stroke),
            "city_norm": norm(F.col("city"), fold_stroke),
        }
    )

    def joined(*names: str) -> Column:
        return F.concat_ws(" ", *[F.col(n) for n in names])

    return (
        folded.withColumn("city_norm", known_city(F.col("city_norm")))
        .withColumn("class_text", joined("title_norm", "subcategory_norm", "description_norm"))
        .withColumn(
            "match_text", joined("class_text", "venue_norm", "address_norm", "artist_norm")
        )
        .drop("description_norm", "address_norm", "artist_norm")
    )


def with_identity(events: DataFrame) -> DataFrame:
    """Home-area flag and dedup key, from the columns of :func:`with_text`."""
    return events.withColumns(
        {
            "is_tricity": is_home_city(F.col("city_norm")),
            "dedup_key": dedup_key(
                F.col("title_norm"), F.col("start_datetime"),
                F.col("city_norm"), F.col("venue_norm"),
            ),
        }
    )
