"""Exclusion, place and time rules; one pass that records why a row is dropped."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from handbill.config import FALLBACK_KIDS_KEYWORDS, RunConfig
from handbill.functions.text import contains_any, first_contained

# The drop reasons a run can report.
NO_CATEGORY = "no_category"
SPORTS = "excluded:sports_or_league_match"
GEO_AI = "geo:ai_digital_outside_tricity_not_large"
GEO_CULTURE = "geo:culture_family_outside_tricity"
GEO_CONCERT = "geo:concert_outside_tricity_not_world_class"
PAST = "date:past"
BEYOND = "date:beyond_window"
DROP_REASONS = (NO_CATEGORY, SPORTS, GEO_AI, GEO_CULTURE, GEO_CONCERT, PAST, BEYOND)


def _fold_literal(text: str) -> str:
    """A configured word in the folded form of the texts it is compared with."""
    import unicodedata

    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join(plain.lower().split())


def _one_of(c: Column, words) -> Column:
    words = [_fold_literal(w) for w in words]
    return c.isin(*words) if words else F.lit(False)


def is_excluded_sports(rules: dict) -> Column:
    """A sports keyword in the text, or a sports subcategory."""
    exclusions = rules["exclusions"]
    return contains_any(F.col("match_text"), exclusions["keywords"]) | _one_of(
        F.col("subcategory_norm"), exclusions["subcategories"]
    )


def large_event_reason(rules: dict) -> Column:
    """Why an event is large (known brand, else number of days), NULL when it is not."""
    large = rules["large_event"]
    brand = first_contained(F.col("match_text"), large["known_brands"])
    days = F.datediff(F.to_date("end_datetime"), F.to_date("start_datetime")) + 1
    return F.coalesce(
        F.concat(F.lit("known_brand:"), brand),
        F.when(
            days >= large["min_days"], F.concat(F.lit("multiday:"), days.cast("string"), F.lit("d"))
        ),
    )


def world_class_reason(rules: dict) -> Column:
    """Why a concert is world class (source, artist, venue in this order), NULL when it is not."""
    world = rules["world_class"]
    trusted = world.get("trusted_sources") or []
    from_source = F.when(
        F.col("source").isin(*trusted) if trusted else F.lit(False),
        F.concat(F.lit("trusted_source:"), F.col("source")),
    )
    text = F.col("match_text")
    return F.coalesce(
        from_source,
        F.concat(F.lit("allowlist:"), first_contained(text, world["allowlist"])),
        F.concat(F.lit("large_venue:"), first_contained(text, world["large_venues"])),
    )


def family_suitability(rules: dict) -> Column:
    """False for adult words, else true for family words, else NULL (not known)."""
    kids = rules.get("family", {}).get("kids_keywords") or FALLBACK_KIDS_KEYWORDS
    text = F.col("match_text")
    return F.when(contains_any(text, rules["exclusions"]["adult_only"]), F.lit(False)).when(
        contains_any(text, kids), F.lit(True)
    )


def with_geo(events: DataFrame, rules: dict) -> DataFrame:
    """Place rule per stream: ``geo_drop``, ``national_scope``, ``scope_reason`` and
    ``family_suitable``."""
    category = F.col("category")
    city = F.col("city_norm")
    near = _one_of(city, rules["tricity_surroundings"])
    major = _one_of(city, rules["major_cities"])
    judged = events.withColumns(
        {
            "_large": F.when((category == "ai_digital") & ~near & major, large_event_reason(rules)),
            "_world": F.when(
                (category == "concert") & ~F.col("is_tricity"), world_class_reason(rules)
            ),
            "family_suitable": F.when(
                category == "culture_family", family_suitability(rules)
            ).otherwise(F.col("family_suitable")),
        }
    )
    large, world = F.col("_large"), F.col("_world")
    geo_drop = (
        F.when(category == "ai_digital", F.when(~near & large.isNull(), F.lit(GEO_AI)))
        .when(category == "culture_family", F.when(~F.col("is_tricity"), F.lit(GEO_CULTURE)))
        .when(
            category == "concert",
            F.when(~F.col("is_tricity") & world.isNull(), F.lit(GEO_CONCERT)),
        )
        .otherwise(F.lit(NO_CATEGORY))
    )
    return judged.withColumns(
        {
            "geo_drop": geo_drop,
            "national_scope": large.isNotNull() | world.isNotNull(),
            "scope_reason": F.coalesce(
                F.concat(F.lit("large_event:"), large),
                F.concat(F.lit("world_class:"), world),
                F.lit(""),
            ),
        }
    ).drop("_large", "_world")


def window_end(config: RunConfig) -> Column:
    """Last admissible start: longer for concerts, longest for national ones."""

    def after(days: int) -> Column:
        end = config.run_ts + timedelta(days=days)
        if config.inclusive_last_day:
            end = end.replace(hour=23, minute=59, second=59, microsecond=999999)
        return F.lit(end).cast("timestamp_ntz")

    concert = F.col("category") == "concert"
    return (
        F.when(concert & F.col("national_scope"), after(config.national_window_days))
        .when(concert, after(config.concert_window_days))
        .otherwise(after(config.date_window_days))
    )


def date_drop(config: RunConfig) -> Column:
    """Reason to drop by date, NULL for events that overlap the window or have no start."""
    start = F.col("start_datetime")
    last_day = F.to_date(F.coalesce("end_datetime", "start_datetime"))
    return F.when(
        start.isNotNull(),
        F.when(last_day < F.lit(config.run_ts.date()), F.lit(PAST)).when(
            start > window_end(config), F.lit(BEYOND)
        ),
    )


def apply_filters(events: DataFrame, config: RunConfig) -> DataFrame:
    """Add ``drop_reason``: the first rule that refuses the row, NULL for a kept one.

    Reads the columns of ``with_text``, ``with_identity`` and ``classify``. Nothing is
    filtered out here, so kept rows and drop counts come from the same pass.
    """
    rules = config.rules
    refused = events.withColumn(
        "_refused",
        F.when(F.col("category").isNull(), F.lit(NO_CATEGORY)).when(
            (F.col("category") == "culture_family") & is_excluded_sports(rules), F.lit(SPORTS)
        ),
    )
    open_rows = F.col("_refused").isNull()
    judged = with_geo(refused, rules).withColumn(
        "family_suitable", F.when(open_rows, F.col("family_suitable"))
    )
    # A one-element explode: filters and groupings on the reason stay above it. Pushed down,
    # they would repeat every rule, keyword test and date parse inside the filter.
    reason = F.explode(F.array(F.coalesce("_refused", "geo_drop", date_drop(config))))
    return judged.select("*", reason.alias("drop_reason")).drop("_refused", "geo_drop")

