"""Collapse copies of one event inside a run: most trusted source wins, gaps are filled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from handbill.config import DEFAULT_TRUST

_STRINGS = (
    "source_url", "title", "city", "venue_name", "address", "description", "ticket_url",
    "artist", "category", "subcategory", "scope_reason",
)
_NUMBERS = ("price_min", "price_max", "relevance_score")
_FLAGS = ("is_free", "national_scope", "family_suitable")
_TIMES = ("start_datetime", "end_datetime", "scraped_at")


def source_trust(source: Column, trust: dict[str, float]) -> Column:
    """Configured trust of a source, 0.5 for one the rules do not list."""
    if not trust:
        return F.lit(DEFAULT_TRUST)
    pairs = [F.lit(x) for name, value in trust.items() for x in (name, float(value))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), source), F.lit(DEFAULT_TRUST))


def first_filled(value: Column, order: Column, filled: Column) -> Column:
    """The value of the first row, in the given order, that satisfies ``filled``."""
    return F.min_by(F.when(filled, value), F.when(filled, order))


def merged_columns(order: Column, columns) -> dict[str, Column]:
    """Aggregates that rebuild the survivor of a group.

    Text: first non-empty value in trust order, else the survivor's own. Numbers: first
    non-zero one, else 0 if any row says 0. Flags: true beats false beats unknown.
    """
    out: dict[str, Column] = {}
    for name in columns:
        c = F.col(name)
        if name in _STRINGS:
            out[name] = F.coalesce(first_filled(c, order, c != ""), F.min_by(c, order))
        elif name in _NUMBERS:
            out[name] = F.coalesce(
                first_filled(c, order, c != 0), F.max(F.when(c == 0, F.lit(0.0)))
            )
        elif name in _FLAGS:
            out[name] = F.bool_or(c)
        elif name in _TIMES:
            out[name] = first_filled(c, order, c.isNotNull())
        else:
            out[name] = F.min_by(c, order)
    return out


def within_run_dedup(events: DataFrame, trust: dict[str, float]) -> DataFrame:
    """One row per ``dedup_key``: survivor by trust, then arrival, with merged fields.

    A single aggregation with map-side partials: copies of one event collapse before the
    exchange, so a key that holds a third of the rows sends one row per map task.
    """
    order = F.struct((-source_trust(F.col("source"), trust)).alias("t"), F.col("seq").alias("s"))
    columns = [c for c in events.columns if c not in ("dedup_key", "seq")]
    merged = merged_columns(order, columns)
    return events.groupBy("dedup_key").agg(
        F.min_by("seq", order).alias("seq"),
        F.count(F.lit(1)).alias("n_copies"),
        *[merged[c].alias(c) for c in columns],
    )
