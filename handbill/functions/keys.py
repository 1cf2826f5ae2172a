"""Prices and identity of an event."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from handbill.functions.text import norm, strip

_NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$"


def parse_price(c: Column) -> Column:
    """Price text to a number: comma is a decimal point, ``zl`` is dropped, else NULL.

    A number too large for a double is NULL too.
    """
    text = F.replace(F.replace(c, F.lit(","), F.lit(".")), F.lit("zl"), F.lit(""))
    text = strip(text)
    value = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def dedup_key(title_norm: Column, start: Column, city_norm: Column, venue_norm: Column) -> Column:
    """Title slug, day and place: equal for the same event whatever source lists it."""
    return F.concat_ws(
        "|",
        F.replace(title_norm, F.lit(" "), F.lit("-")),
        F.coalesce(F.date_format(start, "yyyy-MM-dd"), F.lit("no-date")),
        F.coalesce(F.nullif(city_norm, F.lit("")), venue_norm),
    )


def event_id(key: Column) -> Column:
    return F.substring(F.sha1(key), 1, 16)


def content_hash(start: Column, end: Column, city_norm: Column, venue: Column,
                 price_min: Column, price_max: Column, ticket_url: Column) -> Column:
    """Hash of the fields whose change makes a listing "updated"."""

    def when(ts: Column) -> Column:
        return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))

    def money(price: Column) -> Column:
        return F.when(price.isNull(), F.lit("None")).otherwise(F.format_string("%.2f", price))

    material = F.concat_ws(
        "|", when(start), when(end), city_norm, norm(venue),
        money(price_min), money(price_max), F.coalesce(ticket_url, F.lit("")),
    )
    return F.substring(F.sha1(material), 1, 16)
