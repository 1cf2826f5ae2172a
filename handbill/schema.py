"""Schemas of the raw record, the canonical event and the state snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

_S, _D, _B, _L = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType()
_TS = T.TimestampNTZType()

RAW_FIELDS = [
    ("source", _S), ("title", _S), ("url", _S), ("source_url", _S),
    ("start", _S), ("start_datetime", _S), ("end", _S), ("end_datetime", _S),
    ("city", _S), ("venue", _S), ("venue_name", _S), ("address", _S),
    ("description", _S), ("ticket_url", _S), ("artist", _S), ("subcategory", _S),
    ("force_category", _S), ("price_min", _S), ("price_max", _S),
    ("is_free", _B), ("needs_extraction", _B),
    ("seq", _L), ("source_streams", T.ArrayType(_S)),
]
RAW_SCHEMA = T.StructType([T.StructField(n, t) for n, t in RAW_FIELDS])

EVENT_FIELDS = [
    ("source", _S), ("source_url", _S), ("title", _S),
    ("start_datetime", _TS), ("end_datetime", _TS),
    ("city", _S), ("venue_name", _S), ("address", _S), ("description", _S),
    ("price_min", _D), ("price_max", _D), ("is_free", _B), ("ticket_url", _S),
    ("artist", _S), ("category", _S), ("subcategory", _S),
    ("national_scope", _B), ("scope_reason", _S), ("family_suitable", _B),
    ("relevance_score", _D), ("scraped_at", _TS),
]
EVENT_COLUMNS = [n for n, _ in EVENT_FIELDS]

STATE_FIELDS = (
    [("id", _S), ("dedup_key", _S)]
    + EVENT_FIELDS[:-2]
    + [("is_tricity", _B), ("relevance_score", _D), ("content_hash", _S),
       ("scraped_at", _TS), ("delivered", _B), ("delivered_at", _TS)]
)
STATE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in STATE_FIELDS])
STATE_COLUMNS = [n for n, _ in STATE_FIELDS]


def with_raw_columns(df: DataFrame, *keep: str) -> DataFrame:
    """Give a frame every raw column, NULL where it has none; of others only ``keep`` stay."""
    have = set(df.columns)
    return df.select(
        *[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in RAW_FIELDS],
        *keep,
    )
