"""Assign each event to one stream by keyword hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from handbill.config import STREAMS
from handbill.functions.text import keyword_hits

# Fixed value: extra concert points for a record that names an artist.
ARTIST_BONUS = 2


def stream_scores(rules: dict) -> dict[str, Column]:
    """Points per stream over ``class_text`` and ``artist``."""
    scores = {s: keyword_hits(F.col("class_text"), rules["classify"][s]) for s in STREAMS}
    has_artist = F.coalesce(F.col("artist"), F.lit("")) != ""
    scores["concert"] = scores["concert"] + F.when(has_artist, ARTIST_BONUS).otherwise(0)
    return scores


def classify(events: DataFrame, rules: dict, selected) -> DataFrame:
    """Set ``category``: a forced one wins; else the stream with most points among those the
    source serves (all selected ones when it names none), the earlier one on a tie; NULL
    without any hit."""
    scored = events.withColumn(
        "_scores", F.struct(*[score.alias(name) for name, score in stream_scores(rules).items()])
    )
    selected_array = F.array(*[F.lit(s) for s in selected])
    streams = F.when(
        F.coalesce(F.size("source_streams"), F.lit(0)) > 0, F.col("source_streams")
    ).otherwise(selected_array)

    def points(stream: Column) -> Column:
        value = F.lit(None).cast("int")
        for name in STREAMS:
            value = F.when(stream == name, F.col(f"_scores.{name}")).otherwise(value)
        return value

    known = F.filter(streams, lambda s: s.isin(*STREAMS))
    best = F.array_max(
        F.transform(
            known,
            lambda s, i: F.struct(points(s).alias("points"), (-i).alias("order"), s.alias("stream")),
        )
    )
    return (
        scored.withColumn("_best", best)
        .withColumn(
            "category",
            F.coalesce(
                F.nullif("force_category", F.lit("")),
                F.when(F.col("_best.points") > 0, F.col("_best.stream")),
            ),
        )
        .drop("_scores", "_best")
    )
