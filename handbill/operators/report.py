"""Counts of a run: per source, per drop reason, totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from handbill.config import RunConfig
from handbill.operators.rules import DROP_REASONS


def drop_report(judged: DataFrame) -> DataFrame:
    """Rows per drop reason."""
    return (
        judged.where(F.col("drop_reason").isNotNull())
        .groupBy("drop_reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def source_drop_matrix(judged: DataFrame, reasons=DROP_REASONS) -> DataFrame:
    """One row per source: rows found, kept, and dropped for each reason, 0 where none.

    A reason's column has its name with an underscore for the colon.
    """
    reason = F.col("drop_reason")
    return judged.groupBy("source").agg(
        F.count(F.lit(1)).alias("found"), F.count_if(reason.isNull()).alias("kept"),
        *[F.count_if(reason == name).alias(name.replace(":", "_")) for name in reasons],
    )


def broken_sources(history: DataFrame, current: DataFrame, least: int = 1) -> DataFrame:
    """Sources that gave at least ``least`` records in every earlier run and none in this one, while others did.

    ``history`` holds (run, source, found), ``current`` (source, found). A run in which a source has no row
    gave it nothing; a run of which no source has a row is not known. A source that was asked and gave
    nothing and one that is missing from ``current`` are both broken; one new to the runs is not. If no source
    gave anything this time, the run failed as a whole and none is flagged.
    """
    runs = history.agg(F.count_distinct("run")).scalar()
    found = history.groupBy("run", "source").agg(F.sum("found").alias("found")).where(F.col("found") >= least)
    usual = found.groupBy("source").agg(F.min("found").alias("least_found"), F.count("*").alias("runs"))
    now = current.groupBy("source").agg(F.sum("found").alias("found")).where(F.col("found") > 0).select("source")
    return usual.where((F.col("runs") == runs) & now.exists()).join(now, "source", "left_anti")


def source_outcomes(attempts: DataFrame) -> DataFrame:
    """One row per source from its attempts (``source``, ``n_records``, ``error``).

    A failed attempt is a row with an error text; it never stops the others. The error shown
    is the alphabetically first one.
    """
    return attempts.groupBy("source").agg(
        F.sum("n_records").alias("found"),
        (F.count("error") == 0).alias("ok"),
        F.min("error").alias("error"),
    )


def source_report(registry: DataFrame, raw: DataFrame) -> DataFrame:
    """Records found per registered source, also for those that gave none; stubs apart."""
    stub = F.coalesce("needs_extraction", F.lit(False))
    counts = raw.groupBy(F.col("source").alias("source_id")).agg(
        F.count(F.lit(1)).alias("found"), F.count_if(stub).alias("stubs")
    )
    return registry.join(counts, "source_id", "left").withColumns(
        {"found": F.coalesce("found", F.lit(0)), "stubs": F.coalesce("stubs", F.lit(0))}
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Single-row frames side by side."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def funnel(judged: DataFrame, deduped: DataFrame, delivered: DataFrame) -> DataFrame:
    """One row: events after normalising, after dedup, and in the digest."""

    def total(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    return one_row(
        total(judged, "events_found"), total(deduped, "events_kept"),
        total(delivered, "events_delivered"),
    )


def run_status(failures: Column) -> Column:
    """0 when every source worked, 1 when some failed."""
    return F.when(failures > 0, F.lit(1)).otherwise(F.lit(0))


# Sources and failures that the report's row lists; all of them are the rows of its ``sources`` frame.
LISTED = 1000


def run_report(funnel_row: DataFrame, drops: DataFrame, sources: DataFrame,
               config: RunConfig, credits_used: DataFrame | None = None) -> DataFrame:
    """The run as one row: parameters, totals, drop reasons and source outcomes.

    Nested values are bounded: a handful of reasons, and the first ``LISTED`` sources and failures in order of name
    next to the numbers of all. ``send`` tells whether there is a message to send: events, or the rules'
    ``empty_run_message``.
    """
    reasons = drops.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("drop_reason", "n")))).alias(
            "drop_reasons"
        )
    )
    outcome = F.struct("source", "found", "ok", "error")
    first = sources.orderBy("source", "found", "ok", "error").limit(LISTED)
    failed = sources.where(~F.col("ok")).select("source").orderBy("source").limit(LISTED)
    parts = [
        funnel_row, reasons, first.agg(F.array_sort(F.collect_list(outcome)).alias("sources")),
        failed.agg(F.array_sort(F.collect_list("source")).alias("failures")),
        sources.agg(F.count("*").alias("n_sources"), F.count_if(~F.col("ok")).alias("n_failures")),
    ]
    if credits_used is not None:
        parts.append(credits_used.select("credits"))
    row = one_row(*parts)
    if credits_used is None:
        row = row.withColumn("credits", F.lit(0).cast("bigint"))
    return row.select(
        F.lit(config.run_ts.strftime("%Y-%m-%dT%H:%M:%S")).alias("run_at"),
        F.array(*[F.lit(s) for s in config.streams]).alias("streams"),
        F.lit(config.date_window_days).alias("window_days"),
        "events_found", "events_kept", "events_delivered", "drop_reasons",
        "sources", "failures", "n_sources", "n_failures", run_status(F.col("n_failures")).alias("status"),
        "credits", (F.col("events_delivered") > 0).alias("send") if not config.rules.get("empty_run_message", True)
        else F.lit(True).alias("send"),
    )
