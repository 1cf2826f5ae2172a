"""One run: raw records in; judged rows, deduplicated events, ranked digest and reports out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from handbill.config import RunConfig
from handbill.operators import report as reports
from handbill.operators.classify import classify
from handbill.operators.dedup import within_run_dedup
from handbill.operators.digest import digest, event_lines
from handbill.operators.normalize import normalize, with_identity, with_text
from handbill.operators.rank import rank_streams
from handbill.operators.rules import apply_filters
from handbill.operators.similar import similar_title_dedup
from handbill.operators.state import (
    StateTable, delivery_status, suppress_unchanged, with_content_hash,
)
from handbill.schema import EVENT_COLUMNS
from handbill.session import checkpoint_dir, saved, shared_path
from handbill.sources.sinks import write_digest, write_digest_sections, write_report


def judge(raw: DataFrame, config: RunConfig) -> DataFrame:
    """Every titled record with its category and drop reason (NULL = kept). No exchange."""
    events = with_identity(with_text(normalize(raw, config.run_ts), config.fold_stroke))
    return apply_filters(classify(events, config.rules, config.streams), config)


def keep_and_dedup(judged: DataFrame, config: RunConfig) -> DataFrame:
    """Kept rows, one per event, with the texts and identity of the merged fields."""
    kept = judged.where(F.col("drop_reason").isNull()).select("seq", "dedup_key", *EVENT_COLUMNS)
    merged = within_run_dedup(kept, config.rules.get("source_trust", {}))
    key = merged.select("dedup_key", "seq", "n_copies", *EVENT_COLUMNS)
    if config.similar_titles:
        once = saved(key, "run-exact")
        key = similar_title_dedup(with_text(once, config.fold_stroke), config.rules.get("source_trust", {}),
                                  EVENT_COLUMNS, config.similar_titles)
    return with_content_hash(with_identity_of(with_text(key, config.fold_stroke)))


def with_identity_of(events: DataFrame) -> DataFrame:
    """The home-area flag of merged events; their key is the one they were grouped by."""
    return with_identity(events.withColumnRenamed("dedup_key", "_key")).withColumn(
        "dedup_key", F.col("_key")
    ).drop("_key")


def rank_new(raw: DataFrame, config: RunConfig, state: DataFrame | None = None) -> DataFrame:
    """The digest's events in order: judged, deduplicated, compared with the state, ranked."""
    events = keep_and_dedup(judge(raw, config), config)
    if state is None:
        events = events.withColumn("delivery_state", F.lit("new"))
    else:
        events = suppress_unchanged(delivery_status(events, state), config.deliver_unchanged)
    return rank_streams(events, config)


@dataclass(frozen=True)
class RunResult:
    judged: DataFrame
    events: DataFrame
    ranked: DataFrame
    digest: DataFrame
    drops: DataFrame
    report: DataFrame


def run_listings(raw: DataFrame, config: RunConfig, output: str, state: StateTable | None = None,
                 outcomes: DataFrame | None = None, deliver: bool = True,
                 unreadable: DataFrame | None = None, one_commit: bool = False) -> RunResult:
    """A full run with its outputs (digest, sections, report, outcomes) under ``output`` and its state in ``state``.

    Judged rows and deduplicated events are each used several times, so both are written to
    the shared folder once, the former by drop reason, so a reader of kept rows or of one
    reason opens only those files. The
    prior snapshot is compared first and its buckets are rewritten after ranking, so "updated" can be told
    and scores are stored; delivery marks go to the events the digest holds, when
    ``deliver`` is set. ``outcomes`` (source, found, ok, error and, for paid
    fetches, granted) defaults to the records seen. Files of ``unreadable`` (source, n_records, error: see
    :func:`handbill.sources.listings.unreadable`) are failed outcomes next to those.

    With ``one_commit`` outputs go to a folder of this attempt below ``output``, and the row that puts the new
    snapshot in force also names it: ``state.published()``. A run that dies before leaves both as they were, so nothing
    is delivered twice or lost. Without it the outputs lie under ``output`` before the state is written.
    """
    if one_commit:
        if state is None:
            raise ValueError("one_commit needs a state table")
        output = f"{output.rstrip('/')}/run={config.resolved_run_id}/attempt={uuid.uuid4().hex}"
    spark = raw.sparkSession
    checkpoint_dir(spark)
    run_id = config.resolved_run_id
    scratch = shared_path(spark, f"run-{run_id}")

    def written(df: DataFrame, name: str, *partition_columns: str) -> DataFrame:
        df.write.partitionBy(*partition_columns).parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    judged = written(
        judge(raw, config).select("seq", "dedup_key", "drop_reason", *EVENT_COLUMNS),
        "judged", "drop_reason",
    )
    events = written(keep_and_dedup(judged, config), "events")

    prior = state.read_for(events, for_run=run_id) if state is not None else None
    if prior is None:
        compared = events.withColumn("delivery_state", F.lit("new"))
    else:
        compared = delivery_status(events, prior)
    ranked = written(
        rank_streams(suppress_unchanged(compared, config.deliver_unchanged), config), "ranked"
    )

    drops = reports.drop_report(judged)
    if outcomes is None:
        outcomes = judged.groupBy("source").agg(
            F.count(F.lit(1)).alias("found"), F.lit(True).alias("ok"),
            F.lit(None).cast("string").alias("error"),
        )
    if "granted" not in outcomes.columns:
        outcomes = outcomes.withColumn("granted", F.lit(False))
    if unreadable is not None:
        failed = reports.source_outcomes(unreadable).withColumns({"found": F.lit(0), "granted": F.lit(False)})
        outcomes = outcomes.unionByName(failed, allowMissingColumns=True)
    outcomes = written(outcomes, "outcomes")
    totals = outcomes.agg(
        F.count_if("ok").alias("sources"), F.count_if(~F.col("ok")).alias("skipped"),
        F.count_if("granted").alias("credits"),
    )
    text = digest(ranked, config, totals)
    report = reports.run_report(
        reports.funnel(judged, events, ranked), drops, outcomes, config, totals
    )

    write_digest(text, f"{output}/digest")
    write_digest_sections(event_lines(ranked, config), f"{output}/sections")
    write_report(report, f"{output}/report")
    write_report(outcomes, f"{output}/outcomes")
    if state is not None:
        scores = ranked.select("dedup_key", F.col("relevance_score").alias("_score"))
        scored = (
            events.join(scores, "dedup_key", "left")
            .withColumn("relevance_score", F.coalesce("_score", "relevance_score"))
            .drop("_score")
        )
        state.merge(scored, run_id, ranked if deliver else None, config.run_ts, output if one_commit else None)
    return RunResult(judged, events, ranked, text, drops, report)
