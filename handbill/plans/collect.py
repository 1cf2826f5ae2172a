"""Records of all configured sources from landed pages, with fallbacks under a fetch budget."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from handbill.config import RunConfig
from handbill.operators.admission import budget_admission
from handbill.operators.rank import rank_all
from handbill.schema import with_raw_columns
from handbill.session import shared_path
from handbill.sources.listings import attach_source, registry_frame
from handbill.sources.parsers import PARSERS, parse_pages, parser_name

# How the source list names a metered fetch, the parser of a source that names
# none for its fallback, and the errors of a source whose page was not landed or whose parser is unknown.
METERED = "firecrawl"
DEFAULT_FALLBACK_PARSER = "page_stub"
NOT_LANDED = "page_not_landed"
UNKNOWN_PARSER = "unknown_parser"


@dataclass(frozen=True)
class Collected:
    """``records`` for a run; ``outcomes`` per source (source, found, ok, error, method,
    granted); the number of granted fetches is the run's credits."""

    records: DataFrame
    outcomes: DataFrame

    @property
    def credits(self) -> DataFrame:
        return self.outcomes.agg(F.count_if("granted").alias("credits"))


def collect(sources: list[dict], pages: DataFrame, fallback_pages: DataFrame,
            config: RunConfig) -> Collected:
    """Parse each serving source's pages; where that gives nothing and the source has a
    fallback, take its fallback pages instead, in registry order while the budget lasts.

    ``pages`` and ``fallback_pages`` hold ``page_id``, ``source``, ``url`` and ``html``. A
    source that fails or is refused gives an outcome row and no records; the others go on.
    ``seq`` numbers the records by source in registry order, first pages before fallback pages, then
    page and place.
    """
    spark = pages.sparkSession
    serving = [
        s for s in sources
        if s.get("enabled") and set(s.get("streams", [])) & set(config.streams)
    ]
    second = [
        {**s, "parser": s.get("fallback_parser", DEFAULT_FALLBACK_PARSER)}
        for s in serving if s.get("fallback") == METERED
    ]
    scratch = shared_path(spark, "collect")

    def parsed(frame: DataFrame, chosen: list[dict], name: str) -> DataFrame:
        """Written once, because counts decide which rows are used."""
        records = parse_pages(frame, chosen, config.run_ts)
        records.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(records.schema).parquet(f"{scratch}/{name}")

    first_records = parsed(pages, serving, "first")
    second_records = parsed(fallback_pages, second, "second")

    def counts(records: DataFrame, frame: DataFrame, prefix: str) -> DataFrame:
        """Records per source, 0 for a landed page without any, no row without a page."""
        rows = frame.select("source", F.lit(0).alias("n")).unionByName(
            records.select("source", F.lit(1).alias("n"))
        )
        return rows.groupBy("source").agg(F.sum("n").alias(prefix))

    registry = registry_frame(spark, serving)
    seen = (
        registry.select(F.col("source_id").alias("source"), "registry_no", "method", "fallback")
        .join(counts(first_records, pages, "first_found"), "source", "left")
        .join(counts(second_records, fallback_pages, "second_found"), "source", "left")
        .withColumn("run", F.lit(config.resolved_run_id))
    )
    decided = budget_admission(
        seen.withColumnRenamed("method", "registry_method"), "run", ["registry_no"],
        metered=F.col("registry_method") == METERED,
        empty=F.coalesce("first_found", F.lit(0)) == 0,
        fallback=F.coalesce(F.col("fallback") == METERED, F.lit(False)),
        budget=config.fetch_budget,
    )
    metered = F.col("registry_method") == METERED
    took_second = F.col("granted") & ~metered
    found = F.when(took_second, F.col("second_found")).otherwise(F.col("first_found"))
    unknown = [s["id"] for s in serving if parser_name(s) not in PARSERS]
    error = F.coalesce(
        "error",
        F.when(F.col("source").isin(unknown) & ~took_second, F.lit(UNKNOWN_PARSER)),
        F.when(found.isNull(), F.lit(NOT_LANDED)),
    )
    outcomes = decided.select(
        "source", "method", "granted", took_second.alias("took_second"), error.alias("error"),
        F.when(error.isNull(), found).otherwise(F.lit(0)).alias("found"),
        error.isNull().alias("ok"),
    )

    def of(records: DataFrame, which) -> DataFrame:
        return records.join(outcomes.where(which & F.col("ok")).select("source"), "source", "left_semi")

    every = of(first_records, ~F.col("took_second")).withColumn("_area", F.lit(0)).unionByName(
        of(second_records, F.col("took_second")).withColumn("_area", F.lit(1)))
    order = registry.select(F.col("source_id").alias("source"), F.col("registry_no").alias("_no"))
    numbered = rank_all(
        every.join(F.broadcast(order), "source").withColumn("_all", F.lit(0)),  # configured sources
        F.col("_all"), "_all", [F.col(c).asc() for c in ("_no", "_area", "page_id", "place")], "_rank")
    records = with_raw_columns(numbered.withColumn("seq", F.col("_rank") - 1))
    return Collected(
        attach_source(records, registry, config.streams),
        outcomes.select("source", "found", "ok", "error", "method", "granted"),
    )
