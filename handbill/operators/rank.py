"""Relevance score, order inside a stream, cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from handbill.config import STREAMS, RunConfig
from handbill.functions.text import keyword_hits
from handbill.operators.dedup import source_trust
from handbill.session import shared_path

# Score of an undated event, hits for a full topical score.
UNDATED_PROXIMITY = 0.3
FULL_TOPICAL_HITS = 3.0

# Rows of one range partition when whole groups are numbered, and bytes of its files as written: rows may hold long texts.
ROWS_PER_PARTITION = 1_000_000
BYTES_PER_PARTITION = 16_000_000


def relevance_score(config: RunConfig) -> Column:
    """Closeness in time, own-category keyword hits and source trust, weighted, four decimals."""
    weights = config.rules["scoring"]
    days = F.greatest(
        F.datediff(F.to_date("start_datetime"), F.lit(config.run_ts.date())), F.lit(0)
    )
    proximity = F.when(
        F.col("start_datetime").isNotNull(), F.lit(1.0) / (F.lit(1.0) + days)
    ).otherwise(F.lit(UNDATED_PROXIMITY))
    hits = F.lit(0)
    for stream in STREAMS:
        own = keyword_hits(F.col("class_text"), config.rules["classify"].get(stream, []))
        hits = F.when(F.col("category") == stream, own).otherwise(hits)
    topical = F.least(hits / F.lit(FULL_TOPICAL_HITS), F.lit(1.0))
    trust = source_trust(F.col("source"), config.rules.get("source_trust", {}))
    total = (
        proximity * F.lit(float(weights["date_proximity_weight"]))
        + topical * F.lit(float(weights["topical_match_weight"]))
        + trust * F.lit(float(weights["source_trust_weight"]))
    )
    return F.floor(total * 10000 + F.lit(0.5)) / F.lit(10000.0)


def stream_number(category: Column, streams=STREAMS) -> Column:
    """1-based place of a stream in the digest, 0 for an unknown one."""
    return F.array_position(F.array(*[F.lit(s) for s in streams]), category)


def _order(score: str, start: str, seq: str) -> list[Column]:
    return [F.col(score).desc(), F.col(start).asc_nulls_last(), F.col(seq).asc()]


def top_per_group(df: DataFrame, group_order: Column, group: str, order: list[Column], cap: int,
                  rank: str = "rank") -> DataFrame:
    """The first ``cap`` rows of every group, numbered from 1.

    Up to the planner's limit for it, a window's group limit also runs before the exchange, so a
    task sends at most ``cap`` rows of a group. The planner leaves that out for a larger cap, and then
    the rows are numbered by :func:`rank_all`, which needs no group in one task.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if cap > limit:
        return rank_all(df, group_order, group, order, rank).where(F.col(rank) <= cap)
    window = Window.partitionBy(group).orderBy(*order)
    numbered = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= cap)
    return numbered.withColumn(rank, F.col(rank).cast("bigint"))


def rank_all(df: DataFrame, group_order: Column, group: str, order: list[Column],
             rank: str = "rank", rows: int = ROWS_PER_PARTITION, size: int = BYTES_PER_PARTITION) -> DataFrame:
    """Number all rows of every group in order, without putting a group into one task.

    Rows are written once, range-partitioned on the sort keys into about ``rows`` or ``size`` bytes each,
    whichever is less, and sorted inside partitions; the result is written too, because partition numbers must not change between its
    two uses. A row's rank is its place in its partition plus the rows of its group in earlier
    partitions; those counts are one row per partition and group.
    """
    spark = df.sparkSession
    written, placed = shared_path(spark, "rank-rows"), shared_path(spark, "rank-placed")
    df.write.parquet(written)
    source = spark.read.schema(df.schema).parquet(written)
    files = source.groupBy("_metadata.file_path").agg(
        F.first("_metadata.file_size").alias("size"), F.count(F.lit(1)).alias("rows"))
    held = files.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    count = max(1, -(-held[0] // rows), -(-held[1] // size))
    keys = [group_order.asc(), *order]
    (
        source.repartitionByRange(count, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id())
        .write.parquet(placed)
    )
    numbered = spark.read.parquet(placed)
    counts = numbered.groupBy("_pid", group).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_pid").alias("_at"), F.col(group).alias("_group"), "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    return (
        numbered.join(
            offsets, (F.col("_pid") == F.col("_at")) & F.col(group).eqNullSafe(F.col("_group")))
        .withColumn(rank, F.col("_place") - F.col("_first") + F.col("_before") + 1)
        .select(*df.columns, rank)
    )


def rank_streams(events: DataFrame, config: RunConfig) -> DataFrame:
    """Score, keep known streams, number rows inside each stream and apply the cap.

    Adds ``relevance_score``, ``stream_no`` and ``rank`` (1 = first in its stream).
    """
    scored = (
        events.withColumn("relevance_score", relevance_score(config))
        .withColumn("stream_no", stream_number(F.col("category")))
        .where(F.col("stream_no") > 0)
    )
    order = _order("relevance_score", "start_datetime", "seq")
    number = F.col("stream_no")
    if config.cap > 0:
        return top_per_group(scored, number, "category", order, config.cap)
    return rank_all(scored, number, "category", order)
