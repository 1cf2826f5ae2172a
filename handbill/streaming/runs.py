"""Scheduled incremental runs with Structured Streaming over landed files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from handbill.operators.state import StateTable, delivery_status, suppress_unchanged
from handbill.session import saved


def landed_stream(spark: SparkSession, path: str, schema, pattern: str | None = None,
                  file_format: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """New files of a landing folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(file_format).load(path)


def run_available(stream: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Process what has landed since the last call and append it as Parquet, exactly once."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", output).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def event_time(stream: DataFrame, time: str, delay: str, name: str = "_event_time") -> DataFrame:
    """A watermarked time column from wall-clock time. Watermarks need an instant, so the wall
    clock is read as UTC; the session zone plays no part."""
    micros = F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, `{time}`)")
    return stream.withColumn(name, F.timestamp_micros(micros)).withWatermark(name, delay)


def wall_clock(instant: Column) -> Column:
    """Back from such an instant to wall-clock time, to the second."""
    return F.expr(_EPOCH) + F.make_dt_interval(secs=F.unix_seconds(instant))


def first_per_key(stream: DataFrame, keys: list[str], time: str, horizon: str) -> DataFrame:
    """The first arrival per key; a copy within the horizon is dropped. Trust order and field
    merging need the batch operator."""
    timed = event_time(stream, time, horizon)
    return timed.dropDuplicatesWithinWatermark(keys).drop("_event_time")


def run_updates(stream: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Process what has landed and write the rows each batch changed, with its number.

    A batch that is replayed rewrites its own folder. :func:`newest` reads the result.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{output}/batch={batch_id}")

    return (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def newest(updates: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The last value written per key, open periods included."""
    return updates.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value))


def drop_counts(stream: DataFrame, time: str, reason: str, period: str, delay: str) -> DataFrame:
    """Rows per period and drop reason. Appended, a period comes once the watermark has passed it;
    with :func:`run_updates` each batch gives the counts so far, the running period's too."""
    return (
        event_time(stream.where(F.col(reason).isNotNull()), time, delay)
        .groupBy(F.window("_event_time", period).alias("period"), reason)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(wall_clock(F.col("period.start")).alias("period_start"), reason, "n")
    )


def track_status(stream: DataFrame, latest: Callable[[DataFrame], DataFrame], state: StateTable,
                 output: str, checkpoint: str, run_ts: datetime,
                 run_prefix: str = "batch") -> StreamingQuery:
    """New, updated and unchanged over time: each batch is compared with the snapshot of the
    batches before it, then becomes part of the next one. A batch reads and rewrites only the buckets of
    its own keys.

    ``latest`` turns a batch into one row per key with ``content_hash`` and the state's
    columns. A batch that is replayed reads the same prior snapshot and gives the same
    output folder and state, so replays change nothing.
    """

    def compare(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = f"{run_prefix}-{batch_id}"
        target = f"{output}/batch_id={batch_id}"
        now = latest(batch)
        now = saved(now.select(*[F.col(c).cast("string") if t == "void" else F.col(c) for c, t in now.dtypes]), "status-batch")
        delivery_status(now, state.read_for(now, for_run=run_id)).write.mode("overwrite").parquet(target)
        compared = spark.read.parquet(target)
        state.merge(compared, run_id, suppress_unchanged(compared), run_ts)

    return (
        stream.writeStream.foreachBatch(compare).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
