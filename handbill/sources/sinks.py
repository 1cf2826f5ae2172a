"""Writing the digest and the run report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_digest_sections(lines: DataFrame, path: str, partitions: int | None = None) -> None:
    """Event lines as text files per stream, in stream and rank order across the part files."""
    keys = [F.col("stream_no"), F.col("rank")]
    spark = lines.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        lines.repartitionByRange(count, *keys)
        .sortWithinPartitions("category", *keys)
        .select("category", F.col("line").alias("value"))
        .write.mode("overwrite").partitionBy("category").text(path)
    )


def write_digest(lines: DataFrame, path: str, partitions: int | None = None) -> None:
    """The whole digest as text: the part files in name order are the digest."""
    spark = lines.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        lines.repartitionByRange(count, "line_no")
        .sortWithinPartitions("line_no")
        .select(F.col("line").alias("value"))
        .write.mode("overwrite").text(path)
    )


def write_report(report: DataFrame, path: str) -> None:
    """The one-row run report, or its source outcomes, as JSON."""
    report.write.mode("overwrite").json(path)
