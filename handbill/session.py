"""Session settings and the shared folder for files that outlive one job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def tuned(builder):
    """Adaptive settings for large inputs, partitions merged or split at run time.

    The rules make long expressions. Generated methods above 8000 bytes are never compiled to
    machine code by the JVM, so such stages are better run as split projections.
    """
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )


def spread(df: DataFrame) -> DataFrame:
    """Spread records of few unsplittable files over all cores; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private one only where none is set (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not configured:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="handbill-")
        spark.sparkContext.setCheckpointDir(configured)
        current = spark.sparkContext.getCheckpointDir()
    return configured or current


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, of known size, without lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
