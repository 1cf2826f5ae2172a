"""Helpers the operators share: scratch tables, sizes, local views of the shared folder, components."""

from __future__ import annotations

import math
import os
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from handbill.session import shared_path

WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cut lineage, computed once."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for files that workers write and memory-map; all machines must mount it."""
    url = urlparse(shared_path(spark, name))
    if url.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {url.scheme}://")
    path = unquote(url.path)
    os.makedirs(path, exist_ok=True)
    return path


def pieces(total: int, each: int) -> int:
    """How many parts of about ``each`` hold ``total``; at least one."""
    return max(1, math.ceil((total or 0) / each))


def text_bytes_of(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just the columns an operator works on, so that extra ones cannot clash with its own."""
    return df.select(*names)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has an edge.

    ``edges`` holds (u, v) longs. Large-star and small-star rounds: neighbours of a node move to its
    smallest neighbour, until every component is a star. Each round is written to the shared
    folder; a node with very many neighbours only ever passes through map-side minima and joins.
    """
    now = saved(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = saved(
            small.select("u", F.col("m").alias("v"))
            .union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .where("u <> v").distinct(), "edges")
        state = tuple(now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def split_groups(rows: DataFrame, keys: list[str], row_id: str, capacity: int) -> DataFrame:
    """Add (lo, hi, blk): groups over ``capacity`` rows are compared block against block.

    A group of n rows has ceil(n / capacity) blocks, and a row goes to each pair of blocks that has its
    own, so every two rows of a group meet in one task at least, and tasks hold about two blocks.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > capacity)
    return (
        rows.join(sizes, keys, "left")
        .withColumn("_n", F.ceil(F.coalesce("_n", F.lit(1)) / capacity))
        .withColumn("blk", F.pmod(F.xxhash64(row_id), F.col("_n")))
        .withColumn("_o", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)))
        .withColumn("lo", F.least("blk", "_o")).withColumn("hi", F.greatest("blk", "_o"))
        .drop("_n", "_o")
    )


def linked(rows: DataFrame, found: DataFrame, row_id: str) -> DataFrame:
    """Rows (cid, row_id, size, ...) with n_links, component_id and kept.

    ``found`` holds (cid, links) sums and (cid, other) edges of classes, in one table; a row links with
    the other members of its class too. The component's id is the smallest ``row_id`` in it.
    Rows whose cid is NULL link with nothing.
    """
    links = found.where("other IS NULL").groupBy("cid").agg(F.sum("links").alias("_links"))
    roots = components(found.where("other IS NOT NULL").selectExpr("cid AS u", "other AS v"))
    classes = rows.where("cid IS NOT NULL").groupBy("cid").agg(F.min(row_id).alias("_first"))
    classes = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    classes = classes.withColumn("root", F.coalesce("root", "cid")).join(links, "cid", "left")
    least = classes.groupBy("root").agg(F.min("_first").alias("_least"))
    classes = classes.join(least, "root").select("cid", "_links", "_least")
    return (
        rows.join(classes, "cid", "left")
        .withColumn("n_links", F.coalesce(F.col("size") - 1 + F.coalesce("_links", F.lit(0)), F.lit(0)))
        .withColumn("component_id", F.coalesce("_least", row_id))
        .withColumn("kept", F.col(row_id).eqNullSafe(F.col("component_id")))
        .drop("_links", "_least")
    )
