"""Exact deduplication through an extendible-hash index on shared files. DataFrame functions only.

Texts are equal when identical after each run of white space became one space. The index has one
entry per distinct text:

- *Owner tasks.* Grouping by (64-bit key, text) makes the task that owns a key range compare whole
  texts byte by byte. Copies are counted in the map tasks first, so a text that a third of all rows
  share sends one row per map task.
- *Directory doubling.* Buckets are prefixes of the key. A bucket over ``capacity`` splits on its next bit, and
  the directory doubles when a bucket gets deeper than it, until each bucket fits or holds one key only, whose
  texts are a chain of any length. ``directory`` follows the splits level by level from one histogram of key
  prefixes, and deeper ones of the buckets that are still too full.
- *Shared files.* Entries are written by bucket, each bucket whole in one file, with their place in
  the chain of texts that have the same key.

A row finds its entry as a look-up in such an index does: the first bits of its key are a slot of the directory,
which names the bucket; there its key has a chain, and in that the entry has the row's SHA-256.

Null texts count as empty; null ids sort last (an all-null group has keep_id NULL and keeps its
rows); rows that repeat both id and text share their fate; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from handbill.session import shared_path

from .common import SPACE, only, pieces, saved


def normalised(text: str | Column) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(col, F.lit("")), SPACE, " ")


def entries(docs: DataFrame, key=F.xxhash64) -> DataFrame:
    """One row per distinct text: key, sha, keep_id, group_size."""
    return (
        only(docs, "doc_id", "text").select("doc_id", normalised("text").alias("norm"))
        .withColumn("key", key("norm"))
        .groupBy("key", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("key", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size")
    )


def _prefix(bits: Column | int) -> Column:
    """The first bits of the key, as a number; shifts of 64 would be shifts of 0."""
    return F.expr("shiftrightunsigned(shiftrightunsigned(key, 1), CAST(63 - {} AS INT))".format(bits))


def _slots(found: DataFrame, depth: int) -> DataFrame:
    """Used slots of a directory of ``depth`` bits: how many entries, the least and the largest key."""
    return found.groupBy(_prefix(depth).alias("slot")).agg(
        F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))


def directory(found: DataFrame, n: int, capacity: int, spare: int = 3, step: int = 8) -> DataFrame:
    """(depth, slot, bucket, local_depth): the bucket of each used slot.

    ``depth`` is that of the directory which the slot is in. Every prefix of a slot is a bucket that doubling may pass
    through; the bucket that stays is the shortest one that fits. A slot without one is looked at
    again in a directory ``step`` bits deeper, with the entries of such slots alone, so each key is in one slot.
    ``bucket`` is the prefix of ``local_depth`` bits, told apart from those of other depths by a leading 1.
    """
    levels, first, depth, left = [], 0, min(63, (pieces(n, capacity) - 1).bit_length() + spare), found
    while True:
        slots = _slots(left, depth)
        nodes = slots.select("*", F.explode(F.sequence(F.lit(first), F.lit(depth))).alias("d"))
        nodes = nodes.withColumn("node", F.expr(f"shiftrightunsigned(slot, CAST({depth} - d AS INT))"))
        fits = (
            nodes.groupBy("d", "node").agg(F.sum("n").alias("held"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .where((F.col("held") <= capacity) | (F.col("lo") == F.col("hi")) | (F.col("d") == 63))
            .select("d", "node")
        )
        stays = nodes.join(fits, ["d", "node"]).groupBy("slot").agg(F.min("d").alias("local_depth"))
        placed = saved(
            slots.select("slot").join(stays, "slot", "left").select(
                F.lit(depth).alias("depth"), "slot", "local_depth",
                F.expr(f"shiftrightunsigned(slot, CAST({depth} - local_depth AS INT)) + shiftleft(1L, local_depth)")
                .alias("bucket")), "exact-directory")
        levels.append(placed.where("local_depth IS NOT NULL"))
        full = placed.where("local_depth IS NULL")
        if depth == 63 or full.isEmpty():
            return reduce(DataFrame.union, levels)
        left = left.join(full.select("slot"), _prefix(depth) == F.col("slot"), "left_semi")
        first, depth = depth + 1, min(63, depth + step)


def _with_bucket(rows: DataFrame, slots: DataFrame, depths: list[int]) -> DataFrame:
    """``rows`` with the bucket that the directory names for their key."""
    return (
        rows.withColumn("depth", F.explode(F.array(*map(F.lit, depths))))
        .withColumn("slot", _prefix("depth")).join(slots, ["depth", "slot"]).drop("depth", "slot")
    )


def build_index(docs: DataFrame, capacity: int = 1 << 17, per_file: int = 1 << 20,
                key=F.xxhash64) -> tuple[DataFrame, DataFrame, list[int]]:
    """Write the index of ``docs`` to the shared folder: its entries, its directory and the depths of that.

    Columns of the entries: bucket, local_depth, key, chain, sha, keep_id, group_size.
    """
    spark = docs.sparkSession
    found = saved(entries(docs, key), "exact-entries")
    n = found.count()
    slots = directory(found, n, capacity)
    depths = sorted(r.depth for r in slots.select("depth").distinct().collect()) or [0]  # at most 9 numbers
    placed = (
        _with_bucket(found, slots, depths)
        .repartitionByRange(pieces(n, per_file), "bucket")
        .withColumn("chain", F.row_number().over(
            Window.partitionBy("bucket", "key").orderBy("keep_id", "sha")) - 1)
    )
    path = shared_path(spark, "exact-index")
    placed.select("bucket", "local_depth", "key", "chain", "sha", "keep_id", "group_size") \
        .write.parquet(path)
    return spark.read.parquet(path), slots.drop("local_depth"), depths


def exact_duplicates(docs: DataFrame, key=F.xxhash64, **index) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    held, slots, depths = build_index(docs, key=key, **index)
    rows = (
        only(docs, "doc_id", "text").select("doc_id", normalised("text").alias("norm"))
        .select("doc_id", key("norm").alias("key"), F.unhex(F.sha2("norm", 256)).alias("sha"))
    )
    found = _with_bucket(rows, slots, depths).join(
        held.select("bucket", "key", "sha", "keep_id", "group_size"), ["bucket", "key", "sha"])
    return found.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
