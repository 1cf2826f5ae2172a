"""Records of large JSON arrays, read by byte ranges: one file over many tasks.

The text reader cuts files into ranges at closing braces, so every range starts with a piece of text right after
one. Whether a piece starts inside a string, and how deep, depends on all pieces before it in the file. A first pass
finds for each range what it does to either start (inside a string or not); composing these in file order
gives each range its start. A second pass then cuts ranges into records on their own; only the pieces of records
that cross a border are exchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from handbill.session import saved

_ESCAPED = re.compile(r"\\.", re.DOTALL)
# Ranges up to which their starts go to every task (some 150 bytes each); beyond, pieces meet them in an exchange.
BROADCAST_RANGES = 200_000

# Pieces of one record that crosses a border, and whole records.
_PARTS = "_file STRING, _block BIGINT, _place BIGINT, closed BOOLEAN, whole BOOLEAN, _text STRING"
_SUMMARY = "_file STRING, _block BIGINT, first STRING, flips BOOLEAN, deeper_out BIGINT, deeper_in BIGINT"


def _outside(piece: str, inside: bool) -> tuple[str, bool]:
    """What of a piece lies outside strings, and whether its end lies in one.

    A backslash is never the last character before a brace that closes an object, so escapes end in their piece.
    """
    spans = (_ESCAPED.sub("", piece) if "\\" in piece else piece).split('"')
    return "".join(spans[inside::2]), inside ^ (len(spans) % 2 == 0)


def _depth(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("]") - text.count("}")


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per range of a partition: its first character, whether it ends in the other string state, and the change
    of depth for a start outside and inside a string."""
    found: dict[tuple, list] = {}
    for batch in batches:
        for file, block, piece in zip(batch["_file"], batch["_block"], batch["value"]):
            state = found.setdefault((file, block), ["", [False, True], [0, 0]])
            if not state[0]:
                state[0] = piece.lstrip("﻿ \t\r\n")[:1] or "}"
            for start in (0, 1):
                text, state[1][start] = _outside(piece, state[1][start])
                state[2][start] += _depth(text) - (not state[1][start])
    yield pd.DataFrame(
        [(file, block, first, inside[0], *depth) for (file, block), (first, inside, depth) in found.items()],
        columns=["_file", "_block", "first", "flips", "deeper_out", "deeper_in"])


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records that lie in one range, and the first and last pieces of a range for those that do not."""
    at, inside, depth, level, place, open_pieces, file, block = None, False, 0, 1, 0, [], None, None

    def left():
        # the reader took a brace off the end of every piece; the next range's first piece follows it
        return [(file, block, place, False, False, "}".join(open_pieces) + "}")] if open_pieces else []

    for batch in batches:
        out = []
        rows = zip(batch["_file"], batch["_block"], batch["value"], batch["inside"], batch["depth"], batch["level"])
        for *here, piece, inside_at, depth_at, level_at in rows:
            if here != at:
                out += left()
                at, (file, block) = here, here
                inside, depth, level, place, open_pieces = bool(inside_at), int(depth_at), int(level_at), 0, []
            if not (open_pieces or inside or piece.strip()):
                continue  # what follows the last object
            text, inside = _outside(piece, inside)
            depth += _depth(text)
            open_pieces.append(piece)
            if not inside and depth < level:  # the end of the list
                rest = "}".join(open_pieces).rstrip().removesuffix("]")
                out.append((file, block, place, True, place > 0, rest))
                place, open_pieces = place + 1, []
                continue
            depth -= not inside
            if not inside and depth <= level:
                out.append((file, block, place, True, place > 0, "}".join(open_pieces) + "}"))
                place, open_pieces = place + 1, []
        yield pd.DataFrame(out, columns=["_file", "_block", "_place", "closed", "whole", "_text"])
    yield pd.DataFrame(left(), columns=["_file", "_block", "_place", "closed", "whole", "_text"])


def array_texts(spark: SparkSession, path: str) -> DataFrame:
    """The text of every entry of UTF-8 files that hold a list each: ``_text``, ``_file``, ``_block``, ``_place``.

    ``_block``, the start of the range an entry begins in, and ``_place`` there give the order in a file. Entries
    that are no objects come as texts too, with bare numbers and nested values written anew. A file of
    objects next to each other gives each of them; an empty file and an empty list give none. Where a file is no
    JSON, what follows the fault, up to where braces close again, is one text, and has to fit a task
    as any entry does; an object cut off at the end of a file counts if one brace completes it.
    """
    where = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    pieces = spark.read.option("lineSep", "}").text(path).select(*where, "value")
    parts = saved(_with_starts(pieces).mapInPandas(_cut, _PARTS), "range-records")

    narrow = parts.where("NOT whole").select("_file", "_block", "_place", "closed")
    before = Window.partitionBy("_file").orderBy("_block", "_place").rowsBetween(Window.unboundedPreceding, -1)
    grouped = narrow.select(
        "_file", "_block", "_place", F.coalesce(F.count_if("closed").over(before), F.lit(0)).alias("_group"))
    crossing = (
        parts.where("NOT whole").join(grouped, ["_file", "_block", "_place"])
        .groupBy("_file", "_group")
        .agg(F.array_sort(F.collect_list(F.struct("_block", "_place", "_text"))).alias("of"))
        .select("_file", F.expr("of[0]._block AS _block"), F.expr("of[0]._place AS _place"),
                F.array_join("of._text", "").alias("_text"))
    )
    texts = parts.where("whole").select("_file", "_block", "_place", "_text").unionByName(crossing)
    opening = F.when((F.col("_block") == 0) & (F.col("_place") == 0), F.regexp_replace("_text", r"^[\ufeff\s]*\[?", ""))
    text = F.regexp_replace(F.coalesce(opening, "_text"), r"^[\s,]+", "")
    entries = F.from_json(F.concat(F.lit("["), F.col("_text"), F.lit("]")), "array<string>")
    return (
        texts.withColumn("_text", text).where("_text <> ''")
        .select("_file", "_block", "_place", F.posexplode(
            F.when(F.col("_text").startswith("{"), F.array("_text")).otherwise(F.coalesce(entries, F.array("_text")))
        ).alias("_entry", "_text"))
        .select("_file", "_block", F.struct("_place", "_entry").alias("_place"),
                F.coalesce("_text", F.lit("")).alias("_text"))
    )


def _with_starts(pieces: DataFrame) -> DataFrame:
    """Pieces, those of a range in order, with the state their range starts in."""
    ranges = saved(pieces.mapInPandas(_summaries, _SUMMARY), "ranges")
    # windows over one row a range, not over text
    order = Window.partitionBy("_file").orderBy("_block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumns({
        "inside": F.coalesce(F.count_if("flips").over(before), F.lit(0)) % 2 == 1,
        "level": (F.first("first").over(order) == "[").cast("int"),
    }).withColumn("deeper", F.when(F.col("inside"), F.col("deeper_in")).otherwise(F.col("deeper_out")))
    starts = starts.select(
        "_file", "_block", "inside", "level", F.coalesce(F.sum("deeper").over(before), F.lit(0)).alias("depth"))
    if ranges.count() <= BROADCAST_RANGES:
        return pieces.join(F.broadcast(starts), ["_file", "_block"])
    numbered = pieces.withColumn("_row", F.monotonically_increasing_id())
    return numbered.join(starts, ["_file", "_block"]).sortWithinPartitions("_file", "_block", "_row")
