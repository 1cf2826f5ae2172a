"""A whole digest packed into messages, as :func:`handbill.operators.digest.pack_lines` packs one text.

A line is known by its position: the characters before it, breaks included. The message that begins at
a line ends at the last position that the limit reaches, so every line has one next message start, and the starts
of the digest are those reached from position 0. Lines are cut into blocks of characters. Each block works
out alone where a message that begins at one of its first lines leaves it; pointer doubling over these jumps, a
few rows a block, tells in which line each block is really entered, and blocks mark their messages alone again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from handbill.session import saved

# Lines numbered together, and characters of a block (only positions enter its task, 16 bytes a line).
LINES_PER_RANGE = 65_536
BLOCK_CHARS = 4_000_000


def with_positions(lines: DataFrame, rows: int = LINES_PER_RANGE) -> DataFrame:
    """``lines`` with ``pos``, the characters of all lines before it, and ``end``, where the next begins."""
    group = F.floor(F.col("line_no") / rows)
    length = (F.length("line") + 1).cast("bigint")
    sized = saved(lines.select("line_no", "line", length.alias("n"), group.alias("_range")), "digest-lines")
    # one row a range of lines
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sized.groupBy("_range").agg(F.sum("n").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy("line_no")
    placed = sized.select("line_no", "_range", "n", F.sum("n").over(within).alias("_sum")).join(starts, "_range")
    end = F.col("_start") + F.col("_sum")
    return sized.select("line_no", "line").join(
        placed.select("line_no", (end - F.col("n")).alias("pos"), end.alias("end")), "line_no")


def _next_starts(pos: np.ndarray, end: np.ndarray, limit: int) -> np.ndarray:
    """Where the message that begins at each line ends: the last known position in reach, at least one line on."""
    known = np.union1d(pos, end)
    reach = known[np.searchsorted(known, pos + limit, side="right") - 1]
    return np.maximum(reach, end)


def _block_arrays(block: pd.DataFrame, size: int):
    """The lines of a block and those after it that it needs, in order, and which are its own."""
    block = block.sort_values("pos")
    pos, end = block["pos"].to_numpy(), block["end"].to_numpy()
    return pos, end, pos // size == block["block"].iloc[0]


def _jumps(limit: int, size: int):
    def jumps(block: pd.DataFrame) -> pd.DataFrame:
        pos, end, own = _block_arrays(block, size)
        number = int(block["block"].iloc[0])
        target = _next_starts(pos, end, limit)
        at = np.searchsorted(pos, target)  # meaningful only for targets in the block
        pos, target = pos[own], target[own]
        for i in range(len(pos) - 1, -1, -1):
            if target[i] // size == number and at[i] < len(pos):
                target[i] = target[at[i]]
        # a message that began before the block reaches no further than the limit, or ends with a longer line
        entry = pos - number * size < limit
        entry[0] = True
        return pd.DataFrame({"start": pos[entry], "target": target[entry]})
    return jumps


def _marked(limit: int, size: int):
    def marked(block: pd.DataFrame) -> pd.DataFrame:
        pos, end, own = _block_arrays(block, size)
        target = _next_starts(pos, end, limit)
        last = pos[own][-1]
        starts, here = [], int(block["entered"].iloc[0])
        while here <= last:
            starts.append(here)
            here = int(target[np.searchsorted(pos, here)])
        covered = pos[(pos >= starts[0]) & (pos < here)]
        starts = np.array(starts)
        return pd.DataFrame({"pos": covered, "message": starts[np.searchsorted(starts, covered, side="right") - 1]})
    return marked


def pack_digest(lines: DataFrame, limit: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Messages ``(message_no, text, n_lines)`` of whole lines, each of at most ``limit`` characters; a longer
    line stays whole.

    ``lines`` holds (line_no, line) with distinct numbers, in whose order they are packed. The rows are the texts
    that ``pack_lines`` gives for the joined lines, numbered from 0. A NULL line is an empty one; no lines give
    no message.
    """
    size = max(block_chars, limit)
    lines = lines.select(F.col("line_no").cast("bigint").alias("line_no"), F.coalesce("line", F.lit("")).alias("line"))
    placed = saved(with_positions(lines), "digest-placed")
    if placed.isEmpty():
        return lines.sparkSession.createDataFrame([], "message_no BIGINT, text STRING, n_lines BIGINT")
    # lines up to the limit behind a block's end are needed there too
    block = F.floor(F.col("pos") / size)
    early = (block > 0) & (F.col("pos") - block * size <= limit)
    seen = F.when(early, F.array(block - 1, block)).otherwise(F.array(block))
    blocks = saved(placed.select("pos", "end", F.explode(seen).alias("block")), "digest-blocks")
    own = blocks.where(F.floor(F.col("pos") / size) == F.col("block")).select("block").distinct()
    blocks = blocks.join(own, "block", "left_semi")  # none for a block inside one long line

    jumps = blocks.groupBy("block").applyInPandas(_jumps(limit, size), "start BIGINT, target BIGINT")
    jumps = saved(jumps, "digest-jumps")
    entered = saved(jumps.where("start = 0").select("start"), "digest-entered")
    total = entered.count()
    while True:  # both reach twice as far each time
        reached = jumps.join(entered, "start", "left_semi").select(F.col("target").alias("start"))
        entered = saved(entered.union(reached.join(jumps, "start", "left_semi")).distinct(), "digest-entered")
        before, total = total, entered.count()
        if before == total:
            break
        further = jumps.select(F.col("start").alias("target"), F.col("target").alias("further"))
        jumps = saved(jumps.join(further, "target", "left").select(
            "start", F.coalesce("further", "target").alias("target")), "digest-jumps")

    entries = entered.select(F.floor(F.col("start") / size).alias("block"), F.col("start").alias("entered"))
    messages = blocks.join(entries, "block").groupBy("block").applyInPandas(
        _marked(limit, size), "pos BIGINT, message BIGINT")
    texts = saved(
        placed.join(messages, "pos").groupBy("message").agg(
            F.array_join(F.array_sort(F.collect_list(F.struct("pos", "line")))["line"], "\n").alias("text"),
            F.count(F.lit(1)).alias("n_lines"), F.floor(F.first("message") / size).alias("block")),
        "digest-texts")
    shown = texts.join(texts.agg(F.max("message").alias("_last")), F.col("message") == F.col("_last"), "left").where(
        F.col("_last").isNull() | F.col("text").rlike(r"(?U)[^\s]"))
    # numbered by block: what earlier blocks hold, then the place in the block
    counts = texts.groupBy("block").agg(F.count(F.lit(1)).alias("_n")).select(
        "block", F.coalesce(F.sum("_n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("block").orderBy("message")) - 1
    return shown.join(counts, "block").select(
        (F.col("_before") + place).cast("bigint").alias("message_no"),
        F.rtrim("text", F.lit("\n")).alias("text"), "n_lines")
