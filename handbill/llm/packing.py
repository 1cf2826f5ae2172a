"""Packing documents into sequences: first-fit decreasing with a tournament tree of capacities.

A document's ids (its text's, then the end id) are cut into pieces of ``length``; the last piece is
what is left. Pieces are dealt into groups at random by a hash of their document and of their row in the written
table, so rows of one id or none spread as others do; about ``group_rows`` go to a group, and each
group is packed on its own: longest first, each piece into the first sequence with room, which the
tree of free capacities finds in a logarithm of the sequences. A group's pieces are numbers, not ids,
so a group fits a task whatever the documents' lengths.

Null texts are empty: one piece with the end id. Null ids and repeated rows are documents of their
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import only, pieces, saved
from .tokens import Encoder, _crc
from .words import blocks

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class TournamentTree:
    """Free room of up to ``n`` bins; each inner node holds the larger of its two children."""

    def __init__(self, n: int, room: int):
        self.leaves = 1 << max(0, n - 1).bit_length()
        self.room = [room] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """Into the first bin with room for ``size``: its number, and the room it had."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        had = room[node]
        room[node] = had - size
        bin_number = node - self.leaves
        while node > 1:
            node //= 2
            left, right = room[2 * node], room[2 * node + 1]
            best = left if left >= right else right
            if room[node] == best:
                break
            room[node] = best
        return bin_number, had


def first_fit_decreasing(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset in it) of each piece."""
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    tree = TournamentTree(len(sizes), length)
    for k in np.argsort(-sizes, kind="stable"):
        sequence[k], had = tree.put(int(sizes[k]))
        offset[k] = length - had
    return sequence, offset


def _cut(encoder: Encoder, length: int, end: int):
    schema = pa.schema([(x.split()[0], pa.int64()) for x in PIECE.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column(1)):
                ids, at = encoder.encode(data, offsets, end)
                total = np.diff(at)
                count = -(-total // length)
                doc = np.repeat(np.arange(stop - first), count)
                turn = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = turn * length
                size = np.minimum(length, total[doc] - start)
                head = at[doc] + start
                yield pa.record_batch([
                    batch.column(0).slice(first, stop - first).take(pa.array(doc)),
                    pa.array(start), pa.array(size),
                    pa.array([_crc(ids[a: a + n]) for a, n in zip(head, size)], pa.int64()),
                    pa.array(total[doc]),
                ], schema=schema)

    return run


def _pack(length: int):
    def run(table: pa.Table) -> pa.Table:
        # the row breaks ties, so a repeated task gives the same sequences
        table = table.sort_by([(name, "ascending") for name in ("doc_id", "start", "part", "row")])
        sequence, offset = first_fit_decreasing(table["length"].to_numpy(), length)
        group = table["grp"][0].as_py()
        return table.drop_columns(["grp", "part", "row"]).append_column(
            "sequence_id", pa.array((group << 32) + sequence)).append_column("offset", pa.array(offset))

    return run


def pack(docs: DataFrame, path: str, length: int = 4096, end: int = 2, group_rows: int = 8192,
         seed: int = 11) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = only(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    encoder = Encoder.of(docs, path)
    cut = saved(docs.mapInArrow(_cut(encoder, length, end), PIECE), "pieces")
    groups = pieces(cut.count(), group_rows)
    placed = cut.select(
        "*", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint").alias("part"),
        F.col("_metadata.row_index").alias("row"))
    grouped = placed.withColumn(
        "grp", F.pmod(F.xxhash64("doc_id", "start", "part", "row", F.lit(seed)), F.lit(groups)))
    return grouped.groupBy("grp").applyInArrow(
        _pack(length), PIECE + ", sequence_id bigint, offset bigint")
