"""Substring deduplication: prefix-partitioned suffix groups whose deep nodes are repeats.

Every run of ``window`` words that also starts earlier in the corpus is a repeat; the words that
such runs cover are removed. A suffix tree over all suffixes would hold each word position ``window``
levels deep, so the tree is kept sparse and cut into groups:

1. *Prefixes.* Of the ``gram``-word sequences in a window, the one with the smallest hash stands for the
   window; copies of a window choose the same one at the same place. Only suffixes that start at
   such a sequence enter the tree, about two in ``window - gram + 2``, and the sequence is the prefix
   under which they are filed. Documents are dealt into parts by id; a part sends each of its
   prefixes once, and prefixes that occur in two parts or more are the ones that go on.
2. *Variable length.* A prefix with more than ``capacity`` windows below it is made longer, by as many
   bits of the hash of the whole window as bring its groups down to that size. Parts send the first of
   each of their own equal windows only, so a passage that a third of all documents share sends
   one entry per part.
3. *Subtrees.* A group's windows, sorted, are the leaves of its subtree; windows that are equal hang from
   one node ``window`` words deep. All but the first in the corpus, by (doc_id, place), are repeats.
   Neighbouring ones join up to the maximal repeats.

Windows are compared by their whole 64-bit hash within a part, and by that and the 64 bits of the prefix
across parts. Texts are exchanged once, by part; each later pass over them reads the same exchange.

Null texts have no words; null ids sort last; rows with one id are told apart by their text, and of rows
alike in both one comes first; texts shorter than a window are kept whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import by_part, counted, from_planes, planes, range_of, summed
from .common import only, pieces, text_bytes_of
from .tokens import _gather
from .words import blocks, in_doc_order, mix, span_hashes, word_spans

LAST = np.iinfo(np.int64).max
KEYS = pa.schema([("bin", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
WINDOWS = pa.schema([("bin", pa.int32()), ("keys", pa.binary()), ("prints", pa.binary()),
                     ("docs", pa.binary()), ("at", pa.binary())])


class Part:
    """The windows of a part's texts, in order of (doc_id, text): word number, prefix, hash."""

    def __init__(self, table: pa.Table, window: int, gram: int):
        self.table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        texts = self.table["text"]
        ids = self.table["doc_id"].combine_chunks()
        self.doc_ids = ids.fill_null(LAST).to_numpy(zero_copy_only=False)
        at, key, whole, words, doc = [], [], [], [0], []
        for first, stop, data, offsets in blocks(
                texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts):
            starts, stops, before = word_spans(data, offsets)
            h = span_hashes(data, starts, stops)
            base = words[-1]
            words.extend((base + before[1:]).tolist())
            runs = in_doc_order(h, gram, seed=3)
            n = len(h) - window + 1
            if n <= 0:
                continue
            low, width, goal = runs, 1, window - gram + 1
            while width < goal:
                step = min(width, goal - width)
                low = np.minimum(low[:-step], low[step:])
                width += step
            of = np.repeat(np.arange(stop - first), np.diff(before))
            own = np.flatnonzero(of[:n] == of[window - 1:])
            at.append((own + base).astype(np.uint32))
            key.append(low[:n][own])
            whole.append(in_doc_order(h, window, seed=5)[own])
            doc.append((of[own] + first).astype(np.int32))
        join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
        self.at, self.key, self.whole = join(at, np.uint32), join(key, np.uint64), join(whole, np.uint64)
        self.doc, self.words = join(doc, np.int32), np.array(words)

    def first(self) -> np.ndarray:
        """Whether each window is the part's first of its kind."""
        order = np.argsort(self.whole, kind="stable")
        again = np.zeros(len(order), bool)
        again[1:] = self.whole[order][1:] == self.whole[order][:-1]
        out = np.ones(len(order), bool)
        out[order[again]] = False
        return out


def _prefixes(window: int, gram: int, bins: int):
    def run(table: pa.Table) -> pa.Table:
        part = Part(table, window, gram)
        heads = np.flatnonzero(np.append(True, part.key[1:] != part.key[:-1])) if len(part.key) else \
            np.empty(0, np.int64)
        keys, counts = summed(part.key[heads], np.diff(np.append(heads, len(part.key))))
        out = by_part(range_of(keys, bins), bins, [keys, np.minimum(counts, 65535).astype(np.uint16)], KEYS)
        return pa.Table.from_batches([out]).append_column(
            "part", pa.array([table["part"][0].as_py()] * out.num_rows, pa.int32()))

    return run


def _split(table: pa.Table, column: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and the part each came from."""
    held = [from_planes([x], kind) for x in table[column]]
    part = np.repeat(table["part"].to_numpy(), [len(x) for x in held])
    return np.concatenate(held), part


def _shared(capacity: int):
    """Of a bin's prefixes those that two parts or more hold, sent back to each with the bits to add."""
    def run(table: pa.Table) -> pa.Table:
        keys, part = _split(table, "keys", np.uint64)
        counts = from_planes(table["counts"], np.uint16).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, part, counts = keys[order], part[order], counts[order]
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        times = np.diff(np.append(heads, len(keys)))
        total = np.add.reduceat(counts, heads)
        bits = np.ceil(np.log2(np.maximum(total / capacity, 1))).astype(np.uint8)
        keep = np.repeat(times > 1, times)
        keys, part, bits = keys[keep], part[keep], np.repeat(bits, times)[keep]
        order = np.argsort(part, kind="stable")
        keys, part, bits = keys[order], part[order], bits[order]
        used, counts = counted(part)
        ends = np.cumsum(counts)
        cut = [slice(e - n, e) for e, n in zip(ends, counts)]
        return pa.table({"part": pa.array(used, pa.int32()),
                         "keys": pa.array([planes(keys[c]) for c in cut], pa.binary()),
                         "bits": pa.array([planes(bits[c]) for c in cut], pa.binary())})

    return run


def _windows(window: int, gram: int, bins: int):
    """The part's own first windows below shared prefixes, by group."""
    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        empty = WINDOWS.empty_table().append_column("part", pa.array([], pa.int32()))
        if not found.num_rows or not table.num_rows:
            return empty
        part = Part(table, window, gram)
        keys, bits = from_planes(found["keys"], np.uint64), from_planes(found["bits"], np.uint8)
        order = np.argsort(keys)
        keys, bits = keys[order], bits[order]
        at = np.minimum(np.searchsorted(keys, part.key), len(keys) - 1)
        own = np.flatnonzero((keys[at] == part.key) & part.first())
        key, prints, bits = part.key[own], part.whole[own], bits[at[own]].astype(np.uint64)
        longer = mix(key + (prints >> np.uint64(32) & ((np.uint64(1) << bits) - np.uint64(1))))
        group = range_of(longer, bins)
        order = np.argsort(group, kind="stable")
        group, own = group[order], own[order]
        out = by_part(group, bins, [
            key[order], prints[order], part.doc_ids[part.doc[own]], part.at[own]], WINDOWS)
        return pa.Table.from_batches([out]).append_column(
            "part", pa.array([table["part"][0].as_py()] * out.num_rows, pa.int32()))

    return run


def _later(table: pa.Table) -> pa.Table:
    """A group's windows that another part holds earlier, by part."""
    keys, part = _split(table, "keys", np.uint64)
    prints = from_planes(table["prints"], np.uint64)
    docs, at = from_planes(table["docs"], np.int64), from_planes(table["at"], np.uint32)
    order = np.lexsort((prints, keys))
    keys, prints, docs = keys[order], prints[order], docs[order]
    heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1])))
    first = np.repeat(np.minimum.reduceat(docs, heads), np.diff(np.append(heads, len(keys))))
    later = order[docs != first]
    later = later[np.argsort(part[later], kind="stable")]
    used, counts = counted(part[later])
    ends = np.cumsum(counts)
    return pa.table({"part": pa.array(used, pa.int32()), "at": pa.array(
        [planes(np.sort(at[later[e - n: e]])) for e, n in zip(ends, counts)], pa.binary())})


def _remove(window: int, gram: int, with_text: bool):
    def run(table: pa.Table, later: pa.Table) -> pa.Table:
        part = Part(table, window, gram)
        covered = np.zeros(part.words[-1] + 1, np.int32)
        for at in (part.at[~part.first()], from_planes(later["at"], np.uint32)):
            np.add.at(covered, at, 1)
            np.add.at(covered, at.astype(np.int64) + window, -1)
        gone = np.cumsum(covered[:-1]) > 0
        sums = np.concatenate(([0], np.cumsum(gone)))
        removed = sums[part.words[1:]] - sums[part.words[:-1]]
        hashes, texts = [], []
        for first, stop, data, offsets in blocks(part.table["text"].combine_chunks()):
            starts, stops, before = word_spans(data, offsets)
            stay = ~gone[part.words[first]: part.words[stop]]
            lens = (stops - starts)[stay]
            out = np.full(int(lens.sum()) + len(lens), 32, np.uint8)
            inside = np.ones(len(out), bool)
            ends = np.cumsum(lens + 1)
            inside[ends - 1] = False
            out[inside] = _gather(data, starts[stay], lens)
            doc_end = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(stay)))[before]]
            raw = out.tobytes()
            for a, b in zip(doc_end[:-1], doc_end[1:]):
                kept = raw[a: max(a, b - 1)]
                hashes.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept.decode("utf-8"))
        columns = {"doc_id": part.table["doc_id"], "n_words": pa.array(np.diff(part.words), pa.int64()),
                   "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(hashes, pa.string())}
        return pa.table(columns | ({"kept_text": pa.array(texts, pa.string())} if with_text else {}))

    return run


def remove_repeats(docs: DataFrame, window: int = 20, gram: int = 8, part_bytes: int = 8 << 20,
                   capacity: int = 1 << 18, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and kept_text)."""
    docs = only(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    parts = pieces(text_bytes_of(docs), part_bytes)
    dealt = docs.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    prefixes = dealt.groupBy("part").applyInArrow(
        _prefixes(window, gram, parts), "bin int, keys binary, counts binary, part int")
    shared = prefixes.groupBy("bin").applyInArrow(_shared(capacity), "part int, keys binary, bits binary")
    windows = dealt.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(
        _windows(window, gram, parts), "bin int, keys binary, prints binary, docs binary, at binary, part int")
    later = windows.groupBy("bin").applyInArrow(_later, "part int, at binary")
    out = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return dealt.groupBy("part").cogroup(later.groupBy("part")).applyInArrow(
        _remove(window, gram, with_text), out + (", kept_text string" if with_text else ""))
