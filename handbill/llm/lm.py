"""An interpolated modified Kneser-Ney bigram model, counted in Spark, and scores of texts by it.

Tokens are the words of a text with A-Z lower-cased, then one end token; a start mark is the first
context. Counting goes through three Spark jobs: tokens by hash, bigrams by hash, and per word the
number of distinct words before it and the counts of its own continuations. Map tasks count first
and send sorted arrays for each range of hashes, so neither a frequent word nor a frequent context
is ever gathered in one task. What is kept are sorted hash arrays and dense arrays by word number in
the shared folder; workers memory-map them, and look up each block's distinct bigrams in order.

p(w | u) = max(c(uw) - D(c(uw)), 0) / c(u) + g(u) p(w)
p(w)     = max(k(w) - D'(k(w)), 0) / K + g' / (V + 1)

with k(w) the number of distinct words before w, K their sum, discounts D and D' from the counts of
counts (one, two, three or more), and g what the discounts leave. Words never seen in training share
the last term; a context never seen leaves p(w).

Null texts are empty texts: one end token. A null id counts as the empty text when rows are dealt
into training and held out. Rows with the same id are scored one by one; an empty training set
gives the uniform model; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import by_part, counted, from_planes, mapped, range_of, store, summed
from .common import only, pieces, saved, shared_folder, text_bytes_of
from .words import LOWER, blocks, mix, span_hashes, word_spans

END = np.uint64(0x5DEECE66D1CE4E5B)
_COUNTS = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_STATS = pa.schema([("part", pa.int32()), *((x, pa.binary()) for x in (
    "ids", "before", "total", "one", "two", "more"))])
FLUSH = 2 << 20


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % folds


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of a block of texts, and where each text starts."""
    data = LOWER[data]
    starts, stops, before = word_spans(data, offsets)
    at = before + np.arange(len(before))
    out = np.full(at[-1], END, np.uint64)
    own = np.ones(len(out), bool)
    own[at[1:] - 1] = False
    out[own] = span_hashes(data, starts, stops)
    return out, at


def _count(keys_of, parts: int):
    """Count keys in each task and send them on by range, in order."""
    def rows(kept):
        keys, counts = counted(np.concatenate(kept))
        return by_part(range_of(keys, parts), parts, [keys, counts.astype(np.uint32)], _COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                kept.append(keys_of(data, offsets))
                held += len(kept[-1])
                if held > FLUSH:
                    yield rows(kept)
                    kept, held = [], 0
        if held:
            yield rows(kept)

    return run


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4)]


def _merged(table: pa.Table):
    return summed(from_planes(table["keys"], np.uint64),
                  from_planes(table["counts"], np.uint32).astype(np.int64))


def _store_words(folder: str):
    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        keys, counts = _merged(table)
        store(folder, f"word-{part}", keys)
        store(folder, f"count-{part}", counts)
        return pa.table({"part": pa.array([part], pa.int32()), "n": [len(keys)],
                         "total": [int(counts.sum())]})

    return run


class Words:
    """The numbers of words: their place in the order of hashes."""

    def __init__(self, folder: str, sizes: list[int]):
        self.folder, self.parts = folder, len(sizes)
        self.bases = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.size = int(self.bases[-1])

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: unknown) and count of each of some hashes."""
        order = np.argsort(hashes)
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        names = hashes[order][new]
        number, count = np.full(len(names), -1, np.int64), np.zeros(len(names), np.int64)
        edges = np.searchsorted(range_of(names, self.parts), np.arange(self.parts + 1))
        for part in np.flatnonzero(np.diff(edges)):
            if self.bases[part + 1] == self.bases[part]:
                continue
            held, own = mapped(self.folder, f"word-{part}"), slice(edges[part], edges[part + 1])
            at = np.minimum(np.searchsorted(held, names[own]), len(held) - 1)
            hit = held[at] == names[own]
            number[own] = np.where(hit, at + self.bases[part], -1)
            count[own] = np.where(hit, mapped(self.folder, f"count-{part}")[at], 0)
        which = np.empty(len(hashes), np.int64)
        which[order] = np.cumsum(new) - 1
        return number[which], count[which]


def _bigrams(words: Words, hashes: np.ndarray, at: np.ndarray):
    """(context numbers, word numbers, counts) of a block's tokens; the start mark is number V."""
    number, count = words.numbers(hashes)
    context = np.empty_like(number)
    context[1:] = number[:-1]
    context[at[:-1]] = words.size
    return context, number, count


def _key(context: np.ndarray, number: np.ndarray) -> np.ndarray:
    return mix(context.astype(np.uint64) << np.uint64(32) | number.astype(np.uint64))


def unmix(h: np.ndarray) -> np.ndarray:
    back = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * back
    return h ^ (h >> np.uint64(32))


def _store_bigrams(folder: str, per_part: int, id_parts: int):
    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        keys, counts = _merged(table)
        store(folder, f"pair-{part}", keys)
        store(folder, f"pairs-{part}", np.minimum(counts, 0xFFFFFFFF).astype(np.uint32))
        pair = unmix(keys)
        context, word = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
        del pair, keys
        words, before = counted(word)
        contexts, *found = summed(context, counts, *(
            hit.astype(np.int64) for hit in (counts == 1, counts == 2, counts > 2)))
        none = np.zeros(len(words), np.int64)
        ids, *stats = summed(
            np.concatenate((words, contexts)), np.concatenate((before, np.zeros(len(contexts), np.int64))),
            *(np.concatenate((none, x)) for x in found))
        out = by_part(ids // per_part, id_parts, [ids, *stats], _STATS)
        extra = [pa.array([n] * out.num_rows, pa.int64()) for n in _counts_of_counts(counts)]
        first = pa.array(np.arange(out.num_rows) == 0)
        return pa.Table.from_arrays([*out.columns, first, *extra],
                                    names=[*_STATS.names, "first", "n1", "n2", "n3", "n4"])

    return run


def _store_stats(folder: str, per_part: int, size: int):
    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        ids, before, total, one, two, more = summed(
            *(from_planes(table[x], np.int64) for x in _STATS.names[1:]))
        n = min(per_part, size - part * per_part)
        dense = np.zeros((5, n), np.int64)
        dense[:, ids - part * per_part] = before, total, one, two, more
        store(folder, f"before-{part}", dense[0])
        store(folder, f"context-{part}", np.ascontiguousarray(dense[1:].T))
        ns = _counts_of_counts(before)
        return pa.table({"part": pa.array([part], pa.int32()), "n1": [ns[0]], "n2": [ns[1]], "n3": [ns[2]],
                         "n4": [ns[3]], "words": [int((before > 0).sum())], "total": [int(before.sum())]})

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, 3 and more, from counts of counts."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 else 0.0,
           3 - 4 * y * n4 / n3 if n3 else 0.0]
    return np.array([0.0, *(min(max(d, 0.0), float(k)) for k, d in enumerate(raw, 1))])


class Model:
    """A trained model: folders and a few numbers; workers map what they look up."""

    def __init__(self, words, folder, parts, per_part, total, pair, single, kinds, left):
        self.words, self.folder, self.parts, self.per_part = words, folder, parts, per_part
        self.total, self.pair, self.single, self.kinds, self.left = total, pair, single, kinds, left

    def _dense(self, name: str, ids: np.ndarray, width: tuple = ()) -> np.ndarray:
        """Rows of the dense arrays for some numbers of words."""
        out = np.zeros((len(ids), *width), np.int64)
        order = np.argsort(ids)
        edges = np.searchsorted(ids[order], np.arange(0, self.words.size + self.per_part + 1, self.per_part))
        for k in np.flatnonzero(np.diff(edges)):
            own = order[edges[k]: edges[k + 1]]
            out[own] = mapped(self.folder, f"{name}-{k}")[ids[own] - k * self.per_part]
        return out

    def single_probability(self, number: np.ndarray) -> np.ndarray:
        spread = 1.0 / (self.words.size + 1)
        if not self.kinds:
            return np.full(len(number), spread)
        known = number >= 0
        before = np.zeros(len(number), np.int64)
        before[known] = self._dense("before", number[known])
        kept = np.maximum(before - self.single[np.minimum(before, 3)], 0.0)
        return kept / self.kinds + self.left * spread

    def probability(self, context: np.ndarray, number: np.ndarray) -> np.ndarray:
        """p(word | context) of bigrams, looked up once each."""
        lower = self.single_probability(number)
        if not self.kinds:
            return lower
        seen = np.zeros(len(number), np.int64)
        known = np.flatnonzero((context >= 0) & (number >= 0))
        keys = _key(context[known], number[known])
        edges = np.searchsorted(range_of(keys, self.parts), np.arange(self.parts + 1))
        for part in np.flatnonzero(np.diff(edges)):
            own = slice(edges[part], edges[part + 1])
            held = mapped(self.folder, f"pair-{part}")
            at = np.minimum(np.searchsorted(held, keys[own]), len(held) - 1)
            hit = held[at] == keys[own]
            seen[known[own]] = np.where(hit, mapped(self.folder, f"pairs-{part}")[at], 0)
        stats = np.zeros((len(number), 4), np.int64)
        has = context >= 0
        stats[has] = self._dense("context", context[has], (4,))
        total = stats[:, 0]
        left = stats[:, 1:] @ self.pair[1:]
        kept = np.maximum(seen - self.pair[np.minimum(seen, 3)], 0.0)
        return np.where(total > 0, (kept + left * lower) / np.maximum(total, 1), lower)

    def score(self, data: np.ndarray, offsets: np.ndarray):
        """Per text of a block: tokens, known tokens, log10 by counts, log10 by the model."""
        hashes, at = tokens(data, offsets)
        context, number, count = _bigrams(self.words, hashes, at)
        # distinct bigrams in the order of their look-up
        order = np.argsort(_key(context + 1, number + 1))
        c, w = context[order], number[order]
        new = np.ones(len(order), bool)
        new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
        c, w = c[new], w[new]
        look = np.argsort(_key(c, w))
        p = np.empty(len(c))
        p[look] = np.log10(self.probability(c[look], w[look]))
        value = np.empty(len(order))
        value[order] = p[np.cumsum(new) - 1]
        base = np.log10((count + 1) / (self.total + self.words.size + 1))
        heads = at[:-1]
        return (np.diff(at), np.add.reduceat((count > 0).astype(np.int64), heads),
                np.add.reduceat(base, heads), np.add.reduceat(value, heads))


def train(texts: DataFrame, part_bytes: int = 12 << 20, per_part: int = 1 << 16) -> Model:
    """Count ``texts`` (one column, text) into a model in the shared folder."""
    spark = texts.sparkSession
    folder = shared_folder(spark, "lm")
    parts = pieces(text_bytes_of(texts), part_bytes)
    counts = "part int, keys binary, counts binary"
    found = (
        texts.select("text").mapInArrow(_count(lambda d, o: tokens(d, o)[0], parts), counts)
        .groupBy("part").applyInArrow(_store_words(folder), "part int, n bigint, total bigint").collect()
    )
    sizes = [0] * parts
    for row in found:
        sizes[row.part] = row.n
    words = Words(folder, sizes)
    if words.size >= 1 << 32:
        raise ValueError("word numbers need more than 32 bits")

    def keys(data, offsets):
        context, number, _ = _bigrams(words, *tokens(data, offsets))
        return _key(context, number)

    id_parts = pieces(words.size + 1, per_part)
    stats = ", ".join(f"{x} binary" for x in _STATS.names[1:])
    more = "first boolean, n1 bigint, n2 bigint, n3 bigint, n4 bigint"
    pairs = texts.select("text").mapInArrow(_count(keys, parts), counts).groupBy("part").applyInArrow(
        _store_bigrams(folder, per_part, id_parts), f"part int, {stats}, {more}")
    pairs = saved(pairs, "lm-stats")
    pair = pairs.where("first").agg(*(F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in (1, 2, 3, 4))).first()
    singles = pairs.select(*_STATS.names).groupBy("part").applyInArrow(
        _store_stats(folder, per_part, words.size + 1),
        "part int, n1 bigint, n2 bigint, n3 bigint, n4 bigint, words bigint, total bigint").collect()
    ns = [sum(row[f"n{k}"] for row in singles) for k in (1, 2, 3, 4)]
    kinds, seen = sum(row.total for row in singles), sum(row.words for row in singles)
    single = discounts(*ns)
    left = float(single @ [0, ns[0], ns[1], seen - ns[0] - ns[1]]) / kinds if kinds else 1.0
    return Model(words, folder, parts, per_part, sum(r.total for r in found), discounts(*pair), single,
                 kinds, left)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(first, stop - first),
                                       *map(pa.array, model.score(data, offsets))], schema=schema)

    return only(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def held_out_scores(docs: DataFrame, folds: int = 7, held: int = 2, **options) -> DataFrame:
    """Train on all documents but one fold, score all; see the query's contract for the columns."""
    docs = only(docs, "doc_id", "text")
    model = train(docs.where(fold("doc_id", folds) != held).select("text"), **options)
    return score(docs, model).select(
        "doc_id", (fold("doc_id", folds) == held).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("bigint").alias("train_tokens"), "base_score", "score")
