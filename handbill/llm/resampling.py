"""Resampling documents towards a target distribution: hashed n-gram weights, then a parallel sort by regular sampling.

*Weights.* A feature is a run of 1 to ``order`` consecutive words (runs of ASCII letters and digits, A to Z in lower case,
and of all characters beyond ASCII), joined by one space. Its bucket is the CRC-32 of its bytes modulo
``buckets``. Every task counts its own documents in an array; the sums over all documents and all target texts
give one gain a bucket, and a document's weight is the floored mean of its features' gains. Weight plus Gumbel
noise from a hash of the id is the score, so the highest scores are a draw without replacement.

*Order.* Each task sorts its rows to a run and numbers them. Every ``gap``-th row of each run is a sample, and
regular samples of the samples are the splitters, so a segment between two splitters has at most about twice its
share whatever the keys. Runs are cut at the splitters, segments are exchanged and merged, and the counts of earlier
segments give exact ranks; segments beyond the draw are not sorted. At most ``MOST`` runs and segments
are made, so the driver sees no more than about MOST * MOST sample keys, ``buckets`` sums and MOST counts.

Null texts have no words; a null id is hashed as the empty string and sorts last; rows that repeat an id are drawn
one by one, those with equal scores in order of weight and features; equal rows may be part of a segment each.
Empty tables give empty results (without target texts, all gains come from the corpus alone); other columns
are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import only, pieces, saved
from .words import blocks, word_spans

MOST = 512
SEGMENT = 8192
#: Words over this many bytes are hashed one by one.
LONG = 64

_code = np.arange(256)
#: Bytes of words in lower case; all others are a space.
WORD_BYTE = np.where((_code >= 128) | ((_code >= 48) & (_code < 58)) | ((_code >= 97) & (_code < 123)), _code, 32)
WORD_BYTE[65:91] = _code[97:123]
WORD_BYTE = WORD_BYTE.astype(np.uint8)
_crc = _code.astype(np.uint32)
for _ in range(8):
    _crc = np.where(_crc & 1, (_crc >> 1) ^ np.uint32(0xEDB88320), _crc >> 1).astype(np.uint32)
CRC = _crc


def crc_after(state: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """CRC-32 states (not inverted) after each span of bytes, from the states before them."""
    lens = stops - starts
    order = np.argsort(-lens, kind="stable")
    lens, at, out = lens[order], starts[order], state[order].astype(np.uint32)
    far = int(np.searchsorted(-lens, -LONG, "left"))
    for k in range(far):
        whole = data[at[k]: at[k] + lens[k]].tobytes()
        out[k] = zlib.crc32(whole, int(out[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for k in range(int(lens[far]) if far < len(lens) else 0):
        stop = int(np.searchsorted(-lens, -k, "left"))
        now = out[far:stop]
        out[far:stop] = CRC[(now ^ data[at[far:stop] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    back = np.empty_like(out)
    back[order] = out
    return back


def features(data: np.ndarray, offsets: np.ndarray, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, the text of each, and the number of words of each text."""
    data = WORD_BYTE[data]
    starts, stops, before = word_spans(data, offsets)
    words = np.diff(before)
    left = np.repeat(before[1:], words) - np.arange(len(starts))  # words from each to its text's end
    text = np.repeat(np.arange(len(words)), words)
    found, owner = [], []
    at = np.arange(len(starts))
    state = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    for n in range(1, order + 1):
        if n > 1:
            stay = left[at] >= n
            at, state = at[stay], state[stay]
            state = CRC[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))
        state = crc_after(state, data, starts[at + n - 1], stops[at + n - 1])
        found.append((state ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % buckets)
        owner.append(text[at])
    return np.concatenate(found), np.concatenate(owner), words


def bucket_counts(docs: DataFrame, order: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                total += np.bincount(features(data, offsets, order, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    sums = docs.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target, with one added to each count."""
    s, t = corpus.astype(float), target.astype(float)
    k = float(len(s))
    ratio = (t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, order: int, seed: int | str) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each document."""
    schema = pa.schema([("doc_id", pa.int64()), ("noise", pa.int64()), ("n_words", pa.int64()),
                        ("n_features", pa.int64()), ("weight", pa.int64())])
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column(2)):
                found, owner, words = features(data, offsets, order, buckets)
                n = np.bincount(owner, minlength=stop - first)
                total = np.zeros(stop - first, np.int64)
                np.add.at(total, owner, gain[found])
                yield pa.record_batch([
                    *(batch.column(k).slice(first, stop - first) for k in (0, 1)), pa.array(words, pa.int64()),
                    pa.array(n, pa.int64()), pa.array(total // np.maximum(n, 1), pa.int64())], schema=schema)

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((draw + 0.5) / 4294967296.0)))
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), noise.cast("bigint").alias("noise"), "text")
    made = rows.mapInArrow(weigh, "doc_id bigint, noise bigint, n_words bigint, n_features bigint, weight bigint")
    return made.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + F.col("noise")).alias("score"))


#: Highest scores first, ties to the smaller id; then what makes equal ids differ, then the place in the runs.
ORDER = ["score", "doc_id", "weight", "n_features", "place"]


class _Rows:
    """Sorted rows as a sequence of their keys, made only where a search looks."""

    def __init__(self, batch: pa.RecordBatch | pa.Table, start: int, stop: int):
        self.columns = [batch.column(x) for x in ORDER]
        self.start, self.n = start, stop - start

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, k: int) -> tuple:
        if k >= self.n:
            raise IndexError(k)
        score, doc_id, weight, n, place = (c[self.start + k].as_py() for c in self.columns)
        return -score, doc_id is None, doc_id or 0, weight, n, place


def _cut_runs(splitters: list[tuple]):
    """Adds to rows of sorted runs the number of splitters that are not above them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            segment = np.zeros(len(batch), np.int32)
            owner = batch.column("place").to_numpy() >> 33
            borders = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(batch)]
            for start, stop in zip(borders, borders[1:]):
                rows = _Rows(batch, start, stop)
                first, last = bisect_left(splitters, rows[0]), bisect_left(splitters, rows[stop - start - 1])
                segment[start:stop] = first
                for k in range(first, last + 1):
                    if k < len(splitters):
                        segment[start + bisect_left(rows, splitters[k]): stop] = k + 1
            yield batch.append_column("segment", pa.array(segment, pa.int32()))

    return run


def ranked(rows: DataFrame, take: int, count: int, segment_rows: int = SEGMENT) -> DataFrame:
    """``rows`` (of ORDER, without place) with the exact rank, from 1, of the first ``take`` ones; NULL beyond."""
    columns = rows.columns
    by = [F.desc("score"), F.asc_nulls_last("doc_id"), "weight", "n_features"]
    runs = saved(rows.coalesce(MOST).sortWithinPartitions(*by)
                 .withColumn("place", F.monotonically_increasing_id()), "resampling-runs")
    segments = min(MOST, pieces(count, segment_rows))
    run_count = runs.agg(F.max(F.shiftright("place", 33))).first()[0]
    gap = max(1, count // (segments * ((run_count or 0) + 1)))
    samples = runs.where((F.col("place") % F.lit(1 << 33)) % gap == 0).select(*ORDER).toArrow()
    order = sorted(_Rows(samples, 0, samples.num_rows))
    splitters = [order[k * len(order) // segments] for k in range(1, segments)] if order else []
    schema = StructType([*runs.schema.fields, StructField("segment", IntegerType())])
    cut = saved(runs.mapInArrow(_cut_runs(splitters), schema), "resampling-segments")
    bases, before = [], 0
    for segment, held in sorted(cut.groupBy("segment").count().collect()):
        bases.append((segment, before))
        before += held
    drawn = F.lit(max((s for s, base in bases if base < take), default=-1))
    base = F.element_at(F.create_map(*(F.lit(x) for pair in bases for x in pair)), F.col("segment")) if bases else F.lit(0)
    merged = (
        cut.where(F.col("segment") <= drawn).repartition(segments, "segment")
        .withColumn("rank", base.cast("bigint") + F.expr(
            "row_number() OVER (PARTITION BY segment ORDER BY score DESC, doc_id ASC NULLS LAST, weight, n_features, place)"))
    )
    merged = merged.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    rest = cut.where(F.col("segment") > drawn).withColumn("rank", F.lit(None).cast("bigint"))
    return merged.select(*columns, "rank").union(rest.select(*columns, "rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, order: int = 1,
             buckets: int = 10_000, seed: int | str = 2024, segment_rows: int = SEGMENT) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    Of the documents with ``least_words`` words, ``percent`` percent (rounded down) are drawn: those with the
    highest scores, ranked from 1. The others' rank is NULL.
    """
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets))
    scored = saved(weighed(docs, gain, order, seed), "resampling-scores")
    able = F.col("n_words") >= least_words
    count = scored.where(able).count()
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = ranked(scored.where(able).select(columns), percent * count // 100, count, segment_rows)
    return drawn.unionByName(scored.where(~able).select(*columns, F.lit(None).cast("bigint").alias("rank")))
