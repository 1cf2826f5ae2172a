"""Toxicity of texts after noisy-channel deobfuscation.

Words that are plain runs of letters are taken as they are, without punctuation around them. Words with
digits or signs inside, with a sign that stands for a letter at an end, or with a letter three times
running, and runs of single characters (spaced-out words), are decoded: each character gives a column of
a lattice (itself if a letter, the letters it may stand for, nothing at all), and Viterbi finds the
cheapest path through the whole word or run under a character trigram model counted over all texts. In a spaced-out run a gap may stay a
word boundary. Restored words are compared with each letter run folded to one.

A document's features are its restored words and their first four and five bytes. From a bounded sample
of labelled documents, features whose share of toxic documents is far from the overall one are kept and
weighted by logistic regression; the score is its probability, over all words of the text.

Null and empty texts have only the bias. Labels that are NULL are not used; a document with several
labels counts once for each. Without labels every score is 1/21. Rows with one id are scored one by
one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import only
from .lm import fold
from .tokens import _gather
from .words import IS_LETTER, LOWER, blocks, mix, span_hashes, word_spans

#: Characters and the letters they may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "&": "a",
}
OTHER, SIZE = 27, 28
_CODE = np.zeros(256, np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[128:] = OTHER
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LEET]] = True
_SINGLE = _SIGN | IS_LETTER


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of three characters running, words bounded by one mark, summed over the task."""
    total = np.zeros(SIZE ** 3, np.int64)
    for batch in batches:
        for _, _, data, offsets in blocks(batch.column(0)):
            code = _CODE[LOWER[data]]
            code = code[(code != 0) | np.append(True, code[:-1] != 0)]
            total += np.bincount((code[:-2] * SIZE + code[1:-1]) * SIZE + code[2:], minlength=SIZE ** 3)
    used = np.flatnonzero(total)
    yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["code", "n"])


def character_model(texts: DataFrame) -> np.ndarray:
    """Costs (-log p) of a character after two others, over all ``texts`` (one column, text)."""
    counts = np.zeros(SIZE ** 3)
    found = texts.select("text").mapInArrow(_count_trigrams, "code bigint, n bigint")
    for row in found.groupBy("code").agg(F.sum("n").alias("n")).collect():  # at most 28 ** 3 rows
        counts[row.code] = row.n
    three = counts.reshape(SIZE, SIZE, SIZE)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + 5 * p1) / (two.sum(-1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(-1, keepdims=True) + 5)
    return -np.log(p3)


def decode(token: str, cost: np.ndarray, spaced: bool = False) -> list[str]:
    """The words that a token most cheaply stands for, over its whole length.

    ``spaced``: characters came one by one, so each may begin a new word.
    """
    # a state is the last two characters of the output and the last one of the input; what it said is a
    # chain of (before, characters), so states share what they have in common
    paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    last = ""
    for place, c in enumerate(token):
        letter = c.isalpha()
        choices = [(c, 0.0)] if letter else [(x, 0.7) for x in LEET.get(c, "")]
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (sofar, said) in paths.items():
            starts = [(a, b, sofar, "")]
            if spaced and place and b:
                starts.append((b, 0, sofar + cost[a, b, 0] + 1.5, " "))
            for u, v, before, gap in starts:
                for x, channel in choices:
                    n = ord(x) - 96 if "a" <= x <= "z" else OTHER
                    at = before + channel + cost[u, v, n]
                    if (v, n) not in new or at < new[v, n][0]:
                        new[v, n] = (at, (said, gap + x))
            # nothing: a repetition, or a sign between letters
            skip = 1.0 if letter and c == last else 6.0 if c.isdigit() else 1.2
            if not letter or c == last:
                at = sofar + skip
                if (a, b) not in new or at < new[a, b][0]:
                    new[a, b] = (at, said)
        paths, last = new, c
    ends = [(sofar + cost[a, b, 0], said) for (a, b), (sofar, said) in paths.items()]
    least = min(at for at, _ in ends)
    best = min(_said(said) for at, said in ends if at == least)
    return [w for w in best.split(" ") if w]


def _said(chain: tuple | None) -> str:
    out = []
    while chain is not None:
        chain, x = chain
        out.append(x)
    return "".join(reversed(out))


_FOLD = re.compile(r"(.)\1+", re.S)


class Reader:
    """Restored words of blocks of texts, as spans of one buffer; remembers what a task decoded."""

    def __init__(self, cost: np.ndarray, memory: int = 200_000):
        self.cost, self.memory, self.known = cost, memory, {}

    def _restore(self, token: bytes, spaced: bool) -> list[bytes]:
        found = self.known.get((token, spaced))
        if found is None:
            words = decode(token.decode("utf-8", "replace"), self.cost, spaced)
            found = [_FOLD.sub(r"\1", w).encode() for w in words]
            if len(self.known) >= self.memory:
                self.known.clear()
            self.known[token, spaced] = found
        return found

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """(buffer, starts, stops, text of each): distinct restored words of each text of a block."""
        low = LOWER[data]
        starts, stops, before = word_spans(low, offsets)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
        n = len(low)
        letter = IS_LETTER[low] | (low >= 128)
        at = np.flatnonzero(letter)
        single = (stops - starts == 1) & _SINGLE[low[starts]]
        spaced, spread = self._spaced(low, starts, single, doc)
        # distinct words, each with the texts it is in
        hashes = span_hashes(low, starts, stops)
        hashes[spread] = 0  # read as part of a run
        order = np.lexsort((doc, hashes))
        h, d = hashes[order], doc[order]
        keep = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])) & (h != 0) if len(h) else h.astype(bool)
        order = order[keep]
        h, d = h[keep], d[keep]
        new = np.append(True, h[1:] != h[:-1]) if len(h) else h.astype(bool)
        which, first = np.cumsum(new) - 1, order[new]
        s, e = starts[first], stops[first]
        low_at = np.searchsorted(at, s)
        high_at = np.searchsorted(at, e)
        some = high_at > low_at
        head, tail = s.copy(), s.copy()
        head[some], tail[some] = at[low_at[some]], at[high_at[some] - 1] + 1
        triple = np.zeros(n + 1, np.int64)
        same = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) if n > 2 else np.zeros(0, bool)
        triple[1: 1 + len(same)] = np.cumsum(same)
        triple[1 + len(same):] = triple[len(same)]
        odd = some & (high_at - low_at < tail - head)
        odd |= some & (triple[np.maximum(tail - 2, head)] > triple[head])
        odd |= some & (head - s == 1) & _SIGN[low[np.maximum(head - 1, 0)]]
        odd |= some & (e - tail == 1) & _SIGN[low[np.minimum(tail, n - 1)]]
        plain = np.flatnonzero(some & ~odd)
        # plain words: folded in place
        fresh = np.ones(n, bool)
        fresh[1:] = low[1:] != low[:-1]
        fresh[head[plain]] = True
        fresh |= low >= 128  # bytes of wide characters stay
        lens = tail[plain] - head[plain]
        flat = _gather(np.arange(n), head[plain], lens)
        stay = fresh[flat]
        size = np.add.reduceat(stay.astype(np.int64), np.cumsum(lens) - lens) if len(lens) else lens
        buffers, sizes, owner = [low[flat[stay]].tobytes()], [size], [plain]
        for k in np.flatnonzero(odd):
            for word in self._restore(low[s[k]: e[k]].tobytes(), False):
                buffers.append(word)
                sizes.append(np.array([len(word)]))
                owner.append(np.array([k]))
        sizes, owner = np.concatenate(sizes), np.concatenate(owner)
        # back to texts: a word for each of its texts
        texts_of = np.searchsorted(which, np.arange(len(first) + 1))
        times = np.diff(texts_of)[owner]
        end = np.cumsum(sizes)
        text = d[_gather(np.arange(len(d)), texts_of[owner], times)]
        a, b = np.repeat(end - sizes, times), np.repeat(end, times)
        extra = [(doc_no, word) for doc_no, run in spaced for word in self._restore(run, True)]
        base = int(end[-1]) if len(end) else 0
        more = np.cumsum([0, *(len(w) for _, w in extra)]) + base
        buffer = np.frombuffer(b"".join([*buffers, *(w for _, w in extra)]), np.uint8)
        return (buffer, np.append(a, more[:-1]), np.append(b, more[1:]),
                np.append(text, np.array([k for k, _ in extra], np.int64)))

    @staticmethod
    def _spaced(low, starts, single, doc):
        """Runs of three and more one-character words: their text and characters; and their words."""
        edge = np.flatnonzero(np.append(True, (single[1:] != single[:-1]) | (doc[1:] != doc[:-1]))) \
            if len(single) else np.empty(0, np.int64)
        size = np.diff(np.append(edge, len(single)))
        runs = np.flatnonzero((size > 2) & single[edge]) if len(edge) else edge
        found = [(int(doc[edge[k]]), low[starts[edge[k]: edge[k] + size[k]]].tobytes()) for k in runs]
        return found, _gather(np.arange(len(single)), edge[runs], size[runs])

    def features(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, feature) pairs of a block."""
        buffer, a, b, text = self.words(data, offsets)
        ok = b > a
        a, b, text = a[ok], b[ok], text[ok]
        kinds = [mix(_hash(buffer, a, np.minimum(a + k, b)) + np.uint64(k)) for k in (4, 5, 1 << 20)]
        feature, text = np.concatenate(kinds), np.tile(text, 3)
        order = np.lexsort((feature, text))
        feature, text = feature[order], text[order]
        new = np.append(True, (feature[1:] != feature[:-1]) | (text[1:] != text[:-1])) if len(text) else \
            text.astype(bool)
        return text[new], feature[new]


def _hash(buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of spans that may be the same or overlap."""
    lens = stops - starts
    ends = np.cumsum(lens)
    return span_hashes(_gather(buffer, starts, lens), ends - lens, ends)


def _features_of(cost: np.ndarray):
    schema = pa.schema([("toxic", pa.int32()), ("features", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(cost)
        for batch in batches:
            for first, stop, data, offsets in blocks(batch["text"]):
                text, feature = reader.features(data, offsets)
                at = np.searchsorted(text, np.arange(stop - first + 1))
                yield pa.record_batch([batch["toxic"].slice(first, stop - first), pa.array(
                    [feature[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())], schema=schema)

    return run


def _fit(least: int, far: float, rounds: int, decay: float):
    """Keep telling features and weight them; the sample's size bounds this one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, found = [], []
        for batch in batches:
            label += batch["toxic"].to_pylist()
            found += [np.frombuffer(x, np.uint64) for x in batch["features"].to_pylist()]
        order = sorted(range(len(label)), key=lambda k: (label[k], found[k].tobytes()))
        label = np.array([label[k] for k in order], np.float64)
        found = [found[k] for k in order]
        owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
        flat = np.concatenate([np.empty(0, np.uint64), *found])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        heads = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.empty(0, np.int64)
        times = np.diff(np.append(heads, len(flat)))
        toxic = np.add.reduceat(label[owner], heads) if len(heads) else np.empty(0)
        share = (label.sum() + 1) / (len(label) + 21 if not len(label) else len(label) + 2)
        z = (toxic - times * share) / np.sqrt(times * share * (1 - share) + 1e-12)
        telling = (times >= least) & (np.abs(z) >= far)
        kept = np.repeat(telling, times)
        names, owner = flat[heads[telling]], owner[kept]
        code = np.repeat(np.arange(len(names)), times[telling])
        weights, bias = np.zeros(len(names)), np.log(share / (1 - share))
        sums, bias_sum = np.full(len(names), 1e-6), 1e-6
        for _ in range(rounds if len(names) else 0):
            z = np.bincount(owner, weights[code], len(label)) + bias
            wrong = 1 / (1 + np.exp(-z)) - label
            slope = np.bincount(code, wrong[owner], len(names)) + decay * weights
            sums += slope ** 2
            weights -= 0.3 * slope / np.sqrt(sums)
            bias_sum += wrong.sum() ** 2
            bias -= 0.3 * wrong.sum() / np.sqrt(bias_sum)
        yield pa.record_batch([[names.tobytes()], [weights.tobytes()], [float(bias)]],
                              names=["names", "weights", "bias"])

    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000, least: int = 5, far: float = 4.0,
          rounds: int = 400, decay: float = 0.01):
    """(cost, names, weights, bias): the character model of all ``docs``, the classifier of ``labels``."""
    cost = character_model(only(docs, "text"))
    known = only(labels, F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("_id IS NOT NULL AND toxic IS NOT NULL")
    share = min(1.0, max_rows / max(1, known.count()))
    draw = F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = only(docs, "doc_id", "text").join(known.where(draw < share), F.col("doc_id") == F.col("_id"))
    model = (
        sample.select("toxic", "text").mapInArrow(_features_of(cost), "toxic int, features binary")
        .repartition(1).mapInArrow(_fit(least, far, rounds, decay), "names binary, weights binary, bias double").first()
    )
    return cost, np.frombuffer(model.names, np.uint64), np.frombuffer(model.weights, np.float64), model.bias


def _scores_of(cost, names, weights, bias):
    """Scores of a column of texts; remembers decoded words from one column to the next."""
    reader = Reader(cost)

    def score(texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), float(bias))
        for first, stop, data, offsets in blocks(texts) if len(names) else ():
            text, feature = reader.features(data, offsets)
            at = np.minimum(np.searchsorted(names, feature), len(names) - 1)
            hit = names[at] == feature
            out[first:stop] += np.bincount(text[hit], weights[at[hit]], stop - first)
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))

    return score


def _score(model):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scores_of(*model)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(score(batch.column(1)))], schema=schema)

    return run


def scores(docs: DataFrame, model) -> DataFrame:
    """doc_id, score of every text."""
    return only(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _score(model), "doc_id bigint, score double")


def without_toxic(docs: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below ``threshold``, with all their columns."""
    cost, names, weights, bias = model
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scores_of(cost, names, weights, bias)
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(place)) < threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, **options) -> DataFrame:
    """Learn from the labels of all folds but one, score all documents."""
    model = train(docs, labels.where(fold("doc_id", folds) != held), **options)
    return scores(docs, model).select(
        "doc_id", (fold("doc_id", folds) == held).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
