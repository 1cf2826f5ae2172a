"""Language of texts by a linear-chain conditional random field over words.

Emissions are sums of learned weights of a word's affixes (one to three characters, as bytes), its two-
and three-byte sequences and the word itself (the lexicon), hashed into a table of bounded size.
Transitions between the labels of neighbouring words are learned with them. Training takes whole texts of
a bounded sample of labelled documents, splices spans of different documents so that languages switch within
a sequence, and follows the gradient of the sequences' likelihood, which forward-backward gives.

A text is labelled in chains of up to ``CHAIN`` words, all words of it: forward-backward gives each word's
distribution over languages. The text's language is the one with the largest mean over words that have a
letter, and that mean is its score. Texts with no letter, and NULL ones, are 'und' with score 0;
so are all texts if nothing is labelled. Rows with one id are labelled one by one; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import only
from .lm import fold
from .tokens import _gather
from .words import IS_LETTER, LOWER, blocks, mix, span_hashes, word_spans

CHAIN = 256
BITS = 17


def features(data: np.ndarray, starts: np.ndarray, stops: np.ndarray):
    """Table places of some words' features: seven for each word, then its byte sequences with their word."""
    mask = np.uint64((1 << BITS) - 1)
    fixed = np.empty((len(starts), 7), np.int64)
    spans = [(starts, np.minimum(starts + k, stops)) for k in (1, 2, 3)]
    spans += [(np.maximum(stops - k, starts), stops) for k in (1, 2, 3)] + [(starts, stops)]
    lens = stops - starts
    heads = np.cumsum(lens) - lens
    chars = _gather(data, starts, lens)
    for k, (a, b) in enumerate(spans):
        size = b - a
        fixed[:, k] = (mix(span_hashes(chars, heads + (a - starts), heads + (a - starts) + size)
                           + np.uint64(k + 1)) & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(starts)), lens)
    left = np.repeat(heads + lens, lens) - np.arange(len(chars))
    code = chars.astype(np.uint64)
    grams, whose = [], []
    for size in (2, 3):
        at = np.flatnonzero(left >= size)
        value = code[at]
        for k in range(1, size):
            value = value << np.uint64(8) | code[at + k]
        grams.append((mix(value + np.uint64(size << 32)) & mask).astype(np.int64))
        whose.append(owner[at])
    return fixed, np.concatenate(grams), np.concatenate(whose)


def emissions(weights: np.ndarray, fixed, grams, whose) -> np.ndarray:
    out = weights[fixed].sum(1)
    for label in range(weights.shape[1]):
        out[:, label] += np.bincount(whose, weights[grams, label], len(out))
    return out


def forward_backward(emit: np.ndarray, moves: np.ndarray, real: np.ndarray):
    """Posteriors of (chain, place, label), expected moves, log-likelihood's normaliser of each chain.

    Places past a chain's end (not ``real``) are passed through.
    """
    chains, length, n = emit.shape
    top = emit.max(-1, keepdims=True)
    likely, step = np.exp(emit - top), np.exp(moves)
    ahead, scale = np.empty_like(likely), np.ones((chains, length), likely.dtype)
    now = likely[:, 0]
    for t in range(length):
        if t:
            now = np.where(real[:, t, None], (now @ step) * likely[:, t], now)
        scale[:, t] = now.sum(-1)
        now = now / scale[:, t, None]
        ahead[:, t] = now
    back = np.ones((chains, n), likely.dtype)
    posterior, pairs = np.empty_like(likely), np.zeros((n, n))
    for t in range(length - 1, -1, -1):
        now = ahead[:, t] * back
        posterior[:, t] = now / now.sum(-1, keepdims=True)
        if t:
            onward = likely[:, t] * back / scale[:, t, None]
            on = real[:, t]
            pairs += np.einsum("ci,cj->ij", ahead[on, t - 1], onward[on]) * step
            back = np.where(real[:, t, None], onward @ step.T, back)
    return posterior, pairs, (np.log(scale) + top[..., 0]).sum(1, where=real)


def _words_of(data: np.ndarray, offsets: np.ndarray):
    """Distinct words of a block (features' arguments), which one each word is, words before each text."""
    data = LOWER[data]
    starts, stops, before = word_spans(data, offsets)
    hashes = span_hashes(data, starts, stops)
    order = np.argsort(hashes)
    new = np.ones(len(order), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    first = order[new]
    return data, starts[first], stops[first], which, before


def _train(labels: list[str], rounds: int, switch: float, decay: float):
    """Fit the field in one task; the sample's size bounds it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=pa.schema(
            [("text", pa.string()), ("lang", pa.string()), ("doc_id", pa.int64())]))
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        draw = np.random.default_rng(99)
        parts, words, gold, base = [], [], [], 0
        places = {x: k for k, x in enumerate(labels)}
        tags = np.array([places[x] for x in table["lang"].to_pylist()], np.int64)
        for first, stop, data, offsets in blocks(table["text"]):
            low, starts, stops, which, before = _words_of(data, offsets)
            fixed, grams, whose = features(low, starts, stops)
            parts.append((fixed, grams, whose + base))
            words.append(which + base)
            gold.append(np.repeat(tags[first:stop], np.diff(before)))
            base += len(starts)
        fixed, grams, whose = (np.concatenate(x) for x in zip(*parts))
        words, gold = np.concatenate(words), np.concatenate(gold)
        # spans of about 1 / switch words, in random order, make sequences that change language
        cuts = np.flatnonzero((draw.random(len(words)) < switch) | np.append(True, gold[1:] != gold[:-1]))
        ends = np.append(cuts[1:], len(words))
        turn = draw.permutation(len(cuts))
        order = _gather(np.arange(len(words)), cuts[turn], (ends - cuts)[turn])
        chains = -(-len(order) // CHAIN)
        real = (np.arange(chains * CHAIN) < len(order)).reshape(chains, CHAIN)
        order = np.append(order, np.zeros(chains * CHAIN - len(order), np.int64))
        words, gold = words[order].reshape(chains, CHAIN), gold[order].reshape(chains, CHAIN)
        n = len(labels)
        weights, moves = np.zeros((1 << BITS, n), np.float32), np.zeros((n, n), np.float32)
        sums, move_sums = np.full(weights.shape, 1e-6, np.float32), np.full((n, n), 1e-6, np.float32)
        truth = np.eye(n, dtype=np.float32)[gold] * real[..., None]
        steps = (real[:, 1:] & real[:, :-1]).reshape(-1)
        told = np.zeros((n, n))
        np.add.at(told, (gold[:, :-1].reshape(-1)[steps], gold[:, 1:].reshape(-1)[steps]), 1)
        flat = words.reshape(-1)
        for _ in range(rounds):
            emit = emissions(weights, fixed, grams, whose)[words] * real[..., None]
            posterior, pairs, _ = forward_backward(emit.astype(np.float32), moves, real)
            wrong = ((posterior * real[..., None]) - truth).reshape(-1, n)
            for label in range(n):
                by_word = np.bincount(flat, wrong[:, label], base)
                slope = np.bincount(grams, by_word[whose], 1 << BITS)
                for k in range(fixed.shape[1]):
                    slope += np.bincount(fixed[:, k], by_word, 1 << BITS)
                slope = slope + decay * weights[:, label]
                sums[:, label] += slope ** 2
                weights[:, label] -= 0.5 * slope / np.sqrt(sums[:, label])
            slope = pairs - told
            move_sums += slope ** 2
            moves -= (0.5 * slope / np.sqrt(move_sums)).astype(np.float32)
        yield pa.record_batch([[weights.tobytes()], [moves.tobytes()]], names=["weights", "moves"])

    return run


def train(labelled: DataFrame, max_rows: int = 1000, rounds: int = 40, switch: float = 0.05,
          decay: float = 0.1):
    """(labels, weights, moves) from up to ``max_rows`` labelled texts per language."""
    sample = only(labelled, "doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    labels = sorted(counts)
    if not labels:
        return [], np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0), np.float32)
    share = F.element_at(F.create_map(*(x for k in labels for x in (
        F.lit(k), F.lit(min(1.0, max_rows / counts[k]))))), F.col("lang"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    model = (
        sample.where(draw < share)
        .select("text", "lang", F.col("doc_id").cast("bigint").alias("doc_id"))
        .repartition(1).mapInArrow(_train(labels, rounds, switch, decay), "weights binary, moves binary").first()
    )
    n = len(labels)
    return (labels, np.frombuffer(model.weights, np.float32).reshape(-1, n),
            np.frombuffer(model.moves, np.float32).reshape(n, n))


def _label(labels: list[str], weights: np.ndarray, moves: np.ndarray):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    names = np.array([*labels, "und"], object)
    n = len(labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column(1)):
                low, starts, stops, which, before = _words_of(data, offsets)
                best, score = np.full(stop - first, n), np.zeros(stop - first)
                if len(which) and n:
                    table = emissions(weights, *features(low, starts, stops)).astype(np.float32)
                    plain, wide = (np.concatenate(([0], np.cumsum(x))) for x in (IS_LETTER[low], low >= 128))
                    has = plain[stops] > plain[starts]
                    for k in np.flatnonzero(~has & (wide[stops] > wide[starts])):
                        has[k] = _alphabetic(low[starts[k]: stops[k]])
                    table[~has] = 0
                    words = np.diff(before)
                    count = -(-words // CHAIN)
                    doc = np.repeat(np.arange(len(words)), count)
                    turn = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                    head = before[doc] + turn * CHAIN
                    size = np.minimum(CHAIN, before[doc + 1] - head)
                    long = int(size.max())
                    total, seen = np.zeros((len(words), n)), np.zeros(len(words))
                    for k in range(0, len(doc), 4096):
                        own = slice(k, k + 4096)
                        place = head[own, None] + np.arange(long)
                        real = np.arange(long) < size[own, None]
                        at = which[np.where(real, place, 0)]
                        posterior, _, _ = forward_backward(table[at] * real[..., None], moves, real)
                        use = real & has[at]
                        np.add.at(total, doc[own], (posterior * use[..., None]).sum(1))
                        np.add.at(seen, doc[own], use.sum(1))
                    some = seen > 0
                    best[some] = total[some].argmax(1)
                    score[some] = np.minimum(total[some].max(1) / seen[some], 1.0)
                yield pa.record_batch([batch.column(0).slice(first, stop - first),
                                       pa.array(names[best], pa.string()), pa.array(score)], schema=schema)

    return run


def _alphabetic(word: np.ndarray) -> bool:
    return any(c.isalpha() for c in word.tobytes().decode("utf-8", "replace"))


def languages(docs: DataFrame, model) -> DataFrame:
    """doc_id, lang_pred, score of every text."""
    return only(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _label(*model), "doc_id bigint, lang_pred string, score double")


def held_out_languages(docs: DataFrame, folds: int = 5, held: int = 0, **options) -> DataFrame:
    """Learn from all folds but one, label all documents."""
    model = train(docs.where(fold("doc_id", folds) != held), **options)
    return languages(docs, model).select(
        "doc_id", (fold("doc_id", folds) == held).alias("held_out"), "lang_pred", "score")
