"""Operators for training text against brute force, on small tables with awkward rows."""

import collections
import hashlib
import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from handbill.llm import (
    exact, jaccard, langid, lm, mixing, packing, substrings, tokens, toxicity, vectors,
)
from handbill.llm.arrays import labels
from handbill.llm.common import components, saved

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, bin int, _n int"


def words_of(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 6))) for _ in range(300)]
    passage = " ".join(draw.choice(vocabulary) for _ in range(45))
    out = []
    for k in range(150):
        text = " ".join(draw.choice(vocabulary) for _ in range(draw.choice([0, 1, 3, 30, 120, 400])))
        if k % 3 == 0:
            text = f"{text}\n{passage} \t{text[:50]}"
        out.append([k * 7 % 151, text])
    copies = [[200 + k, out[k * 5][1].replace(" ", "  ", 3)] for k in range(12)]
    near = [[300 + k, out[4][1] + " " + passage + f" tail{k} end"] for k in range(9)]
    awkward = [[400, None], [401, ""], [402, " \n "], [403, "é"], [404, "x" * 9000], [None, "without id"],
               [405, "same"], [405, "same"], [406, "same"], [407, " ".join(["again"] * 90)], [408, "123 !!!"]]
    return [(i, t, "en", None if k % 7 == 0 else f"s{k % 3}", 0, "clash", 1, 1)
            for k, (i, t) in enumerate(out + copies + near + awkward)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def counter(frame):
    return collections.Counter(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("key, capacity", [(F.xxhash64, 1 << 17), (F.xxhash64, 8),
                                           (lambda c: F.xxhash64(c) % 4, 8)])
def test_exact_copies_also_in_chains(docs, rows, key, capacity):
    import re

    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    want = collections.Counter()
    for text, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, least, len(ids), i == least, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert counter(exact.exact_duplicates(docs, key=key, capacity=capacity, per_file=50)) == want


def test_directory_holds_buckets_within_capacity(docs):
    index, slots, depths = exact.build_index(docs, capacity=10, per_file=40)
    assert index.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 10
    files = index.withColumn("f", F.input_file_name()).groupBy("bucket").agg(F.count_distinct("f").alias("n"))
    assert files.agg(F.max("n")).first()[0] == 1
    assert index.where("chain > 0").count() == 0
    assert slots.groupBy("depth", "slot").count().where("count > 1").isEmpty()
    # a bucket is a prefix of its keys, and one that had room would not have been split further
    for r in index.collect():
        assert r.bucket == (1 << r.local_depth) + ((r.key % (1 << 64)) >> (64 - r.local_depth))
    held = collections.Counter((r.local_depth, r.bucket) for r in index.collect())
    for (depth, bucket), n in held.items():
        parent = sum(m for (d, b), m in held.items() if d >= depth and b >> (d - depth + 1) == bucket >> 1)
        assert depth == 0 or parent > 10


def test_buckets_split_until_they_fit_or_hold_one_chain(spark):
    """Keys that differ in their last bits only: the directory gets as deep as that, and chains stay whole."""
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(200)], "doc_id bigint, text string")
    low = lambda c: F.xxhash64(c) % 4 + 8
    index, slots, depths = exact.build_index(docs, capacity=5, key=low)
    assert max(depths) >= 60
    assert index.groupBy("bucket").agg(F.count_distinct("key").alias("k")).agg(F.max("k")).first()[0] <= 2
    chains = collections.defaultdict(list)
    for r in index.collect():
        chains[r.key].append(r.chain)
    assert len(chains) > 1 and all(sorted(c) == list(range(len(c))) for c in chains.values())
    got = exact.exact_duplicates(docs, key=low, capacity=5).collect()
    assert sorted(r.doc_id for r in got if r.kept and r.group_size == 1) == list(range(200))


@pytest.mark.parametrize("options", [{}, {"part_bytes": 4000}, {"part_bytes": 4000, "capacity": 3},
                                     {"part_bytes": 4000, "window": 6, "gram": 3}])
def test_repeats_go_and_their_first_stays(docs, rows, options):
    size = options.get("window", 20)
    seen, want = set(), collections.Counter()
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        words = words_of(t)
        gone = [False] * len(words)
        for k in range(len(words) - size + 1):
            one = tuple(words[k: k + size])
            if one in seen:
                gone[k: k + size] = [True] * size
            seen.add(one)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        want[i, len(words), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()] += 1
    assert counter(substrings.remove_repeats(docs, with_text=True, **options)) == want


def test_different_windows_below_one_prefix_stay(spark):
    """A phrase all documents share, with different text around it: 300,000 windows, none of them twice."""
    import pyarrow as pa

    draw = random.Random(12)
    word = lambda: f"{draw.randrange(1 << 40):x}"
    some = [word() for _ in range(100_000)]
    one = substrings.Part(pa.table({"doc_id": [0], "text": [" ".join(some)]}), 8, 8)
    k = int(one.key.argmin())  # so it is the prefix of each window that holds it
    phrase = some[int(one.at[k]): int(one.at[k]) + 8]
    texts = [" ".join([*(word() for _ in range(12)), *phrase, *(word() for _ in range(12))]) for _ in range(23_000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = substrings.remove_repeats(frame, part_bytes=1 << 20, capacity=1 << 20)
    assert got.agg(F.count("*"), F.sum("n_words"), F.sum("n_removed")).first()[:] == (23_000, 23_000 * 32, 0)


def test_token_files_hold_all_ids_in_order(docs, rows, spark):
    path = tokens.vocabulary("byte_bpe_50k.json")
    got = tokens.write_token_files(docs, path, part_bytes=20_000).read(spark).collect()
    assert [r.start for r in sorted(got, key=lambda r: r.start)] == [
        0, *np.cumsum([r.n_tokens for r in sorted(got, key=lambda r: r.start)])[:-1]]
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    tool = tokens.library(path)
    want = collections.Counter()
    for i, t, *_ in rows:
        own = tool.encode(t or "", add_special_tokens=False).ids + [2]
        want[i, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_spans_encode_as_whole_texts(spark, name):
    draw = random.Random(8)
    parts = ["a", "The", "'s", "'", "it's", "1", "23", ",", ".", "  ", " ", "\n", "\t", "é", "È", "à", "ß", "—", "中文",
             "<|endoftext|>", "<|ENDOFTEXT|>", "|", "<", "\x1c", "\x85", " ", " ", "　", "́", "İ",
             "Σ", "😀", "_", "-"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(600)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    path = tokens.vocabulary(name)
    tool = tokens.library(path)
    got = packing.pack(frame, path).groupBy("doc_id").agg(F.max("doc_tokens").alias("n"), F.max("ids_crc32").alias("c"))
    own = [tool.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert {tuple(r) for r in got.collect()} == {
        (k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in enumerate(own)}


@pytest.mark.parametrize("files, file_bytes", [(3, 1 << 20), (3, 700), (2, 0)])
def test_spans_beyond_the_dictionary_are_encoded_in_place(docs, rows, files, file_bytes):
    path = tokens.vocabulary("byte_bpe_50k.json")
    encoder = tokens.Encoder.of(docs, path, part_bytes=4000, files=files, file_bytes=file_bytes)
    assert encoder.parts > files == encoder.files
    assert len(os.listdir(encoder.folder)) <= 4 * files
    known = sum(len(np.load(f"{encoder.folder}/{k}.hash.npy")) for k in range(files))
    texts = [t or "" for _, t, *_ in rows]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    starts, stops = tokens.spans(data, offsets, tokens.keeps_space(path))
    distinct = len({data[a:b].tobytes() for a, b in zip(starts, stops)})
    assert known == distinct if file_bytes == 1 << 20 else known < distinct
    ids, at = encoder.encode(data, offsets, 2)
    tool = tokens.library(path)
    for k, text in enumerate(texts):
        assert ids[at[k]: at[k + 1]].tolist() == tool.encode(text, add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("length, group", [(64, 40), (4096, 8192)])
def test_packing_is_a_partition_without_gaps(docs, rows, length, group):
    got = packing.pack(docs, tokens.vocabulary("word_bpe_49k.json"), length=length, group_rows=group).collect()
    by_sequence = collections.defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= length
    pieces = collections.Counter((r.doc_id, r.doc_tokens, r.start, r.length) for r in got)
    tool = tokens.library(tokens.vocabulary("word_bpe_49k.json"))
    want = collections.Counter()
    for i, t, *_ in rows:
        n = len(tool.encode(t or "", add_special_tokens=False).ids) + 1
        for k in range(0, n, length):
            want[i, n, k, min(length, n - k)] += 1
    assert pieces == want


@pytest.mark.parametrize("doc_id", [None, 7])
def test_packing_spreads_rows_of_one_id(spark, doc_id):
    frame = spark.createDataFrame([(doc_id, "same words"), *((doc_id, f"w {k}") for k in range(1500)),
                                   *((doc_id, "same words") for _ in range(1500))], "doc_id bigint, text string")
    path = tokens.vocabulary("word_bpe_49k.json")
    got = packing.pack(frame, path, length=16, group_rows=100).collect()
    sizes = collections.Counter(r.sequence_id >> 32 for r in got)
    assert len(got) == 3001 and len(sizes) > 20 and max(sizes.values()) < 200
    assert sorted(map(str, got)) == sorted(map(str, packing.pack(frame, path, length=16, group_rows=100).collect()))


def test_first_fit_decreasing_equals_the_plain_search():
    draw = np.random.default_rng(3)
    for _ in range(20):
        sizes = draw.integers(1, 101, draw.integers(1, 60))
        got, _ = packing.first_fit_decreasing(sizes, 100)
        room, want = [], np.empty(len(sizes), int)
        for k in np.argsort(-sizes, kind="stable"):
            spot = next((b for b, r in enumerate(room) if r >= sizes[k]), len(room))
            if spot == len(room):
                room.append(100)
            room[spot] -= sizes[k]
            want[k] = spot
        assert (got == want).all()


@pytest.mark.parametrize("options", [{}, {"capacity": 3, "group": 3, "node_rows": 20, "set_rows": 3}])
def test_similar_documents_by_brute_force(docs, rows, options):
    sets, ids = [], []
    for i, t, *_ in rows:
        words = words_of(t)
        if i is not None and words:
            ids.append(i)
            sets.append(frozenset(tuple(words[k: k + 5]) for k in range(len(words) - 4)) or frozenset([tuple(words)]))
    n = len(sets)
    link = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(a):
            both = len(sets[a] & sets[b])
            link[a, b] = link[b, a] = both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9
    order = np.argsort(ids, kind="stable")
    i, j = np.nonzero(link[order][:, order])
    root = labels(n, i, j)
    want = {(ids[k], int(link[k].sum()), ids[order[root[p]]]) for p, k in enumerate(order)}
    want |= {(i, 0, i) for i, t, *_ in rows if i is None or not words_of(t)}
    got = jaccard.similar_documents(docs, **options)
    assert got.count() == len(rows)
    assert {(r.doc_id, r.n_links, r.component_id) for r in got.collect()} == want


def test_prefix_shortens_to_the_target_recall():
    assert jaccard.prefix_length(0.8, 20, 8, 0.9999) == 4
    assert jaccard.prefix_length(0.8, 20, 8, 0.9) > 4


def test_components(spark):
    draw = np.random.default_rng(2)
    i, j = draw.integers(0, 400, 300), draw.integers(0, 400, 300)
    chain = np.arange(500, 540)
    i, j = np.concatenate((i, chain[1:])), np.concatenate((j, chain[:-1]))
    want = labels(600, i, j)
    frame = spark.createDataFrame([(int(a), int(b)) for a, b in zip(i, j)], "u bigint, v bigint")
    assert {(r.node, r.root) for r in components(frame).collect()} == {
        (int(k), int(want[k])) for k in np.unique(np.concatenate((i[i != j], j[i != j])))}


def test_mixing_reaches_targets_and_stops_at_the_budget(docs, rows):
    got = mixing.mix(docs, rows=20).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for _, t, _, s, *_ in rows:
        size[s] += len(words_of(t))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, open_ = {}, set(size)
    while True:  # share, stop those above, share again
        left = sum(size.values()) - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 3 * size[s]]
        if not over:
            break
        target |= {s: 3 * size[s] for s in over}
        open_ -= set(over)
    target |= {s: level * weight[s] for s in open_}
    taken = collections.Counter()
    for r in got:
        assert r.source_size == size[r.source] and math.isclose(r.target, target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= 1
    assert sum(taken.values()) <= sum(size.values())
    assert counter(mixing.mix(docs, rows=7).drop("position")) == counter(mixing.mix(docs.repartition(5)).drop("position"))


def test_mixed_documents_come_as_often_as_taken(docs):
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+"))
    assert got.agg(F.sum(words)).first()[0] == mixing.mix(docs).agg(F.sum("taken")).first()[0]


def test_languages_of_code_switched_and_empty_texts(spark):
    draw = random.Random(1)
    kinds = {"aa": ["kalo", "kami", "kasu", "kaleth"], "bb": ["wurt", "wunden", "wulf", "wust"]}
    data = [(k, " ".join(draw.choice(kinds[lang]) for _ in range(30)), lang)
            for k, lang in enumerate(["aa", "bb"] * 40)]
    data += [(500, None, "aa"), (501, "", "bb"), (502, "12 !? —", None), (None, "kami kasu", None),
             (503, "kalo " * 3000, None), (503, "wulf", None), (504, "kalo kami kasu wulf", None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    got = langid.held_out_languages(docs)
    by = {(r.doc_id, r.lang_pred) for r in got.collect()}
    assert got.count() == len(data)
    assert {(k, lang) for k, _, lang in data[:80]} <= by
    assert {(500, "und"), (501, "und"), (502, "und"), (503, "aa"), (503, "bb"), (None, "aa"), (504, "aa")} <= by
    assert got.where("score < 0 OR score > 1 OR (lang_pred = 'und' AND score <> 0)").count() == 0


def test_forward_backward_equals_enumeration():
    import itertools

    draw = np.random.default_rng(0)
    emit, moves = draw.normal(size=(1, 4, 3)), draw.normal(size=(3, 3))
    posterior, pairs, norm = langid.forward_backward(emit, moves, np.ones((1, 4), bool))
    total, want, steps = 0.0, np.zeros((4, 3)), np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=4):
        p = math.exp(sum(emit[0, k, x] for k, x in enumerate(path))
                     + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += p
        for k, x in enumerate(path):
            want[k, x] += p
        for a, b in zip(path, path[1:]):
            steps[a, b] += p
    assert np.allclose(posterior[0], want / total)
    assert np.allclose(pairs, steps / total)
    assert np.isclose(norm[0], math.log(total))


def test_toxic_words_are_found_through_disguises(spark):
    draw = random.Random(5)
    plain = ["river", "table", "stone", "garden", "window", "letter", "summer", "paper", "morning", "idea"]
    data, marks = [], []
    for k in range(300):
        words = [draw.choice(plain) for _ in range(20)]
        if k % 5 == 0:
            words[draw.randrange(20)] = words[draw.randrange(20)] = draw.choice(["grumbol", "snerdle"])
        data.append((k, " ".join(words)))
        marks.append((k, int(k % 5 == 0)))
    hidden = ["gr0mb0l grumb0l", "s n e r d l e", "grrrumbol", "sn3rdl3", "g.r.u.m.b.o.l", "GRUMBOL!!!"]
    data += [(1000 + k, f"river {x} stone") for k, x in enumerate(hidden)]
    clean = [None, "", "river stone", "1234 5678", "s t o n e"]
    data += [(2000 + k, x) for k, x in enumerate(clean)] + [(None, "river")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    labelled = spark.createDataFrame([*marks, (7, None), (None, 1)], "doc_id bigint, toxic int")
    got = toxicity.held_out_scores(docs, labelled)
    toxic = {r.doc_id for r in got.where("predicted = 1").collect()}
    assert got.count() == len(data)
    assert toxic == {k for k, t in marks if t} | {1000 + k for k in range(len(hidden))}
    model = toxicity.train(docs, labelled)
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    assert toxicity.without_toxic(docs, model).where("doc_id IS NULL").count() == 1
    assert toxicity.held_out_scores(docs, labelled.limit(0)).where("predicted = 1").count() == 0


@pytest.mark.parametrize("options", [{}, {"capacity": 40, "block": 4}])
def test_near_vectors_by_brute_force(spark, options):
    draw = np.random.default_rng(6)
    base = draw.normal(size=(60, 16))
    near = np.concatenate([base[:30] + draw.normal(size=(30, 16)) * s for s in (0.05, 0.15, 0.22, 0.3)]
                          + [base[0] + draw.normal(size=(50, 16)) * 0.1])
    x = np.concatenate((base, near, base[:5])).astype(np.float32)
    ids = [int(k) for k in draw.permutation(1000)[: len(x)]]
    data = [(i, [float(a) for a in v]) for i, v in zip(ids, x)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [float("inf")] * 16),
           (2004, [None] * 16), (2005, []), (None, [1.0] * 16), (2006, [1.0, 2.0]), (2007, [2.0, 4.0])]
    frame = spark.createDataFrame(data + odd, "vec_id bigint, embedding array<float>").withColumn("cid", F.lit("x"))
    d = x.astype(np.float64)
    link = d @ d.T / np.linalg.norm(d, axis=1)[:, None] / np.linalg.norm(d, axis=1)[None] >= 0.95
    np.fill_diagonal(link, False)
    order = np.argsort(ids)
    i, j = np.nonzero(link[order][:, order])
    root = labels(len(x), i, j)
    want = {(ids[k], int(link[k].sum()), ids[order[root[p]]]) for p, k in enumerate(order)}
    want |= {(i, 0, i) for i, _ in odd if i not in (2006, 2007)} | {(2006, 1, 2006), (2007, 1, 2006)}
    got = vectors.near_vectors(frame, **options).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == want and len(got) == len(data) + len(odd)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_near_vectors_keep_double_components(spark):
    """Beyond the range of 32-bit floats, and apart by less than they can tell."""
    least = 0.95
    turned = [least, math.sqrt(1 - least * least)]
    within, without = [turned[0] + 1e-12, turned[1]], [turned[0] - 1e-12, turned[1]]
    data = [(1, [1e39, 0.0]), (2, [1e39, 0.0]), (3, [1e308, 0.0]), (4, [1e-300, 0.0]), (5, [0.0, 1e200]), (6, None),
            (7, within), (8, without)]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (0, 5), 6: (0, 6), 7: (5, 1), 8: (1, 1)}


def test_language_model_by_plain_counts(docs, rows):
    got = lm.held_out_scores(docs, part_bytes=20_000, per_part=64).collect()
    texts = [(i, [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words_of(t)] + [None]) for i, t, *_ in rows]
    trained = [t for i, t in texts if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2]
    count = collections.Counter(w for t in trained for w in t)
    pairs = collections.Counter(p for t in trained for p in zip(["^", *t[:-1]], t))
    before = collections.Counter(w for _, w in pairs)
    two, one = (lm.discounts(*(sum(v == k for v in c.values()) for k in (1, 2, 3, 4))) for c in (pairs, before))
    total, left = collections.Counter(), collections.Counter()
    for (u, _), v in pairs.items():
        total[u] += v
        left[u] += two[min(v, 3)]
    spread = sum(one[min(v, 3)] for v in before.values()) / len(pairs) / (len(count) + 1)

    def p(u, w):
        lower = max(before[w] - one[min(before[w], 3)], 0) / len(pairs) + spread
        v = pairs[u, w]
        return (max(v - two[min(v, 3)], 0) + left[u] * lower) / total[u] if total[u] else lower

    assert math.isclose(sum(p("^", w) for w in [*count, b"never seen"]), 1)
    n = sum(count.values())
    want = sorted((-1 if i is None else i, len(t), sum(count[w] > 0 for w in t), n,
                   round(sum(math.log10((count[w] + 1) / (n + len(count) + 1)) for w in t), 6),
                   round(sum(math.log10(p(u, w)) for u, w in zip(["^", *t[:-1]], t)), 6)) for i, t in texts)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 6), round(r.score, 6)) for r in got) == want


def test_toxic_words_are_found_at_any_place_of_a_long_run(spark):
    """Sentences written letter by letter, and long dotted tokens, with the word at each place in turn."""
    draw = random.Random(9)
    plain = ["river", "table", "stone", "garden", "window", "letter", "summer", "paper", "morning", "idea"]
    data = [(k, " ".join(draw.choice(plain) for _ in range(20)) + (" snerdle" if k % 5 == 0 else "")) for k in range(300)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    cost = toxicity.character_model(docs)
    reader = toxicity.Reader(cost)
    for n, m in ((7, 0), (3, 5), (4, 4), (0, 9), (1, 8), (2, 7)):  # after 42 to 47 letters
        letters = "garden" * n + "table" * m + "snerdle" + "garden" * 9
        assert "snerdle" in toxicity.decode(letters, cost, spaced=True)
        assert toxicity.decode(".".join(letters), cost) == [letters]
        text = np.frombuffer(" ".join(letters).encode(), np.uint8)
        buffer, a, b, _ = reader.words(text, np.array([0, len(text)]))
        assert b"snerdle" in [buffer[i:j].tobytes() for i, j in zip(a, b)]
    assert "".join(toxicity.decode("table" * 4_000, cost, spaced=True)) == "table" * 4_000


def test_empty_tables(spark, none):
    path = tokens.vocabulary("word_bpe_49k.json")
    flags = spark.createDataFrame([], "doc_id bigint, toxic int")
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    for frame in (exact.exact_duplicates(none), substrings.remove_repeats(none), packing.pack(none, path),
                  tokens.write_token_files(none, path).read(spark), jaccard.similar_documents(none),
                  mixing.mix(none), mixing.mixed_documents(none), langid.held_out_languages(none),
                  lm.held_out_scores(none), toxicity.held_out_scores(none, flags), vectors.near_vectors(empty)):
        assert frame.count() == 0


CLASHING = ["_id", "_sha", "_from", "_size", "_taken", "_own", "_words", "_turn", "_ID2", "bin", "part", "rank"]


def test_pipeline_stages_against_brute_force(spark, rows, tmp_path):
    """Each stage on what the one before kept, with columns named like the stages' own."""
    pipeline = pytest.importorskip("corpus_pipeline")
    draw = random.Random(6)
    base = [(i, t) for i, t, *_ in rows if i is not None and i not in (405,)]
    toxic = [(1000 + k, " ".join(["snerdle", "grackot"] * 3 + [draw.choice(["abc", "def", "gh"]) for _ in range(12)]))
             for k in range(60)]
    data = [(i, t, "en", f"s{i % 3}", 0, *(f"{c}{i}" for c in CLASHING)) for i, t in base + toxic]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
        f"{c} string" for c in CLASHING)
    spark.createDataFrame(data, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels_of = [(i, int(i >= 1000)) for i, _ in base + toxic if i % 3]
    spark.createDataFrame(labels_of, "doc_id bigint, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in now.collect()}
        now = saved(stage(spark, now, str(tmp_path)), f"test-{name}")
        assert now.columns == [x.split()[0] for x in schema.split(", ")]
        kept[name] = now.collect()
        for r in kept[name]:  # extra columns pass; all but the mix leave texts alone
            assert [r[c] for c in CLASHING] == [f"{c}{r.doc_id}" for c in CLASHING]
            assert name == "mixing" or r == before[r.doc_id]
    ids = {name: sorted(r.doc_id for r in got) for name, got in kept.items()}
    assert ids["toxicity"] == sorted(i for i, _ in base)
    import re

    first = {}
    for r in sorted(kept["toxicity"], key=lambda r: r.doc_id):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r.text or ""), r.doc_id)
    assert ids["exact_dedup"] == sorted(first.values())
    grams = {}
    for r in kept["exact_dedup"]:
        ws = words_of(r.text)
        grams[r.doc_id] = {tuple(ws[k: k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set()
    root = {i: i for i in grams}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in grams:
        for b in grams:
            if a < b and grams[a] and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert ids["ngram_jaccard"] == sorted(i for i in root if find(i) == i) != ids["exact_dedup"]
    taken = {r.doc_id: r.taken for r in mixing.mix(spark.createDataFrame(kept["ngram_jaccard"], schema)).collect()}
    words = collections.Counter()
    for r in kept["mixing"]:
        words[r.doc_id] += len(words_of(r.text))
    assert words == collections.Counter({i: n for i, n in taken.items() if n})
    pieces = pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(ids["mixing"])


def test_rows_alike_are_taken_within_the_budget(spark):
    """Rows without id, alike in source and size, of which the mix takes some once and others more often."""
    data = [(None, " ".join([f"w{k}"] * 7), "a", 0, "x") for k in range(40)] + [
        (k, "one two three", s, 0, "y") for k in range(20) for s in "bc"] + [(77, "alike rows", None, 0, "z")] * 10
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string, n_chars bigint, _taken string")
    got = mixing.mixed_documents(docs)
    words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+"))
    plan = mixing.mix(docs)
    by = ["doc_id", "source"]
    assert counter(got.groupBy(*by).agg(F.sum(words))) == counter(
        plan.groupBy(*by).agg(F.sum("taken").alias("n")).where("n > 0"))
    assert plan.groupBy(*by, "size").agg(F.count_distinct("taken").alias("n")).where("n > 1").count() > 0
