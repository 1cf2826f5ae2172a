"""Operators 11 to 13 against brute force, on small tables with awkward rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from handbill.llm import middle, postings, resampling

SCHEMA = ("doc_id bigint, text string, lang string, output string, form string, rid bigint, word string, pos int, "
          "place bigint, segment int, noise bigint, h1 bigint, rank int")
EXTRA = ("en", "clash", "psm", 7, "clash", 1, 1, 1, 1, 1, 1)


def counter(frame):
    return collections.Counter(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    words = ["".join(draw.choice("abcdEFéß語𝄞") for _ in range(draw.randint(1, 4))) for _ in range(60)]
    glue = [" ", "  ", "\n", "\t ", ", ", " - "]
    some = lambda n: "".join(draw.choice(words) + draw.choice(glue) for _ in range(n))
    out = [(k * 7 % 211, some(draw.choice([0, 1, 2, 25, 60, 200]))) for k in range(200)]
    out += [(300 + k, f"{some(3)}<{m}>{some(4)}") for k, m in enumerate("PSMX")]
    out += [(400, None), (401, ""), (402, " \n "), (403, "é"), (404, "x" * 9000), (405, "語" * 5000 + " a"),
            (406, "<"), (407, "a <S"), (408, " lead and trail  "), (409, "𝄞𝄞 𝄞é ßa"), (410, some(30_000)),
            (None, "no id one two"), (None, "no id one two"), (None, some(40)), (411, "same"), (411, "same"),
            (411, some(30)), (412, "the " * 90), (413, "123 !!! ABC abc")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([r + EXTRA for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# fill-in-middle

def cut_text(doc_id, text, unit, markers, rate, spm):
    text = text or ""
    units = list(text) if unit == "characters" else re.findall(
        "[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k: 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in markers) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text, text
    p, s, m = markers
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", len(pre), len(mid), s + suf + p + pre + m + mid, text
    return doc_id, len(units), "psm", len(pre), len(mid), p + pre + s + suf + m + mid, text


@pytest.mark.parametrize("unit", ["words", "characters"])
@pytest.mark.parametrize("markers, rate, spm", [(middle.MARKERS, 50, 80), (("<é", "<語>", "<M"), 100, 40)])
def test_parts_are_cut_as_drawn_and_rebuilt(docs, rows, unit, markers, rate, spm):
    made = middle.fill_in_middle(docs, unit=unit, markers=markers, rate=rate, spm=spm)
    got = counter(made.withColumn("back", middle.restored(markers=markers)))
    want = collections.Counter(cut_text(i, t, unit, markers, rate, spm) for i, t in rows)
    assert got == want
    assert len({r[2] for r in want}) == 3


def test_places_of_bytes_and_code_points():
    for text in ("", "plain", "é", "aé語𝄞b", "語" * 50 + "a" * 50 + "𝄞é" * 20):
        raw = text.encode()
        index = middle.Exceptions(np.frombuffer(raw, np.uint8))
        chars = np.arange(len(text) + 1)
        places = np.array([len(text[:k].encode()) for k in chars])
        assert (index.to_bytes(chars) == places).all() and (index.to_chars(places) == chars).all()
        assert len(index.at) == sum(ord(c) > 127 for c in text)


def test_markers_that_read_two_ways_are_refused(docs, none):
    for markers in (("<P>", "<P>x", "<M>"), ("<P>", "S>", "<M>"), ("<<P", "<S>", "<M>"), ("<P>", "<P>", "<M>")):
        with pytest.raises(ValueError):
            middle.fill_in_middle(docs, markers=markers)
    with pytest.raises(ValueError):
        middle.fill_in_middle(docs, unit="tokens")
    assert middle.fill_in_middle(none).count() == 0


# decontamination

def words_of(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


@pytest.fixture(scope="module")
def items(rows):
    draw = random.Random(5)
    longest = [words_of(t) for _, t in rows if len(words_of(t)) > 50]
    out = [(k, " ".join((part := draw.choice(longest))[(at := draw.randrange(len(part) - 30)): at + draw.randint(3, 30)]))
           for k in range(25)]
    out += [(100, " ".join(["the"] * 12)), (101, "same"), (102, "unheard of words here"), (103, None), (104, " - "),
            (105, "NO id, one"), (105, "a é"), (106, "same"), (None, "same"), (None, out[0][1]), (9, out[1][1]),
            (107, "é"), (108, " ".join(longest[-1][:400]))]
    return out


@pytest.fixture(scope="module")
def asked(spark, items):
    return spark.createDataFrame([r + EXTRA for r in items], SCHEMA.replace("doc_id", "item_id")).cache()


def windows_of(text, size):
    ws = words_of(text)
    size = min(size, len(ws))
    return {tuple(ws[k: k + size]) for k in range(len(ws) - size + 1)} if ws else set()


@pytest.mark.parametrize("window", [10, 4, 1])
def test_words_of_windows_are_found(docs, rows, asked, items, window):
    by_size = collections.defaultdict(lambda: collections.defaultdict(set))
    for i, t in items:
        for w in windows_of(t, window):
            by_size[len(w)][w].add("" if i is None else str(i))
    want = collections.Counter()
    for i, t in rows:
        ws, hit, who = words_of(t), set(), set()
        for size, known in by_size.items():
            for k in range(len(ws) - size + 1):
                found = known.get(tuple(ws[k: k + size]))
                if found:
                    hit |= set(range(k, k + size))
                    who |= found
        want[i, len(ws), len(hit), len(who), tuple(sorted(who)), bool(hit)] += 1
    got = postings.contamination(docs, asked, window).collect()
    assert collections.Counter((*r[:4], tuple(r[4]), r[5]) for r in got) == want


def test_occurrences_have_their_places(spark):
    docs = spark.createDataFrame([(1, "x a b c d a b c"), (1, "A b, c")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c d"), (8, "c")], "item_id long, text string")
    got = counter(postings.matches(docs, items, 3).drop("rid"))
    assert got == collections.Counter(
        [(1, 7, 2, 5), (1, 7, 6, 8), (1, 7, 1, 3), (1, 8, 4, 4), (1, 8, 8, 8), (1, 8, 3, 3)])


@pytest.mark.parametrize("within", [6, 14])
def test_words_close_together_are_found_in_any_order(spark, within):
    draw = random.Random(within)
    letters = "aabbccddefghijklm"
    texts = [" ".join(draw.choice(letters) for _ in range(draw.choice([3, 40, 150]))) for _ in range(25)]
    items = ["a b c d", "m l k", "e", "a a b", "zz a", "f g h i j"]
    counts = collections.Counter(w for t in texts for w in t.split())
    want = set()
    for d, text in enumerate(texts):
        ws = text.split()
        for k, item in enumerate(items):
            size = min(4, len(item.split()))
            for at in range(len(item.split()) - size + 1):
                win = set(item.split()[at: at + size])
                if any(not counts[w] for w in win):
                    continue
                rarest = min(win, key=lambda w: (counts[w], w))
                for p in (q for q, w in enumerate(ws) if w == rarest):
                    spans = [(hi - lo, lo + 1, hi + 1) for lo in range(max(0, p - within + 1), p + 1) if ws[lo] in win
                             for hi in range(p, min(len(ws), lo + within)) if win <= set(ws[lo: hi + 1])]
                    if spans:
                        want.add((d, k, *min(spans)[1:]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = postings.matches(docs, asked, 4, within=within).drop("rid")
    assert {tuple(r) for r in got.collect()} == want and want


def test_nothing_to_search(docs, none, asked):
    empty = none.withColumnRenamed("doc_id", "item_id")
    assert postings.contamination(none, asked).count() == 0
    found = postings.contamination(docs, empty)
    assert found.count() == docs.count() and found.where("contaminated OR n_hit > 0 OR n_items > 0").count() == 0


def test_index_is_sorted_in_shards(docs, rows):
    index = postings.build_index(docs)
    assert index.where("word <> ''").count() == sum(len(words_of(t)) for _, t in rows)
    shards = index.select(F.input_file_name().alias("file"), "word", "rid", "pos").collect()
    for _, own in itertools.groupby(shards, key=lambda r: r[0]):
        own = [(r[1].encode(), r[2], r[3]) for r in own]
        assert own == sorted(own)


# importance resampling

def brute_resample(rows, target, percent, least, order, buckets):
    def found(text):
        ws = words_of(text)
        return [zlib.crc32(" ".join(ws[k: k + n]).encode()) % buckets
                for n in range(1, order + 1) for k in range(len(ws) - n + 1)]

    s, t = (collections.Counter(b for x in texts for b in found(x))
            for texts in ([x for _, x in rows], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (total_s + buckets) / ((s[b] + 1.0) * (total_t + buckets))))
            for b in range(buckets)]
    scored = []
    for i, x in rows:
        own = found(x)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((-score, i is None, i or 0, weight, len(own), i, len(words_of(x)) >= least))
    able = sorted(x for x in scored if x[-1])
    take = percent * len(able) // 100
    out = [(x, k + 1 if k < take else None) for k, x in enumerate(able)] + [(x, None) for x in scored if not x[-1]]
    return collections.Counter((x[5], x[4], x[3], -x[0], rank) for x, rank in out)


@pytest.mark.parametrize("options", [{}, {"segment_rows": 9}, {"segment_rows": 1, "percent": 100, "least_words": 0},
                                     {"order": 3, "buckets": 97, "percent": 50, "segment_rows": 20}])
def test_documents_are_drawn_by_weight(docs, rows, asked, items, options):
    got = counter(resampling.resample(docs, asked, **options))
    want = brute_resample(rows, [t for _, t in items], options.get("percent", 10), options.get("least_words", 20),
                          options.get("order", 1), options.get("buckets", 10_000))
    assert got == want


def test_equal_keys_are_ranked_over_many_segments(spark):
    """A third of the rows are one row: runs are cut by place, so no segment holds them all."""
    data = [(5, None, 1, 1)] * 700 + [(k % 50, k, 1, 1) for k in range(1400)]
    rows = spark.createDataFrame(data, "score long, doc_id long, weight long, n_features long").repartition(4)
    got = resampling.ranked(rows, 1500, len(data), segment_rows=100).collect()
    want = sorted(data, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    assert sorted((r[4], r[0]) for r in got if r[4]) == [(k + 1, r[0]) for k, r in enumerate(want[:1500])]
    assert len(got) == len(data)
    cut = spark.read.parquet(sorted(_scratch(spark, "resampling-segments"))[-1])
    sizes = [r[1] for r in cut.groupBy("segment").count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 2 * len(data) / len(sizes) + 100


def _scratch(spark, name):
    import glob
    import os

    from handbill.session import checkpoint_dir

    return sorted(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/{name}-*"), key=os.path.getmtime)[-1:]


def test_resampling_of_nothing(docs, none, asked):
    assert resampling.resample(none, asked).count() == 0
    found = resampling.resample(docs, none.withColumnRenamed("doc_id", "item_id"))
    assert found.count() == docs.count()


def test_crc_of_spans_of_any_length():
    draw = np.random.default_rng(3)
    data = draw.integers(0, 256, 5000).astype(np.uint8)
    starts = np.array([0, 0, 10, 300, 900, 4999])
    stops = np.array([0, 1, 74, 365, 4900, 5000])
    state = resampling.crc_after(np.full(6, 0xFFFFFFFF, np.uint32), data, starts, stops) ^ np.uint32(0xFFFFFFFF)
    assert state.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, stops)]
