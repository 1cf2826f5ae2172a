"""Similar titles against brute force: every link between different sets counts, however large a group is."""

import collections
import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from conftest import NOW
from handbill.config import RunConfig
from handbill.operators import similar
from handbill.operators.graph import components
from handbill.operators.report import broken_sources
from handbill.plans.run import judge, keep_and_dedup
from handbill.schema import with_raw_columns


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_cliques(spark):
    draw = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(150, k) for k in range(120, 125)]
    edges += [(draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(110)] + [(500, 500), (7, 3)]
    draw.shuffle(edges)
    edges = [e if draw.random() < 0.5 else e[::-1] for e in edges]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == brute_components(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0


@pytest.mark.parametrize("threshold, capacity", [(0.8, 500), (0.8, 3), (0.5, 4), (0.7, 1), (0.34, 2), (1, 5)])
def test_no_link_is_lost(spark, threshold, capacity):
    draw = random.Random(int(threshold * 100) + capacity)
    words = [f"w{k}" for k in range(25)]
    rows = []
    for k in range(130):
        if k % 3 and rows:
            own = set(draw.choice(rows)[2] or ["w1"])
            for _ in range(draw.randint(0, 2)):
                own ^= {draw.choice(words)}
        else:
            own = set(draw.sample(words, draw.randint(1, 12)))
        rows.append((k, draw.choice("ab"), sorted(own)))
    rows += [(500 + k, "hot", ["all", "have", "these", "words", "x", f"n{k}"]) for k in range(40)]
    rows += [(600, None, ["w1"]), (601, "a", []), (602, "a", None), (None, "a", ["w1"])]
    able = {r[0]: r for r in rows if r[0] is not None and r[1] and r[2]}
    linked = [(a, b) for a in able for b in able if a < b and able[a][1] == able[b][1]
              and (n := len(set(able[a][2]) & set(able[b][2]))) >= threshold * (len(able[a][2]) + len(able[b][2]) - n)]
    want = {n: r for n, r in brute_components({x for e in linked for x in e}, linked).items()}
    frame = spark.createDataFrame(rows, "id long, block string, words array<string>")
    got = similar.similar_sets(frame, threshold, capacity).collect()
    assert len(got) == len(want) and {r[0]: r[1] for r in got} == want
    assert threshold == 1 or len(set(want.values())) > 1


def test_a_cluster_of_near_copies_costs_one_comparison_each(spark):
    """A thousand titles that differ in one number: all like the smallest, so nothing is left to compare."""
    rows = [(k, "no-date|", sorted(["nowy", "koncert", "w", "ergo", "arena", "dnia", "numer", "wielki", "finał", f"{k:05}"]))
            for k in range(1000)]
    sets = similar._by_rarity(spark.createDataFrame(rows, "class long, block string, words array<string>"), 0.8)
    groups = similar._groups(sets, 0.8, 50)
    assert groups.groupBy("block", "path").count().agg(F.max("count")).first()[0] == 1000
    frame = spark.createDataFrame(rows, "id long, block string, words array<string>")
    assert similar.similar_sets(frame, 0.8, 50).where("group_id = 0").count() == 1000


def test_near_copies_meet_in_no_more_groups_than_they_have_words_to_share(spark):
    """Long near copies share many words; split by four of them at a time, each would stand in hundreds of groups."""
    shared = [f"s{k:02}" for k in range(40)]
    rows = [(k, "a", sorted([*shared[: 40 - k % 3], f"n{k:05}"])) for k in range(300)]
    sets = similar._by_rarity(spark.createDataFrame(rows, "class long, block string, words array<string>"), 0.8)
    groups = similar._groups(sets, 0.8, 50)
    assert groups.count() <= sets.agg(F.sum("prefix")).first()[0]
    assert groups.where("cross > 0").count() == 0
    frame = spark.createDataFrame(rows, "id long, block string, words array<string>")
    assert similar.similar_sets(frame, 0.8, 50).where("group_id = 0").count() == 300


def test_events_of_similar_titles_become_one(spark, make_events):
    day = {"days": 3, "city": "Sopot", "venue_name": "Klub"}
    rows = [
        {"title": "Wielki koncert Sting w Ergo Arenie", "source": "going", "price_min": 120.0, **day},
        {"title": "Wielki KONCERT: Sting w Ergo-Arenie!", "source": "crossweb", "price_min": None, **day},
        {"title": "Wielki koncert Sting w Ergo Arenie dziś", "source": "x", "artist": "Sting", **day},
        {"title": "Wielki koncert Sting w Ergo Arenie", "source": "x", **{**day, "days": 4}},
        {"title": "Bajka dla dzieci", "source": "x", **day},
    ]
    raw = with_raw_columns(make_events(rows).withColumn("start", F.date_format("start_datetime", "yyyy-MM-dd HH:mm"))
                           .drop("start_datetime").withColumnsRenamed({"source_url": "url"}))
    config = RunConfig(NOW)
    exact = keep_and_dedup(judge(raw, config), config)
    merged = keep_and_dedup(judge(raw, config), dataclasses.replace(config, similar_titles=0.8))
    assert exact.count() == 5
    got = {r["seq"]: r for r in merged.collect()}
    assert set(got) == {1, 3, 4}
    assert (got[1]["source"], got[1]["price_min"], got[1]["artist"], got[1]["n_copies"]) == ("crossweb", 120.0, "Sting", 3)
    kept = {r["seq"]: r["dedup_key"] for r in exact.collect()}
    assert got[1]["dedup_key"] == kept[1] and merged.columns == exact.columns


def test_only_sources_of_every_earlier_run_can_break(spark):
    history = spark.createDataFrame(
        [(1, "a", 3), (2, "a", 2), (1, "b", 5), (1, "c", 4), (2, "c", 0), (1, "d", 1), (2, "d", 9), (1, "e", 2), (2, "e", 2)],
        "run int, source string, found int")
    now = spark.createDataFrame([("a", 0), ("d", 4), ("new", 1)], "source string, found int")
    flagged = lambda found, least=1: {r["source"] for r in broken_sources(history, found, least).collect()}
    assert flagged(now) == {"a", "e"} and flagged(now, 3) == set()
    assert flagged(now.where("found = 0")) == set() and flagged(now.limit(0)) == set()
