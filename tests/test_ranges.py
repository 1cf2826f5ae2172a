import json
import random

import pytest
from pyspark.sql import functions as F

from handbill.sources import ranges
from handbill.sources.listings import read_listings, unreadable

TEXTS = ["plain", "a } b { c", 'quote " and \\ back\\\\', "[]}{][", "", "\n}\n", "zażółć } \U0001F916", '\\"}', "x" * 700]


def records(count, seed):
    of = random.Random(seed)
    for number in range(count):
        yield {"source": f"s{number % 3}", "title": f"t{number} {of.choice(TEXTS)}", "description": of.choice(TEXTS),
               "city": of.choice([None, "Gdynia", "}{"]), "price_min": of.choice([None, "1.10", 5])}


@pytest.fixture
def small_ranges(spark):
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def rows(df):
    return [tuple(r) for r in df.orderBy("seq").collect()]


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_over_many_ranges(spark, tmp_path, small_ranges, monkeypatch, indent, few):
    if not few:
        monkeypatch.setattr(ranges, "BROADCAST_RANGES", 0)
    path = tmp_path / "feed"
    path.mkdir()
    for name, count in (("a.json", 60), ("b.json", 1), ("c.json", 0), ("d.json", 25)):
        (path / name).write_text(json.dumps(list(records(count, name)), indent=indent, ensure_ascii=count == 25))
    got = read_listings(spark, str(path), layout="ranges", arrival=True)
    want = read_listings(spark, str(path), layout="array", arrival=True)
    assert rows(got) == rows(want) and len(rows(got)) == 86
    assert unreadable(spark, str(path), layout="ranges").count() == 0
    parts = spark.read.option("lineSep", "}").text(str(path))
    assert parts.select(F.spark_partition_id()).distinct().count() > 8


def test_entries_that_are_no_records(spark, tmp_path, small_ranges):
    path = tmp_path / "feed.json"
    path.write_text('﻿ [1, {"title": "a", "description": "' + "y}" * 300 + '"}, "}{", [{"title": "no"}], null,\n'
                    '{"title": "b", "city": {"x": [1, {}]}}, {}, true, "' + "z" * 500 + '" ]\n')
    got = read_listings(spark, str(path), layout="ranges", arrival=True).select("title").collect()
    want = read_listings(spark, str(path), layout="array", arrival=True).select("title").collect()
    assert [r.title for r in got] == [r.title for r in want]
    bad = [unreadable(spark, str(path), layout=layout).select("n_records").collect() for layout in ("ranges", "array")]
    assert bad[0] == bad[1]


def test_files_of_no_list(spark, tmp_path, small_ranges):
    (tmp_path / "a.json").write_text('{"title": "one"}\n')
    (tmp_path / "b.json").write_text("")
    (tmp_path / "c.json").write_text('{"title": "two"}\n{"title": "three"}')
    (tmp_path / "d.json").write_text("not json at all")
    got = read_listings(spark, str(tmp_path), layout="ranges", arrival=True)
    assert [r.title for r in got.orderBy("seq").collect()] == ["one", "two", "three"]
    assert [r.n_records for r in unreadable(spark, str(tmp_path), layout="ranges").collect()] == [1]
