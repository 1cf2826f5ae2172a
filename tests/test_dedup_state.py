import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import NOW
from handbill.operators.dedup import within_run_dedup
from handbill.operators.normalize import with_text
from handbill.operators.state import (
    StateTable, bucket_of, delivery_status, mark_delivered, suppress_unchanged, upsert, with_content_hash,
)
from handbill.operators.normalize import with_identity

TRUST = {"a": 0.9, "b": 0.7}


def fold(group):
    """Brute force: fill the survivor from the others one by one."""
    ordered = sorted(group, key=lambda r: -TRUST.get(r["source"], 0.5))
    base = dict(ordered[0])
    for other in ordered[1:]:
        for name in base:
            if base[name] in (None, "", 0.0) and other[name] not in (None, ""):
                base[name] = other[name]
    return base


def test_merge_equals_the_fold(spark):
    rng = random.Random(5)
    day = datetime(2026, 6, 10)
    fields = {
        "source": lambda: rng.choice("abcd"), "title": lambda: rng.choice([None, "", "x", "y"]),
        "city": lambda: rng.choice([None, "", "p", "q"]),
        "price_min": lambda: rng.choice([None, 0.0, 5.0, 7.0]),
        "is_free": lambda: rng.choice([None, True, False]),
        "national_scope": lambda: rng.choice([True, False]),
        "end_datetime": lambda: rng.choice([None, day, day + timedelta(days=1)]),
    }
    rows = [{k: f() for k, f in fields.items()} | {"dedup_key": str(rng.randrange(150)), "seq": i}
            for i in range(900)]
    schema = ("source string, title string, city string, price_min double, is_free boolean, "
              "national_scope boolean, end_datetime timestamp_ntz, dedup_key string, seq bigint")
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema).repartition(4)
    got = {r["dedup_key"]: r.asDict() for r in within_run_dedup(df, TRUST).collect()}
    groups = {}
    for row in rows:
        groups.setdefault(row["dedup_key"], []).append(row)
    assert got.keys() == groups.keys()
    for key, group in groups.items():
        want = fold(group)
        found = got[key]
        assert found.pop("n_copies") == len(group)
        want["seq"] = sorted(group, key=lambda r: -TRUST.get(r["source"], 0.5))[0]["seq"]
        assert found == want


def prepared(make_events, rows):
    events = with_identity(with_text(make_events([
        dict(title="Kapela - koncert", city="Sopot", days=5, category="concert", **r)
        for r in rows])))
    return with_content_hash(events)


def states_of(df):
    return [r[0] for r in df.select("delivery_state").collect()]


def test_new_unchanged_updated_and_replay(spark, make_events, tmp_path):
    store = StateTable(spark, str(tmp_path / "state"))
    first = prepared(make_events, [dict(price_min=120.0)])
    assert states_of(delivery_status(first, store.read())) == ["new"]

    def run(events, run_id, deliver=True):
        prior = store.read(for_run=run_id)
        shown = suppress_unchanged(delivery_status(events, prior))
        snapshot = upsert(prior, events)
        if deliver:
            snapshot = mark_delivered(snapshot, shown, NOW)
        status = states_of(delivery_status(events, prior))
        store.commit(snapshot, run_id)
        return status, shown.count()

    assert run(first, "r0", deliver=False) == (["new"], 1)
    assert run(first, "r1") == (["new"], 1)          # seen before but not delivered
    assert run(first, "r2") == (["unchanged"], 0)
    cheaper = prepared(make_events, [dict(price_min=99.0)])
    assert run(cheaper, "r3") == (["updated"], 1)
    assert run(cheaper, "r3") == (["updated"], 1)    # a repeated run repeats its result
    assert run(cheaper, "r4") == (["unchanged"], 0)
    kept = store.read().collect()
    assert len(kept) == 1 and kept[0].price_min == 99.0 and kept[0].delivered
    assert kept[0].delivered_at == NOW


def test_upsert_keeps_rows_the_run_did_not_see(spark, make_events):
    old = prepared(make_events, [dict(price_min=1.0)]).withColumns(
        {"delivered": F.lit(True), "delivered_at": F.lit(NOW).cast("timestamp_ntz")})
    other = prepared(make_events, [dict(price_min=2.0)]).withColumn(
        "dedup_key", F.lit("other|2026-06-10|sopot"))
    rows = {r.dedup_key: r for r in upsert(old, other).collect()}
    assert len(rows) == 2
    assert rows["other|2026-06-10|sopot"].delivered is False
    assert [r.delivered for k, r in rows.items() if not k.startswith("other")] == [True]


def test_a_repeat_that_dies_leaves_the_snapshot_in_force(spark, make_events, tmp_path):
    store = StateTable(spark, str(tmp_path / "state"))
    store.commit(upsert(store.read(), prepared(make_events, [dict(price_min=5.0)])), "r1")
    failing = prepared(make_events, [dict(price_min=6.0)]).withColumn(
        "title", F.when(F.col("price_min") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("title")))
    try:
        store.commit(upsert(store.read(for_run="r1"), failing), "r1")
        raise AssertionError("the commit should have failed")
    except Exception as error:
        assert "lost" in str(error)
    assert [r.price_min for r in store.read().collect()] == [5.0]


def many(make_events, numbers, price):
    return prepared(make_events, [dict(price_min=price)]).withColumn(
        "n", F.explode(F.array(*map(F.lit, numbers)))).withColumn(
        "dedup_key", F.format_string("event-%03d|2026-06-10|sopot", "n")).drop("n")


def files_of(store):
    """Name and time of each file of rows in force, by bucket."""
    return {b: {(p.name, p.stat().st_mtime_ns) for p in Path(f"{store.path}/{f}/rows/bucket={b}").glob("part-*")}
            for b, f in store.listing()[1].items()}


def test_a_merge_rewrites_only_the_buckets_of_its_keys(spark, make_events, tmp_path):
    store, whole = (StateTable(spark, str(tmp_path / x), buckets=12) for x in ("merged", "whole"))
    first, second = many(make_events, range(200), 5.0), many(make_events, [3, 50, 300], 6.0)
    store.merge(first, "r1", first, NOW)
    whole.commit(mark_delivered(upsert(whole.read(), first), first, NOW), "r1")
    before = files_of(store)
    assert len(before) == 12 and all(len(x) == 1 for x in before.values())
    for _ in range(2):  # a repeated run changes nothing
        store.merge(second, "r2", second.where("dedup_key LIKE 'event-300%'"), NOW)
        assert sorted(store.read().collect()) == sorted(upsert(whole.read(), second).withColumns({
            "delivered": F.lit(True), "delivered_at": F.coalesce("delivered_at", F.lit(NOW).cast("timestamp_ntz")),
        }).collect()) and store.read().count() == 201
    after = files_of(store)
    touched = {r[0] for r in second.select(bucket_of(F.col("dedup_key"), 12)).collect()}
    assert {b for b in after if before.get(b) != after[b]} == touched and len(touched) <= 3


def test_a_look_up_reads_only_buckets_that_hold_a_key(spark, make_events, tmp_path):
    store = StateTable(spark, str(tmp_path / "state"), buckets=16)
    assert store.read_for(many(make_events, [1], 1.0)).count() == 0
    known = many(make_events, range(100), 5.0)
    store.merge(known, "r1", known, NOW)
    asked = many(make_events, [7, 42, *range(500, 540)], 5.0)   # two known ones; the others share many buckets
    rows = store.read_for(asked)
    read = {p.split("/bucket=")[1].split("/")[0] for p in rows.inputFiles()}
    held = {str(r[0]) for r in asked.where("dedup_key < 'event-5'").select(bucket_of(F.col("dedup_key"), 16)).collect()}
    assert read == held and len(held) == 2
    got = {r.dedup_key[6:9]: r.delivery_state for r in delivery_status(asked, rows).collect()}
    assert {k for k, v in got.items() if v == "unchanged"} == {"007", "042"}
    assert got == {r.dedup_key[6:9]: r.delivery_state for r in delivery_status(asked, store.read()).collect()}
    assert store.read_for(many(make_events, range(500, 540), 5.0)).inputFiles() == []


def test_a_merge_that_dies_leaves_all_buckets_in_force(spark, make_events, tmp_path):
    store = StateTable(spark, str(tmp_path / "state"), buckets=8)
    store.merge(many(make_events, range(30), 5.0), "r1")
    failing = many(make_events, range(20, 40), 6.0).withColumn("title", F.when(
        F.col("dedup_key").contains("event-035"), F.raise_error(F.lit("lost"))).otherwise(F.col("title")))
    with pytest.raises(Exception, match="lost"):
        store.merge(failing, "r2")
    assert store.read().count() == 30 and store.read().where("price_min <> 5").count() == 0
    reopened = StateTable(spark, str(tmp_path / "state"), buckets=99)   # the number of buckets is the store's
    reopened.merge(many(make_events, range(20, 40), 6.0), "r2")
    assert reopened.listing()[0] == 8 and store.read().count() == 40
