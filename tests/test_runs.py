import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import NOW
from handbill import RunConfig, run_listings
from handbill.operators.state import StateTable
from handbill.sources.listings import read_listings, unreadable
from handbill.streaming import runs as streams

RECORDS = [
    dict(source="crossweb", title="Wieczor AI & data engineering", city="Gdansk",
         start="2026-06-10 18:00", is_free=True, url="https://c.example/1"),
    dict(source="evenea", title="Data science summit 2026", city="Warszawa",
         start="2026-06-12 09:00", end="2026-06-13 17:00", price_min=499),
    dict(source="crossweb", title="Spotkanie kolekcjonerow", city="Krakow", start="2026-06-11"),
    dict(source="trojmiasto", title="Bal dla dzieci", city="Gdansk", start="2026-06-07 10:00"),
    dict(source="trojmiasto", title="Spektakl i mecz", city="Gdynia", start="2026-06-08"),
    dict(source="ebilet", title="Kapela - koncert", city="Sopot", artist="Kapela",
         start="2026-06-15 19:00", price_min=120, venue="Molo"),
    dict(source="going", title="KAPELA - Koncert", city="Sopot, molo",
         start="15.06.2026 19:00", description="opis"),
    dict(source="ticketmaster", title="Sting tour", city="Warszawa", start="2026-10-15 20:00"),
    dict(source="crossweb", title="  ", city="Gdansk"),
    dict(source="evenea", title="[do ekstrakcji] AI", needs_extraction=True),
]


def landed(spark, folder, records):
    folder.mkdir()
    (folder / "feed.json").write_text(
        "\n".join(json.dumps({**r, "seq": i}) for i, r in enumerate(records)))
    return read_listings(spark, str(folder), "lines")


def digest_lines(output):
    """The part files in name order are the digest."""
    parts = sorted((output / "digest").glob("part-*"))
    return "".join(p.read_text() for p in parts).split("\n")[:-1]


def test_runs_over_time(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"))
    raw = landed(spark, tmp_path / "in", RECORDS)
    first = run_listings(raw, RunConfig(NOW, run_id="1"), str(tmp_path / "out1"), state)
    drops = {r.drop_reason: r.n for r in first.drops.collect()}
    assert drops == {"no_category": 1, "excluded:sports_or_league_match": 1}
    report = json.loads(spark.read.text(str(tmp_path / "out1" / "report")).first()[0])
    assert (report["events_found"], report["events_kept"], report["events_delivered"]) == (8, 5, 5)
    assert report["status"] == 0
    order = [(r.category, r.title) for r in first.ranked.orderBy("stream_no", "rank").collect()]
    assert order == [
        ("ai_digital", "Wieczor AI & data engineering"), ("ai_digital", "Data science summit 2026"),
        ("culture_family", "Bal dla dzieci"), ("concert", "Kapela - koncert"),
        ("concert", "Sting tour")]
    lines = digest_lines(tmp_path / "out1")
    assert [line for line in lines if line.startswith("- *")] == [
        r.line for r in first.digest.orderBy("line_no").collect() if r.line.startswith("- *")]
    assert sum(line.startswith("- *") for line in lines) == 5
    merged = first.events.where("title = 'Kapela - koncert'").first()
    assert (merged.n_copies, merged.description, merged.price_min) == (2, "opis", 120.0)
    stored = {r.title: r for r in state.read().collect()}
    assert len(stored) == 5 and all(r.delivered for r in stored.values())
    assert stored["Bal dla dzieci"].relevance_score > 1

    again = run_listings(raw, RunConfig(NOW, run_id="2"), str(tmp_path / "out2"), state)
    assert again.ranked.count() == 0
    lines = digest_lines(tmp_path / "out2")
    assert lines[1:] == ["", "Brak nowych wydarzen w oknie."]

    cheaper = [{**r, "price_min": 99} if r["title"].startswith("Kapela") else r for r in RECORDS]
    third = run_listings(landed(spark, tmp_path / "in3", cheaper), RunConfig(NOW, run_id="3"),
                         str(tmp_path / "out3"), state)
    assert [(r.title, r.delivery_state) for r in third.ranked.collect()] == [
        ("Kapela - koncert", "updated")]


def test_unreadable_texts_are_failed_outcomes_of_a_run(spark, tmp_path):
    raw = landed(spark, tmp_path / "in", RECORDS)
    (tmp_path / "in" / "other.json").write_text("not json\n{\n")
    run_listings(raw, RunConfig(NOW, run_id="1"), str(tmp_path / "out"),
                 unreadable=unreadable(spark, str(tmp_path / "in"), "lines"))
    report = json.loads(spark.read.text(str(tmp_path / "out" / "report")).first()[0])
    failed = [x for x in report["sources"] if not x["ok"]]
    assert [(x["source"].rsplit("/", 1)[1], x["found"], x["error"]) for x in failed] == [
        ("other.json", 0, "invalid_json")]
    assert (report["status"], report["events_found"]) == (1, 8)


def test_collect_falls_back_under_a_budget(spark, tmp_path):
    from handbill.config import default_rules
    from handbill.plans.collect import collect

    def block(title):
        return ('<script type="application/ld+json">'
                f'{{"name": "{title}", "startDate": "2026-06-10"}}</script>')

    base = dict(streams=["concert", "ai_digital"], enabled=True, parser="jsonld_walk",
                fallback_parser="jsonld_walk", method="python", default_city="Sopot")
    sources = [
        {**base, "id": "full"}, {**base, "id": "empty1", "fallback": "firecrawl"},
        {**base, "id": "paid1", "method": "firecrawl"}, {**base, "id": "off", "enabled": False},
        {**base, "id": "other", "streams": ["x"]}, {**base, "id": "empty2"},
        {**base, "id": "paid2", "method": "firecrawl", "force_category": "concert"},
        {**base, "id": "lost", "fallback": "firecrawl"}, {**base, "id": "gone"},
    ]
    schema = "page_id bigint, source string, url string, html string"

    def frame(pages):
        return spark.createDataFrame(
            [(i, s, "https://p.example/x", h) for i, (s, h) in enumerate(pages.items())], schema)

    first = frame({"full": block("koncert A"), "empty1": "<p>", "paid1": block("koncert P"),
                   "off": block("koncert O"), "other": block("koncert Q"), "empty2": "<p>",
                   "paid2": block("Wieczor")})
    second = frame({"empty1": block("koncert F"), "full": block("koncert Z"),
                    "lost": block("koncert L")})

    def outcome(budget):
        config = RunConfig(NOW, {**default_rules(), "fetch_budget_per_run": budget},
                           streams=("concert",))
        got = collect(sources, first, second, config)
        rows = {r.source: (r.found, r.ok, r.error, r.method) for r in got.outcomes.collect()}
        return (rows, sorted(r.title for r in got.records.collect()), got.credits.first()[0], got,
                config)

    rows, titles, used, got, _ = outcome(2)
    assert rows == {
        "full": (1, True, None, "direct"), "empty1": (1, True, None, "metered"),
        "paid1": (1, True, None, "metered"), "empty2": (0, True, None, "direct"),
        "paid2": (0, False, "budget_exceeded", "metered"),
        "lost": (0, False, "page_not_landed", "direct"),
        "gone": (0, False, "page_not_landed", "direct"),
    }
    assert (titles, used) == (["koncert A", "koncert F", "koncert P"], 2)
    order = [r.title for r in got.records.orderBy("seq").collect()]
    assert order == ["koncert A", "koncert F", "koncert P"]
    assert [r.seq for r in got.records.orderBy("seq").collect()] == [0, 1, 2]
    rows, titles, used, got, config = outcome(30)
    assert rows["lost"] == (1, True, None, "metered") and rows["paid2"][1]
    assert (titles, used) == (
        ["Wieczor", "koncert A", "koncert F", "koncert L", "koncert P"], 4)
    result = run_listings(got.records, config, str(tmp_path / "out"), outcomes=got.outcomes)
    assert result.ranked.count() == 5    # the untitled category is forced by its source
    report = json.loads(spark.read.text(str(tmp_path / "out" / "report")).first()[0])
    assert (report["status"], report["credits"], report["failures"]) == (1, 4, ["gone"])


def test_stream_horizon_and_late_rows(spark, tmp_path):
    """Two scheduled runs: a copy inside the horizon is dropped, late rows do not reopen a day."""
    schema = "k string, ts timestamp_ntz, reason string"
    rows = [("a", datetime(2026, 1, 1, 1), "x"), ("a", datetime(2026, 1, 1, 2), "x"),
            ("b", datetime(2026, 1, 3), "y")]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))

    def run(name, build):
        stream = build(streams.landed_stream(spark, str(tmp_path / "in"), schema))
        streams.run_available(
            stream, str(tmp_path / name), str(tmp_path / f"{name}-cp")).awaitTermination()
        return spark.read.schema(stream.schema).parquet(str(tmp_path / name))

    first = lambda: run("first", lambda s: streams.first_per_key(s, ["k"], "ts", "1 day"))
    counts = lambda: run("counts", lambda s: streams.drop_counts(
        s, "ts", "reason", "1 day", "1 hour"))
    assert sorted(r.k for r in first().collect()) == ["a", "b"]
    assert [(r.period_start, r.reason, r.n) for r in counts().collect()] == [
        (datetime(2026, 1, 1), "x", 2)]
    more = [("b", datetime(2026, 1, 3, 5), "y"), ("c", datetime(2026, 1, 9), "z")]
    spark.createDataFrame(more, schema).coalesce(1).write.mode("append").parquet(
        str(tmp_path / "in"))
    assert sorted(r.k for r in first().collect()) == ["a", "b", "c"]
    assert {(r.reason, r.n) for r in counts().collect()} == {("x", 2), ("y", 2)}


# Queries checked on the smallest tables here; `python -m checks.compare` checks all of them.
SAMPLE = [
    "full_run", "digest", "mark_delivered", "jsonld_walk", "html_rows", "budget_admission",
    "rank_orders", "pack_lines", "stream_drop_report", "lineitem_dedup", "html_rows_nested",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    from checks.compare import compare, duck

    sf_dir = "/root/testdata/sf0.001"
    ok, note = compare(spark, duck(sf_dir), sf_dir, name)
    assert ok, note


def test_every_query_has_sql():
    import __spark_entry__ as entry
    from checks.queries import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    import __spark_entry__ as entry

    result = entry.entry(spark)
    assert result.count() > 0
    assert F.col("rank") is not None and "relevance_score" in result.columns


STEPS = ["write_digest", "write_digest_sections", "write_report", "rows", "listing", "manifest"]


def test_a_run_that_dies_publishes_neither_outputs_nor_state(spark, tmp_path, monkeypatch):
    from handbill.plans import run as plan
    from pyspark.sql.readwriter import DataFrameWriter

    state, output = StateTable(spark, str(tmp_path / "state"), buckets=4), str(tmp_path / "out")
    raw = landed(spark, tmp_path / "in", RECORDS)
    config = RunConfig(NOW, run_id="1")

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    for step in STEPS:
        with monkeypatch.context() as patched:
            if hasattr(plan, step):
                patched.setattr(plan, step, die)
            else:
                kind = "parquet" if step == "rows" else "json"
                write = getattr(DataFrameWriter, kind)
                patched.setattr(DataFrameWriter, kind, lambda self, path, **k: (
                    die() if path.startswith(state.path) and path.endswith(step) else write(self, path, **k)))
            with pytest.raises(RuntimeError, match="lost"):
                run_listings(raw, config, output, state, one_commit=True)
        assert state.published().count() == 0 and state.read().count() == 0

    run_listings(raw, config, output, state, one_commit=True)
    again = run_listings(raw, RunConfig(NOW, run_id="2"), output, state, one_commit=True)
    assert again.ranked.count() == 0
    folders = {r.run_id: r.outputs for r in state.published().collect()}
    shown = [r.value for r in spark.read.text(f"{folders['1']}/digest").collect() if r.value.startswith("- *")]
    assert len(shown) == 5 and all(r.delivered for r in state.read().collect())
    assert not [r for r in spark.read.text(f"{folders['2']}/digest").collect() if r.value.startswith("- *")]


def test_a_report_lists_some_sources_and_counts_all(spark, tmp_path, monkeypatch):
    from handbill.operators import report

    monkeypatch.setattr(report, "LISTED", 2)
    raw = landed(spark, tmp_path / "in", RECORDS)
    for name in "abc":
        (tmp_path / "in" / f"{name}.json").write_text("not json\n")
    rules = {**RunConfig(NOW).rules, "empty_run_message": False}
    run_listings(raw, RunConfig(NOW, rules, run_id="1"), str(tmp_path / "out"),
                 unreadable=unreadable(spark, str(tmp_path / "in"), "lines"))
    row = json.loads(spark.read.text(str(tmp_path / "out" / "report")).first()[0])
    assert (len(row["sources"]), len(row["failures"]), row["n_failures"], row["status"]) == (2, 2, 3, 1)
    assert row["send"] is True
    every = spark.read.json(str(tmp_path / "out" / "outcomes"))
    assert every.count() == row["n_sources"] and every.where("NOT ok").count() == 3

    empty = run_listings(raw.where("false"), RunConfig(NOW, rules, run_id="2"), str(tmp_path / "none"))
    assert empty.report.first().send is False
