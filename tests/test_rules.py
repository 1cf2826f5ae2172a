from datetime import timedelta

from conftest import NOW, by_seq
from handbill.config import RunConfig, default_rules
from handbill.operators.classify import classify
from handbill.operators.normalize import with_identity, with_text
from handbill.operators.rules import apply_filters


def judged(make_events, rows, config):
    return apply_filters(with_identity(with_text(make_events(rows))), config)


CASES = [
    (dict(category="culture_family", city="Gdansk", days=3, title="Mecz A - B (Ekstraklasa)",
          subcategory="sport"), "excluded:sports_or_league_match", False),
    (dict(category="culture_family", city="Warszawa", days=3, title="Spektakl"),
     "geo:culture_family_outside_tricity", False),
    (dict(category="concert", city="Warszawa", days=100, title="Sting", artist="Sting",
          venue_name="PGE Narodowy"), None, True),
    (dict(category="concert", city="Poznan", days=5, title="Kapela"),
     "geo:concert_outside_tricity_not_world_class", False),
    (dict(category="ai_digital", city="Krakow", days=5, title="Power BI"),
     "geo:ai_digital_outside_tricity_not_large", False),
    (dict(category="ai_digital", city="Warszawa", days=7, end_days=8, title="Szczyt"), None, True),
    (dict(category="concert", city="Gdansk", days=-2), "date:past", False),
    (dict(category="concert", city="Sopot", days=10), None, False),
    (dict(category="culture_family", city="Gdańsk", days=-3, end_days=5), None, False),
    (dict(category="culture_family", city="Gdansk", days=50, end_days=70),
     "date:beyond_window", False),
    (dict(category="culture_family", city="Gdansk", days=-10, end_days=-2), "date:past", False),
    (dict(category=None, city="Gdansk", days=1), "no_category", False),
    # a league keyword with blanks: found inside and at the end of a title, not at its start
    (dict(category="culture_family", city="Gdansk", days=1, title="Nasza liga"),
     "excluded:sports_or_league_match", False),
    (dict(category="culture_family", city="Gdansk", days=1, title="Liga gra"), None, False),
    # no start, an end in the past
    (dict(category="culture_family", city="Gdansk", end_days=-9), None, False),
    (dict(category="concert", city="Gdansk", days=30), None, False),
    (dict(category="concert", city="Gdansk", days=30 + 1 / 1440), "date:beyond_window", False),
    (dict(category="culture_family", city="Pruszcz Gdański", days=1), None, False),
    (dict(category="culture_family", city="Łódź", days=1),
     "geo:culture_family_outside_tricity", False),
    (dict(category="other", city="Gdansk", days=1), "no_category", False),
]


def test_reasons_and_scope(make_events, config):
    result = judged(make_events, [c for c, _, _ in CASES], config)
    assert by_seq(result, "drop_reason") == {i: r for i, (_, r, _) in enumerate(CASES)}
    national = by_seq(result.where("drop_reason IS NULL"), "national_scope")
    assert national == {i: n for i, (_, r, n) in enumerate(CASES) if r is None}
    reasons = by_seq(result, "scope_reason")
    assert reasons[2] == "world_class:allowlist:sting"
    assert reasons[5] == "large_event:multiday:2d"


def test_inclusive_last_day_is_an_option(make_events):
    late = [dict(category="culture_family", city="Gdansk", days=14.4)]
    strict = judged(make_events, late, RunConfig(NOW))
    whole_day = judged(make_events, late, RunConfig(NOW, inclusive_last_day=True))
    assert by_seq(strict, "drop_reason") == {0: "date:beyond_window"}
    assert by_seq(whole_day, "drop_reason") == {0: None}


def test_family_flag_is_three_valued(make_events, config):
    rows = [dict(category="culture_family", city="Sopot", days=1, title=t)
            for t in ("Bajka dla dzieci 18+", "Bajka dla dzieci", "Wystawa")]
    assert by_seq(judged(make_events, rows, config), "family_suitable") == {
        0: False, 1: True, 2: None}


def test_classify(make_events):
    rows = [
        dict(title="Meetup AI & Data Engineering", source_streams=["ai_digital"]),
        dict(title="Muzyka - koncert", artist="Kto", source_streams=["concert", "culture_family"]),
        dict(title="Spektakl dla dzieci", source_streams=["culture_family", "concert"]),
        dict(title="Cos nieoczywistego xyz", source_streams=["culture_family", "concert"]),
        dict(title="koncert data", source_streams=["culture_family", "concert", "ai_digital"]),
        dict(title="koncert data", source_streams=["ai_digital", "concert"]),
        dict(title="koncert", source_streams=["unknown"]),
        dict(title="koncert", source_streams=[]),
        dict(title="koncert", force_category="ai_digital", source_streams=["concert"]),
    ]
    out = classify(with_text(make_events(rows)), default_rules(), RunConfig(NOW).streams)
    assert by_seq(out, "category") == {
        0: "ai_digital", 1: "concert", 2: "culture_family", 3: None, 4: "concert",
        5: "ai_digital", 6: None, 7: "concert", 8: "ai_digital"}


def test_many_keywords_give_the_same_hits(spark):
    from pyspark.sql import functions as F

    from handbill.functions.text import contains_any, first_contained, keyword_hits

    words = [f"w{i}x" for i in range(300)] + ["tour", "live"]
    df = spark.createDataFrame([("a live tour",), ("w7x w12x w7x",), ("none",)], "t string")
    t = F.col("t")
    rows = df.select(keyword_hits(t, words), contains_any(t, words), first_contained(t, words))
    assert [tuple(r) for r in rows.collect()] == [
        (2, True, "tour"), (2, True, "w7x"), (0, False, None)]


def test_kept_and_dropped_are_all_rows(make_events, config):
    rows = [dict(category=c, city=t, days=d) for c in ("concert", "ai_digital", None)
            for t in ("Gdynia", "Krakow") for d in (-1, 3, 40)]
    out = judged(make_events, rows, config)
    assert out.count() == len(rows)
    assert timedelta(days=14) == timedelta(days=config.date_window_days)
