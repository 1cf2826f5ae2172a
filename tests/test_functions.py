import re
import unicodedata
from datetime import datetime

from pyspark.sql import functions as F

from handbill.functions import dates, keys, text
from handbill.operators import digest

RUN = datetime(2026, 6, 5, 12, 0)


def apply(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def python_norm(value):
    if not value:
        return ""
    plain = "".join(
        c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", plain.lower()).strip()


TEXTS = [None, "", "  Zażółć  gęślą\tjaźń ", "Łódź", "ÉÈ ñ Ö", "a b c", "x\x1cy",
         "Ａｂｃ", "é́", "Й", "plain ascii\n\ntext", "Ὀδυσσεύς"]


def test_norm_is_decompose_lower_collapse(spark):
    assert apply(spark, text.norm, TEXTS) == [python_norm(t) for t in TEXTS]


def test_exact_norm_takes_ligatures(spark):
    values = [*TEXTS, "ﬁn ½ …"]
    assert apply(spark, text.norm, values) == [python_norm(t) for t in values]


def test_city(spark):
    values = ["Gdańsk, Galeria", "Warszawa, ul. Gdanska", "Łódź", "Rumia", None]
    assert apply(spark, text.norm_city, values) == ["gdansk", "gdansk", "łodz", "rumia", ""]
    assert apply(spark, lambda c: text.norm(c, fold_stroke=True), ["Łódź"]) == ["lodz"]


def test_parse_dt(spark):
    cases = {
        "2026-06-10 18:00": datetime(2026, 6, 10, 18), "": None, "12": None, "2026": None,
        "2026-07-03T17:00:00.000Z": datetime(2026, 7, 3, 19), "20260610": datetime(2026, 6, 10),
        "10.06.2026": datetime(2026, 6, 10), "06.25.2026": datetime(2026, 6, 25),
        "Sobota, 10 czerwca 2026, godz. 18:00": datetime(2026, 6, 10, 18),
        "Jul 3, 2026": datetime(2026, 7, 3), "3 października 2026": datetime(2026, 10, 3),
        "2026-03-29 02:30": datetime(2026, 3, 29, 2, 30), "2026-02-30": None,
        "2026-06-10T18:00:00-05": datetime(2026, 6, 11, 1), "kiedys": None,
    }
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert apply(spark, dates.parse_dt, list(cases)) == list(cases.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ranges(spark):
    cases = {
        "19 - 28 czerwca 2026 Gdynia": ("2026-06-19", "2026-06-28"),
        "25 lipca - 16 sierpnia 2026": ("2026-07-25", "2026-08-16"),
        "13 czerwca - 27 września 2026": ("2026-06-13", "2026-09-27"),
        "28 grudnia - 3 stycznia 2027": ("2027-12-28", "2027-01-03"),
        "19-28 czerwca 2026": (None, None), "Sobota, godz. 18:00": (None, None),
        "1 - 2 foo 2026": (None, None),
    }
    both = apply(spark, lambda c: F.struct(*dates.parse_date_range(c)), list(cases))
    assert [tuple(r) for r in both] == list(cases.values())


def test_rolling(spark):
    assert apply(spark, lambda c: dates.roll_day_month(c, RUN), [
        "10.06 Sr", "4.06", "31.02", "29.02", "x"]) == [
        "2026-06-10", "2027-06-04", None, None, None]
    df = spark.createDataFrame(
        [("Cze", "7", "godz. 18:00"), ("paź", "2 Pt", ""), ("sty", "9", None), ("abc", "1", ""),
         ("cze", "", ""), ("lip", "1", "25:00")], "m string, d string, h string")
    rolled = df.select(dates.roll_calendar_icon(F.col("m"), F.col("d"), F.col("h"), RUN))
    assert [r[0] for r in rolled.collect()] == [
        "2026-06-07T18:00", "2026-10-02T00:00", "2027-01-09T00:00", None, None, None]


def test_fix_year(spark):
    assert apply(spark, lambda c: dates.fix_year(c, RUN), [
        "2023-07-03", "2023-01-03", "2024-02-29", "2026-08-01 10:00", "soon", None]) == [
        "2026-07-03T00:00:00", "2027-01-03T00:00:00", "2024-02-29", "2026-08-01T10:00:00",
        "soon", None]


def test_price(spark):
    cases = {"12,5": 12.5, "12.5 zl": 12.5, "12 zł": None, "od 12": None, "1 200": None,
             "1,200.50": None, "12d": None, "": None, "1e2": 100.0, "5.": 5.0, " 7 ": 7.0}
    assert apply(spark, keys.parse_price, list(cases)) == list(cases.values())


def test_loose_dates_take_the_year_of_the_run(spark):
    texts = {
        "10 czerwca": "2026-06-10 00:00:00", "10.06": "2026-06-10 00:00:00", "10.06.26": "2026-06-10 00:00:00",
        "2026/06/10": "2026-06-10 00:00:00", "sob. 10.06.2026 19:00": "2026-06-10 19:00:00",
        "10 June 2026 7:00 PM": "2026-06-10 19:00:00", "10 czerwca 2026 o 19:00": "2026-06-10 19:00:00",
        "Wed, 10 Jun 2026 19:00:00 +0200": "2026-06-10 19:00:00", "20260610T190000Z": "2026-06-10 21:00:00",
        "31.02": None, "12:30": None, "soon": None,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = frame.select("t", dates.parse_dt(F.col("t"), datetime(2026, 6, 5)).cast("string").alias("d")).collect()
    assert {r.t: r.d for r in got} == texts


def test_letters_that_fold_into_several_and_beyond_the_first_plane(spark):
    frame = spark.createDataFrame([("\U0001d401old \ufb01n \u2163 \u2460 \u0141\u00f3d\u017a",)], "t string")
    assert frame.select(text.norm(F.col("t"))).first()[0] == "bold fin iv 1 \u0142odz"
    assert frame.select(text.norm(F.col("t"), True)).first()[0] == "bold fin iv 1 lodz"


def test_prices_beyond_numbers_end_no_job(spark):
    frame = spark.createDataFrame([("1e30",), ("1e999",), ("12,50 zl",), (None,)], "p string")
    frame = frame.withColumn("price_min", keys.parse_price(F.col("p"))).withColumn("is_free", F.lit(False))
    assert [r[0] for r in frame.select(digest.price_label()).collect()] == [
        "1" + "0" * 30 + " zl+", "?", "12 zl+", "?"]


def test_long_keyword_lists_find_the_same_in_one_pass(spark, monkeypatch):
    import random

    of = random.Random(3)
    words = ["".join(of.choices("abż \U0001F916", k=of.randint(1, 4))) for _ in range(300)]
    texts = ["".join(of.choices("abcż \U0001F916", k=of.choice([0, 1, 5, 40]))) for _ in range(80)]
    df = spark.createDataFrame([(n, t) for n, t in enumerate([*texts, None])], "n INT, t STRING")
    for keywords in (words, [w + "q" for w in words] + [""], [w + "q" for w in words], [""] * 250):
        got = {r.n: r for r in df.select(
            "n", text.keyword_hits(F.col("t"), keywords).alias("hits"), text.contains_any(F.col("t"), keywords).alias("any"),
            text.first_contained(F.col("t"), keywords).alias("first")).collect()}
        for n, t in enumerate(texts):
            held = [w for w in keywords if w in t]
            assert (got[n].hits, got[n].any, got[n].first) == (len(held), bool(held), held[0] if held else None)
        assert (got[80].hits, got[80].any, got[80].first) == (0, None, None)


def test_twenty_thousand_keywords(spark):
    many = [f"word{n:05d}x" for n in range(20_000)]
    df = spark.range(2000).select("id", F.concat(F.lit("a word"), F.lpad(F.col("id") * 10, 5, "0"), F.lit("x b")).alias("t"))
    got = df.agg(F.sum(text.keyword_hits(F.col("t"), many)).alias("n")).first().n
    assert got == 2000
