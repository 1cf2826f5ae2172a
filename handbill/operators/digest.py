"""The digest as ordered text lines, markup conversion and packing into messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from handbill.config import STREAMS, RunConfig
from handbill.operators.report import one_row

# Texts and marks of the digest.
SECTION_TITLES = {
    "ai_digital": "\U0001F916 AI / DIGITAL",
    "culture_family": "\U0001F3AD KULTURA & RODZINA (Trojmiasto)",
    "concert": "\U0001F3B5 KONCERTY",
}
TITLE = "## \U0001F4C5 Kalendarz imprez: "
NOTHING_NEW = "Brak nowych wydarzen w oknie."
MARK_NATIONAL = " \U0001F30D"
MARK_FAMILY = " \U0001F468‍\U0001F469‍\U0001F467"
MARK_UPDATED = " \U0001F504"
UNDATED = "termin ?"
RUNNING = "trwa do "
SEPARATOR = " · "


def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def price_label() -> Column:
    price = F.coalesce("price_min", F.lit(0.0))
    whole = F.when(F.abs(price) < 2.0 ** 53, price.try_cast("bigint").cast("string")).otherwise(
        F.format_string("%.0f", price))
    return (
        F.when(F.coalesce("is_free", F.lit(False)), F.lit("free"))
        .when((price != 0) & (F.abs(price) < float("inf")), F.concat(whole, F.lit(" zl+")))
        .otherwise(F.lit("?"))
    )


def event_line(config: RunConfig) -> Column:
    """Text of one event: title, marks, time, place, price, link."""
    start, end = F.col("start_datetime"), F.col("end_datetime")
    today = F.lit(config.run_ts.date())
    running = F.coalesce((F.to_date(start) < today) & (today <= F.to_date(end)), F.lit(False))
    when = (
        F.when(running, F.concat(F.lit(RUNNING), F.date_format(end, "dd MMM")))
        .when(start.isNotNull(), F.date_format(start, "EEE dd MMM HH:mm"))
        .otherwise(F.lit(UNDATED))
    )
    city, venue = F.col("city"), F.col("venue_name")
    place = (
        F.when(_filled(city) & _filled(venue), F.concat(city, F.lit(", "), venue))
        .when(_filled(city), city)
        .when(_filled(venue), venue)
        .otherwise(F.lit("?"))
    )
    link = (
        F.when(_filled(F.col("ticket_url")), F.col("ticket_url"))
        .when(_filled(F.col("source_url")), F.col("source_url"))
        .otherwise(F.lit(""))
    )

    def mark(flag: Column, text: str) -> Column:
        return F.when(flag, F.lit(text)).otherwise(F.lit(""))

    marks = F.concat(
        mark(F.col("national_scope"), MARK_NATIONAL),
        mark(F.col("family_suitable"), MARK_FAMILY),
        mark(F.col("delivery_state") == "updated", MARK_UPDATED),
    )
    return F.concat(
        F.lit("- *"), F.col("title"), F.lit("*"), marks, F.lit(SEPARATOR), when,
        F.lit(SEPARATOR), place, F.lit(SEPARATOR), price_label(),
        F.lit(SEPARATOR + "<"), link, F.lit("|Info>"),
    )


def event_lines(ranked: DataFrame, config: RunConfig) -> DataFrame:
    """One line per ranked event, with its stream and rank."""
    return ranked.select("category", "stream_no", "rank", event_line(config).alias("line"))


def digest(ranked: DataFrame, config: RunConfig, run_totals: DataFrame) -> DataFrame:
    """The whole digest as ``(line_no, category, line)``; no text is gathered into one row.

    Frame lines get their numbers from the row counts per stream (at most one row per
    stream). ``run_totals`` holds one row: sources, skipped, credits.
    """
    spark = ranked.sparkSession
    lines = event_lines(ranked, config)
    sections = spark.createDataFrame(
        [(i + 1, s, SECTION_TITLES[s]) for i, s in enumerate(STREAMS)],
        "stream_no INT, category STRING, section STRING",
    )
    sizes = ranked.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    counted = sections.join(F.broadcast(sizes), "category", "left").select(
        "stream_no", "category", "section", F.coalesce("n", F.lit(0)).alias("n")
    )
    # One row: lines and events per stream, so offsets are plain column arithmetic.
    per_stream = [
        F.coalesce(F.max(F.when(F.col("category") == s, F.col("n"))), F.lit(0)).alias(f"n_{s}")
        for s in STREAMS
    ]
    totals = counted.agg(*per_stream)

    def block(stream: str) -> Column:
        n = F.col(f"n_{stream}")
        return F.when(n > 0, n + 3).otherwise(F.lit(0))

    offset, offsets = F.lit(3), {}
    for stream in STREAMS:
        offsets[stream] = offset
        offset = offset + block(stream)
    total_events = sum((F.col(f"n_{s}") for s in STREAMS), F.lit(0))
    frame = one_row(totals, run_totals.select("sources", "skipped", "credits")).select(
        *[offsets[s].alias(f"at_{s}") for s in STREAMS],
        *[f"n_{s}" for s in STREAMS],
        offset.alias("at_end"), total_events.alias("n_events"),
        "sources", "skipped", "credits",
    )
    header = TITLE + config.window_label

    def entry(number: Column, category: Column, text: Column, shown: Column) -> Column:
        return F.struct(
            number.cast("bigint").alias("line_no"), category.alias("category"),
            text.alias("line"), shown.alias("shown"),
        )

    none = F.lit(None).cast("string")
    some, always = F.col("n_events") > 0, F.lit(True)
    entries = [
        entry(F.lit(1), none, F.lit(header), always),
        entry(F.lit(2), none, F.lit(f"_run {config.run_ts:%Y-%m-%d %H:%M}_"), some),
        entry(F.lit(3), none, F.lit(""), some),
        entry(F.lit(2), none, F.lit(""), ~some),
        entry(F.lit(3), none, F.lit(NOTHING_NEW), ~some),
        entry(F.col("at_end") + 1, none, F.lit("---"), some),
        entry(
            F.col("at_end") + 2, none,
            F.concat(
                F.lit("_"), F.col("n_events"), F.lit(f" wydarzen{SEPARATOR}"), F.col("sources"),
                F.lit(f" zrodel{SEPARATOR}"), F.col("skipped"), F.lit(f" pominietych{SEPARATOR}"),
                F.col("credits"), F.lit(" kredytow Firecrawl_"),
            ),
            some,
        ),
    ]
    for s in STREAMS:
        at, n = F.col(f"at_{s}"), F.col(f"n_{s}")
        entries += [
            entry(at + 1, F.lit(s), F.lit(f"### {SECTION_TITLES[s]}"), n > 0),
            entry(at + 2, F.lit(s), F.lit(""), n > 0),
            entry(at + 3 + n, F.lit(s), F.lit(""), n > 0),
        ]
    frame_lines = (
        frame.select(F.inline(F.array(*entries))).where("shown").select("line_no", "category", "line")
    )
    starts = frame.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s).alias("category"), F.col(f"at_{s}").alias("at"))
                    for s in STREAMS
                ]
            )
        )
    )
    body = lines.join(F.broadcast(starts), "category").select(
        (F.col("at") + 2 + F.col("rank")).cast("bigint").alias("line_no"), "category", "line"
    )
    return frame_lines.unionByName(body)


def to_markdown(text: Column) -> Column:
    """``<url|label>`` to ``[label](url)`` and ``*bold*`` to ``**bold**``."""
    linked = F.regexp_replace(text, r"<([^|>]+)\|([^>]+)>", "[$2]($1)")
    return F.regexp_replace(linked, r"(?<!\*)\*([^*\n]+)\*(?!\*)", "**$1**")


def _without_last_breaks(c: Column) -> Column:
    return F.rtrim(c, F.lit("\n"))


def pack_lines(text: Column, limit: int) -> Column:
    """Chunks of whole lines, each at most ``limit`` characters; a longer line stays whole.

    A fold over the lines of one text; trailing line breaks of a chunk are dropped, and a
    last chunk of blanks only is not emitted.
    """
    start = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit("").alias("open")
    )

    def step(acc: Column, line: Column) -> Column:
        full = (acc["open"] != "") & (
            F.length(acc["open"]) + F.length(line) + 1 > F.lit(limit)
        )
        return F.when(
            full,
            F.struct(
                F.concat(acc["done"], F.array(_without_last_breaks(acc["open"]))).alias("done"),
                F.concat(line, F.lit("\n")).alias("open"),
            ),
        ).otherwise(
            F.struct(
                acc["done"].alias("done"),
                F.concat(acc["open"], line, F.lit("\n")).alias("open"),
            )
        )

    def close(acc: Column) -> Column:
        blank = ~acc["open"].rlike(r"(?U)[^\s]")
        return F.when(blank, acc["done"]).otherwise(
            F.concat(acc["done"], F.array(_without_last_breaks(acc["open"])))
        )

    return F.aggregate(F.split(text, "\n", -1), start, step, close)
