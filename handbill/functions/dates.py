"""Dates as Warsaw wall-clock ``TIMESTAMP_NTZ``; bad input gives NULL, never an error."""

from __future__ import annotations

import calendar
from datetime import datetime

from pyspark.sql import Column, functions as F

from handbill.functions.text import strip, strip_accents

# Polish month names as written in dates, accents removed.
POLISH_MONTHS = {
    "stycznia": 1, "lutego": 2, "marca": 3, "kwietnia": 4, "maja": 5, "czerwca": 6,
    "lipca": 7, "sierpnia": 8, "wrzesnia": 9, "pazdziernika": 10, "listopada": 11,
    "grudnia": 12,
}
# Polish month abbreviations of calendar icons.
POLISH_SHORT_MONTHS = {
    "sty": 1, "lut": 2, "mar": 3, "kwi": 4, "maj": 5, "cze": 6,
    "lip": 7, "sie": 8, "wrz": 9, "paz": 10, "lis": 11, "gru": 12,
}

_ENGLISH_MONTHS = {
    name.lower(): number
    for names in (calendar.month_name, calendar.month_abbr)
    for number, name in enumerate(names)
    if name
}
_ALL_MONTHS = {**_ENGLISH_MONTHS, **POLISH_SHORT_MONTHS, **POLISH_MONTHS}

_CLOCK = r"(?:[T ,]+(?:godz\.?\s*)?(\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?))?"
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?$"
_ISO_OFFSET = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}(?::\d{2}){0,2}(?:\.\d+)?)\s*(Z|z|[+-]\d{2}(?::?\d{2})?)$"
_ISO_LOOSE = r"^(\d{4}-\d{1,2}-\d{1,2})" + _CLOCK + r"$"
_ISO_HOUR = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_NUMERIC = r"^(\d{1,2})[./-](\d{1,2})[./-](\d{4})" + _CLOCK + r"$"
_DAY_NAME = r"^(?:[^\d]*\s)?(\d{1,2})\.?\s+(\p{L}+)\.?,?\s+(\d{4})" + _CLOCK + r"$"
_NAME_DAY = r"^(?:[^\d]*\s)?(\p{L}+)\.?\s+(\d{1,2}),?\s+(\d{4})" + _CLOCK + r"$"


# Looser layouts, each with its groups put in the order year, month, day, hour, minute, second, half of the
# day, offset. Words before the day and a weekday are skipped.
_LEAD = r"^(?:[^\d]*\s)?"
_TIME = (
    r"(?:[T ,]+(?:o\s+|at\s+|godz\.?\s*)?(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?\s*([AaPp])?(?:\.?[Mm]\.?)?"
    r"\s*(Z|[+-]\d{2}:?\d{2})?)?$"
)
_LOOSE = (
    (_LEAD + r"(\d{1,2})[./-](\d{1,2})(?:[./-](\d{4}|\d{2}))?\.?" + _TIME, "$3|$2|$1"),
    (_LEAD + r"(\d{1,2})\.?\s+(\p{L}+)\.?,?(?:\s+(\d{4}))?(?:\s*r\.)?" + _TIME, "$3|$2|$1"),
    (_LEAD + r"(\p{L}+)\.?\s+(\d{1,2})(?:,?\s+(\d{4}))?" + _TIME, "$3|$1|$2"),
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})" + _TIME, "$1|$2|$3"),
)
_COMPACT_TIME = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})?(Z|[+-]\d{2}:?\d{2})?$"


def _month_number(name: Column, table: dict[str, int]) -> Column:
    """Month number of a name, NULL for an unknown one."""
    pairs = [item for key, value in table.items() for item in (F.lit(key), F.lit(value))]
    return F.try_element_at(F.create_map(*pairs), strip_accents(F.lower(name)))


def _ntz(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def _date_text(year: Column, month: Column, day: Column) -> Column:
    return F.concat(year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"))


def _from_parts(p: Column, year: int | None) -> Column:
    """Time from its parts as text; ``year`` is that of texts without one."""
    month = F.when(p[1].rlike(r"^\d"), p[1]).otherwise(_month_number(p[1], _ALL_MONTHS).cast("string"))
    full = (
        F.when(p[0] == "", F.lit(None if year is None else str(year)).cast("string"))
        .when(F.length(p[0]) == 2, F.concat(F.when(p[0] < "70", F.lit("20")).otherwise(F.lit("19")), p[0]))
        .otherwise(p[0])
    )
    hour = F.coalesce(p[3].try_cast("int"), F.lit(0))
    half = F.lower(p[6])
    hour = F.when((half == "p") & (hour < 12), hour + 12).when((half == "a") & (hour == 12), 0).otherwise(hour)
    second = F.when(p[5] == "", F.lit("00")).otherwise(p[5])
    minute = F.when(p[4] == "", F.lit("00")).otherwise(p[4])

    def at(month: Column, day: Column) -> Column:
        clock = F.concat_ws(":", F.lpad(hour.cast("string"), 2, "0"), minute, second)
        return _ntz(F.concat(_date_text(full, month, day), F.lit(" "), clock))

    local = F.coalesce(at(month, p[2]), at(p[2], month))
    digits = F.rpad(F.regexp_replace(p[7], r"[^0-9]", ""), 4, "0")
    ahead = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    utc = local - F.make_dt_interval(mins=F.when(p[7].startswith("-"), -ahead).otherwise(ahead))
    moved = F.convert_timezone(F.lit("UTC"), F.lit("Europe/Warsaw"), utc)
    return F.when(p[7] == "", local).otherwise(moved)


def _loose(s: Column, year: int | None) -> Column:
    """The looser layouts; a text's parts are taken apart once."""
    parts = F.when(s.rlike(_COMPACT_TIME), F.regexp_replace(s, _COMPACT_TIME, "$1|$2|$3|$4|$5|$6||$7"))
    for pattern, date in _LOOSE:
        parts = parts.when(s.rlike(pattern), F.regexp_replace(s, pattern, f"{date}|$4|$5|$6|$7|$8"))
    return F.transform(F.array(F.split(parts, r"\|", -1)), lambda p: _from_parts(p, year))[0]


def parse_dt(c: Column, run_ts: datetime | None = None) -> Column:
    """Timestamp text to Warsaw wall-clock time; see :func:`parse_trimmed_dt`."""
    return parse_trimmed_dt(strip(c), run_ts)


def parse_trimmed_dt(s: Column, run_ts: datetime | None = None) -> Column:
    """Timestamp text without outer blanks to Warsaw wall-clock time.

    A text without a year gets that of ``run_ts``, and is NULL where none is given.

    Year-first layouts are month before day, all others day first (month first only where
    the middle number cannot be a month). Polish and English month names are known. A zone
    offset is taken off by arithmetic on the wall clock, so the session zone plays no part.
    """

    def rewritten(pattern: str, year_first: str) -> Column:
        return _ntz(F.regexp_replace(s, pattern, year_first))

    def group(pattern: str, index: int) -> Column:
        return F.regexp_extract(s, pattern, index)

    def named(pattern: str, name: int, rest: str) -> Column:
        month = _month_number(group(pattern, name), _ALL_MONTHS).cast("string")
        written = F.regexp_replace(s, pattern, rest)
        return _ntz(F.replace(written, F.lit("M"), month))

    local, offset = group(_ISO_OFFSET, 1), group(_ISO_OFFSET, 2)
    local = F.when(F.length(local) == 13, F.concat(local, F.lit(":00"))).otherwise(local)
    digits = F.rpad(F.regexp_replace(offset, r"[^0-9]", ""), 4, "0")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(
        digits, 3, 2
    ).try_cast("int")
    minutes = F.when(offset.startswith("-"), -minutes).otherwise(minutes)
    utc = _ntz(local) - F.make_dt_interval(mins=minutes)

    return (
        F.when(s.rlike(_ISO), _ntz(s))
        .when(
            s.rlike(_ISO_OFFSET),
            F.convert_timezone(F.lit("UTC"), F.lit("Europe/Warsaw"), utc),
        )
        .when(
            s.rlike(_NUMERIC),
            F.coalesce(rewritten(_NUMERIC, "$3-$2-$1 $4"), rewritten(_NUMERIC, "$3-$1-$2 $4")),
        )
        .when(s.rlike(_DAY_NAME), named(_DAY_NAME, 2, "$3-M-$1 $4"))
        .when(s.rlike(_NAME_DAY), named(_NAME_DAY, 1, "$3-M-$2 $4"))
        .when(s.rlike(_ISO_HOUR), _ntz(F.concat(s, F.lit(":00"))))
        .when(s.rlike(_COMPACT), rewritten(_COMPACT, "$1-$2-$3"))
        .when(s.rlike(_ISO_LOOSE), rewritten(_ISO_LOOSE, "$1 $2"))
        .otherwise(_loose(s, run_ts.year if run_ts else None))
    )


def _next_occurrence(month: Column, day: Column, run_ts: datetime) -> Column:
    """The date of a day and month in the run's year, or in the next one when it is past.

    NULL for an impossible day, also when 29 February has to move to a common year.
    """

    def in_year(year: int) -> Column:
        return F.try_to_date(_date_text(F.lit(str(year)), month, day), "yyyy-MM-dd")

    this_year = in_year(run_ts.year)
    return F.when(this_year < F.lit(run_ts.date()), in_year(run_ts.year + 1)).otherwise(this_year)


def roll_day_month(text: Column, run_ts: datetime) -> Column:
    """``10.06 ...`` without a year to a date text."""
    pattern = r"(\d{1,2})\.(\d{1,2})"
    day, month = (F.regexp_extract(text, pattern, i) for i in (1, 2))
    when = _next_occurrence(month, day, run_ts)
    return F.when(text.rlike(pattern), F.date_format(when, "yyyy-MM-dd"))


def roll_calendar_icon(month_text: Column, day_text: Column, hour_text: Column,
                       run_ts: datetime) -> Column:
    """Abbreviated month, day and clock text to a timestamp text; midnight without a clock."""
    name = F.substring(F.lower(strip(month_text)), 1, 3)
    month = _month_number(name, POLISH_SHORT_MONTHS).cast("string")
    day = F.nullif(F.regexp_extract(day_text, r"(\d{1,2})", 1), F.lit(""))
    clock = r"(\d{1,2}):(\d{2})"
    hour = F.coalesce(F.regexp_extract(hour_text, clock, 1), F.lit(""))
    minute = F.coalesce(F.regexp_extract(hour_text, clock, 2), F.lit(""))
    hour = F.when(hour == "", F.lit("00")).otherwise(F.lpad(hour, 2, "0"))
    minute = F.when(minute == "", F.lit("00")).otherwise(minute)
    date = _next_occurrence(month, day, run_ts)
    valid = (hour < "24") & (minute < "60")
    return F.when(
        valid,
        F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("T"), hour, F.lit(":"), minute),
    )


def parse_date_range(text: Column) -> tuple[Column, Column]:
    """``19 - 28 czerwca 2026`` or ``25 lipca - 16 sierpnia 2026`` to (first, last) date texts.

    Both ends carry the one year in the text; (NULL, NULL) when the text is no range.
    """
    pattern = r"(\d{1,2})\s+(\p{L}+)?\s*[-–]\s*(\d{1,2})\s+(\p{L}+)\s+(\d{4})"
    day1, name1, day2, name2, year = (F.regexp_extract(text, pattern, i) for i in range(1, 6))
    month2 = _month_number(name2, POLISH_MONTHS)
    month1 = F.when(name1 == "", month2).otherwise(_month_number(name1, POLISH_MONTHS))
    known = month1.isNotNull() & month2.isNotNull()
    first = F.when(known, _date_text(year, month1.cast("string"), day1))
    last = F.when(known, _date_text(year, month2.cast("string"), day2))
    return first, last


def fix_year(text: Column, run_ts: datetime) -> Column:
    """Move a past date to the run's year, or the next; unreadable text and a 29 February
    that has no counterpart stay as they are."""
    parsed = parse_dt(text)

    def in_year(year: int) -> Column:
        return _ntz(F.concat(F.lit(str(year)), F.substring(parsed.cast("string"), 5, 40)))

    def show(ts: Column) -> Column:
        return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))

    today = F.lit(run_ts.date())
    moved = F.when(F.to_date(in_year(run_ts.year)) < today, in_year(run_ts.year + 1)).otherwise(
        in_year(run_ts.year)
    )
    repaired = F.when(F.to_date(parsed) < today, F.when(in_year(run_ts.year).isNotNull(), moved)) \
        .otherwise(parsed)
    return F.coalesce(show(repaired), text)
