"""Text folding and keyword matching as column expressions."""

from __future__ import annotations

import unicodedata
from collections import Counter
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, functions as F

from handbill.config import HOME_CITIES, KNOWN_CITIES

# Whitespace as Python's str.strip and re \s see it.
_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_SPACE_RUNS = r"(?U)[\s\x1c-\x1f]+"


@lru_cache(maxsize=None)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """(from, to) for ``translate`` and the letters that fold into several.

    Built from the Unicode data: what the compatibility decomposition of a letter leaves
    without combining marks; then the marks themselves, deleted. Composed Hangul stays, as one
    spelling is used throughout.
    """
    source, target, several = [], [], {}
    for code in chain(range(0x80, 0xAC00), range(0xD7A4, 0xD800), range(0xE000, 0x30000)):
        char = chr(code)
        decomposed = unicodedata.normalize("NFKD", char)
        if decomposed == char:
            continue
        folded = "".join(c for c in decomposed if not unicodedata.combining(c))
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        elif folded:
            several[char] = folded
    marks = [chr(c) for c in range(0x300, 0x1F000) if unicodedata.combining(chr(c))]
    return "".join(source + marks), "".join(target), several


def strip(c: Column) -> Column:
    """Trim every kind of whitespace, as ``str.strip`` does."""
    return F.btrim(c, F.lit(_SPACES))


def first_of(*cols: Column) -> Column:
    """``a or b or c``: the first non-empty value, else the last operand as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols[:-1]], cols[-1])


def strip_accents(c: Column, fold_stroke: bool = False) -> Column:
    """Drop accents. ASCII text, found by comparing byte and character counts, passes through.

    The stroked l has no decomposition and stays unless ``fold_stroke`` is set.
    """
    source, target, several = _fold_tables()
    if fold_stroke:
        source, target = "łŁ" + source, "lL" + target
    # letters that fold into several are looked up one by one, only in texts that hold one
    table = F.str_to_map(
        F.lit("\x01".join(f"{k}\x02{v}" for k, v in several.items())), F.lit("\x01"), F.lit("\x02"))
    spread = F.array_join(F.transform(
        F.regexp_extract_all(c, F.lit("(?s)(.)")),
        lambda x: F.when(F.octet_length(x) == 1, x).otherwise(F.coalesce(F.try_element_at(table, x), x))), "")
    holds = F.octet_length(F.translate(c, "".join(several), "")) < F.octet_length(c)
    wide = F.when(holds, spread).otherwise(c)
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.translate(wide, source, target))


def norm(c: Column, fold_stroke: bool = False) -> Column:
    """Accent-free lower case with single spaces; NULL becomes the empty text."""
    lowered = F.lower(strip_accents(F.coalesce(c, F.lit("")), fold_stroke))
    return F.trim(F.regexp_replace(lowered, _SPACE_RUNS, " "))


def known_city(normed: Column) -> Column:
    """The first known city contained in an already normalised place, else the place."""
    branches = [F.when(F.contains(normed, F.lit(name)), F.lit(name)) for name in KNOWN_CITIES]
    return F.coalesce(*branches, normed)


def norm_city(c: Column) -> Column:
    return known_city(norm(c))


def is_home_city(city_norm: Column) -> Column:
    return city_norm.isin(*HOME_CITIES)


# Above this many keywords one expression per keyword would outgrow a generated method, and a text would be searched
# once for each: an automaton then finds all of them in one pass.
_INLINE_KEYWORDS = 200


def keyword_hits(text: Column, keywords) -> Column:
    """How many of the keywords occur in the text (each counted once)."""
    keywords = list(keywords)
    if not keywords:
        return F.lit(0)
    if len(keywords) > _INLINE_KEYWORDS:
        return F.coalesce(_searched(text, keywords, "hits"), F.lit(0))
    total = F.contains(text, F.lit(keywords[0])).cast("int")
    for word in keywords[1:]:
        total = total + F.contains(text, F.lit(word)).cast("int")
    return total


def contains_any(text: Column, keywords) -> Column:
    """True when at least one keyword occurs in the text; stops at the first hit."""
    keywords = list(keywords)
    if not keywords:
        return F.lit(False)
    if len(keywords) > _INLINE_KEYWORDS:
        return _searched(text, keywords, "any") > 0
    found = F.contains(text, F.lit(keywords[0]))
    for word in keywords[1:]:
        found = found | F.contains(text, F.lit(word))
    return found


def first_contained(text: Column, keywords) -> Column:
    """The first keyword, in list order, that occurs in the text, else NULL."""
    keywords = list(keywords)
    if not keywords:
        return F.lit(None).cast("string")
    if len(keywords) > _INLINE_KEYWORDS:
        number = _searched(text, keywords, "first")
        return F.try_element_at(F.array(*[F.lit(w) for w in keywords]), F.nullif(number, F.lit(0)))
    return F.coalesce(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in keywords])


@lru_cache(maxsize=8)
def _automaton(keywords: tuple[str, ...]):
    """The automaton of distinct keywords, each with its first place (from 1) in the list; kept by the worker."""
    import ahocorasick

    places: dict[str, int] = {}
    for place, word in enumerate(keywords, 1):
        places.setdefault(word, place)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for word, place in places.items():
        if word:  # the empty text occurs everywhere
            automaton.add_word(word, place)
    automaton.make_automaton()
    return automaton, Counter(keywords), places.get("")


def _searched(text: Column, keywords: list[str], kind: str) -> Column:
    """One pass over each text, in Arrow batches: number of listed keywords it holds, place of the first, or 1 for
    any (0 for none). NULL for NULL."""
    held = tuple(keywords)

    def number(value: str | None) -> int | None:
        if value is None:
            return None
        automaton, times, empty = _automaton(held)
        places = (place for _, place in automaton.iter(value)) if len(automaton) else iter(())
        if kind == "any":
            return int(empty is not None or next(places, None) is not None)
        found = {*places, *([empty] if empty else [])}
        return sum(times[held[place - 1]] for place in found) if kind == "hits" else min(found, default=0)

    def batch(values: pa.Array) -> pa.Array:
        return pa.array([number(value.as_py()) for value in values], pa.int32())

    return F.arrow_udf(batch, "int")(text)
