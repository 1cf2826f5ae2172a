"""Fill-in-the-middle examples, cut on bytes with a sparse index of the characters that are not ASCII.

A text is cut twice, after units drawn from a hash of its id, and its parts are put in the order of a form:
``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), each after its marker. ``plain`` texts
stay as they are: those not drawn, empty ones, and those that hold a marker.

All work is on the bytes of a block of texts. ``Exceptions`` lists only the multibyte characters, with
the bytes each has beyond its first; a search in that list turns places in bytes into places in code
points and back, and in between both grow alike. A block of ASCII texts has an empty list.

Units are ``words`` (a word with the white space before it; white space at the end is one of its own) or
``characters`` (code points). ``restored`` rebuilds a text from its output and form alone.

Null texts are empty (``plain``, no units); a null id is drawn as the empty string; repeated rows get
alike; an empty table gives an empty result; other columns are ignored. Tasks hold one block (about 2 MB,
or one longer text); nothing is exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import only
from .words import IS_SPACE, blocks, word_spans

MARKERS = ("<P>", "<S>", "<M>")
FORMS = np.array(["plain", "psm", "spm"])
OUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


class Exceptions:
    """Places of the multibyte characters in bytes of UTF-8, and how many bytes too many precede them."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.extra = np.concatenate(([0], np.cumsum(extra)))
        self.char_at = self.at - self.extra[:-1]

    def to_chars(self, places: np.ndarray) -> np.ndarray:
        """Code points before each place in bytes; places are borders of characters."""
        return places - self.extra[np.searchsorted(self.at, places, "left")]

    def to_bytes(self, places: np.ndarray) -> np.ndarray:
        """Bytes before each place in code points."""
        return places + self.extra[np.searchsorted(self.char_at, places, "left")]


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of all words, the number of words before each text, and the units of each text."""
    _, stops, before = word_spans(data, offsets)
    filled = np.diff(offsets) > 0
    loose = np.zeros(len(filled), bool)
    loose[filled] = IS_SPACE[data[offsets[1:][filled] - 1]]
    return stops, before, np.diff(before) + loose


def _cuts(data, offsets, index: Exceptions, unit: str, draws: np.ndarray):
    """Units of each text, and its two cuts in bytes of the block, in order."""
    if unit == "words":
        stops, before, n = word_units(data, offsets)
        cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
        ends = np.concatenate((stops, [0]))
        last = cuts > np.diff(before)[:, None]  # past the last word: white space at the end
        at = ends[np.clip(before[:-1, None] + cuts - 1, 0, len(stops))]
        at = np.where(cuts == 0, offsets[:-1, None], np.where(last, offsets[1:, None], at))
        return n, at
    chars = index.to_chars(offsets)
    n = np.diff(chars)
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    return n, index.to_bytes(chars[:-1, None] + cuts)


def _marked(data: bytes, offsets: np.ndarray, markers: tuple[bytes, ...]) -> np.ndarray:
    """Texts that hold a marker."""
    out = np.zeros(len(offsets) - 1, bool)
    for marker in markers:
        at = data.find(marker)
        while at >= 0:
            text = int(np.searchsorted(offsets, at, "right")) - 1
            if at + len(marker) <= offsets[text + 1]:
                out[text] = True
                at = data.find(marker, int(offsets[text + 1]))
            else:
                at = data.find(marker, at + 1)
    return out


def _transform(unit: str, rate: int, spm: int, markers: tuple[str, ...]):
    p, s, m = (x.encode() for x in markers)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.stack([batch.column(f"h{k}").to_numpy() for k in range(1, 5)], axis=1)
            for first, stop, data, offsets in blocks(batch.column("text")):
                draws = every[first:stop]
                index = Exceptions(data)
                n, at = _cuts(data, offsets, index, unit, draws)
                raw = data.tobytes()
                plain = (np.diff(offsets) == 0) | (draws[:, 2] % 100 >= rate) | _marked(raw, offsets, (p, s, m))
                form = np.where(plain, 0, np.where(draws[:, 3] % 100 < spm, 2, 1))
                edges = np.concatenate((offsets[:-1, None], at), axis=1)
                chars = np.diff(index.to_chars(edges.ravel()).reshape(-1, 3), axis=1)
                outputs = []
                for chosen, a, (b, c), d in zip(form.tolist(), offsets[:-1].tolist(), at.tolist(), offsets[1:].tolist()):
                    if chosen == 0:
                        outputs.append(raw[a:d])
                    elif chosen == 1:
                        outputs.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
                    else:
                        outputs.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
                yield pa.record_batch([
                    batch.column("doc_id").slice(first, stop - first), pa.array(n, pa.int64()), pa.array(FORMS[form]),
                    pa.array(chars[:, 0], pa.int64(), mask=plain), pa.array(chars[:, 1], pa.int64(), mask=plain),
                    pa.array(outputs, pa.binary()).view(pa.string()),
                ], schema=schema)

    return run


def draws(doc_id: str, seed: int | str) -> list[Column]:
    """Four numbers of 32 bits from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = "words", rate: int = 50, spm: int = 80, seed: int | str = 42,
                   markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars (NULL if plain), output.

    ``rate`` percent of the texts are cut, ``spm`` percent of those have the suffix first. All markers begin with
    one character, which they hold nowhere else, and none begins another: an output reads one way only.
    """
    if unit not in ("words", "characters"):
        raise ValueError(f"unknown unit: {unit}")
    if len({x[:1] for x in markers}) != 1 or any(x[:1] in x[1:] for x in markers) or any(
            a != b and a.startswith(b) for a in markers for b in markers) or len(set(markers)) < 3:
        raise ValueError(f"markers that could be read two ways: {markers}")
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text", *draws("doc_id", seed))
    return rows.mapInArrow(_transform(unit, rate, spm, markers), OUT)


def restored(output: str = "output", form: str = "form", markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text an output was made of: its parts are read off between the first of each marker."""
    out, (p, s, m) = F.col(output), markers

    def between(a: str, b: str | None) -> Column:
        start = F.locate(a, out) + len(a)
        rest = F.substring(out, start, F.length(out))
        return rest if b is None else F.substring_index(rest, b, 1)

    return F.when(F.col(form) == "psm", F.concat(between(p, s), between(m, None), between(s, m))).when(
        F.col(form) == "spm", F.concat(between(p, m), between(m, None), between(s, p))).otherwise(out)
