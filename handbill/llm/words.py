"""Words and cut points of many texts at once, on the bytes of an Arrow string column.

White space is ``[\\x20\\x09-\\x0D]`` throughout. Work goes through blocks of whole texts of about
``BLOCK`` bytes, so a task's memory does not follow the size of its Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 2 << 20

_rng = np.random.default_rng(20240607)
_TABLE = _rng.integers(0, 1 << 63, 64 * 256, dtype=np.uint64) * np.uint64(2) + _rng.integers(
    0, 2, 64 * 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[65:91] = IS_LETTER[97:123] = True
#: ASCII characters that always end a run of letters: all but white space, letters, apostrophe.
IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[33:127] = True
IS_BREAK[39] = False
IS_BREAK &= ~IS_LETTER
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the offsets of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``size`` bytes: first, stop, their bytes, their offsets."""
    if len(texts) == 0:
        return
    data, offsets = text_bytes(texts)
    first = 0
    while first < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        stop = min(max(stop, first + 1), len(offsets) - 1)
        yield first, stop, data[offsets[first]: offsets[stop]], offsets[first: stop + 1] - offsets[first]
        first = stop


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and stop of each word, and for each text the number of words before it (one more at the end)."""
    inside = ~IS_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    at = edges[(edges > 0) & (edges < len(data))]
    starts[at] |= inside[at]
    stops[at - 1] |= inside[at - 1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty span of bytes, by its place and byte; spans don't overlap."""
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    lens = stops - starts
    heads = np.cumsum(lens) - lens
    place = np.arange(heads[-1] + lens[-1], dtype=np.int32)
    place -= np.repeat(heads.astype(np.int32), lens)
    if len(place) == len(data):
        chars = data
    else:
        marks = np.zeros(len(data) + 1, np.int8)
        marks[starts] += 1
        np.subtract.at(marks, stops, 1) if len(stops) and stops.max() > len(data) else None
        marks[stops] -= 1
        chars = data[np.cumsum(marks[:-1], dtype=np.int8).astype(bool)]
    values = _TABLE[((place & 63) << 8) | chars]
    far = np.flatnonzero(place > 63)
    if len(far):
        values[far] *= mix((place[far] >> 6).astype(np.uint64)) | np.uint64(1)
    return mix(np.add.reduceat(values, heads) + lens.astype(np.uint64) * _ODD)


def in_doc_order(hashes: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """A hash of each run of ``size`` neighbouring values (runs across texts included)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    base = mix(np.array([seed], np.uint64))[0] | np.uint64(1)
    for k in range(size):
        out *= base
        out += hashes[k: k + n]
    return mix(out)
