"""Repeated elements of web pages and the texts and attributes inside them.

Pages go through one pass over their tags, batch by batch, with the open elements on a stack: nesting of
any depth, any quoting and letter case of attributes, all character references. An element ends at its own
end tag, where an element around it ends, or where HTML implies its end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
#: Elements that the next one of their kind ends, unless one of these is open in between.
_IMPLIED = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",),
    "td": ("table", "tr"), "th": ("table", "tr"), "a": (),
}


# Characters of the pages whose rows are held as Python objects together.
PIECE_CHARS = 1_000_000


@dataclass(frozen=True)
class Element:
    """Elements by name ('' for any) and patterns found in their attributes."""

    name: str = ""
    attributes: dict[str, str] = field(default_factory=dict)

    def compiled(self):
        return self.name, [(k, re.compile(v)) for k, v in self.attributes.items()]


@dataclass(frozen=True)
class Cell:
    """The first such element of a row (``None``: the row's own): an attribute, or its text
    without the text of ``without`` elements in it."""

    element: Element | None = None
    attribute: str | None = None
    without: Element | None = None


@dataclass(frozen=True)
class RowLayout:
    row: Element
    cells: dict[str, Cell]


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def _fits(element, name: str, attributes: dict[str, str]) -> bool:
    wanted, patterns = element
    return (not wanted or wanted == name) and all(
        k in attributes and p.search(attributes[k]) for k, p in patterns)


class _Text:
    """Text gathered from an element that is still open."""

    def __init__(self, row: list, place: int, level: int, without):
        self.row, self.place, self.level, self.without = row, place, level, without
        self.pieces: list[str] = []
        self.skipping = 0  # level of the element left out just now


class _Page:
    def __init__(self, layout: RowLayout):
        self.row = layout.row.compiled()
        self.cells = [
            (c.element and c.element.compiled(), c.attribute, c.without and c.without.compiled())
            for c in layout.cells.values()
        ]

    def rows(self, html: str) -> list[list[str]]:
        """Cells of each row, '' for an absent one."""
        self.stack: list[str] = []
        self.open_rows: list[tuple[int, list]] = []
        self.texts: list[_Text] = []
        found: list[list] = []
        at = 0
        for token in _TOKEN.finditer(html):
            if self.texts and token.start() > at:
                self._text(html[at: token.start()])
            at = token.end()
            name = token["name"]
            if name is None:
                continue
            name = name.lower()
            if token["end"]:
                if name in self.stack:
                    self._close(len(self.stack) - 1 - self.stack[::-1].index(name))
            else:
                self._open(name, token["attributes"], found)
        if self.texts and at < len(html):
            self._text(html[at:])
        self._close(0)
        return [[x or "" for x in row] for row in found]

    def _text(self, text: str) -> None:
        piece = unescape(text).strip()
        if piece:
            for one in self.texts:
                if not one.skipping:
                    one.pieces.append(piece)

    def _open(self, name: str, text: str, found: list) -> None:
        if name in _IMPLIED:
            for level in range(len(self.stack) - 1, -1, -1):
                if self.stack[level] == name:
                    self._close(level)
                if level >= len(self.stack) or self.stack[level] in _IMPLIED[name]:
                    break
        attributes = _attributes(text) if "=" in text else {}
        level = len(self.stack)
        own = None
        if _fits(self.row, name, attributes):
            own = [None] * len(self.cells)
            found.append(own)
            self.open_rows.append((level, own))
        for one in self.texts:
            if one.without and not one.skipping and _fits(one.without, name, attributes):
                one.skipping = level + 1
        for _, row in self.open_rows:
            for place, (element, attribute, without) in enumerate(self.cells):
                if row[place] is not None or not (
                        row is own if element is None else row is not own and _fits(element, name, attributes)):
                    continue
                if attribute:
                    row[place] = attributes.get(attribute, "")
                else:
                    row[place] = ""
                    self.texts.append(_Text(row, place, level, without))
        if name not in _VOID:
            self.stack.append(name)
        else:
            self._end_level(level)

    def _close(self, level: int) -> None:
        """The element at ``level`` ends, with all in it."""
        del self.stack[level:]
        self._end_level(level)

    def _end_level(self, level: int) -> None:
        for one in self.texts:
            if one.skipping > level:
                one.skipping = 0
            if one.level >= level:
                one.row[one.place] = " ".join(one.pieces)
        self.texts = [one for one in self.texts if one.level < level]
        self.open_rows = [(at, row) for at, row in self.open_rows if at < level]


def layout_rows(pages: DataFrame, layout: RowLayout, keep: list[str]) -> DataFrame:
    """One row per element of the layout: kept columns, ``row_no`` in the page, one text per cell.

    Narrow: a page's rows stay in its partition. A NULL page has no rows.
    """
    frame = pages.select(*keep, "html")
    names = list(layout.cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = _Page(layout)
        for batch in batches:
            htmls = batch.column(len(keep))
            source, number, cells, read = [], [], [[] for _ in names], 0
            for k in range(batch.num_rows):
                html = htmls[k].as_py() or ""
                read += len(html)
                for n, row in enumerate(page.rows(html) if html else ()):
                    source.append(k)
                    number.append(n)
                    for column, value in zip(cells, row):
                        column.append(value)
                if read < PIECE_CHARS and k + 1 < batch.num_rows:
                    continue
                kept = [c.take(pa.array(source, pa.int64())) for c in batch.columns[: len(keep)]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(number, pa.int32()), *(pa.array(c, pa.string()) for c in cells)],
                    names=[*keep, "row_no", *names])
                source, number, cells, read = [], [], [[] for _ in names], 0

    schema = pages.select(*keep).schema.add("row_no", T.IntegerType())
    for name in names:
        schema = schema.add(name, T.StringType())
    return frame.mapInArrow(run, schema)
