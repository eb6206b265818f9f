"""Rows of HTML tables and elements of stored pages.

Elements that do not nest are found by built-in expressions. Tables nest, span and leave out end tags,
so their rows come from one pass over each page's tags, in Arrow batches.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Executors get the reader itself, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows handed to Spark at once, whatever the size of a page.
ROWS = 4096

# Character references found in table cells.
REFERENCES = {
    "&nbsp;": " ",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&amp;": "&",
}


def visible_text(html: Column) -> Column:
    """Text without tags, references resolved, white space collapsed."""
    bare = F.regexp_replace(html, "<[^>]*>", "")
    plain = reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), REFERENCES.items(), bare)
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def elements(html: Column, tag: str) -> Column:
    """Inner HTML of every closed element of a tag that does not nest."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))


class _Table:
    """Grid of one open table: its rows so far, the row and cell being read, and cells that reach down."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.rows = 0
        self.header: list[str | None] = []
        self.row: list[tuple[str, int, float]] | None = None
        self.cell: list[str] | None = None
        self.spans = (1, 1.0)
        self.down: dict[int, tuple[float, str]] = {}

    def start_cell(self, attrs: list[tuple[str, str | None]]) -> None:
        self.end_cell()
        self.row = [] if self.row is None else self.row
        self.cell = []
        named = dict(reversed(attrs))
        across, down = _span(named.get("colspan"), 1000), _span(named.get("rowspan"), 65534)
        self.spans = (max(across, 1), math.inf if down == 0 else down)

    def end_cell(self) -> None:
        if self.cell is not None:
            self.row.append((" ".join("".join(self.cell).split()), *self.spans))
            self.cell = None

    def end_row(self) -> tuple[int, int, list, list] | None:
        self.end_cell()
        if self.row is None:
            return None
        places: dict[int, str] = {at: text for at, (_, text) in self.down.items()}
        down = {at: (left - 1, text) for at, (left, text) in self.down.items() if left > 1}
        at = 0
        for text, across, rows in self.row:
            while at in places:
                at += 1
            for place in range(at, at + across):
                if place not in places:
                    places[place] = text
                    if rows > 1:
                        down[place] = (rows - 1, text)
            at += across
        cells = [places.get(i) for i in range(max(places, default=-1) + 1)]
        if not self.rows:
            self.header = cells
        self.rows, self.row, self.down = self.rows + 1, None, down
        return self.number, self.rows - 1, self.header, cells


def _span(value: str | None, most: int) -> int:
    """A span attribute by the HTML standard: digits, at most ``most``, otherwise 1."""
    digits = (value or "").strip()
    return min(int(digits[:9]), most) if digits.isascii() and digits.isdigit() else 1


class _Reader(HTMLParser):
    """Collects finished rows of all tables of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Table] = []
        self.tables = 0
        self.hidden = 0
        self.done: list[tuple[int, int, list, list]] = []

    def _end_row(self) -> None:
        row = self.open[-1].end_row()
        if row is not None:
            self.done.append(row)

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append(_Table(self.tables))
            self.tables += 1
        elif tag in ("script", "style"):
            self.hidden += 1
        elif self.open:
            if tag in ("td", "th"):
                self.open[-1].start_cell(attrs)
            elif tag in ("tr", "thead", "tbody", "tfoot", "caption"):
                self._end_row()
                if tag == "tr":
                    self.open[-1].row = []

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(self.hidden - 1, 0)
        elif self.open:
            if tag in ("td", "th"):
                self.open[-1].end_cell()
            elif tag in ("tr", "thead", "tbody", "tfoot", "table"):
                self._end_row()
                if tag == "table":
                    self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1].cell is not None and not self.hidden:
            self.open[-1].cell.append(data)

    def close(self):
        super().close()
        while self.open:
            self._end_row()
            self.open.pop()


def page_tables(pages: DataFrame, html: str, keep: list[str] = ()) -> DataFrame:
    """One row per table row: ``keep``, table (by opening tags, from 0), row (from 0), header, cells.

    header is the table's first row. A table inside a cell is a table of its own, and its text does not
    belong to that cell. A cell stands in every place that its rowspan and colspan cover within the rows
    of its table; a rowspan of 0 reaches the last one, and where two overlap the earlier cell stays. End
    tags of cells, rows and tables may be missing, comments and scripts are skipped, character references
    resolved, white space collapsed. Pages that are null or hold no table give no rows.
    """
    kept = [f"k{i}" for i in range(len(keep))]
    rows = pages.select(*[F.col(c).alias(k) for c, k in zip(keep, kept)], F.col(html).cast("string").alias("html"))
    types = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "html"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(batch, source, found):
            taken = [batch.column(k).take(pa.array(source, pa.int64())) for k in kept]
            number, row, header, cells = zip(*found)
            texts = pa.list_(pa.string())
            made = [pa.array(number, pa.int32()), pa.array(row, pa.int32()), pa.array(header, texts), pa.array(cells, texts)]
            return pa.RecordBatch.from_arrays([*taken, *made], names=[*kept, "table", "row", "header", "cells"])

        for batch in batches:
            source, found = [], []
            for i, page in enumerate(batch.column("html")):
                text = page.as_py()
                if not text or "<table" not in text.lower():
                    continue
                reader = _Reader()
                reader.feed(text)
                reader.close()
                for at in range(0, len(reader.done), ROWS):
                    part = reader.done[at : at + ROWS]
                    found += part
                    source += [i] * len(part)
                    if len(found) >= ROWS:
                        yield out(batch, source, found)
                        source, found = [], []
            if found:
                yield out(batch, source, found)

    schema = ", ".join([*types, "table int, row int, header array<string>, cells array<string>"])
    return rows.mapInArrow(read, schema).withColumnsRenamed(dict(zip(kept, keep)))


def first_table(
    pages: DataFrame, html: str, columns: dict[str, str], keep: list[str] = ()
) -> DataFrame:
    """Rows of a page's first table: header cells choose and ``columns`` renames the columns.

    Pages without a table give no rows. Tables are read as ``page_tables`` says.
    """
    kept = [f"k{i}" for i in range(len(keep))]
    rows = page_tables(pages.select(*[F.col(c).alias(k) for c, k in zip(keep, kept)], F.col(html).alias("html")), "html", kept)
    return rows.where("table = 0 AND row > 0").select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)],
        (F.col("row") - 1).alias("row"),
        *[
            F.get("cells", (F.array_position("header", head) - 1).cast("int")).alias(name)
            for head, name in columns.items()
        ],
    )
