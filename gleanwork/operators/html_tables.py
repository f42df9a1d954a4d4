"""Tables in HTML pages: to rows of cell texts, and to CSV text.

Reading HTML needs a parser, so this is one of the few places with Python inside a task. Only
pages that hold a table are shipped to it, in Arrow batches that Spark bounds by size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions.markup import END, START, VERBATIM, markup_events
from gleanwork.functions.text import TRIMMED_CHARS, _col
from gleanwork.operators.columns import quoted

ROWS_TYPE = T.ArrayType(T.ArrayType(T.StringType()))

# A batch of rows is sent on when it holds this many rows or this many characters.
BATCH_ROWS = 4096
BATCH_CHARS = 1 << 23

# The HTML elements that set their text apart from what stands before them.
BLOCK_TAGS = frozenset(
    """
    address article aside audio blockquote body canvas caption center col colgroup dd del details
    dir div dl dt fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head
    header hgroup hr html ins li link main math menu meta nav noframes noscript ol p plaintext pre
    script section style svg table tbody td template tfoot th thead title tr ul video
    """.split()
)
# Elements that close an open row, rows and cells, elements that have no content,
# runs of blanks that are not just one space, invisible characters.
ROW_CLOSERS = frozenset("caption col colgroup tbody tfoot thead".split())
CELL_TAGS = frozenset("td th tr".split())
EMPTY_TAGS = frozenset("col frame hr link meta".split())
BLANK_RUN = re.compile("[\t\n\f\r\xa0][ \t\n\f\r\xa0]*| [ \t\n\f\r\xa0]+")
INVISIBLE = re.compile("[\u200b\xad]")


class _Text:
    """Text as it is laid out: blanks folded, blocks set apart from the text around them.

    A block element is set apart from the text before it, and from a text that directly follows.
    """

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.ends_blank = False
        self.after_block = False

    def _put(self, piece: str) -> None:
        if piece:
            self.pieces.append(piece)
            self.length += len(piece)
            self.ends_blank = piece[-1] == " "

    def set_apart(self) -> None:
        if self.length and not self.ends_blank:
            self._put(" ")

    def add(self, data: str, verbatim: bool) -> None:
        if self.after_block:
            self.set_apart()
            self.after_block = False
        if not verbatim:
            data = BLANK_RUN.sub(" ", INVISIBLE.sub("", data))
            if self.ends_blank:
                data = data.lstrip(" ")
        self._put(data)

    def whole(self) -> str:
        if len(self.pieces) > 1:
            self.pieces = ["".join(self.pieces)]
        return self.pieces[0] if self.pieces else ""


class _Cell:
    """One ``td``: a slice of a text that it may share with the cells around it."""

    def __init__(self, text: _Text) -> None:
        self.text = text
        self.start = text.length
        self.end: int | None = None

    def finished(self) -> str:
        return self.text.whole()[self.start : self.end].strip(TRIMMED_CHARS)


class _Row:
    """One ``tr``: its own cells, and the range of all cells opened while it was open."""

    def __init__(self, first: int) -> None:
        self.own: list[_Cell] = []
        self.first = first
        self.last: int | None = None


class _Table:
    """One open table: its open row, and which kind of cell is open in it."""

    def __init__(self) -> None:
        self.row: _Row | None = None
        self.open_tag: str | None = None


class _RowReader:
    """Collects the rows of every table in time and space linear in the page, however deep they nest.

    ``nested="descendant"``: a nested table's cells also count for the outer row, and their text for
    the outer cell, so all cells share one text. ``"own"``: a cell counts for its own row alone and
    its text holds nothing of nested cells.
    """

    def __init__(self, nested: str) -> None:
        self.shared = _Text() if nested == "descendant" else None
        self.rows: list[_Row] = []
        self.cells: list[_Cell] = []
        self.tables: list[_Table] = []
        self.open_cells: list[_Cell] = []
        self.verbatim = 0

    def _close_cell(self) -> None:
        table = self.tables[-1]
        if table.open_tag == "td":
            cell = self.open_cells.pop()
            cell.end = cell.text.length
        table.open_tag = None

    def _close_row(self) -> None:
        self._close_cell()
        table = self.tables[-1]
        if table.row is not None:
            table.row.last = len(self.cells)
            table.row = None

    def _close_table(self) -> None:
        self._close_row()
        self.tables.pop()

    def _open_row(self) -> None:
        self._close_row()
        self.tables[-1].row = _Row(len(self.cells))
        self.rows.append(self.tables[-1].row)

    def _open_cell(self, tag: str) -> None:
        table = self.tables[-1]
        if table.row is None:
            self._open_row()
        self._close_cell()
        table.open_tag = tag
        if tag == "td":
            cell = _Cell(self.shared or _Text())
            self.open_cells.append(cell)
            self.cells.append(cell)
            table.row.own.append(cell)

    def _text(self) -> _Text | None:
        return self.open_cells[-1].text if self.open_cells else None

    def start(self, tag: str) -> None:
        if text := self._text():
            text.after_block = False
            if tag in BLOCK_TAGS or tag == "br":
                text.set_apart()
        if tag == "table":
            if self.tables and self.tables[-1].open_tag is None:
                self._close_table()
            self.tables.append(_Table())
        elif tag == "pre":
            self.verbatim += 1
        elif self.tables:
            if tag == "tr":
                self._open_row()
            elif tag in ("td", "th"):
                self._open_cell(tag)
            elif tag in ROW_CLOSERS:
                self._close_row()
        # A shared text may still wait for what followed an earlier cell.
        if tag == "td" and (text := self._text()):
            text.after_block = False
        if tag in EMPTY_TAGS:
            self._end_block()

    def end(self, tag: str) -> None:
        if text := self._text():
            text.after_block = False
        if tag == "pre":
            self.verbatim = max(0, self.verbatim - 1)
        if self.tables:
            if tag == "table":
                self._close_table()
            elif tag == "tr" or tag in ROW_CLOSERS:
                self._close_row()
            elif tag in ("td", "th") and self.tables[-1].open_tag == tag:
                self._close_cell()
        if tag in BLOCK_TAGS and tag not in CELL_TAGS and tag not in ROW_CLOSERS:
            self._end_block()
        elif tag == "br" and (text := self._text()):
            text.set_apart()

    def _end_block(self) -> None:
        if text := self._text():
            text.after_block = True

    def add(self, data: str, verbatim: bool) -> None:
        if text := self._text():
            text.add(data, verbatim)

    def finished(self) -> Iterator[list[str]]:
        for row in self.rows:
            cells = row.own if self.shared is None else self.cells[row.first : row.last]
            yield [cell.finished() for cell in cells]


def page_rows(html: str, nested: str = "descendant") -> Iterator[list[str]]:
    """The rows of one page, one at a time: with deep nesting all of them are far larger than the page."""
    reader = _RowReader(nested)
    for kind, value in markup_events(html):
        if kind == START:
            reader.start(value)
        elif kind == END:
            reader.end(value)
        else:
            reader.add(value, kind == VERBATIM or reader.verbatim > 0)
    return reader.finished()


def read_rows(html: str, nested: str = "descendant") -> list[list[str]]:
    return list(page_rows(html, nested))


def page_csv(html: str, escape_quotes: bool = True, nested: str = "descendant") -> Iterator[str]:
    """The CSV text of one page, one line at a time.

    Rows without cells leave no line, but if the very first row has none, the text starts with an
    empty line.
    """
    for number, cells in enumerate(page_rows(html, nested)):
        if cells:
            if escape_quotes:
                cells = [cell.replace('"', '""') for cell in cells]
            yield '"' + '","'.join(cells) + '"\n'
        elif number == 0:
            yield "\n"


def _with_table(page: Column) -> Column:
    return F.rlike(page, F.lit("(?i)<table"))


def _checked(nested: str) -> str:
    if nested not in ("descendant", "own"):
        raise ValueError(f"nested is 'descendant' or 'own', not {nested!r}")
    return nested


def table_rows(html: Column | str, nested: str = "descendant") -> Column:
    """The rows of all tables in a page, each an array of its ``td`` texts, in page order.

    One value holds a whole page; :func:`html_rows` sends its rows on one batch at a time.
    """
    _checked(nested)

    @F.pandas_udf(ROWS_TYPE)
    def rows(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: read_rows(page, nested) if isinstance(page, str) else [])

    page = _col(html)
    return rows(F.when(_with_table(page), page))


def csv_line(cells: Column | str, escape_quotes: bool = True) -> Column:
    """The cells in quotes, joined by commas. Inner quotes are doubled unless told otherwise."""

    def enclosed(cell: Column) -> Column:
        inner = F.replace(cell, F.lit('"'), F.lit('""')) if escape_quotes else cell
        return F.concat(F.lit('"'), inner, F.lit('"'))

    return F.array_join(F.transform(_col(cells), enclosed), ",")


def csv_body(rows: Column | str, escape_quotes: bool = True) -> Column:
    """The rows of one page as CSV text.

    Rows without cells leave no line, but if the very first row has none, the text starts with an
    empty line.
    """
    table = _col(rows)
    filled = F.filter(table, lambda cells: F.size(cells) > 0)
    lines = F.transform(filled, lambda cells: F.concat(csv_line(cells, escape_quotes), F.lit("\n")))
    first_is_empty = F.coalesce(F.size(F.get(table, F.lit(0))) == 0, F.lit(False))
    return F.concat(F.when(first_is_empty, F.lit("\n")).otherwise(F.lit("")), F.array_join(lines, ""))


def html_rows(pages: DataFrame, html: str = "html", nested: str = "descendant") -> DataFrame:
    """One row per table row: the other columns, ``row_idx`` and ``cells``.

    With ``nested="descendant"`` the cells of a nested table also count for the rows around it, so
    deep nesting gives far more text than the page has; ``"own"`` counts each cell once. Either way
    a task holds one page, and one bounded batch of its rows.
    """
    _checked(nested)
    kept = [name for name in pages.columns if name != html]
    shown = pages.where(_with_table(quoted(html))).select(*[quoted(name) for name in kept], quoted(html))
    schema = T.StructType(
        [
            *shown.schema.fields[:-1],
            T.StructField("row_idx", T.IntegerType()),
            T.StructField("cells", T.ArrayType(T.StringType())),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.name for field in schema.fields]
        for batch in batches:
            *others, texts = batch.columns

            def sent(rows: list[tuple[int, int, list[str]]]) -> pa.RecordBatch:
                page, number, cells = zip(*rows)
                taken = [column.take(pa.array(page)) for column in others]
                found = [pa.array(number, pa.int32()), pa.array(cells, pa.list_(pa.string()))]
                return pa.RecordBatch.from_arrays(taken + found, names=names)

            held: list[tuple[int, int, list[str]]] = []
            chars = 0
            for page, text in enumerate(texts):
                for number, cells in enumerate(page_rows(text.as_py(), nested)):
                    held.append((page, number, cells))
                    chars += sum(map(len, cells))
                    if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
                        yield sent(held)
                        held, chars = [], 0
            if held:
                yield sent(held)

    return shown.mapInArrow(read, schema)


def html_csv(
    pages: DataFrame, html: str = "html", escape_quotes: bool = True, nested: str = "descendant"
) -> DataFrame:
    """The other columns, and ``csv``: all table rows of the page as CSV text.

    The text of a page must fit in one value; landed pages of any size are cut into chunks, see
    :func:`response_chunks`.
    """
    _checked(nested)
    kept = [name for name in pages.columns if name != html]
    # Only pages that hold a table cross over to Python.
    text = F.when(_with_table(quoted(html)), quoted(html))
    shown = pages.select(*[quoted(name) for name in kept], text.alias("csv"))
    names = shown.columns

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, texts = batch.columns
            found = ["".join(page_csv(t, escape_quotes, nested)) if t else "" for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([*others, pa.array(found, pa.string())], names=names)

    return shown.mapInArrow(read, shown.schema)
