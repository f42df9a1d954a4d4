"""Untitled grids: workbook sheets and exported online sheets, in one long form.

Every reader gives ``(path, sheet, sheet_idx, row_idx, cells, error)``, one row per sheet row and
one extra row, with ``error`` set, per file or sheet that cannot be read; such a sheet gives no
other row. Rows keep their own length, so sheets of any width fit in one table and one job reads all
files and sheets. A reader holds one file and a bounded number of its rows at a time.
"""

from __future__ import annotations

import csv
import io
import math
import pickle
import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from io import TextIOWrapper
from posixpath import normpath
from typing import IO
from urllib.parse import unquote
from xml.etree import ElementTree
from zipfile import ZIP_DEFLATED, ZIP_STORED, BadZipFile, ZipFile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.text import scrub_newlines

GRID_TYPE = (
    "path string, sheet string, sheet_idx int, row_idx int, cells array<string>, error string"
)
LISTING_TYPE = "path string, sheet string, sheet_idx int, error string"
JSON_GRID_TYPE = "range string, values array<array<string>>"

UNIT_TYPE = "path string, unit int, body binary"
_UNITS = pa.schema([("path", pa.string()), ("unit", pa.int32()), ("body", pa.binary())])

# Workbooks beyond the first size are dealt out in units of the second one.
SPLIT_BYTES = 1 << 22
UNIT_BYTES = 1 << 24
# An output batch is sent on when it holds this many rows or this many characters.
BATCH_ROWS = 4096
BATCH_CHARS = 1 << 23


class _Batches:
    """Gathers output rows and hands them over as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema = schema
        self._reset()

    def _reset(self) -> None:
        self.rows: list[tuple] = []
        self.chars = 0

    def add(self, row: tuple, chars: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if len(self.rows) >= BATCH_ROWS or self.chars >= BATCH_CHARS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [
                pa.array(values, type=field.type)
                for values, field in zip(zip(*self.rows), self.schema)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
            self._reset()


def _grid_schema() -> pa.Schema:
    return pa.schema(
        [
            ("path", pa.string()),
            ("sheet", pa.string()),
            ("sheet_idx", pa.int32()),
            ("row_idx", pa.int32()),
            ("cells", pa.list_(pa.string())),
            ("error", pa.string()),
        ]
    )


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Buffer]]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            yield path.as_py(), content.as_buffer() if content.is_valid else pa.py_buffer(b"")


def _problem(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def _whole(read: Callable[[], Iterator[tuple[int, list[str]]]]) -> Iterable[tuple[int, list[str]]]:
    """The rows of a sheet, if every one of them can be read; raises before any row is sent on.

    A sheet that fits in one batch is held; a longer one is read to its end and then read again.
    """
    held = []
    chars = 0
    rows = read()
    for row in rows:
        held.append(row)
        chars += sum(map(len, row[1]))
        if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
            for _ in rows:
                pass
            return read()
    return held


# -- workbooks ------------------------------------------------------------------------------------

# An escaped character (halves of surrogate pairs are none), the format's widest row.
_ESCAPED_CHAR = re.compile("_x((?![Dd][89A-Fa-f])[0-9A-Fa-f]{4})_")
MAX_COLUMNS = 16_384


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _attribute(element: ElementTree.Element, name: str) -> str | None:
    for key, value in element.attrib.items():
        if _local(key) == name:
            return value
    return None


def _text_of(element: ElementTree.Element) -> str:
    """The text of a string item; pronunciation hints are no part of it."""
    parts = []
    for child in element:
        kind = _local(child.tag)
        if kind == "t":
            parts.append(child.text or "")
        elif kind == "r":
            parts.append(_text_of(child))
    return _ESCAPED_CHAR.sub(lambda match: chr(int(match[1], 16)), "".join(parts))


def _column_number(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


class _Workbook:
    """The parts of one workbook file that its grids need."""

    def __init__(self, content: pa.Buffer) -> None:
        self.archive = ZipFile(pa.BufferReader(content))
        main = [
            target for kind, target in self._links("").values() if kind.endswith("/officeDocument")
        ]
        self.main = main[0] if main else "xl/workbook.xml"
        self.links = self._links(self.main)

    def _links(self, part: str) -> dict[str, tuple[str, str]]:
        folder, _, name = part.rpartition("/")
        prefix = f"{folder}/" if folder else ""
        try:
            tree = ElementTree.fromstring(self.archive.read(f"{prefix}_rels/{name}.rels"))
        except KeyError:
            return {}
        found = {}
        for link in tree:
            target = link.get("Target", "")
            path = normpath(target[1:] if target.startswith("/") else prefix + target)
            found[link.get("Id", "")] = (link.get("Type", ""), path)
        return found

    def sheets(self) -> list[tuple[str, str | None]]:
        """Name and part of each sheet; the part is None for a sheet that is no grid."""
        listed = []
        for element in ElementTree.fromstring(self.archive.read(self.main)).iter():
            if _local(element.tag) == "sheet":
                kind, part = self.links.get(_attribute(element, "id") or "", ("", None))
                grid = part if kind.endswith("/worksheet") else None
                listed.append((element.get("name", ""), grid))
        return listed

    def string_parts(self) -> list[str]:
        return [part for kind, part in self.links.values() if kind.endswith("/sharedStrings")]


def _shared_strings(open_part: Callable[[str], IO[bytes]], parts: list[str]) -> list[str]:
    strings: list[str] = []
    for part in parts:
        with open_part(part) as stream:
            for _, element in ElementTree.iterparse(stream):
                if _local(element.tag) == "si":
                    strings.append(_text_of(element))
                    element.clear()
    return strings


def _sheet_rows(
    open_part: Callable[[str], IO[bytes]], part: str, shared: list[str]
) -> Iterator[tuple[int, list[str]]]:
    """The rows that the sheet holds, each with its index; gaps are empty text."""
    with open_part(part) as stream:
        holder = None
        index = -1
        for event, element in ElementTree.iterparse(stream, events=("start", "end")):
            kind = _local(element.tag)
            if event == "start":
                if kind == "sheetData":
                    holder = element
            elif kind == "row":
                index = int(element.get("r", index + 2)) - 1
                yield index, _row_cells(element, shared)
                if holder is not None:
                    holder.clear()


def _row_cells(row: ElementTree.Element, shared: list[str]) -> list[str]:
    cells: list[str] = []
    for cell in row:
        if _local(cell.tag) != "c":
            continue
        reference = cell.get("r")
        position = _column_number(reference) if reference else len(cells)
        if not 0 <= position < MAX_COLUMNS:
            raise ValueError(f"no column for cell {reference}")
        cells.extend([""] * (position + 1 - len(cells)))
        cells[position] = _cell_text(cell, shared)
    return cells


def _cell_text(cell: ElementTree.Element, shared: list[str]) -> str:
    kind = cell.get("t", "n")
    for child in cell:
        name = _local(child.tag)
        if name == "is":
            return _text_of(child)
        if name == "v":
            value = child.text or ""
            if kind == "s":
                return shared[int(value)]
            if kind == "b":
                return "true" if value.strip() == "1" else "false"
            return value
    return ""


class _Part(io.RawIOBase):
    """A packed part of an archive, unpacked while it is read; its checksum must be right at the end."""

    def __init__(self, packed: bytes, deflated: bool, checksum: int) -> None:
        self.left, self.deflated, self.checksum = packed, deflated, checksum
        self.inflater = zlib.decompressobj(-zlib.MAX_WBITS)
        self.seen = 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        if self.deflated:
            data = self.inflater.decompress(self.left, len(buffer))
            self.left = self.inflater.unconsumed_tail
        else:
            data, self.left = self.left[: len(buffer)], self.left[len(buffer) :]
        self.seen = zlib.crc32(data, self.seen)
        if not data and self.seen != self.checksum:
            raise BadZipFile("a part of the workbook is damaged")
        buffer[: len(data)] = data
        return len(data)


def _packed(archive: ZipFile, content: pa.Buffer, part: str) -> tuple[bytes, bool, int]:
    """A part as it lies in the archive, unless it is packed in an unusual way."""
    info = archive.getinfo(part)
    if info.flag_bits & 1 or info.compress_type not in (ZIP_STORED, ZIP_DEFLATED):
        data = archive.read(part)
        return data, False, zlib.crc32(data)
    # The length of a local header, and where it has the lengths of its name and extra field.
    head = content[info.header_offset : info.header_offset + 30].to_pybytes()
    start = info.header_offset + 30 + sum(struct.unpack("<HH", head[26:30]))
    packed = content[start : start + info.compress_size].to_pybytes()
    return packed, info.compress_type == ZIP_DEFLATED, info.CRC


class _Unit:
    """Sheets of one workbook that a task reads together, with the strings they share."""

    def __init__(self, path: str, strings: list[str]) -> None:
        self.path, self.strings = path, strings
        self.sheets: list[tuple[str, int, str]] = []
        self.size = 0

    def rows(self, out: _Batches, open_part: Callable[[str], IO[bytes]]) -> Iterator[pa.RecordBatch]:
        try:
            shared = _shared_strings(open_part, self.strings)
        except Exception as error:  # a broken file must not stop the others
            yield from out.add((self.path, None, None, None, None, _problem(error)))
            return
        for sheet, number, part in self.sheets:
            try:
                for index, cells in _whole(lambda: _sheet_rows(open_part, part, shared)):
                    row = (self.path, sheet, number, index, cells, None)
                    yield from out.add(row, sum(map(len, cells)))
            except Exception as error:
                yield from out.add((self.path, sheet, number, None, None, _problem(error)))


def _units(path: str, workbook: _Workbook, most: float) -> list[_Unit]:
    """The sheets in units of about ``most`` bytes of text; a larger sheet is a unit of its own."""
    strings = workbook.string_parts()
    units = [_Unit(path, strings)]
    for number, (sheet, part) in enumerate(workbook.sheets()):
        if part is not None:
            try:
                size = workbook.archive.getinfo(part).file_size
            except KeyError:  # whoever reads the sheet says that it is missing
                size = 0
            if units[-1].sheets and units[-1].size + size > most:
                units.append(_Unit(path, strings))
            units[-1].sheets.append((sheet, number, part))
            units[-1].size += size
    return units


def _read_workbooks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Batches(_grid_schema())
    for path, content in _files(batches):
        try:
            workbook = _Workbook(content)
            (unit,) = _units(path, workbook, math.inf)
        except Exception as error:
            yield from out.add((path, None, None, None, None, _problem(error)))
            continue
        yield from unit.rows(out, workbook.archive.open)
    yield from out.flush()


def _split_workbooks(unit_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each unit with the parts it needs, still packed."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, content in _files(batches):
            try:
                workbook = _Workbook(content)
                units = _units(path, workbook, unit_bytes)
            except Exception as error:
                body = pickle.dumps((path, _problem(error)))
                yield pa.RecordBatch.from_pydict({"path": [path], "unit": [0], "body": [body]}, _UNITS)
                continue
            for number, unit in enumerate(units):
                parts: dict[str, tuple | Exception] = {}
                for part in [*unit.strings, *(part for _, _, part in unit.sheets)]:
                    try:
                        parts[part] = _packed(workbook.archive, content, part)
                    except Exception as error:
                        parts[part] = error
                body = pickle.dumps((path, (unit.strings, unit.sheets, parts)))
                yield pa.RecordBatch.from_pydict({"path": [path], "unit": [number], "body": [body]}, _UNITS)

    return split


def _read_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Batches(_grid_schema())
    for batch in batches:
        for body in batch.column("body"):
            path, found = pickle.loads(body.as_buffer())
            if isinstance(found, str):
                yield from out.add((path, None, None, None, None, found))
                continue
            unit = _Unit(path, found[0])
            unit.sheets, parts = found[1], found[2]

            def open_part(part: str) -> IO[bytes]:
                if isinstance(parts[part], Exception):
                    raise parts[part]
                return io.BufferedReader(_Part(*parts[part]))

            yield from unit.rows(out, open_part)
    yield from out.flush()


def _list_sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Batches(
        pa.schema(
            [
                ("path", pa.string()),
                ("sheet", pa.string()),
                ("sheet_idx", pa.int32()),
                ("error", pa.string()),
            ]
        )
    )
    for path, content in _files(batches):
        try:
            names = [name for name, _ in _Workbook(content).sheets()]
        except Exception as error:
            yield from out.add((path, None, None, _problem(error)))
            continue
        for number, name in enumerate(names):
            yield from out.add((path, name, number, None))
    yield from out.flush()


def sheet_listing(files: DataFrame) -> DataFrame:
    """``(path, sheet, sheet_idx, error)``: the sheets of each workbook, in their order."""
    return files.select("path", "content").mapInArrow(_list_sheets, LISTING_TYPE)


def workbook_rows(files: DataFrame) -> DataFrame:
    """All sheets of all XLSX workbooks in ``files(path, content)``.

    Cells are the stored text: numbers as written in the file, dates as their serial numbers,
    logical values as ``true`` or ``false``, empty cells as empty text.
    """
    return files.select("path", "content").mapInArrow(_read_workbooks, GRID_TYPE)


def workbook_rows_by_sheet(
    files: DataFrame, split_bytes: int = SPLIT_BYTES, unit_bytes: int = UNIT_BYTES
) -> DataFrame:
    """The rows of :func:`workbook_rows`, with the sheets of large workbooks as work of their own.

    A workbook of up to ``split_bytes`` is read where it is. The sheets of a larger one are dealt out, still packed, to
    as many tasks as a shuffle has, in units of ``unit_bytes`` of text or one sheet, so that a book of many sheets or
    with a large one does not hold up its task.
    """
    size = F.col("length") if "length" in files.columns else F.length("content")
    large = files.where(size > split_bytes).select("path", "content").mapInArrow(_split_workbooks(unit_bytes), UNIT_TYPE)
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = large.repartition(tasks, "path", "unit").select("body").mapInArrow(_read_units, GRID_TYPE)
    small = files.where(F.coalesce(size, F.lit(0)) <= split_bytes)
    return workbook_rows(small).unionByName(units)


# -- exported online sheets -----------------------------------------------------------------------


def _title_of(path: str) -> str:
    name = unquote(path.rstrip("/").rpartition("/")[2])
    stem, dot, ending = name.rpartition(".")
    return stem if dot and ending.lower() in ("csv", "tsv") else name


def _csv_rows(content: pa.Buffer) -> Iterator[tuple[int, list[str]]]:
    lines = TextIOWrapper(pa.BufferReader(content), encoding="utf-8-sig", newline="")
    for index, cells in enumerate(csv.reader(lines, strict=True)):
        yield index, cells or [""]


def _read_csv_grids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    csv.field_size_limit(2**31 - 1)
    out = _Batches(_grid_schema())
    for path, content in _files(batches):
        title = _title_of(path)
        try:
            for index, cells in _whole(lambda: _csv_rows(content)):
                row = (path, title, 0, index, cells, None)
                yield from out.add(row, sum(map(len, cells)))
        except Exception as error:
            yield from out.add((path, title, 0, None, None, _problem(error)))
    yield from out.flush()


def csv_grid_rows(files: DataFrame) -> DataFrame:
    """Sheets exported as CSV, one per file of ``files(path, content)``; the file name is the title.

    Cells may hold line breaks and rows may differ in length.
    """
    return files.select("path", "content").mapInArrow(_read_csv_grids, GRID_TYPE)


def json_grid_rows(files: DataFrame) -> DataFrame:
    """Sheets exported as JSON value ranges, ``{"range": "'Title'!A1:C9", "values": [[...]]}``.

    Needs no Python: Spark parses the text and numbers the rows.
    """
    unparsed = "_unparsed"
    grid = F.from_json(
        F.make_valid_utf8(F.col("content").cast("string")),
        f"{JSON_GRID_TYPE}, {unparsed} string",
        {"columnNameOfCorruptRecord": unparsed},
    )
    # The one-element explode keeps filters from being moved below the parse and repeating it.
    parsed = files.select("path", F.explode(F.array(grid)).alias("grid"))
    title = F.regexp_replace(F.col("grid.range"), "![^!]*$", "")
    inner = F.regexp_extract(title, r"(?s)^'?(.*?)'?$", 1)
    broken = F.col("grid").isNull() | F.col(f"grid.{unparsed}").isNotNull()
    exploded = parsed.select(
        "path",
        F.replace(inner, F.lit("''"), F.lit("'")).alias("sheet"),
        F.when(broken, F.lit("malformed grid")).alias("error"),
        F.when(~broken, F.col("grid.values")).alias("values"),
    ).select("path", "sheet", "error", F.posexplode_outer("values").alias("row_idx", "row"))
    row = F.coalesce("row", F.array().cast("array<string>"))
    cells = F.transform(row, lambda cell: F.coalesce(cell, F.lit("")))
    return exploded.where("row_idx IS NOT NULL OR error IS NOT NULL").select(
        "path",
        "sheet",
        F.lit(0).alias("sheet_idx"),
        "row_idx",
        F.when(F.col("row_idx").isNotNull(), cells).alias("cells"),
        "error",
    )


# -- what all grids share -------------------------------------------------------------------------


def sheet_rows(grids: DataFrame) -> DataFrame:
    """The rows that could be read."""
    return grids.where("error IS NULL").drop("error")


def grid_rejects(grids: DataFrame) -> DataFrame:
    """``(key, reason)`` of the files and sheets that could not be read."""
    return grids.where("error IS NOT NULL").select(
        F.concat_ws("#", "path", "sheet").alias("key"), F.col("error").alias("reason")
    )


def widest_row(rows: DataFrame) -> int:
    """The largest number of cells in a row (1 if there is none), found in one aggregation."""
    return rows.agg(F.max(F.size("cells"))).first()[0] or 1


def scrub_cells(rows: DataFrame) -> DataFrame:
    """Every cell on one line."""

    def scrubbed(cell: Column) -> Column:
        # A plain search is far cheaper than the pattern, which most cells don't need.
        broken = F.contains(cell, F.lit("\n")) | F.contains(cell, F.lit("\r"))
        return F.when(broken, scrub_newlines(cell)).otherwise(cell)

    return rows.withColumn("cells", F.transform("cells", scrubbed))


def to_wide(rows: DataFrame, width: int, scrub: bool = True) -> DataFrame:
    """The cells as text columns ``_c0, _c1, …``; short rows are filled with empty text."""

    def cell(position: int):
        text = F.coalesce(F.get("cells", F.lit(position)), F.lit(""))
        return (scrub_newlines(text) if scrub else text).alias(f"_c{position}")

    others = [name for name in rows.columns if name != "cells"]
    return rows.select(*others, *[cell(position) for position in range(width)])
