"""CSV exports that no binary value can hold: read as lines, which Spark splits over tasks.

A line begins either between records or inside a quoted cell; nothing else is possible after a line feed. The lines
of a split are put together to chunks of bounded size, so that no step but the reader works line by line. A chunk
is summed up by a map with two entries: where it leads and how many records end, if it begins in the one
or the other state. The maps of a file, one small row per chunk, are composed along the file, which tells
each chunk its true state and its first row. Then each chunk is parsed on its own, wherever it lies; only what
crosses its borders is shuffled, put together and parsed.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator
from io import StringIO

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.sources import documents
from gleanwork.sources.grids import GRID_TYPE, _Batches, _grid_schema, _problem, _title_of
from gleanwork.workspace import materialise

ENDLESS = "a row is longer than a value can be"
BAD_QUOTE = "Error: ',' expected after '\"'"

# Up to the end of a quoted cell or of the line; up to the end of a plain cell.
_QUOTED = re.compile(b'[^"]*+(?:""[^"]*+)*+')
_PLAIN = re.compile(b"[^,\r\n]*+")
OUTSIDE, INSIDE, BROKEN = 0, 1, 2

# A chunk is full when it holds so many bytes; a longer line is one of its own.
CHUNK_BYTES = 1 << 18

MAP_TYPE = (
    "path string, block long, part int, "
    "out_state int, out_rows long, out_open long, in_state int, in_rows long, in_open long"
)
CHUNK_TYPE = f"{MAP_TYPE}, body binary"
START_TYPE = "path string, block long, part int, state int, first_row long, open_row long"
PIECE_TYPE = f"{GRID_TYPE}, open_row long, block long, part int, piece binary"


def scan_line(line: bytes, state: int) -> tuple[int, int]:
    """The state after the line and its line feed, and the number of records that end in it."""
    return scan_lines(line, state)[:2]


def scan_lines(text: bytes, state: int) -> tuple[int, int, tuple[int, int], tuple[int, int]]:
    """The state after the lines, the number of records that end in them, and two places in them.

    The places are the first and the last line that begins outside of a quoted cell, each with the number of records
    that end before it; (-1, 0) if there is none. ``text`` is without the last line feed.
    """
    none = (-1, 0)
    if state == BROKEN:
        return BROKEN, 0, none, none
    if b'"' not in text and b"\r" not in text:
        if state == INSIDE:
            return INSIDE, 0, none, none
        before = text.count(b"\n")
        return OUTSIDE, before + 1, (0, 0), (text.rfind(b"\n") + 1, before)
    at, records, size = 0, 0, len(text)
    inside = state == INSIDE
    first = last = none if inside else (0, 0)
    if not inside and text.startswith(b'"'):
        inside, at = True, 1
    while True:
        if inside:
            at = _QUOTED.match(text, at).end()
            if at == size:
                return INSIDE, records, first, last
            at += 1
            if at < size and text[at] not in b",\r\n":
                return BROKEN, records, first, last
        else:
            at = _PLAIN.match(text, at).end()
        if at == size:
            return OUTSIDE, records + 1, first, last
        end = text[at]
        at += 1
        if end != 0x2C:
            records += 1
            if end == 0x0D:
                if at == size:
                    return OUTSIDE, records, first, last
                end = text[at]
                at += end == 0x0A
            if end == 0x0A:
                last = (at, records)
                first = last if first == none else first
        inside = text[at : at + 1] == b'"'
        at += inside


def _lines(spark: SparkSession, path: str | list[str], pattern: str, larger_than: int) -> DataFrame:
    """``(path, block, value)``: each line of the large files, with a line feed; those of a split in their order."""
    return (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(path)
        .where(F.col("_metadata.file_size") > larger_than)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.concat("value", F.lit("\n")).cast("binary").alias("value"),
        )
    )


def _plain_path(path: str) -> Column:
    """A path as the binary reader writes it."""
    decoded = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:///", "file:/")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """Path, block and text of lines that lie in one split, about a chunk of them, without a look at each line."""
    for batch in batches:
        paths, blocks, values = (batch.column(name) for name in ("path", "block", "value"))
        ends = {end for column in (paths, blocks) for end in pc.run_end_encode(column).run_ends.to_pylist()}
        size = pc.sum(pc.binary_length(values)).as_py() or 1
        ends.update(range(0, len(values), max(1, len(values) * CHUNK_BYTES // size)))
        begin = 0
        for end in sorted(ends - {0}):
            lines = pa.ListArray.from_arrays(pa.array([0, end - begin], pa.int32()), values.slice(begin, end - begin))
            yield paths[begin].as_py(), blocks[begin].as_py(), pc.binary_join(lines, b"")[0].as_py()
            begin = end


def _chunk(path: str, block: int, part: int, body: bytes) -> pa.RecordBatch:
    """A chunk and its map: for both states the end state, the records that end, and the row that stays open."""
    values: list = [path, block, part]
    for start in (OUTSIDE, INSIDE):
        state, records, _, (place, before) = scan_lines(body, start)
        values += [state, records, before if place >= 0 else -1]
    return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip([*values, body], _CHUNKS.types)], schema=_CHUNKS)


def _read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, part, held, size = None, 0, [], 0
    for path, block, text in _runs(batches):
        if held and (place != (path, block) or size >= CHUNK_BYTES):
            yield _chunk(*place, part, b"".join(held)[:-1])
            part, held, size = part + 1, [], 0
        if place != (path, block):
            place, part = (path, block), 0
        held.append(text)
        size += len(text)
    if held:
        yield _chunk(*place, part, b"".join(held)[:-1])


_CHUNKS = pa.schema(
    [("path", pa.string()), ("block", pa.int64()), ("part", pa.int32())]
    + [
        (f"{side}_{what}", kind)
        for side in ("out", "in")
        for what, kind in (("state", pa.int32()), ("rows", pa.int64()), ("open", pa.int64()))
    ]
    + [("body", pa.binary())]
)


def _walk_file(maps: pa.Table) -> pa.Table:
    """Compose the maps of one file: the state in which each chunk begins, its first row, and the row that is open."""
    state, row, open_row = OUTSIDE, 0, -1
    out = {"path": [], "block": [], "part": [], "state": [], "first_row": [], "open_row": []}
    for chunk in sorted(maps.to_pylist(), key=lambda chunk: (chunk["block"], chunk["part"])):
        for name, value in zip(out, (chunk["path"], chunk["block"], chunk["part"], state, row, open_row)):
            out[name].append(value)
        if state != BROKEN:
            side = "in" if state == INSIDE else "out"
            if chunk[f"{side}_open"] >= 0:
                open_row = row + chunk[f"{side}_open"]
            state, row = chunk[f"{side}_state"], row + chunk[f"{side}_rows"]
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})


def _rows_of(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in columns))


def _records(lines: bytes) -> Iterator[list[str]]:
    """The records of whole lines, without the last line feed."""
    for cells in csv.reader(StringIO(lines.decode("utf-8") + "\n", newline=""), strict=True):
        yield cells or [""]


def _groups(text: bytes) -> Iterator[tuple[int, bytes]]:
    """The lines in the smallest groups that end outside of a quoted cell, each with the records that end before it."""
    held, state, before, row = [], OUTSIDE, 0, 0
    for line in text.split(b"\n"):
        held.append(line)
        state, ended = scan_line(line, state)
        row += ended
        if state == OUTSIDE:
            yield before, b"\n".join(held)
            held, before = [], row


def _read_bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that lie within a chunk, and the pieces of those that don't."""
    csv.field_size_limit(2**31 - 1)
    schema = _grid_schema()
    for name, kind in (("open_row", pa.int64()), ("block", pa.int64()), ("part", pa.int32()), ("piece", pa.binary())):
        schema = schema.append(pa.field(name, kind))
    out = _Batches(schema)
    columns = ("path", "block", "part", "state", "first_row", "open_row", "body")
    for path, block, part, state, row, open_row, body in _rows_of(batches, columns):
        title = _title_of(path)

        def piece(begun: int, text: bytes) -> tuple:
            return path, title, 0, None, None, None, begun, block, part, text

        def failure(problem: str) -> tuple:
            return path, title, 0, None, None, problem, None, None, None, None

        after, _, (begin, before), (tail, open_before) = scan_lines(body, state)
        if after == BROKEN:
            yield from out.add(failure(BAD_QUOTE))
            continue
        if state == INSIDE:  # the first record began in an earlier chunk
            text = body if begin < 0 else body[: begin - 1]
            yield from out.add(piece(open_row, text), len(text))
        if begin < 0:
            continue
        if after == INSIDE:  # the last record ends in a later one
            text = body[tail:]
            yield from out.add(piece(row + open_before, text), len(text))
            if tail == begin:
                continue
        whole = body[begin : tail - 1] if after == INSIDE else body[begin:]
        try:
            whole.decode("utf-8")
            groups: Iterable[tuple[int, bytes]] = ((0, whole),)
        except UnicodeDecodeError:  # the rows before it are good, and the place is told within its row
            groups = _groups(whole)
        for ahead, text in groups:
            try:
                for index, cells in enumerate(_records(text), row + before + ahead):
                    place = (path, title, 0, index, cells, None, None, None, None, None)
                    yield from out.add(place, sum(map(len, cells)))
            except Exception as error:  # a broken file must not stop the others
                yield from out.add(failure(_problem(error)))
    yield from out.flush()


def _read_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    csv.field_size_limit(2**31 - 1)
    out = _Batches(_grid_schema())
    for path, sheet, first, text in _rows_of(batches, ("path", "sheet", "open_row", "text")):
        try:
            if text is None:
                raise ValueError(ENDLESS)
            for index, cells in enumerate(_records(text), first):
                yield from out.add((path, sheet, 0, index, cells, None), sum(map(len, cells)))
        except Exception as error:
            yield from out.add((path, sheet, 0, None, None, _problem(error)))
    yield from out.flush()


def split_csv_rows(
    spark: SparkSession,
    path: str | list[str],
    pattern: str = "*.csv",
    larger_than: int | None = None,
) -> DataFrame:
    """The grids of the exports too large for ``csv_grid_rows``; same form, same rows.

    ``larger_than`` bytes is by default what a binary value holds. Quotes in plain cells, carriage returns as ends of
    lines and records over any number of splits are read as ``csv_grid_rows`` reads them, and what is broken there
    is rejected whole here. So is a sheet with a row that is itself too long for a value. A file must have
    a line feed in every 2 GiB.
    """
    limit = documents.MAX_FILE_BYTES if larger_than is None else larger_than
    lines = _lines(spark, path, pattern, limit)
    chunks = lines.mapInArrow(_read_chunks, CHUNK_TYPE).withColumn("path", _plain_path("path"))
    # What is staged here comes in splits of the same size as the files; few tasks read them, however small they are.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = materialise(chunks, "csv-chunks").coalesce(tasks)
    starts = chunks.drop("body").groupBy("path").applyInArrow(_walk_file, START_TYPE)
    begun = chunks.select("path", "block", "part", "body").join(starts, ["path", "block", "part"])
    read = materialise(begun.mapInArrow(_read_bodies, PIECE_TYPE), "csv-records").coalesce(tasks)

    pieces = read.where("piece IS NOT NULL")
    parts = F.array_sort(F.collect_list(F.struct("block", "part", "piece")))
    sizes = pieces.groupBy("path", "sheet", "open_row").agg(F.sum(F.length("piece") + 1).alias("size"))
    fits = F.col("size") <= documents.MAX_FILE_BYTES
    joined = (
        pieces.join(sizes.where(fits).drop("size"), ["path", "sheet", "open_row"])
        .groupBy("path", "sheet", "open_row")
        .agg(F.concat_ws("\n", F.transform(parts, lambda part: part["piece"].cast("string"))).cast("binary").alias("text"))
    )
    endless = sizes.where(~fits).select("path", "sheet", "open_row", F.lit(None).cast("binary").alias("text"))
    crossing = materialise(joined.unionByName(endless).mapInArrow(_read_pieces, GRID_TYPE), "csv-crossing")
    rows = read.where("piece IS NULL").drop("open_row", "block", "part", "piece").unionByName(crossing)
    failed = rows.where("error IS NOT NULL").groupBy("path", "sheet", "sheet_idx").agg(
        F.lit(None).cast("int").alias("row_idx"),
        F.lit(None).cast("array<string>").alias("cells"),
        F.min("error").alias("error"),
    )
    whole = rows.where("error IS NULL").join(failed.select("path"), "path", "left_anti")
    return whole.unionByName(failed)
