"""Landed web responses: route by content type, name the object, turn HTML tables into CSV.

Input is a table ``(url, content_type, content_disposition, body BINARY)``. All of it is narrow.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions.names import (
    csv_header_file_name,
    file_name,
    header_file_names,
    html_object_name,
    object_key,
)
from gleanwork.functions.text import _col
from gleanwork.operators.columns import quoted
from gleanwork.operators.html_tables import _checked, page_csv

# Stored objects are cut into chunks of this many bytes.
CHUNK_BYTES = 1 << 23

NO_ROUTE = "no route for this content type"
NO_NAME = "no file name in the header"


def routes(content_type: Column | str) -> Column:
    """The routes of a content type, as an array: at most one of csv and html, then the others."""
    kind = _col(content_type)

    def holds(part: str, route: str) -> Column:
        return F.when(F.contains(kind, F.lit(part)), F.lit(route))

    # The part of a content type that marks each route.
    found = F.array(
        F.coalesce(holds("text/csv", "csv"), holds("text/html", "html")),
        holds("officedocument", "office"),
        holds("application/binary", "binary"),
    )
    return F.array_except(found, F.array(F.lit(None).cast("string")))


def _names(route: Column, url: Column, disposition: Column) -> Column:
    from_header = F.when(disposition.isNotNull(), csv_header_file_name(disposition))
    return (
        F.when(route == "csv", F.array(F.coalesce(from_header, file_name(url))))
        .when(route == "html", F.array(html_object_name(url)))
        .otherwise(header_file_names(disposition))
    )


def route_responses(
    responses: DataFrame, prefix: str, run_date: str | datetime.date | None = None
) -> DataFrame:
    """Add ``route``, ``filename``, ``object_key`` and ``reason`` to the columns of the input.

    One row per object; a response without route or name stays, with the reason it has no object.
    """
    routed = responses.select("*", F.explode_outer(routes("content_type")).alias("route"))
    named = routed.select(
        "*",
        F.explode_outer(
            _names(F.col("route"), F.col("url"), F.col("content_disposition"))
        ).alias("filename"),
    )
    missing = F.col("filename").isNull() | (F.col("filename") == "")
    reason = F.when(F.col("route").isNull(), F.lit(NO_ROUTE)).when(missing, F.lit(NO_NAME))
    return named.select(
        "*",
        F.when(~missing, object_key(prefix, "filename", run_date)).alias("object_key"),
        reason.alias("reason"),
    )


def routed_responses(routed: DataFrame) -> DataFrame:
    return routed.where("reason IS NULL").drop("reason")


def response_rejects(routed: DataFrame) -> DataFrame:
    return routed.where("reason IS NOT NULL").select(F.col("url").alias("key"), "reason")


def _cut(pieces: Iterable[bytes], size: int) -> Iterator[bytes]:
    """The bytes in chunks of ``size``; one empty chunk if there are none."""
    held, sent = bytearray(), False
    for piece in pieces:
        held += piece
        while len(held) >= size:
            yield bytes(held[:size])
            del held[:size]
            sent = True
    if held or not sent:
        yield bytes(held)


def response_chunks(
    routed: DataFrame,
    escape_quotes: bool = True,
    nested: str = "descendant",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Replace ``body`` by ``(response_no, chunk, content)``: CSV text for HTML pages, the same bytes
    for the others, in numbered chunks of ``chunk_bytes`` bytes at most.

    The CSV text of a page with nested tables can be far larger than the page, and larger than any
    value. So it is written line by line, and a task holds one page, one of its rows and two chunks.
    ``response_no`` tells objects of the same name apart; :func:`join_chunks` puts them together.
    """
    _checked(nested)
    kept = [name for name in routed.columns if name != "body"]
    is_page = F.coalesce(F.col("route") == "html", F.lit(False))
    text = F.make_valid_utf8(F.col("body").cast("string"))
    shown = routed.select(
        *[quoted(name) for name in kept],
        F.monotonically_increasing_id().alias("response_no"),
        is_page.alias("is_page"),
        F.when(is_page & F.rlike(text, F.lit("(?i)<table")), text).alias("page"),
        F.when(~is_page, F.col("body")).alias("content"),
    )
    names = [*kept, "response_no", "chunk", "content"]
    schema = T.StructType(
        [shown.schema[i] for i in range(len(kept) + 1)]
        + [T.StructField("chunk", T.IntegerType()), T.StructField("content", T.BinaryType())]
    )

    def chunks(is_page: bool, page: pa.Scalar, content: pa.Scalar) -> Iterator[bytes | None]:
        if is_page:
            lines = page_csv(page.as_py(), escape_quotes, nested) if page.is_valid else ()
            yield from _cut((line.encode("utf-8") for line in lines), chunk_bytes)
        elif not content.is_valid:
            yield None
        else:
            body = content.as_buffer()
            yield from (body[at : at + chunk_bytes].to_pybytes() for at in range(0, max(1, body.size), chunk_bytes))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, pages, texts, bodies = batch.columns
            held: list[tuple[int, int, bytes | None]] = []
            size = 0

            def sent() -> pa.RecordBatch:
                rows, numbers, contents = zip(*held)
                taken = [column.take(pa.array(rows)) for column in others]
                found = [pa.array(numbers, pa.int32()), pa.array(contents, pa.binary())]
                return pa.RecordBatch.from_arrays(taken + found, names=names)

            for row, parts in enumerate(zip(pages.to_pylist(), texts, bodies)):
                for number, content in enumerate(chunks(*parts)):
                    held.append((row, number, content))
                    size += len(content or b"")
                    if size >= chunk_bytes:
                        yield sent()
                        held.clear()
                        size = 0
            if held:
                yield sent()

    return shown.mapInArrow(read, schema)


def join_chunks(chunks: DataFrame) -> DataFrame:
    """One row per object again, for objects that fit in one value: ``chunk`` goes, ``content`` is whole."""
    others = [quoted(name) for name in chunks.columns if name not in ("chunk", "content")]
    parts = F.array_sort(F.collect_list(F.struct("chunk", "content")))
    empty = F.lit("").cast("binary")
    whole = F.aggregate(parts, empty, lambda text, part: F.concat(text, part["content"]))
    return chunks.groupBy(*others).agg(whole.alias("content"))
