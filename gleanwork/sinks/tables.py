"""File sinks: dated, compressed snapshots, one folder per run date.

A snapshot lives in ``target/run_date=yyyy-MM-dd``, so the run date is a partition column for
whoever reads the whole history, and a second run of the same day replaces only its own folder. With ``atomic`` it
is written as an attempt that only counts when it is complete, see :mod:`gleanwork.sinks.published`.
No writer gathers its rows in one task. Gzip text cannot be split by readers, so
``max_records_per_file`` bounds the files where the tasks themselves are large.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameWriter

from gleanwork.operators.columns import quoted
from gleanwork.sinks.published import attempt, read_published
from gleanwork.workspace import materialise

# The end of the object name of each dataset.
OBJECT_SUFFIXES = {
    "by_offense": "_agency_arrests",
    "by_race": "_agency_arrests_by_offense",
}
NULL_MARK = "\\N"
# Texts that look like the mark, and what stands for them in a lossless file.
MARK_LIKE, ESCAPED_MARK = r"^(\\+N)$", r"^\\(\\+N)$"


def _each_text(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """``df`` with every text column changed, in its place."""
    changed = [
        change(quoted(field.name)).alias(field.name)
        if isinstance(field.dataType, T.StringType)
        else quoted(field.name)
        for field in df.schema.fields
    ]
    return df.select(*changed)


def run_day(run_date: str | datetime.date | None = None) -> str:
    """The run date as text; a job asks once, so its rows, rejects and keys agree on the day."""
    if run_date is None:
        return datetime.date.today().isoformat()
    return datetime.date.fromisoformat(str(run_date)).isoformat()


def snapshot_path(target: str, run_date: str | datetime.date | None = None) -> str:
    return f"{target.rstrip('/')}/run_date={run_day(run_date)}"


@contextmanager
def _day(
    df: DataFrame, target: str, run_date: str | datetime.date | None, mode: str, atomic: bool
) -> Iterator[tuple[str, str]]:
    """The folder of a day to write in, and the mode to write with."""
    if atomic:
        with attempt(df.sparkSession, target, run_day(run_date), mode == "append") as path:
            yield path, "error"
    else:
        yield snapshot_path(target, run_date), mode


def _text_writer(
    df: DataFrame, mode: str, lossless: bool, compression: str, max_records_per_file: int
) -> DataFrameWriter:
    if lossless:
        df = _each_text(df, lambda text: F.regexp_replace(text, MARK_LIKE, r"\\$1"))
    writer = (
        df.write.mode(mode)
        .option("sep", "\t")
        .option("header", True)
        .option("quoteAll", True)
        .option("compression", compression)
        .option("maxRecordsPerFile", max_records_per_file)
    )
    if lossless:
        writer = (
            writer.option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("nullValue", NULL_MARK)
        )
    return writer


def write_snapshot(
    df: DataFrame,
    target: str,
    run_date: str | datetime.date | None = None,
    mode: str = "overwrite",
    lossless: bool = False,
    compression: str = "gzip",
    max_records_per_file: int = 0,
    atomic: bool = False,
) -> str:
    """Tab-separated, fully quoted gzip text with a header. Returns the folder it wrote.

    By default cells lose the blanks at their edges, and NULL and empty text look the same.
    ``lossless`` keeps all three apart: blanks stay, inner quotes are doubled, NULL is ``\\N``
    and a text of backslashes before an ``N`` has one more of them.
    """
    with _day(df, target, run_date, mode, atomic) as (path, mode):
        _text_writer(df, mode, lossless, compression, max_records_per_file).csv(path)
    return path


def read_snapshot(
    spark: SparkSession, path: str | list[str], schema: str | None = None, lossless: bool = False
) -> DataFrame:
    """Read what :func:`write_snapshot` wrote; cells may hold line breaks."""
    reader = spark.read.option("sep", "\t").option("header", True).option("multiLine", True)
    if lossless:
        reader = reader.option("escape", '"').option("nullValue", NULL_MARK)
    if schema is not None:
        reader = reader.schema(schema)
    stored = reader.csv(path)
    if not lossless:
        return stored
    return _each_text(stored, lambda text: F.regexp_replace(text, ESCAPED_MARK, "$1"))


def read_history(
    spark: SparkSession, target: str, schema: str, lossless: bool = False, atomic: bool = False
) -> DataFrame:
    """All snapshots of a target, with their ``run_date``; a filter on it prunes folders.

    ``atomic`` is what they were written with.
    """
    if atomic:
        columns = f"{schema}, run_date date, attempt string"
        return read_published(spark, target, lambda path: read_snapshot(spark, path, columns, lossless))
    return read_snapshot(spark, target, f"{schema}, run_date date", lossless)


def write_orc(df: DataFrame, target: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("compression", "snappy").orc(target)
    return target


def read_orc(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.orc(target)


def write_by_key(
    df: DataFrame,
    target: str,
    dataset: str = "by_offense",
    key: str = "ORI",
    run_date: str | datetime.date | None = None,
    mode: str = "overwrite",
    lossless: bool = False,
    max_records_per_file: int = 0,
    atomic: bool = False,
) -> str:
    """One folder per key, named after the key and the dataset. The key also stays a column.

    The rebalance brings the rows of a key together, so a key gets one file and not one per task.
    Adaptive execution splits a hot key over several tasks and joins small keys into one.
    """
    named = df.withColumn("object", F.concat(F.col(key), F.lit(OBJECT_SUFFIXES[dataset])))
    gathered = named.hint("rebalance", "object")
    with _day(df, target, run_date, mode, atomic) as (path, mode):
        writer = _text_writer(gathered, mode, lossless, "gzip", max_records_per_file)
        writer.partitionBy("object").csv(path)
    return path


ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_SIZE = re.compile(r"(\d+) *([kmgtp]?)i?b?", re.IGNORECASE)


def _bytes_of(size: str) -> int:
    """A size as Spark's settings write it, such as ``64MB``."""
    number, unit = _SIZE.fullmatch(size.strip()).groups()
    return int(number) << 10 * " kmgtp".index(unit.lower() or " ")


def _width(field: T.StructField) -> Column:
    """About how many bytes a value takes."""
    value = quoted(field.name)
    if isinstance(field.dataType, T.ArrayType):
        value = F.array_join(value, "")
    return F.coalesce(F.octet_length(value.cast("string")), F.lit(0)) + 8


def _in_order(df: DataFrame, slug: str, order: Sequence[str]) -> DataFrame:
    """Sheets side by side, in ranges of their rows: the files of a sheet, by name, hold its rows in order.

    There are as many ranges as fill the advisory size of a partition, so a large sheet fills several and is no
    single task. To find them the rows are read twice more, so they are staged: whatever makes them runs once.
    """
    if not order:
        return df.hint("rebalance", slug)
    df = materialise(df, "ordered")
    size = df.agg(F.sum(sum((_width(field) for field in df.schema.fields), F.lit(0)))).first()[0] or 0
    ranges = size // _bytes_of(df.sparkSession.conf.get(ADVISORY_SIZE)) + 1
    return df.repartitionByRange(ranges, slug, *order).sortWithinPartitions(slug, *order)


def write_by_sheet(
    df: DataFrame,
    target: str,
    slug: str = "sheet_slug",
    order: Sequence[str] = (),
    run_date: str | datetime.date | None = None,
    mode: str = "overwrite",
    lossless: bool = False,
    max_records_per_file: int = 0,
    atomic: bool = False,
) -> str:
    """One folder of text per sheet within the snapshot.

    ``order`` names the columns that sort the rows of a sheet. They are not written themselves.
    """
    ordered = _in_order(df, slug, order).drop(*order)
    with _day(df, target, run_date, mode, atomic) as (path, mode):
        writer = _text_writer(ordered, mode, lossless, "gzip", max_records_per_file)
        writer.partitionBy(slug).csv(path)
    return path


def write_long_by_sheet(
    df: DataFrame,
    target: str,
    slug: str = "sheet_slug",
    order: Sequence[str] = (),
    run_date: str | datetime.date | None = None,
    mode: str = "overwrite",
    atomic: bool = False,
) -> str:
    """One folder of Parquet per sheet, with all columns: rows keep their own number of cells."""
    ordered = _in_order(df, slug, order)
    with _day(df, target, run_date, mode, atomic) as (path, mode):
        ordered.write.mode(mode).partitionBy(slug).parquet(path)
    return path


def write_lines_by_sheet(
    df: DataFrame,
    target: str,
    slug: str = "sheet_slug",
    order: Sequence[str] = ("path", "sheet_idx", "row_idx"),
    run_date: str | datetime.date | None = None,
    mode: str = "overwrite",
    max_records_per_file: int = 0,
    atomic: bool = False,
) -> str:
    """One folder of tab-separated, fully quoted gzip text per sheet, each row at its own width.

    A line holds the path and the title of its sheet and the number of its row, then the cells. So
    sheets that share a folder name can be told apart, and rows put in order, and the plan does not
    grow with the width of a sheet. Inner quotes are doubled; there is no header.
    """
    place = F.array("path", "sheet", F.col("row_idx").cast("string"))

    doubled = F.transform(F.concat(place, "cells"), lambda cell: F.replace(cell, F.lit('"'), F.lit('""')))
    line = F.concat(F.lit('"'), F.array_join(doubled, '"\t"', ""), F.lit('"'))
    # One text a row is far less to sort and to shuffle than its cells.
    joined = df.select(*dict.fromkeys((slug, *order)), line.alias("value"))
    lines = _in_order(joined, slug, order).select(slug, "value")
    with _day(df, target, run_date, mode, atomic) as (path, mode):
        writer = lines.write.mode(mode).option("compression", "gzip")
        writer.option("maxRecordsPerFile", max_records_per_file).partitionBy(slug).text(path)
    return path


def land_objects(
    objects: DataFrame,
    target: str,
    run_date: str | datetime.date | None = None,
    atomic: bool = False,
) -> str:
    """Store ``(object_key, route, response_no, chunk, content)`` as it came, one row per chunk of an object."""
    stored = objects.select("object_key", "route", "response_no", "chunk", "content")
    with _day(objects, target, run_date, "overwrite", atomic) as (path, mode):
        # Look at the buffered size after every row: a hundred large objects would not fit.
        stored.write.mode(mode).option("parquet.page.size.row.check.min", 1).parquet(path)
    return path


def rejects(df: DataFrame, source: str) -> DataFrame:
    """``(source, key, reason)`` from any frame of ``(key, reason)``."""
    return df.select(F.lit(source).alias("source"), F.col("key").cast("string"), "reason")


def rejects_path(target: str, rejects_target: str | None, keep_rejects: bool) -> str | None:
    """Where a job lists its rejects: next to its output, in a folder that readers pass over."""
    if not keep_rejects:
        return None
    return rejects_target or f"{target.rstrip('/')}/_rejects"


def write_rejects(
    df: DataFrame,
    target: str,
    source: str,
    run_date: str | datetime.date | None = None,
    mode: str = "overwrite",
) -> str:
    """A list of its own for each source and day, so jobs that share a folder keep theirs apart."""
    path = snapshot_path(f"{target.rstrip('/')}/source={source}", run_date)
    rejects(df, source).write.mode(mode).parquet(path)
    return path


def list_unread(
    failed: DataFrame | None,
    oversized: DataFrame,
    target: str,
    rejects_target: str | None,
    source: str,
    run_date: str,
) -> None:
    """List what a job could not read; files too large to read also where no other list is kept."""
    if failed is not None:
        oversized = failed.unionByName(oversized)
    elif oversized.isEmpty():
        return
    write_rejects(oversized, rejects_path(target, rejects_target, True), source, run_date)


def preview(df: DataFrame, order: str | list[str], rows: int = 10) -> DataFrame:
    """The first rows in a given order: each task keeps only its own first rows."""
    return df.orderBy(order).limit(rows)
