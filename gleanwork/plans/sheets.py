"""Workbooks and exported online sheets to dated text tables, one folder per sheet."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanwork.functions.names import sheet_slug, workbook_slug
from gleanwork.operators.columns import exclude_titles
from gleanwork.sinks.tables import (
    list_unread,
    run_day,
    write_by_sheet,
    write_lines_by_sheet,
    write_long_by_sheet,
)
from gleanwork.sources.documents import read_binary_files, too_large_files
from gleanwork.sources.grids import (
    csv_grid_rows,
    grid_rejects,
    json_grid_rows,
    scrub_cells,
    sheet_rows,
    to_wide,
    widest_row,
    workbook_rows_by_sheet,
)
from gleanwork.sources.split_csv import split_csv_rows
from gleanwork.workspace import materialise


PLACE = ("path", "sheet_idx", "row_idx")


def finished_sheets(rows: DataFrame) -> DataFrame:
    """The online sheets that nobody is editing, with their ``sheet_slug``."""
    return exclude_titles(rows).withColumn("sheet_slug", sheet_slug("sheet"))


def workbook_sheets(rows: DataFrame) -> DataFrame:
    """Workbook sheets with their ``sheet_slug``."""
    return rows.withColumn("sheet_slug", workbook_slug("sheet"))


def _run(
    spark: SparkSession,
    files: tuple[str | list[str], str],
    read_grids: Callable[[DataFrame], DataFrame],
    name_sheets: Callable[[DataFrame], DataFrame],
    source: str,
    target: str,
    run_date: str | datetime.date | None,
    rejects_target: str | None,
    keep_rejects: bool,
    layout: str,
    width: int | None,
    max_records_per_file: int,
    atomic: bool,
    splittable: bool = False,
) -> str:
    if layout not in ("lines", "wide", "long"):
        raise ValueError(f"layout is 'lines', 'wide' or 'long', not {layout!r}")
    run_date = run_day(run_date)
    grids = read_grids(read_binary_files(spark, *files))
    oversized = too_large_files(spark, *files)
    if splittable:
        if not oversized.isEmpty():
            grids = grids.unionByName(split_csv_rows(spark, *files))
        oversized = oversized.limit(0)  # they have been read
    # Width, rejects, the ranges of the rows and the rows all read the grids: stage them, so each file is parsed once.
    grids = materialise(grids, source)
    failed = grid_rejects(grids) if keep_rejects else None
    list_unread(failed, oversized, target, rejects_target, source, run_date)
    rows = name_sheets(sheet_rows(grids))
    if layout == "long":
        return write_long_by_sheet(scrub_cells(rows), target, order=PLACE, run_date=run_date, atomic=atomic)
    if layout == "lines":
        return write_lines_by_sheet(
            scrub_cells(rows),
            target,
            order=PLACE,
            run_date=run_date,
            max_records_per_file=max_records_per_file,
            atomic=atomic,
        )
    table = to_wide(rows, widest_row(rows) if width is None else width)
    return write_by_sheet(
        table.drop("sheet"),
        target,
        order=PLACE,
        run_date=run_date,
        max_records_per_file=max_records_per_file,
        atomic=atomic,
    )


def run_workbooks(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    run_date: str | datetime.date | None = None,
    rejects_target: str | None = None,
    keep_rejects: bool = True,
    layout: str = "lines",
    width: int | None = None,
    max_records_per_file: int = 0,
    atomic: bool = False,
) -> str:
    """All sheets of all workbooks below ``source``.

    ``layout="lines"`` writes tab-separated text in which each row has its own width and starts with
    its path, its sheet and its number. ``"long"`` writes the same as Parquet, with the cells of a
    row in one array. ``"wide"`` writes text columns ``_c0, _c1, …``, as many as ``width`` says or,
    without it, as the widest row needs, so its plan grows with them; it has no path and no number.

    What cannot be read is listed in ``rejects_target``, by default a folder ``_rejects`` in the
    target. With ``keep_rejects=False`` only the files too large to open are.
    """
    return _run(
        spark,
        (source, "*.xlsx"),
        workbook_rows_by_sheet,
        workbook_sheets,
        "workbooks",
        target,
        run_date,
        rejects_target,
        keep_rejects,
        layout,
        width,
        max_records_per_file,
        atomic,
    )


def run_sheets(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    run_date: str | datetime.date | None = None,
    export: str = "csv",
    rejects_target: str | None = None,
    keep_rejects: bool = True,
    layout: str = "lines",
    width: int | None = None,
    max_records_per_file: int = 0,
    atomic: bool = False,
) -> str:
    """All online sheets exported below ``source``, as CSV files or JSON value ranges.

    The other parameters are those of :func:`run_workbooks`.
    """
    return _run(
        spark,
        (source, f"*.{export}"),
        {"csv": csv_grid_rows, "json": json_grid_rows}[export],
        finished_sheets,
        "sheets",
        target,
        run_date,
        rejects_target,
        keep_rejects,
        layout,
        width,
        max_records_per_file,
        atomic,
        splittable=export == "csv",
    )
