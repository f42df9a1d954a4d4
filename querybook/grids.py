"""Workbooks and exported sheets derived from the customers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.plans import finished_sheets, workbook_sheets
from gleanwork.functions import sheet_slug
from gleanwork.sinks import read_history, write_by_sheet, write_lines_by_sheet, write_long_by_sheet
from gleanwork.sources import (
    csv_grid_rows,
    json_grid_rows,
    read_binary_files,
    scrub_cells,
    sheet_listing,
    sheet_rows,
    split_csv_rows,
    to_wide,
    widest_row,
    workbook_rows,
    workbook_rows_by_sheet,
)
from gleanwork.workspace import fresh_path, materialise
from querybook.tables import RUN_DATE, spread, table

PLACE = ("path", "sheet_idx", "row_idx")
SHEETS = ("Tab One-A", "2020 (in Progress)")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of customers as one workbook: shared strings, inline strings, gaps."""
    import io
    from xml.sax.saxutils import escape
    from zipfile import ZIP_DEFLATED, ZipFile

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    link = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"

    def sheet(rows: list[str]) -> str:
        return f'<worksheet xmlns="{main}"><sheetData>{"".join(rows)}</sheetData></worksheet>'

    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500).to_pylist()
            segments = sorted({row["c_mktsegment"] for row in part})
            first = [
                f'<row r="{i}"><c r="A{i}"><v>{row["c_custkey"]}</v></c>'
                f'<c r="B{i}" t="inlineStr"><is><t>{escape(row["c_name"])}\nline</t></is></c>'
                f'<c r="D{i}" t="s"><v>{segments.index(row["c_mktsegment"])}</v></c></row>'
                for i, row in enumerate(part, 1)
            ]
            second = [f'<row><c t="b"><v>1</v></c><c><v>{row["c_custkey"]}</v></c></row>' for row in part]
            names = "".join(
                f'<sheet name="{name}" sheetId="{i}" r:id="r{i}"/>' for i, name in enumerate(SHEETS, 1)
            )
            links = "".join(
                f'<Relationship Id="r{i}" Type="{link}/{kind}" Target="{target}"/>'
                for i, (kind, target) in enumerate(
                    [
                        ("worksheet", "worksheets/sheet1.xml"),
                        ("worksheet", "/xl/worksheets/sheet2.xml"),
                        ("sharedStrings", "sharedStrings.xml"),
                    ],
                    1,
                )
            )
            strings = "".join(f"<si><t>{escape(segment)}</t></si>" for segment in segments)
            out = io.BytesIO()
            with ZipFile(out, "w", ZIP_DEFLATED) as archive:
                archive.writestr(
                    "xl/workbook.xml",
                    f'<workbook xmlns="{main}" xmlns:r="{link}"><sheets>{names}</sheets></workbook>',
                )
                archive.writestr(
                    "xl/_rels/workbook.xml.rels",
                    f'<Relationships xmlns="{package}">{links}</Relationships>',
                )
                archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{strings}</sst>')
                archive.writestr("xl/worksheets/sheet1.xml", sheet(first))
                archive.writestr("xl/worksheets/sheet2.xml", sheet(second))
            path = f"/books/{part[0]['c_custkey']}.xlsx"
            yield pa.RecordBatch.from_pydict({"path": [path], "content": [out.getvalue()]})


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    # Staged, so that whoever reads them twice does not pack them twice.
    return materialise(spread(customers).mapInArrow(_pack, "path string, content binary"), "packed")


def workbook_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks beyond 25 KB have their sheets dealt out."""
    books = workbooks(spark, sf_dir)
    rows = sheet_rows(workbook_rows_by_sheet(books, split_bytes=25_000, unit_bytes=1000))
    return to_wide(rows, 4, scrub=False).drop("path", "row_idx")


def sheet_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheets of all workbooks that hold rows, by name and place."""
    listed = sheet_listing(workbooks(spark, sf_dir))
    return listed.select("sheet", "sheet_idx").dropDuplicates()


def workbook_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks to a dated table with one folder per sheet, and back."""
    rows = sheet_rows(workbook_rows(workbooks(spark, sf_dir)))
    target = fresh_path(spark, "workbooks")
    shaped = to_wide(workbook_sheets(rows), 4).drop("sheet")
    write_by_sheet(shaped, target, order=PLACE, run_date=RUN_DATE)
    schema = "_c0 string, _c1 string, _c2 string, _c3 string, sheet_slug string"
    return read_history(spark, target, schema).drop("run_date")


def workbook_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks to one folder per sheet in which rows keep their own number of cells, and back."""
    rows = scrub_cells(sheet_rows(workbook_rows(workbooks(spark, sf_dir))))
    target = fresh_path(spark, "workbooks")
    write_long_by_sheet(workbook_sheets(rows), target, order=PLACE, run_date=RUN_DATE)
    stored = spark.read.parquet(target)
    return stored.select(
        "sheet_slug", F.array_join("cells", "|").alias("cells"), F.size("cells").alias("n_cells")
    )


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets of very different widths whose titles share a folder name."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return spread(customers).select(
        F.concat(F.lit("/books/"), (F.col("c_custkey") % 10).cast("string")).alias("path"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("My Sheet")).otherwise(F.lit("my_sheet")).alias("sheet"),
        F.lit(0).alias("sheet_idx"),
        F.col("c_custkey").cast("int").alias("row_idx"),
        F.when(F.col("c_custkey") % 2 == 0, F.array_repeat("c_name", 2))
        .otherwise(F.array_repeat(F.concat(F.lit('a"b\t'), "c_mktsegment"), 2000))
        .alias("cells"),
    )


def sheet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets of very different widths whose titles share a folder name, in one job; the lines found there."""
    target = fresh_path(spark, "lines")
    named = wide_rows(spark, sf_dir).withColumn("sheet_slug", sheet_slug("sheet"))
    write_lines_by_sheet(scrub_cells(named), target, run_date=RUN_DATE)
    return spark.read.text(target).select("sheet_slug", F.col("value").alias("line"))


def whole_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third CSV export is broken in its second row: none of its rows, one reject each."""
    second = F.when(F.col("c_custkey") % 3 == 0, F.lit('"x"y,z\n')).otherwise(F.lit('"x",z\n'))
    files = spread(table(spark, sf_dir, "customer").select("c_custkey")).select(
        F.concat(F.lit("/exports/"), F.col("c_custkey").cast("string"), F.lit(".csv")).alias("path"),
        F.concat(F.lit("one,two\n"), second).cast("binary").alias("content"),
    )
    return csv_grid_rows(files).groupBy("path").agg(
        F.count_if(F.col("error").isNull()).alias("n_rows"),
        F.count_if(F.col("error").isNotNull()).alias("n_rejects"),
    )


@contextmanager
def small_splits(spark: SparkSession, size: str) -> Iterator[None]:
    """Files read within are cut into splits of ``size``, which are dealt to a few tasks for each one of a shuffle."""
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    settings = {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.files.openCostInBytes": size,
        "spark.sql.files.maxPartitionNum": str(tasks),
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def split_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV exports read as lines over many splits, the way that a file beyond a binary value takes: records across
    the borders, quotes in plain cells, carriage returns as ends of lines, one sheet broken in its last row."""
    folder = fresh_path(spark, "exports")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_custkey").cast("string").alias("key"), (F.col("c_custkey") % 10).alias("sheet")
    )
    kinds = (
        F.when(F.col("c_custkey") % 4 == 0, F.concat("key", F.lit(',5" pipe')))
        .when(F.col("c_custkey") % 4 == 1, F.concat("key", F.lit(',"'), "c_name", F.lit(',\n""quoted""\r\n"\r')))
        .when(F.col("c_custkey") % 4 == 2, F.concat("key", F.lit(",x\ry,z")))
        .otherwise(F.concat("key", F.lit(',"'), F.repeat(F.lit("long\n"), 1000), F.lit('"')))
    )
    last = F.when(F.col("c_custkey") % 10 == 9, F.concat(kinds, F.lit('\n"x"y'))).otherwise(kinds)
    # A sheet is one file, so its customers are brought together; their long lines are made after that.
    lines = customers.repartition("sheet").select("sheet", last.alias("line"))
    lines.write.partitionBy("sheet").text(folder)
    with small_splits(spark, "64k"):
        grids = split_csv_rows(spark, folder, "*.txt", larger_than=0)
    cell = F.get("cells", F.lit(1))
    return grids.select(
        F.regexp_extract("path", "sheet=([0-9])", 1).alias("sheet"),
        F.get("cells", F.lit(0)).alias("first"),
        F.substring(cell, 1, 20).alias("second"),
        F.length(cell).alias("n_chars"),
        F.col("error").isNotNull().alias("broken"),
    )


def exported_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers exported as CSV files, read back as grids of the width found in them."""
    folder = fresh_path(spark, "exports")
    cells = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("a"),
        F.concat("c_name", F.lit(',\r\n"quoted" ')).alias("b"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("c"),
    )
    (
        cells.write.option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", 1000)
        .csv(folder)
    )
    rows = sheet_rows(csv_grid_rows(read_binary_files(spark, folder, "*.csv")))
    wide = to_wide(finished_sheets(rows), widest_row(rows))
    return wide.select("_c0", "_c1", "_c2")


def json_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value range per customer, in which rows differ in length."""
    title = F.when(F.col("c_custkey") % 3 == 0, F.lit(" My Sheet ")).when(
        F.col("c_custkey") % 3 == 1, F.lit("It''s 2020 (in Progress)")
    ).otherwise(F.lit("2020 (in progress)"))
    number = F.col("c_custkey").cast("string")
    values = F.array(F.array(number, "c_name", F.lit(None)), F.array("c_mktsegment"))
    body = F.to_json(
        F.struct(F.concat(F.lit("'"), title, F.lit("'!A1:C2")).alias("range"), values.alias("values"))
    )
    files = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("/exports/"), number, F.lit(".json")).alias("path"),
        body.cast("binary").alias("content"),
    )
    return to_wide(finished_sheets(sheet_rows(json_grid_rows(files))), 3).drop("sheet_idx")


BOOK = {
    "workbook_rows": (
        workbook_cells,
        """
        SELECT 'Tab One-A' AS sheet, CAST(0 AS INTEGER) AS sheet_idx,
               CAST(c_custkey AS VARCHAR) AS _c0, c_name || chr(10) || 'line' AS _c1, '' AS _c2,
               c_mktsegment AS _c3
        FROM customer
        UNION ALL
        SELECT '2020 (in Progress)', 1, 'true', CAST(c_custkey AS VARCHAR), '', '' FROM customer
        """,
    ),
    "workbook_sheets": (
        sheet_names,
        """
        SELECT DISTINCT unnest(['Tab One-A', '2020 (in Progress)']) AS sheet,
               CAST(unnest([0, 1]) AS INTEGER) AS sheet_idx
        FROM customer
        """,
    ),
    "workbook_snapshot": (
        workbook_snapshot,
        """
        SELECT 'Tab_One_A' AS sheet_slug, CAST(c_custkey AS VARCHAR) AS _c0,
               c_name || ' line' AS _c1, CAST(NULL AS VARCHAR) AS _c2, c_mktsegment AS _c3
        FROM customer
        UNION ALL
        SELECT '2020_(in_Progress)', 'true', CAST(c_custkey AS VARCHAR), NULL, NULL FROM customer
        """,
    ),
    "sheet_lines": (
        sheet_lines,
        """
        SELECT 'my_sheet' AS sheet_slug, '"/books/' || (c_custkey % 10) || chr(34) || chr(9)
               || CASE c_custkey % 2 WHEN 0 THEN '"My Sheet"' ELSE '"my_sheet"' END || chr(9)
               || chr(34) || c_custkey || chr(34)
               || CASE c_custkey % 2 WHEN 0 THEN repeat(chr(9) || chr(34) || c_name || chr(34), 2)
                  ELSE repeat(chr(9) || '"a""b' || chr(9) || c_mktsegment || chr(34), 2000) END AS line
        FROM customer
        """,
    ),
    "whole_sheets": (
        whole_sheets,
        """
        SELECT '/exports/' || c_custkey || '.csv' AS path,
               CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 2 END::BIGINT AS n_rows,
               CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS n_rejects
        FROM customer
        """,
    ),
    "split_sheet_rows": (
        split_sheets,
        """
        WITH rows AS (
            SELECT CAST(c_custkey % 10 AS VARCHAR) AS sheet, CAST(c_custkey AS VARCHAR) AS first,
                   CASE c_custkey % 4 WHEN 0 THEN '5" pipe' WHEN 2 THEN 'x' WHEN 3 THEN repeat('long' || chr(10), 1000)
                   ELSE c_name || ',' || chr(10) || '"quoted"' || chr(13) || chr(10) END AS cell
            FROM customer WHERE c_custkey % 10 <> 9
            UNION ALL
            SELECT CAST(c_custkey % 10 AS VARCHAR), 'y', 'z' FROM customer WHERE c_custkey % 4 = 2 AND c_custkey % 10 <> 9)
        SELECT sheet, first, substring(cell, 1, 20) AS second, CAST(length(cell) AS INTEGER) AS n_chars, false AS broken
        FROM rows
        UNION ALL
        SELECT DISTINCT '9', NULL, NULL, CAST(NULL AS INTEGER), true FROM customer WHERE c_custkey % 10 = 9
        """,
    ),
    "workbook_long": (
        workbook_long,
        """
        SELECT 'Tab_One_A' AS sheet_slug, c_custkey || '|' || c_name || ' line||' || c_mktsegment
               AS cells, CAST(4 AS INTEGER) AS n_cells
        FROM customer
        UNION ALL
        SELECT '2020_(in_Progress)', 'true|' || c_custkey, 2 FROM customer
        """,
    ),
    "sheet_export_rows": (
        exported_sheets,
        """
        SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name || ', "quoted" ' AS _c1,
               CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS _c2
        FROM customer
        """,
    ),
    "sheet_json_rows": (
        json_sheets,
        """
        WITH titled AS (
            SELECT *, '/exports/' || c_custkey || '.json' AS path, CASE c_custkey % 3
                   WHEN 0 THEN ' My Sheet ' ELSE '2020 (in progress)' END AS sheet
            FROM customer WHERE c_custkey % 3 <> 1)
        SELECT path, sheet, CAST(0 AS INTEGER) AS row_idx, CAST(c_custkey AS VARCHAR) AS _c0,
               c_name AS _c1, '' AS _c2, lower(replace(sheet, ' ', '_')) AS sheet_slug FROM titled
        UNION ALL
        SELECT path, sheet, 1, c_mktsegment, '', '', lower(replace(sheet, ' ', '_')) FROM titled
        """,
    ),
}
