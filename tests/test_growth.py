"""Work that grows with a table is dealt to many tasks and done once; the tables here are one row group each."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gleanwork import sinks as K
from gleanwork import sources as S
from gleanwork.sources import split_csv
from querybook import documents, grids, responses
from tests.conftest import plan_of

DAY = "2024-02-29"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    customers = spark.range(0, 4000, 1, 1).select(
        F.col("id").alias("c_custkey"),
        F.concat(F.lit("Customer "), F.col("id").cast("string")).alias("c_name"),
        F.when(F.col("id") % 2 == 0, F.lit("MACHINERY")).otherwise(F.lit("BUILDING")).alias("c_mktsegment"),
    )
    customers.write.parquet(f"{folder}/customer.parquet")
    suppliers = spark.range(0, 60, 1, 1).select(F.col("id").alias("s_suppkey"))
    suppliers.write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


def tasks_with_rows(frame) -> int:
    return frame.select(F.spark_partition_id().alias("task")).distinct().count()


@pytest.mark.parametrize("write", [K.write_lines_by_sheet, K.write_by_sheet, K.write_long_by_sheet])
def test_ordered_sheets_are_made_once(spark, tmp_path, write):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def slow(number):
        made.add(1)
        return str(number)

    rows = spark.range(0, 500, 1, 2).select(
        F.lit("a").alias("path"), F.lit("s").alias("sheet"), F.lit(0).alias("sheet_idx"), F.col("id").alias("row_idx"),
        F.lit("slug").alias("sheet_slug"), slow.asNondeterministic()("id").alias("text"),
    )
    if write is not K.write_by_sheet:
        rows = rows.select("*", F.array("text").alias("cells")).drop("text")
    write(rows, str(tmp_path), order=("path", "sheet_idx", "row_idx"), run_date=DAY)
    assert made.value == 500


def test_lines_keep_odd_cells(spark, tmp_path):
    cells = [None, "", 'a"b', "tab\there", "x\ny", "x\r\ny\rz", '"\n"']
    rows = spark.createDataFrame(
        [("p", "s", 0, 0, "slug", cells), ("p", "s", 0, 1, "slug", [])],
        "path string, sheet string, sheet_idx int, row_idx int, sheet_slug string, cells array<string>",
    )
    K.write_lines_by_sheet(S.scrub_cells(rows), str(tmp_path), run_date=DAY)
    assert [r["value"] for r in spark.read.text(str(tmp_path)).orderBy("value").collect()] == [
        '"p"\t"s"\t"0"\t""\t""\t"a""b"\t"tab\there"\t"x y"\t"x y z"\t""" """',
        '"p"\t"s"\t"1"',
    ]


def test_wide_rows_are_made_in_many_tasks(spark, tables):
    assert tasks_with_rows(grids.wide_rows(spark, tables)) == 4


def test_images_are_written_by_many_tasks(spark, tables):
    files = [path.rpartition("/")[2] for path in spark.read.text(documents.image_folder(spark, tables)).inputFiles()]
    assert len(files) == 60
    assert len({name.split("-")[1] for name in files}) == 4


def test_workbooks_are_packed_once_in_many_tasks(spark, tables):
    books = grids.workbooks(spark, tables)
    assert "MapInArrow" not in plan_of(books)
    assert len({path.rpartition("/")[2].split("-")[1] for path in books.inputFiles()}) == 4
    assert books.count() == 8  # of 500 customers each


def test_customer_pages_are_read_by_many_tasks(spark, tables):
    assert tasks_with_rows(responses._customer_pages(spark, tables)) == 4


def test_small_splits_are_dealt_to_few_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n" * 1_000_000)
    with grids.small_splits(spark, "64k"):
        lines = spark.read.text(str(tmp_path))
        splits = lines.select("_metadata.file_block_start").distinct().count()
        assert splits > 60 and lines.rdd.getNumPartitions() <= 16


def test_splits_are_read_as_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(split_csv, "CHUNK_BYTES", 100)
    text = 'a,b\n"c\nd",e\r\n' * 50 + '"' + "long\n" * 200 + '",f\nx\ry,z\n'
    (tmp_path / "a.csv").write_text(text, newline="")
    lines = split_csv._lines(spark, str(tmp_path), "*.csv", 0)
    chunks = lines.mapInArrow(split_csv._read_chunks, split_csv.CHUNK_TYPE).orderBy("part").collect()
    assert len(chunks) >= 2
    assert "".join(row["body"].decode() + "\n" for row in chunks) == text
    whole = S.csv_grid_rows(S.read_binary_files(spark, str(tmp_path), "*.csv")).orderBy("row_idx").collect()
    assert S.split_csv_rows(spark, str(tmp_path), larger_than=0).orderBy("row_idx").collect() == whole
