from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gleanwork import operators as O
from gleanwork.sources import read_delimited, read_keys


def test_normalise_names_and_raise_on_clashes(spark):
    frame = spark.createDataFrame([(1, 2)], "`A b.c` int, D int")
    assert O.normalise_columns(frame).columns == ["a_b.c", "d"]
    clash = spark.createDataFrame([(1, 2)], "`A b` int, `a_B` int")
    with pytest.raises(ValueError, match="a_b"):
        O.normalise_columns(clash)


def test_scrub_table(spark):
    frame = spark.createDataFrame([(1, "x\r\ny"), (None, None)], "`N o.` int, Text string")
    assert [tuple(r) for r in O.scrub_table(frame).collect()] == [("1", "x y"), (None, None)]


def test_align_columns(spark):
    frame = spark.createDataFrame([("1", "2", None)], "a string, `b c` string, d string")
    aligned = O.align_columns(frame, ["z", "d", "a", "b\nc"])
    assert aligned.columns == ["z", "d", "a", "b c"]
    assert tuple(aligned.first()) == ("", None, "1", "2")


def test_join_guarded(evaluate):
    arrays = [["a", None, "b"], [], None, [None]]
    assert evaluate(O.join_guarded, arrays, "array<string>") == ["a,b", "", None, ""]


def test_explode_keeping_empty(spark):
    frame = spark.createDataFrame([(1, ["x", None]), (2, []), (3, None)], "i int, a array<string>")
    rows = [tuple(r) for r in O.explode_keeping_empty(frame, "a", "e").orderBy("i", "e").collect()]
    assert rows == [(1, None), (1, "x"), (2, None), (3, None)]


def test_cell_keys(spark):
    frame = spark.createDataFrame(
        [("a", "b"), ("a", "b"), ("b", "a"), ("c", None)], "x string, y string"
    )
    keys = sorted((r[0] or "") for r in O.cell_keys(frame).collect())
    assert keys == ["", "a", "a", "b", "b", "c"]
    once = sorted((r[0] or "") for r in O.cell_keys(frame, distinct_cells=True).collect())
    assert once == ["", "a", "b", "c"]


def test_key_list_file(spark, tmp_path):
    path = tmp_path / "keys.csv"
    path.write_text('ori\tother\n"A ""1"""\tB\n"A ""1"""\tB\nC\t\n"D\tE"\tA\n')
    keys = [r[0] for r in read_keys(spark, str(path)).collect()]
    assert sorted(k or "" for k in keys) == ["", "A", 'A "1"', "B", "C", "D\tE"]
    typed = read_delimited(spark, str(path), "ori string, other string")
    assert typed.count() == 4


def test_exclude_titles(spark):
    titles = ["2020 (in Progress)", "2020 (in progress)", "x(in Progress)y", "in Progress"]
    frame = spark.createDataFrame([(t,) for t in titles], "sheet string")
    kept = [r[0] for r in O.exclude_titles(frame).collect()]
    assert kept == ["2020 (in progress)", "in Progress"]


def test_distinct_rows(spark):
    frame = spark.range(10).select((F.col("id") % 3).alias("k"))
    assert O.distinct_rows(frame).count() == 3
