from __future__ import annotations

import gzip
import pathlib
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from gleanwork import operators as O
from gleanwork import sinks as K
from gleanwork import sources as S
from gleanwork import workspace
from gleanwork.plans import run_payloads

DAY = "2024-02-29"
VALUES = [None, "", " pad ", "line1\nline2\n", 'q"uo\\te\ttab', "cr\r\nx", "\\N ", "\\"]
SCHEMA = "k int, v string, n int"


@pytest.fixture(scope="module")
def rough(spark):
    return spark.createDataFrame([(i, v, i) for i, v in enumerate(VALUES)], SCHEMA)


def data_files(path) -> list[pathlib.Path]:
    return sorted(p for p in pathlib.Path(path).rglob("part-*") if p.suffix != ".crc")


def test_default_snapshot(spark, rough, tmp_path):
    path = K.write_snapshot(rough, str(tmp_path), DAY)
    assert path.endswith("/run_date=2024-02-29")
    got = [r["v"] for r in K.read_snapshot(spark, path, SCHEMA).orderBy("k").collect()]
    assert got == [None, None, "pad", "line1\nline2", 'q"uo\\te\ttab', "cr\r\nx", "\\N", "\\"]
    assert all(p.name.endswith(".csv.gz") for p in data_files(path))


def test_lossless_snapshot(spark, rough, tmp_path):
    path = K.write_snapshot(rough, str(tmp_path), DAY, lossless=True)
    got = K.read_snapshot(spark, path, SCHEMA, lossless=True).orderBy("k").collect()
    assert [r["v"] for r in got] == VALUES


def test_empty_table_leaves_a_header(spark, rough, tmp_path):
    path = K.write_snapshot(rough.where("false"), str(tmp_path), DAY)
    assert K.read_snapshot(spark, path).columns == ["k", "v", "n"]


def test_days_are_kept_and_reruns_replace_their_own_day(spark, tmp_path):
    target = str(tmp_path)
    for day, rows in ((DAY, 3), ("2024-03-01", 5), ("2024-03-01", 4)):
        K.write_snapshot(spark.range(rows), target, day)
    K.write_snapshot(spark.range(2), target, DAY, mode="append")
    history = K.read_history(spark, target, "id bigint")
    counts = {str(r[0]): r[1] for r in history.groupBy("run_date").count().collect()}
    assert counts == {DAY: 5, "2024-03-01": 4}
    pruned = history.where("run_date = DATE'2024-03-01'")
    assert "PartitionFilters: [isnotnull(run_date" in pruned._jdf.queryExecution().executedPlan().toString()


def test_bad_dates_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        K.write_snapshot(spark.range(1), str(tmp_path), "../elsewhere")


def test_files_are_bounded_on_request(spark, tmp_path):
    path = K.write_snapshot(spark.range(0, 100, 1, 1), str(tmp_path), DAY, max_records_per_file=30)
    assert len(data_files(path)) == 4


def test_failures_raise(spark, tmp_path):
    arrays = spark.range(1).select(F.array("id").alias("a"))
    with pytest.raises(Exception, match="(?i)unsupported"):
        K.write_snapshot(arrays, str(tmp_path), DAY)


def test_orc(spark, rough, tmp_path):
    target = K.write_orc(rough, str(tmp_path / "orc"))
    assert [r["v"] for r in K.read_orc(spark, target).orderBy("k").collect()] == VALUES
    assert any(".snappy.orc" in p.name for p in data_files(target))


def test_a_key_gets_its_own_folder_and_one_file(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 8).select(
        F.lpad((F.col("id") % 20).cast("string"), 3, "0").alias("ORI"), F.col("id").alias("value")
    )
    path = K.write_by_key(rows, str(tmp_path), "by_race", run_date=DAY)
    folders = sorted(p.name for p in pathlib.Path(path).iterdir() if p.is_dir())
    assert folders[1] == "object=001_agency_arrests_by_offense" and len(folders) == 20
    assert len(data_files(path)) == 20
    back = K.read_history(spark, str(tmp_path), "ORI string, value bigint, object string")
    assert back.where("ORI = '007'").count() == 200


def test_a_hot_key_is_split_over_tasks(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5))
        .alias("ORI"),
        F.sha2(F.col("id").cast("string"), 512).alias("value"),
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "1MB")
    try:
        path = K.write_by_key(rows, str(tmp_path), run_date=DAY)
    finally:
        spark.conf.unset(setting)
    hot = data_files(pathlib.Path(path) / "object=hot_agency_arrests")
    assert len(hot) > 4
    back = K.read_history(spark, str(tmp_path), "ORI string, value string, object string")
    assert back.where("ORI = 'hot'").count() == rows.where("ORI = 'hot'").count()


def test_a_hot_sheet_is_split_and_each_file_is_in_order(spark, tmp_path):
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.lit("cold")).alias("sheet_slug"),
        F.col("id").alias("row_idx"),
        F.sha2(F.col("id").cast("string"), 512).alias("_c0"),
        F.col("id").cast("string").alias("_c1"),
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "1MB")
    try:
        path = K.write_by_sheet(rows, str(tmp_path), order=["row_idx"], run_date=DAY)
    finally:
        spark.conf.unset(setting)
    hot = data_files(pathlib.Path(path) / "sheet_slug=hot")
    assert len(hot) > 4
    for file in hot:
        numbers = [int(line.split('"')[3]) for line in gzip.open(file, "rt").readlines()[1:]]
        assert numbers == sorted(numbers)
    assert K.read_snapshot(spark, path).count() == 300_000


def test_rejects_have_one_shape(spark, tmp_path):
    frame = spark.createDataFrame([(7, "why")], "key int, reason string")
    path = K.write_rejects(frame, str(tmp_path), "here", DAY)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("here", "7", "why")]


def test_preview_is_ordered(spark):
    shown = K.preview(spark.range(100).orderBy(F.desc("id")), "id")
    assert [r[0] for r in shown.collect()] == list(range(10))
    assert "TakeOrderedAndProject" in shown._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("layout", ["snapshot", "by_key"])
def test_payload_job(spark, tmp_path, layout):
    body = '{"data":[{"data_year":2001,"key":"a","month_num":1,"value":1}],"title":"t\\nu"}'
    answers = spark.createDataFrame(
        [("A", 200, body), ("B", 200, body), ("C", 500, body), ("D", 200, "x")],
        "key string, status int, body string",
    )
    keys = spark.createDataFrame([("A",), ("Z",)], "key string")
    target, rejects = str(tmp_path / "out"), str(tmp_path / "bad")
    for _ in range(2):
        run_payloads(answers, target, "by_offense", DAY, keys, layout, rejects_target=rejects)
    rows = K.read_snapshot(spark, target).orderBy("ORI").collect()
    assert [(r["ORI"], r["title"], r["value"]) for r in rows] == [("A", "t\nu", "1"), ("B", "t\nu", "1")]
    refused = sorted((r["key"], r["reason"]) for r in spark.read.parquet(rejects).collect())
    assert refused == [
        ("C", "status 500"), ("D", "malformed body"), ("Z", "no answer with status 200"),
    ]
    run_payloads(answers, target, "by_offense", DAY, layout=layout, mode="append")
    assert K.read_snapshot(spark, target).count() == 4
    listed = sorted(r["key"] for r in spark.read.parquet(f"{target}/_rejects").collect())
    assert listed == ["C", "D"]
    with pytest.raises(ValueError, match="pile"):
        run_payloads(answers, target, layout="pile")


def test_job_count_does_not_grow_with_the_keys(spark, tmp_path):
    def jobs(keys: int) -> int:
        group = f"keys-{keys}"
        spark.sparkContext.setJobGroup(group, "")
        answers = spark.range(keys).select(
            F.col("id").cast("string").alias("key"),
            F.lit(200).alias("status"),
            F.lit('{"data":[{"value":1}]}').alias("body"),
        )
        run_payloads(answers, str(tmp_path / group), run_date=DAY, keep_rejects=False)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(3) == jobs(300) == 1


def test_database_writer_bounds_its_connections():
    frame = MagicMock()
    writer = frame.repartition.return_value.write.format.return_value
    writer.option.return_value = writer.options.return_value = writer.mode.return_value = writer
    K.write_database(frame, "jdbc:x", "t", {"user": "u"}, num_partitions=3)
    frame.repartition.assert_called_once_with(3)
    assert {c.args for c in writer.option.call_args_list} == {
        ("url", "jdbc:x"), ("dbtable", "t"), ("batchsize", 5000),
    }
    writer.options.assert_called_once_with(user="u")
    writer.mode.assert_called_once_with("append")
    writer.save.assert_called_once_with()


@pytest.mark.parametrize(("bounds", "sliced"), [((1, 9), True), ((None, None), False), ((4, 4), False)])
def test_database_reader_slices_by_column(bounds, sliced):
    session = MagicMock()
    reader = session.read.format.return_value
    reader.option.return_value = reader.options.return_value = reader
    reader.load.return_value.select.return_value.first.return_value = bounds
    S.read_database(session, "jdbc:x", "SELECT 1", split_column="id")
    options = {c.args[0]: c.args[1] for c in reader.option.call_args_list}
    assert options["dbtable"] == "(SELECT 1) whole"
    assert ("partitionColumn" in options) == sliced
    if sliced:
        assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == (1, 9, 16)


def test_database_reader_without_slices():
    session = MagicMock()
    reader = session.read.format.return_value
    reader.option.return_value = reader.options.return_value = reader
    S.read_database(session, "jdbc:x", "SELECT 1")
    assert ("query", "SELECT 1") in {c.args for c in reader.option.call_args_list}


def test_shared_folder_comes_from_the_session(spark):
    assert workspace.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = workspace.fresh_path(spark, "x"), workspace.fresh_path(spark, "x")
    assert first != second and first.startswith(workspace.shared_dir(spark))
    cluster = MagicMock()
    cluster.conf.get = lambda name, default=None: "yarn" if name == "spark.master" else default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_dir(cluster)
    alone = MagicMock()
    alone.conf.get = lambda name, default=None: "local[2]" if name == "spark.master" else default
    assert workspace.shared_dir(alone) == workspace.shared_dir(alone)
    assert pathlib.Path(workspace.shared_dir(alone)).is_dir()


def test_materialised_table_has_no_lineage(spark):
    frame = spark.range(10).repartition(3).select(F.col("id"), F.array("id").alias("a"))
    stored = workspace.materialise(frame)
    assert stored.schema == frame.schema or stored.columns == frame.columns
    assert "Exchange" not in stored._jdf.queryExecution().executedPlan().toString()
    assert O.distinct_rows(stored).count() == 10


def test_jobs_and_appended_runs_keep_their_rejects(spark, tmp_path):
    from gleanwork import sinks

    def bad(key):
        return spark.createDataFrame([(key, "bad")], "key string, reason string")

    folder = str(tmp_path / "rejects")
    sinks.write_rejects(bad("a"), folder, "one", "2024-02-29")
    sinks.write_rejects(bad("b"), folder, "two", "2024-02-29")
    sinks.write_rejects(bad("c"), folder, "two", "2024-02-29", mode="append")
    sinks.write_rejects(bad("d"), folder, "one", "2024-02-29")
    listed = spark.read.parquet(folder).select("source", "key").collect()
    assert sorted(map(tuple, listed)) == [("one", "d"), ("two", "b"), ("two", "c")]


def test_lossless_keeps_texts_that_look_like_the_mark(spark, tmp_path):
    values = [None, "", "N", "\\N", "\\\\N", "\\\\\\N", "\\N ", "x\\N"]
    frame = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    path = K.write_snapshot(frame, str(tmp_path), DAY, lossless=True)
    got = K.read_snapshot(spark, path, "k int, v string", lossless=True).orderBy("k").collect()
    assert [r["v"] for r in got] == values
