"""What the physical plans must and must not hold."""

from __future__ import annotations

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from gleanwork import operators as O
from gleanwork import sources as S
from gleanwork.plans import document_text, landed_objects
from tests.conftest import plan_of

ROOT = pathlib.Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def answers(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("answers"))
    spark.createDataFrame(
        [("a", 200, '{"data":[{"value":1}]}')], "key string, status int, body string"
    ).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "operator",
    [
        O.flatten_payloads,
        O.payload_rejects,
        O.classify_payloads,
        O.payload_quality,
        lambda a: O.flatten_payloads(a).where("ORI = 'a' AND category = 'c' AND value > 0"),
    ],
)
def test_a_body_is_parsed_once(answers, operator):
    assert plan_of(operator(answers)).count("from_json(") == 1


def test_filters_reach_the_scan_of_the_answers(answers):
    plan = plan_of(O.flatten_payloads(answers).where("ORI = 'a'"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "EqualTo(status,200)" in pushed and "EqualTo(key,a)" in pushed
    assert "Exchange" not in plan


def test_missing_keys_read_no_bodies(answers):
    plan = plan_of(O.unanswered_keys(answers.select("key"), answers))
    assert "body" not in plan


@pytest.fixture(scope="module")
def pages(spark):
    return spark.range(3).select(
        F.col("id").alias("page_id"), F.concat(F.lit("<table>"), "id").alias("html")
    )


def python_nodes(plan: str) -> int:
    return len(re.findall(r"ArrowEvalPython|MapInArrow|BatchEvalPython|MapInPandas", plan))


@pytest.mark.parametrize(
    "operator",
    [
        O.html_rows,
        lambda p: O.html_rows(p).where(F.size("cells") > 1),
        lambda p: O.html_rows(p).where("page_id = 1"),
        O.html_csv,
    ],
)
def test_a_page_is_parsed_once(pages, operator):
    plan = plan_of(operator(pages))
    assert python_nodes(plan) == 1 and "Exchange" not in plan


def test_a_file_is_decoded_once(pages):
    files = pages.select(F.lit("/a.html").alias("path"), F.col("html").cast("binary").alias("content"))
    decoded = S.decode_documents(files)
    for frame in (
        decoded.where("error IS NULL"),
        decoded.where("error IS NOT NULL"),
        document_text(decoded.where("text IS NOT NULL")),
    ):
        assert python_nodes(plan_of(frame)) == 1
    assert python_nodes(plan_of(document_text(S.decode_documents(files, {})))) == 0


def test_a_grid_is_parsed_once(pages):
    files = pages.select(F.lit("/a").alias("path"), F.col("html").cast("binary").alias("content"))
    rows = S.to_wide(S.sheet_rows(S.json_grid_rows(files)), 3)
    assert plan_of(rows).count("from_json(") == 1
    assert python_nodes(plan_of(rows)) == 0
    wide = S.to_wide(S.sheet_rows(S.workbook_rows(files)), 3)
    assert python_nodes(plan_of(wide)) == 1


def test_landing_has_no_shuffle(spark, pages):
    responses = pages.select(
        F.lit("u").alias("url"),
        F.lit("text/html").alias("content_type"),
        F.lit(None).cast("string").alias("content_disposition"),
        F.col("html").cast("binary").alias("body"),
    )
    plan = plan_of(landed_objects(responses, "raw", "2024-02-29"))
    assert python_nodes(plan) == 1 and "Exchange" not in plan


def test_oversized_files_are_not_opened(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("gleanwork.sources.documents.MAX_FILE_BYTES", 5)
    (tmp_path / "a.txt").write_text("x")
    plan = plan_of(S.read_binary_files(spark, str(tmp_path)))
    assert "LessThanOrEqual(length,5)" in plan
    listed = plan_of(S.too_large_files(spark, str(tmp_path)))
    assert "content" not in re.search(r"ReadSchema: (.*)", listed).group(1)


def test_the_library_keeps_rows_off_the_driver():
    forbidden = re.compile(
        r"\.collect\(\)|toPandas|\.rdd\b|localCheckpoint|crossJoin|toLocalIterator|broadcast\(|coalesce\(1\)"
    )
    for source in (ROOT / "gleanwork").rglob("*.py"):
        if "llm" in source.parts:  # its models and filters are gathered within stated bounds
            continue
        assert not forbidden.search(source.read_text()), source


def test_a_null_check_does_not_build_the_text_twice(pages):
    texts = document_text(pages.select(F.lit("/a").alias("path"), F.col("html").alias("text")))
    assert plan_of(texts.where("pdftext IS NOT NULL")).count("array_join(") == 1
