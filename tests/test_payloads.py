from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gleanwork import operators as O
from gleanwork.workspace import materialise

COLUMNS = [
    "ORI", "category", "noun", "short_title", "title", "ui_restriction", "ui_type", "key_array",
    "precise_array", "data_year", "key", "month_num", "value",
]
ROW = {"data_year": 2001, "key": "a", "month_num": 5, "value": 7}


def answer(key, data=..., status=200, **fields):
    body = dict(fields)
    if data is not ...:
        body["data"] = data
    return key, status, json.dumps(body)


@pytest.fixture(scope="module")
def answers(spark):
    rows = [
        answer("normal", [ROW, {**ROW, "value": 8}], category="c", keys=["k"], precise_data=["p"]),
        answer("empty", []),
        answer("null", None),
        answer("missing"),
        answer("first-null", [None, ROW]),
        answer("later-null", [ROW, None]),
        answer("null-fields", [{"key": None, "value": None}]),
        answer("keys-null", [ROW], keys=None),
        answer("keys-empty", [ROW], keys=[]),
        answer("keys-mixed", [ROW], keys=["a", None, "b"]),
        answer("fraction", [{**ROW, "value": 1.5}]),
        answer("text-number", [{**ROW, "value": "12"}]),
        answer("wrong-data", "text"),
        ("not-json", 200, "not json"),
        ("array-root", 200, "[1]"),
        ("blank", 200, " "),
        ("no-body", 200, None),
        answer("refused", [ROW], status=500),
        answer("unknown", [ROW], status=None),
    ]
    return spark.createDataFrame(rows, "key string, status int, body string")


def test_flat_rows(answers):
    flat = O.flatten_payloads(answers)
    assert flat.columns == COLUMNS
    rows = {}
    for row in flat.collect():
        rows.setdefault(row["ORI"], []).append(row)
    assert sorted(rows) == [
        "fraction", "keys-empty", "keys-mixed", "keys-null", "later-null", "normal", "null-fields",
        "text-number",
    ]
    assert tuple(rows["normal"][0]) == (
        "normal", "c", None, None, None, None, None, "k", "p", 2001, "a", 5, 7,
    )
    assert [row["value"] for row in rows["normal"]] == [7, 8]
    assert [row["value"] for row in rows["later-null"]] == [7, None]
    assert rows["later-null"][1]["data_year"] is None
    assert rows["null-fields"][0]["value"] is None
    assert rows["keys-null"][0]["key_array"] is None
    assert rows["keys-empty"][0]["key_array"] == ""
    assert rows["keys-mixed"][0]["key_array"] == "a,b"
    assert rows["fraction"][0]["value"] is None and rows["fraction"][0]["key"] == "a"
    assert rows["text-number"][0]["value"] is None


def test_skip_all_keeps_payloads_that_lead_with_null(answers):
    kept = {row["ORI"] for row in O.flatten_payloads(answers, skip="all").collect()}
    assert "first-null" in kept and "empty" not in kept and "null" not in kept
    with pytest.raises(ValueError, match="some"):
        O.flatten_payloads(answers, skip="some")


def test_rejects(answers):
    reasons = {row["key"]: row["reason"] for row in O.payload_rejects(answers).collect()}
    assert reasons == {
        "wrong-data": "malformed body",
        "not-json": "malformed body",
        "array-root": "malformed body",
        "blank": "empty body",
        "no-body": "empty body",
        "refused": "status 500",
        "unknown": "status unknown",
    }


def test_every_answer_has_one_outcome(answers):
    quality = {row["outcome"]: row for row in O.payload_quality(answers).collect()}
    assert sum(row["answers"] for row in quality.values()) == answers.count()
    assert quality["ok"]["answers"] == 8 and quality["ok"]["inexact"] == 2
    assert quality["no data"]["answers"] == 4
    good = O.classify_payloads(answers).where("outcome = 'ok'").select("key")
    flat = O.flatten_payloads(answers).select(F.col("ORI").alias("key")).distinct()
    assert good.exceptAll(flat).isEmpty() and flat.exceptAll(good).isEmpty()


def test_a_stored_parse_serves_all_operators(answers):
    stored = materialise(O.parse_payloads(answers))
    for operator in (O.flatten_payloads, O.payload_rejects, O.payload_quality):
        fresh, later = operator(answers), operator(stored)
        assert fresh.columns == later.columns
        assert fresh.exceptAll(later).isEmpty() and later.exceptAll(fresh).isEmpty()
    assert O.unanswered_keys(answers, stored).count() == O.unanswered_keys(answers, answers).count()


def test_other_schema(spark):
    schema = O.PAYLOAD_SCHEMA.fromDDL("data array<struct<x: int>>, name string")
    frame = spark.createDataFrame([answer("k", [{"x": 1}], name="n")], "key string, status int, body string")
    flat = O.flatten_payloads(frame, schema)
    assert flat.columns == ["ORI", "name", "x"] and tuple(flat.first()) == ("k", "n", 1)


def test_unanswered_keys(spark, answers):
    keys = spark.createDataFrame([("normal",), ("refused",), ("absent",), ("absent",)], "key string")
    silent = sorted(row[0] for row in O.unanswered_keys(keys, answers).collect())
    assert silent == ["absent", "refused"]


def test_request_list_holds_no_secret(spark):
    keys = spark.createDataFrame([("A1",)], "key string")
    row = O.request_list(keys, "https://data.example.org/").first()
    assert row["request"] == "https://data.example.org/arrest/agencies/offense/A1/all/1995/2018"


def test_fields_with_one_name_are_refused(spark):
    from pyspark.sql import types as T

    frame = spark.createDataFrame([], "key string, status int, body string")
    for names in ("ori string, data array<struct<value int>>", "value int, data array<struct<Value int>>"):
        schema = T.StructType.fromDDL(names)
        with pytest.raises(ValueError, match="one name"):
            O.flatten_payloads(frame, schema=schema)
