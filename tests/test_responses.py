from __future__ import annotations

import hashlib

import pytest

from gleanwork import operators as O
from gleanwork.plans import landed_objects, run_landing

OFFICE = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
HTML_NAME = "html-" + hashlib.sha256(b"http://h/4").hexdigest()
CASES = [
    ("http://h/1", "text/csv; charset=utf-8", 'attachment; filename="X.csv"', "csv", "X.csv"),
    ("http://h/p/Data.CSV", "text/csv", None, "csv", "data.csv"),
    ("http://h/3", "text/csv", 'attachment; filename="a=b.csv"', "csv", "b.csv"),
    ("http://h/4", "text/html", "anything", "html", HTML_NAME),
    ("http://h/5", OFFICE, 'attachment; filename="m.xlsx"', "office", "m.xlsx"),
    ("http://h/6", "application/binary", "attachment; filename=z.zip", "binary", "z.zip"),
]
PLAIN = '<table><tr><td>say "x"</td></tr></table>'
REFUSED = [
    ("http://h/7", OFFICE, None, "no file name in the header"),
    ("http://h/8", "image/png", None, "no route for this content type"),
    ("http://h/9", None, None, "no route for this content type"),
    ("http://h/10", "TEXT/CSV", None, "no route for this content type"),
]


@pytest.fixture(scope="module")
def responses(spark):
    rows = [(url, kind, head, bytearray(b"body")) for url, kind, head, *_ in CASES + REFUSED]
    rows[3] = (*rows[3][:3], bytearray(b'<table><tr><td>a "b"\xff</td></tr></table>'))
    return spark.createDataFrame(
        rows, "url string, content_type string, content_disposition string, body binary"
    )


def test_routes_and_names(responses):
    routed = O.route_responses(responses, "raw", "2024-02-29")
    assert routed.count() == len(CASES) + len(REFUSED)
    good = {r["url"]: r for r in O.routed_responses(routed).collect()}
    for url, _, _, route, name in CASES:
        assert (good[url]["route"], good[url]["filename"]) == (route, name)
        assert good[url]["object_key"] == f"raw/2024-02-29/{name}"
    refused = {r["key"]: r["reason"] for r in O.response_rejects(routed).collect()}
    assert refused == {url: reason for url, _, _, reason in REFUSED}


def test_one_response_can_have_two_routes_and_two_names(spark):
    rows = [("u", "text/csv officedocument", 'a; filename="x", b; filename="y"', bytearray(b"1"))]
    frame = spark.createDataFrame(
        rows, "url string, content_type string, content_disposition string, body binary"
    )
    routed = O.route_responses(frame, "raw", "2024-02-29").select("route", "filename").collect()
    assert sorted(map(tuple, routed)) == [("csv", "y"), ("office", "x"), ("office", "y")]


def test_bodies(responses):
    stored = {r["url"]: r for r in landed_objects(responses, "raw", "2024-02-29").collect()}
    assert bytes(stored["http://h/4"]["content"]) == '"a ""b""�"\n'.encode()
    assert bytes(stored["http://h/1"]["content"]) == b"body"
    plain = landed_objects(responses, "raw", "2024-02-29", escape_quotes=False)
    assert bytes(plain.where("route = 'html'").first()["content"]) == '"a "b"�"\n'.encode()


def test_landing_job(spark, responses, tmp_path):
    target, rejects = str(tmp_path / "objects"), str(tmp_path / "rejects")
    for _ in range(2):
        run_landing(responses, "raw", target, "2024-02-29", rejects_target=rejects)
    stored = spark.read.parquet(target)
    assert stored.count() == len(CASES)
    assert str(stored.first()["run_date"]) == "2024-02-29"
    assert spark.read.parquet(rejects).count() == len(REFUSED)


def test_chunks_hold_the_same_bytes(spark):
    """Nested tables give far more text than the page has: it leaves in chunks, whatever their size is."""
    nested = "<table><tr><td>x é" * 60 + "</table>" * 30
    pages = [nested, "<table><tr><th>h</th></tr><tr><td>a</td></table>", "no table", "", None, PLAIN]
    rows = [("h", "text/html", None, None if p is None else bytearray(p.encode())) for p in pages]
    rows += [(None, "text/csv", 'a; filename="b.csv"', b) for b in (bytearray(b"x" * 1000), bytearray(b""), None)]
    frame = spark.createDataFrame(
        rows, "url string, content_type string, content_disposition string, body binary"
    )
    wanted = [r["csv"].encode() for r in O.html_csv(spark.createDataFrame([(p,) for p in pages], "html string")).collect()]
    assert len(wanted[0]) > 20 * len(nested)
    for size in (7, 100, 1 << 20):
        chunks = landed_objects(frame, "raw", "2024-02-29", chunk_bytes=size)
        assert chunks.selectExpr("max(length(content))").first()[0] <= size
        whole = {r["response_no"]: r["content"] for r in O.join_chunks(chunks).collect()}
        found = [None if whole[no] is None else bytes(whole[no]) for no in sorted(whole)]
        assert found == [*wanted, b"x" * 1000, b"", None]
    own = O.join_chunks(landed_objects(frame.limit(1), "raw", "2024-02-29", nested="own")).first()["content"]
    assert bytes(own).count(b"\n") == 60 and len(own) < 600
    with pytest.raises(ValueError, match="deep"):
        landed_objects(frame, "raw", "2024-02-29", nested="deep")


def test_pages_larger_than_a_task_leave_line_by_line(monkeypatch):
    """A page whose text would be 2.7 thousand million characters starts to leave at once."""
    from gleanwork.operators import responses

    page = "<table><tr><td>" + "text " * 3 + "<table><tr><td>y" * 2000
    lines = responses.page_csv(page)
    pieces = responses._cut((line.encode() for line in lines), 1 << 20)
    assert [len(next(pieces)) for _ in range(5)] == [1 << 20] * 5
