from __future__ import annotations

import hashlib

import pytest

from gleanwork import functions as G


def test_file_name(evaluate):
    paths = ["s3a://b/x/Y.PDF", "http://a/B/", "plain", "a//", "", "/", None]
    assert evaluate(G.file_name, paths) == ["y.pdf", "b", "plain", "a", "", "", None]


def test_slugs(evaluate):
    assert evaluate(G.sheet_slug, [" My Sheet ", "A\tB", "\tx\n"]) == ["_my_sheet_", "a\tb", "x"]
    assert evaluate(G.workbook_slug, ["Tab One-A", " x"]) == ["Tab_One_A", "_x"]


def test_header_names(evaluate):
    headers = ['attachment; filename="X.csv"', 'attachment; filename="a=b.csv"', "a=", None]
    assert evaluate(G.csv_header_file_name, headers) == ["X.csv", "b.csv", "a", None]
    headers = [
        'attachment; filename="m.xlsx"',
        "attachment; filename=z.zip",
        'a; FILENAME = "p q.bin"; size=3, b; filename=r.bin',
        "attachment",
        "attachment; filename*=UTF-8''x.csv",
        "filename=first-element-is-no-parameter",
        None,
    ]
    assert evaluate(G.header_file_names, headers) == [
        ["m.xlsx"], ["z.zip"], ["p q.bin", "r.bin"], [], [], [], None,
    ]


def test_html_object_name_depends_on_the_address_only(evaluate):
    expected = "html-" + hashlib.sha256(b"http://h/p").hexdigest()
    assert evaluate(G.html_object_name, ["http://h/p", "http://h/p"]) == [expected, expected]


def test_object_key_and_stamp(evaluate):
    keys = evaluate(lambda c: G.object_key("raw", c, "2024-02-29"), ["x.csv", None])
    assert keys == ["raw/2024-02-29/x.csv", None]
    today = evaluate(lambda c: G.run_stamp(), ["x"])[0]
    assert len(today) == 10 and today[4] == today[7] == "-"


def test_request_paths(evaluate):
    base = "https://data.example.org/api/"
    assert evaluate(lambda c: G.request_path(base, c), ["AK001", None]) == [
        base + "arrest/agencies/offense/AK001/all/1995/2018", None,
    ]
    assert evaluate(lambda c: G.request_path(base, c, "by_race", 2000, 2001), ["AK001"]) == [
        base + "arrest/agencies/AK001/all/race/2000/2001"
    ]
    with pytest.raises(KeyError):
        G.request_path(base, "v", "by_moon")


def test_file_type(evaluate):
    names = ["a/B.PDF", "x.tar.gz", "p.csv?x=1.png", "h.html#top", "noend", "a.b/c", "x.odd", None]
    assert evaluate(G.file_type, names) == [
        "application/pdf", "application/gzip", "text/csv", "text/html",
        "application/octet-stream", "application/octet-stream", "application/octet-stream", None,
    ]
    assert evaluate(lambda c: G.file_type(c, {"odd": "text/odd"}), ["x.odd", "y.PNG"]) == [
        "text/odd", "image/png",
    ]


def test_file_names_of_headers_with_quotes(evaluate):
    from gleanwork.functions.names import header_file_names

    headers = {
        'attachment; filename="Smith, J; 2020.xlsx"': ["Smith, J; 2020.xlsx"],
        "attachment; filename=x.zip ; size=3": ["x.zip"],
        'attachment; title="x; filename=no.xlsx"; filename="yes.xlsx"': ["yes.xlsx"],
        r'attachment; filename="a\"b.csv"': ['a"b.csv'],
        'attachment; filename="a.csv", inline; FILENAME = b.csv; filename=c.csv': ["a.csv", "b.csv"],
        "attachment": [],
        "": [],
        'attachment; filename="open.csv': [],
    }
    assert evaluate(header_file_names, list(headers)) == list(headers.values())
