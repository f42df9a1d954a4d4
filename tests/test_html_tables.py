from __future__ import annotations

import time
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanwork import operators as O
from gleanwork.operators.html_tables import read_rows

PAGES = {
    "<table><tr><td>a</td><td>b</td></tr></table>": '"a","b"\n',
    "<table><tr><th>h</th></tr><tr><td>a</td><td>b</td></tr></table>": '\n"a","b"\n',
    "<table><tr><td>a</td></tr><tr><th>h</th></tr><tr><td>c</td></tr></table>": '"a"\n"c"\n',
    "<table><tr><th>h</th></tr><tr><th>i</th></tr></table>": "\n",
    "<p>none</p>": "",
    "": "",
    '<table><tr><td>x"y</td></tr></table>': '"x"y"\n',
    "<tr><td>outside a table</td></tr>": "",
}


@pytest.mark.parametrize(
    ("html", "rows"),
    [
        (
            "<table><tr><td>o<table><tr><td>i</td></tr></table></td><td>z</td></tr></table>",
            [["o i", "i", "z"], ["i"]],
        ),
        ("<table><tr><td>a<td>b<tr><td>c</table>", [["a", "b"], ["c"]]),
        ("<table><tr><td>a &amp; b&nbsp;<br>c   d\n</td></tr></table>", [["a & b c d"]]),
        ("<table><tr><td><p>a</p>b<div>c</div><b>d</b>e</td></tr></table>", [["a b cde"]]),
        ("<table><td>no row</td></table>", [["no row"]]),
        ("<table><tbody><tr><td>a</tbody><tbody><td>b</tbody></table>", [["a"], ["b"]]),
        ("<table><tr><td>a<script>var t='</td>'</script><style>p{}</style>b</table>", [["a b"]]),
        ("<table><tr><td>a<b>b</b></i>c</td></tr></table>", [["abc"]]),
        ("<table><tr><td>a<!-- <td>x</td> -->b</td></tr></table>", [["ab"]]),
        ("<TABLE><TR><TD CLASS='x>y'>A</TD></TR></TABLE>", [["A"]]),
        ("<table><tr><td>a</th>b</td></tr></table>", [["ab"]]),
        ("<table><tr><td>x​y\xadz</td></tr></table>", [["xyz"]]),
        ("<table><tr><td><pre> a\n  b</pre></td></tr></table>", [["a\n  b"]]),
        ("<table><tr><td>a \u200b b\u3000<p>c</p></table>", [["a b\u3000 c"]]),
        ("<table><tr><td><b><div>a</div></b>c<p>d</p> <i>e</i></table>", [["ac d e"]]),
        ("<table><tr><td>cut off", [["cut off"]]),
        ("<table><tr><td>a<td title='unfinished", [["a"]]),
        ("<table><tr><td>a<!-- unfinished <td>b", [["a"]]),
        ("<table><tr><td>a<!-->b<!---->c<?x?>d</>e<!x>f", [["abcdef"]]),
        ("<table><tr><td>1 < 2 <3 & 4&lt5</table>", [["1 < 2 <3 & 4<5"]]),
        ("<table><tr><td a=\"x>y\" b='>' c=it's>k<td d=\"e>l</table>", [["k"]]),
        ("<table><tr><td><textarea> <b>&amp; </textarea>|<xmp>&amp;<b></xmp></table>",
         [["<b>& |&amp;<b>"]]),
        ("<table><tr><td>a<script>x</scripty></script >b", [["a b"]]),
        ("<table><tr><td>a</td></tr></table></table></td><table><td>b", [["a"], ["b"]]),
        ("<table><tr><td></td><td> </td></tr><tr></tr></table>", [["", ""], []]),
        ("<table><tr><th>a<table><tr><td>i</td></tr></table></th></tr></table>", [["i"], ["i"]]),
        ("<table><tr><td>a</td></tr></table>after<table><tr><td>b</td></tr></table>", [["a"], ["b"]]),
    ],
)
def test_reading_rows(html, rows):
    assert read_rows(html) == rows


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>", "<tbody>", "x", " ",
     "<br>", "<p>", "</p>", "&lt;", "<", "<!--", "-->", "<script>", "</script>", "<pre>", "\x00"]
)))
def test_any_markup_is_read_to_the_end(parts):
    for row in read_rows("".join(parts)):
        assert all(isinstance(cell, str) for cell in row)


@pytest.mark.parametrize(
    "part",
    ["<", "<!--", "<a ", "<script></", "<td a=\"", "<td a='", "&#", "<!", "<table><tr><th>", "<td>",
     "</", "<?", "<![CDATA[", "<a =", "<pre>", "<title>", "<a b=\"'>"],
)
def test_hostile_markup_takes_linear_time(part):
    def seconds(times: int) -> float:
        start = time.perf_counter()
        read_rows("<table><tr><td>" + part * times)
        return time.perf_counter() - start

    assert seconds(40_000) < 2


def buffer_replay(rows: list[list[str]]) -> str:
    """The text as a string buffer grows it: the last character goes before each line end."""
    text = ""
    for row in rows:
        for cell in row:
            text += f'"{cell}",'
        text = text[:-1] + "\n"
    return text


def test_csv_of_pages(spark):
    frame = spark.createDataFrame([(html,) for html in [*PAGES, None]], "html string")
    bodies = frame.select(
        "html", O.csv_body(O.table_rows("html"), escape_quotes=False).alias("csv")
    ).collect()
    assert {row["html"]: row["csv"] for row in bodies} == {**PAGES, None: ""}
    doubled = frame.where("html LIKE '%x\"y%'")
    assert O.html_csv(doubled).first()["csv"] == '"x""y"\n'


def test_csv_body_equals_a_growing_buffer_on_all_mixes_of_rows(spark):
    kinds = [[], ["a"], ["a", "b"], [""]]
    tables = [list(mix) for n in range(5) for mix in product(kinds, repeat=n)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(tables)], "i int, t array<array<string>>")
    got = [r[0] for r in frame.orderBy("i").select(O.csv_body("t", escape_quotes=False)).collect()]
    assert got == [buffer_replay(table) for table in tables]


def test_html_rows_keeps_other_columns(spark):
    html = "<table><tr><th>h</th></tr><tr><td>a</td></tr></table>"
    frame = spark.createDataFrame([(1, html), (2, "<p>"), (3, None)], "id int, html string")
    rows = [tuple(r) for r in O.html_rows(frame).orderBy("row_idx").collect()]
    assert rows == [(1, 0, []), (1, 1, ["a"])]


def test_deep_nesting_takes_linear_time_where_cells_count_once(spark):
    """One page of tables in tables; whoever wants the cells of all inner rows gets them in batches."""
    page = "<table><tr><td>x"
    start = time.perf_counter()
    assert sum(map(len, read_rows(page * 40_000, "own"))) == 40_000
    assert time.perf_counter() - start < 4
    frame = spark.createDataFrame([(page * 40_000,), (page * 300,)], "html string")
    rows = O.html_rows(frame, nested="own")
    assert rows.selectExpr("count(*)", "max(size(cells))").first()[:] == (40_300, 1)
    inner = O.html_rows(frame.where("length(html) < 10000"))
    totals = inner.selectExpr("count(*)", "sum(size(cells))", "max(length(cells[0]))").first()
    assert totals[:] == (300, 300 * 301 // 2, 599)


def test_nested_cells_count_once_if_asked(spark):
    html = "<table><tr><td>o<table><tr><td>i</td></tr></table>p</td><td>z</td></tr></table>"
    assert read_rows(html, "own") == [["o p", "z"], ["i"]]
    frame = spark.createDataFrame([(html,)], "html string")
    assert O.html_csv(frame, nested="own").first()["csv"] == '"o p","z"\n"i"\n'
    with pytest.raises(ValueError, match="deep"):
        O.html_rows(frame, nested="deep")
