from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gleanwork import functions as G

ROUGH = st.text(alphabet="ab .é\t\r\n\x00\x0b\x1f\xa0\u2028", max_size=12)
BATCH = st.lists(ROUGH, min_size=60, max_size=60)
QUICK = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
BLANKS = "".join(map(chr, range(33)))


def line_model(text: str) -> str:
    lines = text.split("\n")
    if text:
        while lines and lines[-1] == "":
            lines.pop()
    return "".join(line.strip(BLANKS) + "\n" for line in lines)


@pytest.mark.parametrize(
    ("text", "scrubbed", "collapsed"),
    [
        ("a\r\nb", "a b", "a b"),
        ("a\n\nb", "a  b", "a b"),
        ("a\n\rb", "a b", "a b"),
        ("\t a\n", "\t a ", "a"),
        ("a\r\n\r\nb", "a  b", "a b"),
        ("", "", ""),
        (None, None, None),
    ],
)
def test_newline_rules(evaluate, text, scrubbed, collapsed):
    assert evaluate(G.scrub_newlines, [text]) == [scrubbed]
    assert evaluate(G.collapse_lines, [text]) == [collapsed]


def test_scrub_reads_any_type_as_text(evaluate):
    assert evaluate(G.scrub_newlines, [12, None], "int") == ["12", None]


@pytest.mark.parametrize(
    ("text", "lines"),
    [
        (" a \n\tb \n", "a\nb\n"),
        ("a\r\nb", "a\nb\n"),
        ("a\n\n\n", "a\n"),
        ("a\n \n", "a\n\n"),
        ("\na", "\na\n"),
        ("", "\n"),
        ("\n\n", ""),
        (" ", "\n"),
        (" \n", "\n"),
        (None, None),
    ],
)
def test_line_trim(evaluate, text, lines):
    assert evaluate(G.trim_lines, [text]) == [lines]
    assert lines is None or line_model(text) == lines


@QUICK
@given(BATCH)
def test_text_rules_agree_with_a_plain_model(evaluate, texts):
    assert evaluate(G.trim_lines, texts) == [line_model(text) for text in texts]
    assert evaluate(G.scrub_newlines, texts) == [
        re.sub("\r\n|\n\r|\r|\n", " ", text) for text in texts
    ]
    assert evaluate(G.collapse_lines, texts) == [
        re.sub("[\r\n]+", " ", text.strip(BLANKS)) for text in texts
    ]


def test_line_trim_is_linear_in_long_runs_of_blanks(evaluate):
    blanks = " " * 300_000
    assert evaluate(G.trim_lines, [f"a{blanks}b{blanks}\n{blanks}c"]) == [f"a{blanks}b\nc\n"]


def test_flat_lower(evaluate):
    assert evaluate(G.flat_lower, ["A\r\nB\n\nÉ"]) == ["a b  é"]


def test_grouped_integer_rounds_half_to_even(evaluate):
    values = [0.5, 1.5, 2.5, 1234567.49, -1234.5, None]
    assert evaluate(G.grouped_integer, values, "double") == [
        "0", "2", "2", "1,234,567", "-1,234", None,
    ]


@pytest.mark.parametrize(
    ("drop", "text", "rest"),
    [
        ("line", "first\nsecond\nthird", "second\nthird"),
        ("line", "only", ""),
        ("char", "first\nsecond", "irst\nsecond"),
        ("char", "", ""),
    ],
)
def test_type_tagged_text(spark, drop, text, rest):
    frame = spark.createDataFrame([("file:/a/B.PDF", text)], "p string, t string")
    tagged = frame.select(G.type_tagged_text("p", G.file_type("p"), "t", drop=drop)).first()[0]
    assert tagged == f"/a/B.PDF: Type formatted detected -> application/pdf\n{rest}"


def test_type_tagged_text_refuses_other_rules(spark):
    with pytest.raises(ValueError, match="word"):
        G.type_tagged_text("p", "p", "p", drop="word")
