"""Text clean-up. Every function takes and returns a Column; all but ``trim_lines`` stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a JVM string trim removes, and one line break: CR LF, LF CR, CR or LF.
# The pattern starts with the two characters themselves, so the search passes quickly over the rest.
TRIMMED_CHARS = "".join(chr(code) for code in range(0x21))
LINE_BREAK = r"[\r\n](?:(?<=\r)\n|(?<=\n)\r)?"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scrub_newlines(c: Column | str) -> Column:
    """Each line break becomes one space. Any type is read as text."""
    return F.regexp_replace(_col(c).cast("string"), LINE_BREAK, " ")


def trim_controls(c: Column | str) -> Column:
    """Trim blanks and control characters; Spark's plain ``trim`` knows only the space."""
    return F.btrim(_col(c), F.lit(TRIMMED_CHARS))


def collapse_lines(c: Column | str) -> Column:
    """Trim, then turn each run of line breaks into one space."""
    return F.regexp_replace(trim_controls(c), r"[\r\n]+", " ")


def trim_lines(c: Column | str) -> Column:
    """Trim every line and end each with a line feed. Empty lines at the end are dropped.

    The empty text is one empty line; a text of line feeds only has no line.
    """
    text = _col(c)
    body = F.rtrim(text, F.lit("\n"))
    no_line = (F.length(body) == 0) & (F.length(text) > 0)
    lines = F.array_join(F.transform(F.split(body, "\n"), trim_controls), "\n")
    return F.when(no_line, F.lit("")).otherwise(F.concat(lines, F.lit("\n")))


def lower_text(c: Column | str) -> Column:
    return F.lower(_col(c))


def flat_lower(c: Column | str) -> Column:
    """The text on one line, in lower case."""
    return F.lower(scrub_newlines(c))


def grouped_integer(c: Column | str) -> Column:
    """The number rounded half-even to an integer, with a comma between groups of three digits."""
    return F.format_number(_col(c), 0)


def type_tagged_text(
    path: Column | str, detected: Column | str, text: Column | str, drop: str = "line"
) -> Column:
    """A line that names the path and its type, then the text without its first line.

    ``drop="char"`` leaves out only the first character.
    """
    body = _col(text)
    if drop == "char":
        rest = F.substring(body, 2, 2**31 - 1)
    elif drop == "line":
        first_break = F.instr(body, "\n")
        rest = F.when(first_break > 0, F.substr(body, first_break + 1)).otherwise(F.lit(""))
    else:
        raise ValueError(f"drop is 'line' or 'char', not {drop!r}")
    return F.concat(
        F.replace(_col(path), F.lit("file:"), F.lit("")),
        F.lit(": Type formatted detected -> "),  # fixed value
        _col(detected),
        F.lit("\n"),
        rest,
    )
