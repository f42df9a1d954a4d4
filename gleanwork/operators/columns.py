"""Operators on whole column lists: names, alignment, key cells, guarded joins of arrays."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.text import LINE_BREAK, _col, scrub_newlines

IN_PROGRESS = "(in Progress)"  # fixed value: the mark of a sheet that is still being edited


def quoted(name: str) -> Column:
    """The column of this very name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalised_names(names: Sequence[str]) -> list[str]:
    """Spaces become ``_`` and letters lower case. Raises if two names become the same."""
    renamed = [name.replace(" ", "_").lower() for name in names]
    clashes = sorted(name for name, uses in Counter(renamed).items() if uses > 1)
    if clashes:
        raise ValueError(f"columns share a normalised name: {', '.join(clashes)}")
    return renamed


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalised_names(df.columns))


def scrub_table(df: DataFrame) -> DataFrame:
    """Every column as text on one line, under its normalised name."""
    names = normalised_names(df.columns)
    return df.select(
        [scrub_newlines(quoted(old)).alias(new) for old, new in zip(df.columns, names)]
    )


def align_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Exactly the wanted columns, in their order; a missing one is filled with the empty text.

    A line break in a wanted name stands for a space in the column's name.
    """
    present = set(df.columns)

    def pick(name: str) -> Column:
        single_line = re.sub(LINE_BREAK, " ", name)
        for candidate in (name, single_line):
            if candidate in present:
                return quoted(candidate).alias(single_line)
        return F.lit("").alias(name)

    return df.select([pick(name) for name in wanted])


def join_guarded(c: Column | str, separator: str = ",") -> Column:
    """The array as one text; a NULL array stays NULL, NULL elements are left out."""
    return F.array_join(_col(c), separator)


def explode_keeping_empty(df: DataFrame, array: str, element: str) -> DataFrame:
    """One row per element; a row whose array is empty or NULL stays, with a NULL element."""
    kept = [quoted(name) for name in df.columns if name != array]
    return df.select(*kept, F.explode_outer(quoted(array)).alias(element))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def cell_keys(df: DataFrame, key: str = "key", distinct_cells: bool = False) -> DataFrame:
    """Every cell of the distinct rows, as one column of keys.

    A cell that occurs in two columns or in two different rows is listed as often as it occurs;
    ``distinct_cells`` lists it once.
    """
    cells = F.array(*[quoted(name).cast("string") for name in df.columns])
    if distinct_cells:
        return df.select(F.explode(cells).alias(key)).dropDuplicates()
    return distinct_rows(df).select(F.explode(cells).alias(key))


def exclude_titles(df: DataFrame, title: str = "sheet", marker: str = IN_PROGRESS) -> DataFrame:
    """Leave out rows whose title holds the marker, in just this spelling."""
    return df.where(~F.contains(quoted(title), F.lit(marker)))
