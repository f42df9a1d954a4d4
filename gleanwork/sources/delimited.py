"""Delimited text with a header: key lists and other small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanwork.operators.columns import cell_keys


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Tab-separated text with a header; ``"`` quotes a cell and doubles inside one.

    All columns are text unless ``schema`` says otherwise. Cells that hold line breaks need
    ``multi_line``, at the price that Spark can no longer split a file.
    """
    reader = (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_keys(spark: SparkSession, path: str | list[str], distinct_cells: bool = False) -> DataFrame:
    """Every cell of every column of a key list, as one column ``key``."""
    return cell_keys(read_delimited(spark, path), distinct_cells=distinct_cells)
