"""Operators on columns, over the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.operators import (
    align_columns,
    cell_keys,
    distinct_rows,
    exclude_titles,
    explode_keeping_empty,
    join_guarded,
    normalise_columns,
    scrub_table,
)
from querybook.tables import table


def array_join_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_size") % 7
    names = (
        F.when(kind == 0, F.lit(None).cast("array<string>"))
        .when(kind == 1, F.array().cast("array<string>"))
        .otherwise(
            F.array("p_brand", F.when(F.col("p_type") != "ECONOMY", F.col("p_type")), "p_name")
        )
    )
    return table(spark, sf_dir, "part").select("p_partkey", join_guarded(names).alias("joined"))


def explode_outer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("conv_id") % 5
    lines = (
        F.when(kind == 0, F.lit(None).cast("array<string>"))
        .when(kind == 1, F.array().cast("array<string>"))
        .otherwise(F.split("text", "\n"))
    )
    turns = table(spark, sf_dir, "conversations")
    return explode_keeping_empty(
        turns.select("conv_id", "turn", lines.alias("lines")), "lines", "line"
    )


def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus"))


def all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell_keys(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus"))


def distinct_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    return cell_keys(lines, distinct_cells=True)


def title_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = (
        F.when(F.col("p_partkey") % 3 == 0, F.lit(" (in Progress)"))
        .when(F.col("p_partkey") % 3 == 1, F.lit(" (in progress)"))
        .otherwise(F.lit(""))
    )
    titled = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", mark).alias("sheet"))
    return exclude_titles(titled)


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer Key"),
        F.col("c_name").alias("Full Name.Text"),
        F.col("c_mktsegment").alias("SEGMENT"),
    )
    return normalise_columns(customers)


def scrubbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("Doc ID"), F.col("text").alias("Full Text"), F.col("lang").alias("LANG")
    )
    return scrub_table(documents)


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["kind", "name", "segment", "balance"]
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("kind"),
        F.col("s_name").alias("name"),
        F.format_number("s_acctbal", 0).alias("balance"),
    )
    return align_columns(customers, wanted).unionByName(align_columns(suppliers, wanted))


BOOK = {
    "array_join_guard": (
        array_join_guard,
        """
        SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 7 = 1 THEN ''
               ELSE concat_ws(',', p_brand, CASE WHEN p_type <> 'ECONOMY' THEN p_type END, p_name)
               END AS joined
        FROM part
        """,
    ),
    "explode_outer_rows": (
        explode_outer_rows,
        """
        SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line
        FROM conversations WHERE conv_id % 5 > 1
        UNION ALL
        SELECT conv_id, turn, NULL FROM conversations WHERE conv_id % 5 <= 1
        """,
    ),
    "distinct_rows": (
        distinct_pairs,
        "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    ),
    "cell_keys": (
        all_cells,
        """
        WITH pairs AS (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)
        SELECT l_returnflag AS "key" FROM pairs UNION ALL SELECT l_linestatus FROM pairs
        """,
    ),
    "distinct_cells": (
        distinct_cells,
        """
        SELECT CAST(l_partkey AS VARCHAR) AS "key" FROM lineitem
        UNION SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem
        """,
    ),
    "title_exclude": (
        title_exclude,
        """
        SELECT p_partkey, p_name || CASE WHEN p_partkey % 3 = 1 THEN ' (in progress)' ELSE '' END
               AS sheet
        FROM part WHERE p_partkey % 3 <> 0
        """,
    ),
    "normalise_columns": (
        normalised,
        """
        SELECT c_custkey AS customer_key, c_name AS "full_name.text", c_mktsegment AS segment
        FROM customer
        """,
    ),
    "scrub_table": (
        scrubbed,
        """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, replace(text, chr(10), ' ') AS full_text, lang
        FROM documents
        """,
    ),
    "align_columns": (
        aligned,
        """
        SELECT 'customer' AS kind, c_name AS name, c_mktsegment AS segment, '' AS balance
        FROM customer
        UNION ALL
        SELECT 'supplier', s_name, '', format('{:,}', CAST(round_even(s_acctbal, 0) AS BIGINT))
        FROM supplier
        """,
    ),
}
