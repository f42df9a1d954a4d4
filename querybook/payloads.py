"""Payloads derived from the order tables.

Documents are built from rows that were counted first, so one document holds at most one element
per year, month and code, however many order lines its key has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.operators import (
    cell_keys,
    flatten_payloads,
    payload_quality,
    payload_rejects,
    request_list,
    response_ok,
    unanswered_keys,
)
from querybook.tables import table

BASE = "https://data.example.org/api/"


def _documents(rows: DataFrame, key: str, code: str, day: str, label: str) -> DataFrame:
    """``(key, status, body)``: one answer per key, counting its rows by year, month and code."""
    counted = rows.groupBy(
        F.col(key).alias("id"),
        F.year(day).cast("bigint").alias("data_year"),
        F.col(code).alias("code"),
        F.month(day).cast("bigint").alias("month_num"),
    ).agg(F.count(F.lit(1)).alias("value"))
    element = F.struct("data_year", F.col("code").alias("key"), "month_num", "value")
    grouped = counted.groupBy("id").agg(
        F.collect_list(element).alias("data"),
        F.sort_array(F.collect_set("code")).alias("keys"),
    )
    body = F.to_json(
        F.struct(
            F.lit(label).alias("category"),
            "data",
            "keys",
            F.lit("line").alias("noun"),
            F.when(F.col("id") % 2 == 0, F.array().cast("array<string>")).alias("precise_data"),
            F.concat(F.lit("No. "), F.col("id")).alias("short_title"),
            F.concat(F.lit('The "large"\ntitle of '), F.col("id")).alias("title"),
            F.lit("chart").alias("ui_type"),
        )
    )
    return grouped.select(
        F.concat(F.lit(label), F.col("id")).alias("key"),
        F.lit(200).alias("status"),
        body.alias("body"),
    )


def supplier_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return _documents(lines, "l_suppkey", "l_returnflag", "l_shipdate", "S")


def customer_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return _documents(orders, "o_custkey", "o_orderpriority", "o_orderdate", "C")


def odd_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unusable or empty answer per customer."""
    kind = F.col("c_custkey") % 6
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("X"), F.col("c_custkey")).alias("key"),
        F.when(kind == 0, F.lit(500)).when(kind == 1, F.lit(404)).otherwise(F.lit(200))
        .alias("status"),
        F.when(kind == 2, F.lit('{"data":[],"title":"none"}'))
        .when(kind == 3, F.lit('{"title":"none","data":null}'))
        .when(kind == 4, F.concat(F.lit("not json "), F.col("c_name")))
        .when(kind == 5, F.lit('{"data":[null,{"key":"late","value":1}]}'))
        .otherwise(F.lit('{"data":[{"key":"refused","value":1}]}'))
        .alias("body"),
    )


def payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = supplier_answers(spark, sf_dir).unionByName(odd_answers(spark, sf_dir))
    return flatten_payloads(answers)


def payload_flatten_by_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_payloads(customer_answers(spark, sf_dir))


def _flatten_sql(source: str, key: str, code: str, day: str, label: str) -> str:
    return f"""
        WITH counted AS (
            SELECT {key} AS id, CAST(year({day}) AS BIGINT) AS data_year, {code} AS code,
                   CAST(month({day}) AS BIGINT) AS month_num, count(*) AS value
            FROM {source} GROUP BY ALL),
        codes AS (
            SELECT {key} AS id, string_agg(DISTINCT {code}, ',' ORDER BY {code}) AS key_array
            FROM {source} GROUP BY {key})
        SELECT '{label}' || id AS "ORI", '{label}' AS category, 'line' AS noun,
               'No. ' || id AS short_title, 'The "large"' || chr(10) || 'title of ' || id AS title,
               CAST(NULL AS VARCHAR) AS ui_restriction, 'chart' AS ui_type, key_array,
               CASE WHEN id % 2 = 0 THEN '' END AS precise_array,
               data_year, code AS "key", month_num, value
        FROM counted JOIN codes USING (id)
    """


def payload_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays that are empty, lead with NULL or end with NULL, by order."""
    element = F.struct(
        F.col("o_orderpriority").alias("key"), F.col("o_orderkey").alias("value")
    )
    missing = F.lit(None).cast("struct<key:string,value:bigint>")
    kind = F.col("o_orderkey") % 4
    data = (
        F.when(kind == 0, F.array(missing, element))
        .when(kind == 1, F.array().cast("array<struct<key:string,value:bigint>>"))
        .when(kind == 2, F.array(element, missing))
        .otherwise(F.array(element, element))
    )
    answers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.lit(200).alias("status"),
        F.to_json(F.struct(data.alias("data"))).alias("body"),
    )
    return flatten_payloads(answers).select("ORI", "key", "value")


def payload_skip_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other skip rule: an answer counts as soon as any of its elements is there."""
    element = F.struct(F.col("o_orderpriority").alias("key"), F.col("o_orderkey").alias("value"))
    missing = F.lit(None).cast("struct<key:string,value:bigint>")
    data = F.when(F.col("o_orderkey") % 2 == 0, F.array(missing, element)).otherwise(
        F.array(missing)
    )
    answers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.lit(200).alias("status"),
        F.to_json(F.struct(data.alias("data"))).alias("body"),
    )
    return flatten_payloads(answers, skip="all").select("ORI", "key", "value")


def payload_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = supplier_answers(spark, sf_dir).unionByName(odd_answers(spark, sf_dir))
    return payload_quality(answers)


def payload_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = supplier_answers(spark, sf_dir).unionByName(odd_answers(spark, sf_dir))
    return payload_rejects(answers)


def answers_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return response_ok(odd_answers(spark, sf_dir))


def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    answers = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"),
        F.when(F.col("o_totalprice") > 400000, F.lit(200)).otherwise(F.lit(503)).alias("status"),
    )
    return unanswered_keys(keys, answers)


def request_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = cell_keys(table(spark, sf_dir, "supplier").select("s_name"))
    offense = request_list(keys, BASE, "by_offense")
    return offense.unionByName(request_list(keys, BASE, "by_race", 2000, 2010))


BOOK = {
    "payload_flatten": (
        payload_flatten,
        _flatten_sql("lineitem", "l_suppkey", "l_returnflag", "l_shipdate", "S"),
    ),
    "payload_flatten_by_race": (
        payload_flatten_by_race,
        _flatten_sql("orders", "o_custkey", "o_orderpriority", "o_orderdate", "C"),
    ),
    "payload_skip_empty": (
        payload_skip_empty,
        """
        SELECT CAST(o_orderkey AS VARCHAR) AS "ORI", o_orderpriority AS "key", o_orderkey AS value
        FROM orders WHERE o_orderkey % 4 IN (2, 3)
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 4 = 3 THEN o_orderpriority END,
               CASE WHEN o_orderkey % 4 = 3 THEN o_orderkey END
        FROM orders WHERE o_orderkey % 4 IN (2, 3)
        """,
    ),
    "payload_skip_all": (
        payload_skip_all,
        """
        SELECT CAST(o_orderkey AS VARCHAR) AS "ORI", o_orderpriority AS "key", o_orderkey AS value
        FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL FROM orders WHERE o_orderkey % 2 = 0
        """,
    ),
    "payload_outcomes": (
        payload_outcomes,
        """
        SELECT outcome, count(*) AS answers, CAST(0 AS BIGINT) AS inexact FROM (
            SELECT DISTINCT 'ok' AS outcome, l_suppkey FROM lineitem
            UNION ALL
            SELECT CASE c_custkey % 6 WHEN 0 THEN 'status 500' WHEN 1 THEN 'status 404'
                        WHEN 4 THEN 'malformed body' ELSE 'no data' END, c_custkey FROM customer)
        GROUP BY outcome
        """,
    ),
    "payload_refused": (
        payload_refused,
        """
        SELECT 'X' || c_custkey AS "key", CASE c_custkey % 6 WHEN 0 THEN 'status 500'
               WHEN 1 THEN 'status 404' ELSE 'malformed body' END AS reason
        FROM customer WHERE c_custkey % 6 IN (0, 1, 4)
        """,
    ),
    "response_ok": (
        answers_ok,
        """
        SELECT 'X' || c_custkey AS "key", CAST(200 AS INTEGER) AS status,
               CASE c_custkey % 6 WHEN 2 THEN '{"data":[],"title":"none"}'
                    WHEN 3 THEN '{"title":"none","data":null}' WHEN 4 THEN 'not json ' || c_name
                    ELSE '{"data":[null,{"key":"late","value":1}]}' END AS body
        FROM customer WHERE c_custkey % 6 > 1
        """,
    ),
    "missing_keys": (
        missing_keys,
        """
        SELECT c_custkey AS "key" FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
        """,
    ),
    "request_list": (
        request_addresses,
        f"""
        WITH keys AS (SELECT DISTINCT s_name FROM supplier)
        SELECT s_name AS "key",
               '{BASE}arrest/agencies/offense/' || s_name || '/all/1995/2018' AS request FROM keys
        UNION ALL
        SELECT s_name, '{BASE}arrest/agencies/' || s_name || '/all/race/2000/2010' FROM keys
        """,
    ),
}
