"""Sinks: each table is written to a fresh folder and read back."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.plans import run_payloads
from gleanwork.sinks import read_history, read_orc, read_snapshot, write_orc, write_snapshot
from gleanwork.sources import read_keys
from gleanwork.workspace import fresh_path
from querybook.payloads import odd_answers, supplier_answers
from querybook.tables import RUN_DATE, table
from querybook.text import CRLF_SQL, _crlf

NEXT_DATE = "2024-03-01"
FLAT_SCHEMA = (
    "ORI string, category string, noun string, short_title string, title string, "
    "ui_restriction string, ui_type string, key_array string, precise_array string, "
    "data_year bigint, key string, month_num bigint, value bigint"
)


def orc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return read_orc(spark, write_orc(orders, fresh_path(spark, "orc")))


def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit(" \n"), "text", F.lit(' "end"\n ')).alias("text"),
        F.when(F.col("doc_id") % 2 == 0, F.lit("")).alias("blank"),
    )
    path = write_snapshot(texts, fresh_path(spark, "tsv"), RUN_DATE)
    return read_snapshot(spark, path, "doc_id bigint, text string, blank string")


def tsv_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit(" \t\\"), _crlf("text"), F.lit('\\"end"\r\n ')).alias("text"),
        F.when(F.col("doc_id") % 2 == 0, F.lit("")).alias("blank"),
    )
    path = write_snapshot(texts, fresh_path(spark, "tsv"), RUN_DATE, lossless=True)
    return read_snapshot(spark, path, "doc_id bigint, text string, blank string", lossless=True)


def tsv_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fresh_path(spark, "append")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    write_snapshot(orders, target, RUN_DATE)
    write_snapshot(lines.toDF(*orders.columns), target, RUN_DATE, mode="append")
    return read_history(spark, target, "o_orderkey bigint, o_orderpriority string").drop("run_date")


def dated_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, read by the manifest: the second is written twice and added to, then a run fails half-way."""
    target = fresh_path(spark, "history")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_snapshot(orders, target, RUN_DATE, atomic=True)
    write_snapshot(orders, target, NEXT_DATE, atomic=True)
    even, odd = ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1")
    rest = orders.withColumn("o_orderstatus", F.lit("Z"))
    write_snapshot(rest.where(even), target, NEXT_DATE, atomic=True)
    write_snapshot(rest.where(odd), target, NEXT_DATE, mode="append", atomic=True)
    failing = F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("half-way"))).otherwise("x")
    with contextlib.suppress(Exception):
        write_snapshot(orders.withColumn("o_orderstatus", failing), target, NEXT_DATE, atomic=True)
    history = read_history(spark, target, "o_orderkey bigint, o_orderstatus string", atomic=True)
    return history.withColumn("run_date", F.col("run_date").cast("string"))


def nation_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer per customer, with the nation as its key."""
    element = F.struct(
        F.lit(1995).alias("data_year"),
        F.col("c_mktsegment").alias("key"),
        F.lit(1).alias("month_num"),
        F.col("c_custkey").alias("value"),
    )
    return table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("key"),
        F.lit(200).alias("status"),
        F.to_json(F.struct(F.array(element).alias("data"))).alias("body"),
    )


def by_key_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fresh_path(spark, "by-key")
    answers = nation_answers(spark, sf_dir)
    run_payloads(answers, target, run_date=RUN_DATE, layout="by_key", keep_rejects=False)
    stored = read_history(spark, target, FLAT_SCHEMA + ", object string")
    return stored.select("ORI", "object", "key", "value")


def payload_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fresh_path(spark, "payloads")
    run_payloads(supplier_answers(spark, sf_dir), target, run_date=RUN_DATE, keep_rejects=False)
    stored = read_history(spark, target, FLAT_SCHEMA)
    return stored.select("ORI", "key_array", "data_year", "key", "month_num", "value")


def job_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a payload job lists as unusable: bad answers, and keys without a good one."""
    answers = supplier_answers(spark, sf_dir).unionByName(odd_answers(spark, sf_dir))
    names = table(spark, sf_dir, "customer").select(F.concat(F.lit("X"), "c_custkey").alias("key"))
    target = fresh_path(spark, "payloads")
    run_payloads(answers, target, run_date=RUN_DATE, keys=names)
    return spark.read.parquet(f"{target}/_rejects").select("source", "key", "reason")


def key_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key list with doubled rows, quotes and an empty cell, written and read as keys."""
    folder = fresh_path(spark, "keys")
    names = table(spark, sf_dir, "customer").select(
        F.concat("c_name", F.lit('\t"q"')).alias("first"), F.col("c_mktsegment").alias("second")
    )
    names.unionByName(names).write.option("sep", "\t").option("header", True).option(
        "escape", '"'
    ).csv(folder)
    return read_keys(spark, folder)


BOOK = {
    "orc_roundtrip": (orc_roundtrip, "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"),
    "tsv_roundtrip": (
        tsv_roundtrip,
        """
        SELECT doc_id, regexp_replace(text, '\\A[\\x00-\\x20]+', '') || ' "end"' AS text,
               CAST(NULL AS VARCHAR) AS blank
        FROM documents
        """,
    ),
    "tsv_lossless": (
        tsv_lossless,
        f"""
        SELECT doc_id, ' ' || chr(9) || chr(92) || {CRLF_SQL} || chr(92) || '"end"' || chr(13)
               || chr(10) || ' ' AS text, CASE WHEN doc_id % 2 = 0 THEN '' END AS blank
        FROM documents
        """,
    ),
    "tsv_append": (
        tsv_append,
        """
        SELECT o_orderkey, o_orderpriority FROM orders
        UNION ALL SELECT l_orderkey, l_returnflag FROM lineitem
        """,
    ),
    "dated_history": (
        dated_history,
        f"""
        SELECT o_orderkey, o_orderstatus, '{RUN_DATE}' AS run_date FROM orders
        UNION ALL SELECT o_orderkey, 'Z', '{NEXT_DATE}' FROM orders
        """,
    ),
    "by_key_layout": (
        by_key_layout,
        """
        SELECT lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS "ORI",
               lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || '_agency_arrests' AS object,
               c_mktsegment AS "key", c_custkey AS value
        FROM customer
        """,
    ),
    "payload_snapshot": (
        payload_snapshot,
        """
        WITH codes AS (
            SELECT l_suppkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag)
                   AS key_array
            FROM lineitem GROUP BY l_suppkey)
        SELECT 'S' || l_suppkey AS "ORI", key_array,
               CAST(year(l_shipdate) AS BIGINT) AS data_year, l_returnflag AS "key",
               CAST(month(l_shipdate) AS BIGINT) AS month_num, count(*) AS value
        FROM lineitem JOIN codes USING (l_suppkey) GROUP BY ALL
        """,
    ),
    "job_rejects": (
        job_rejects,
        """
        SELECT 'by_offense' AS source, 'X' || c_custkey AS "key", CASE c_custkey % 6
               WHEN 0 THEN 'status 500' WHEN 1 THEN 'status 404' ELSE 'malformed body' END
               AS reason
        FROM customer WHERE c_custkey % 6 IN (0, 1, 4)
        UNION ALL
        SELECT 'by_offense', 'X' || c_custkey, 'no answer with status 200'
        FROM customer WHERE c_custkey % 6 IN (0, 1)
        """,
    ),
    "key_scan": (
        key_scan,
        """
        WITH pairs AS (
            SELECT DISTINCT c_name || chr(9) || '"q"' AS first, c_mktsegment AS second
            FROM customer)
        SELECT first AS "key" FROM pairs UNION ALL SELECT second FROM pairs
        """,
    ),
}
