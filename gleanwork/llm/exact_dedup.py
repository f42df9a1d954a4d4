"""Exact duplicates by content sort.

Sampled splitters deal the texts out by the range of their first characters (and a hash, where many
texts begin alike), an external sort puts equal texts side by side, and neighbours are compared in full.

A text that very many rows share would fill one range. Such texts are found first by counting digests
(summed up before the shuffle); their rows are dealt over ``splits`` ranges by id, and the size and
survivor of the whole group come from the count. At most ``MOST_HOT`` texts can be that frequent, because
each of them has more than one in ``MOST_HOT`` of all rows: that bounds what is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanwork.llm.common import table

PREFIX = 32
MOST_HOT = 4096
LEAST_HOT = 1000


def content_sort(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", splits: int = 64) -> DataFrame:
    """One row per row of ``docs``: ``row`` (struct of all columns but the text), ``body`` (the text,
    null as empty), ``was_null``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical, null counting as empty. Of equal texts the row with the largest id is
    kept; null ids come last; of rows that agree in id and text, one is kept. An empty table gives none.
    """
    total = docs.count()
    body = F.coalesce(F.col(text), F.lit(""))
    rest = [F.col(f"`{name}`") for name in docs.columns if name != text]
    keyed = docs.select(
        F.struct(*rest).alias("row"),
        F.col(doc_id).alias("id"),
        body.alias("body"),
        F.col(text).isNull().alias("was_null"),
        F.sha2(body.cast("binary"), 256).alias("text_sha256"),
    )
    hot = (
        docs.select(F.col(doc_id).alias("id"), F.sha2(body.cast("binary"), 256).alias("text_sha256"))
        .groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("hot_size"), F.max("id").alias("hot_id"))
        .where(F.col("hot_size") > max(LEAST_HOT, total // MOST_HOT))
    )
    dealt = keyed.join(F.broadcast(hot), "text_sha256", "left").select(
        "*",
        F.substring("body", 1, PREFIX).alias("prefix"),
        F.xxhash64("body").alias("mark"),
        F.when(F.col("hot_size").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(splits)))
        .otherwise(F.lit(0))
        .alias("part"),
    )
    ranged = dealt.repartitionByRange("prefix", "mark", "part")
    same = Window.partitionBy("prefix", "mark", "part", "body")
    ranked = ranged.select(
        "*",
        F.row_number().over(same.orderBy(F.col("id").desc_nulls_last())).alias("rank"),
        F.max("id").over(same).alias("own_id"),
        F.count(F.lit(1)).over(same).alias("own_size"),
    )
    is_hot = F.col("hot_size").isNotNull()
    return ranked.select(
        "row",
        "body",
        "was_null",
        F.when(is_hot, F.col("hot_id")).otherwise(F.col("own_id")).alias("keep_id"),
        F.coalesce("hot_size", "own_size").alias("group_size"),
        ((F.col("rank") == 1) & (~is_hot | F.col("id").eqNullSafe(F.col("hot_id")))).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    whole = F.when(~F.col("was_null"), F.col("body")).alias(text)
    columns = [whole if name == text else F.col(f"row.`{name}`") for name in docs.columns]
    return content_sort(docs, doc_id, text).where("kept").select(*columns)


def op3_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return content_sort(docs).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

BOOK = {"op3_content_sort_dedup": (op3_content_sort_dedup, SQL)}
