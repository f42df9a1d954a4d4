"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected in the mix ``target / source size`` times. The expected copies are
summed up along the source, one random offset per source is added, and the document is emitted once per
whole number that its stretch of the sum crosses. Documents stand in order of size, so the words taken
stay close to the target.

The running sum has two levels, so no source has to pass through one task: documents fall into blocks by
source, step of size and ``SPLITS`` parts by id; blocks are counted (summed up before the shuffle), the
counts are added up along the source, and documents are numbered within their block. A source has at most
``STEPS`` x 31 x ``SPLITS`` blocks however many documents it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanwork.llm.common import WORD, full_text, table
from gleanwork.workspace import materialise

STEPS = 8
SPLITS = 64
MOST_COPIES = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """``source, key, source_size, target`` for a table of ``source, key, size``.

    Sources by code point, null last, weigh 1, 2, 3, 1, 2, 3, ... and share the sum of all sizes by
    weight; none gets more than ``MOST_COPIES`` times its size, and what it can't take goes to the others
    by weight. With sources in order of ``cap / weight``, those that reach their cap come first; the level
    that the rest share is the largest of the levels found by taking all before a source as capped.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = (
        sized.groupBy("source", "key")
        .agg(F.sum("size").alias("source_size"))
        .select(
            "*",
            ((F.row_number().over(by_name) - 1) % 3 + 1).alias("weight"),
            (F.lit(MOST_COPIES) * F.col("source_size")).alias("cap"),
        )
        .select(
            "*",
            (
                (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
            ).alias("level"),
        )
    )
    shared = F.col("weight") * F.max("level").over(everything)
    return totals.select(
        "source",
        "key",
        "source_size",
        F.least(F.col("cap").cast("double"), shared).alias("target"),
    )


def mix_sources(
    docs: DataFrame, size: Column, doc_id: str = "doc_id", source: str = "source", seed: str = SEED
) -> DataFrame:
    """``row`` (struct of all columns of ``docs``), ``size``, ``source_size``, ``target``, ``copies``.

    A null source is a source of its own. Documents of size 0 take part and add nothing; a source of size
    0 has target 0 and no copies. Equal rows are sampled one by one. An empty table gives no rows. Reruns
    agree: the order is by size and id, the offset comes from the name of the source.
    """
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), size.alias("size"))
    id_text = F.coalesce(F.col(f"row.`{doc_id}`").cast("string"), F.lit(""))
    blocked = named.select(
        "row",
        "size",
        F.col(f"row.`{source}`").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(f"row.`{source}`")), F.lit("")).alias("key"),
        F.floor(STEPS * F.log2(F.col("size") + 1) + F.lit(1e-9)).alias("step"),
        (F.conv(F.substring(F.md5(id_text.cast("binary")), 1, 4), 16, 10).cast("int") % SPLITS).alias("part"),
    )
    along = Window.partitionBy("key").orderBy("step", "part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocked.groupBy("key", "step", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("key", "step", "part", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
        .join(source_targets(blocked).drop("source"), "key")
    )
    within = Window.partitionBy("key", "step", "part").orderBy("size", F.col(f"row.`{doc_id}`"))
    placed = blocked.select("*", F.row_number().over(within).alias("place")).join(blocks, ["key", "step", "part"])
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("key")).cast("binary")), 1, 4), 16, 10)
    offset = (digits.cast("double") + 0.5) / 65536
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = F.col("before") + F.col("place")
    crossed = F.floor(rate * upto + offset) - F.floor(rate * (upto - 1) + offset)
    return placed.select(
        "row", "size", "source_size", "target", F.least(crossed, F.lit(MOST_COPIES)).cast("int").alias("copies")
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: every document as often as it was drawn, with its own columns."""
    size = word_count(full_text(text))
    drawn = mix_sources(docs, size, doc_id, source).where("copies > 0")
    return drawn.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = materialise(docs.select("doc_id", "source", word_count(full_text()).alias("size")), "mix-sizes")
    return mix_sources(sized, F.col("size")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), totals AS (
  SELECT key, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY key, source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM totals
  WINDOW before AS (ORDER BY 3 * source_size / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT key, source_size, least((3 * source_size)::DOUBLE, weight * max(level) OVER ()) AS target,
         (('0x' || substr(md5('mix' || key), 1, 4))::INT + 0.5::DOUBLE) / 65536 AS start
  FROM levels
), numbered AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY key ORDER BY floor(8 * log2(size + 1) + 1e-9),
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 4))::INT % 64, size, doc_id) AS place
  FROM sized JOIN targets USING (key)
)
SELECT doc_id, size, source_size, target,
       (size * least(3, floor(rate * place + start) - floor(rate * (place - 1) + start)))::BIGINT AS taken
FROM numbered
"""

BOOK = {"op5_source_mixing": (op5_source_mixing, SQL)}
