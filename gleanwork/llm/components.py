"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.workspace import materialise


def _facts(links: DataFrame):
    marks = F.xxhash64("u", "v")
    return links.agg(F.count(F.lit(1)), F.bit_xor(marks), F.sum(marks % 1_000_003)).first()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``u, v``); the root is the least node it can reach.

    Each step hangs the neighbours of a node onto the least of them; steps end when nothing changes. Minima
    are taken before the shuffle, and each step is written to the shared folder.
    """
    links = materialise(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    facts = _facts(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        links = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        last, facts = facts, _facts(links)
        if facts == last:
            roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
