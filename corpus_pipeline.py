"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

Toxic documents go, of equal texts the one with the largest id stays, of near-duplicates the one with the
smallest id, the sources are mixed to their target weights, and what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gleanwork.llm.common import crc_mod, table
from gleanwork.llm.exact_dedup import exact_dedup
from gleanwork.llm.mixing import mixed_documents
from gleanwork.llm.ngram_join import one_per_class
from gleanwork.llm.packing import pack_sequences
from gleanwork.llm.toxicity import drop_toxic
from gleanwork.workspace import materialise


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut; learned from the labelled rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 3) != 1)
    return drop_toxic(docs, labels.select("doc_id", "toxic"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_class(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces with their sequences and offsets."""
    return pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: The toxicity grammar and the packing search have no counterpart in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
