"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def full_text(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def crc_mod(doc_id: str, modulus: int) -> Column:
    """CRC-32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def worker_state() -> dict:
    """A dict that lives as long as the Python worker, so that tasks share what is slow to build.

    Functions travel by value and bring their own globals with each task, so a module global would be
    built anew in every task.
    """
    return sys.modules.setdefault("gleanwork_worker_state", types.ModuleType("gleanwork_worker_state")).__dict__


def split_words(text: str) -> list[str]:
    """Words by ``SPACES`` alone; ``str.split`` also breaks at other blanks of Unicode."""
    if text.isascii() and not any(mark in text for mark in "\x1c\x1d\x1e\x1f"):
        return text.split()
    for space in SPACES[1:]:
        text = text.replace(space, " ")
    return [word for word in text.split(" ") if word]


def lower_ascii(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    if text.isascii():
        return text.lower()
    # Bytes know no other letters than A-Z, and no other character's UTF-8 holds their codes.
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
