"""Binary files and their text.

Plain text is decoded by Spark itself. Other formats go through a decoder, a plain function from
``(content, name)`` to text, which runs on Arrow batches inside the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.functions.markup import END, START, markup_events
from gleanwork.functions.names import file_type
from gleanwork.operators.html_tables import BLOCK_TAGS

Decoder = Callable[[bytes, str], str]

MAX_FILE_BYTES = 2**31 - 1  # fixed value: the largest binary value of Spark
# The types that are text as they stand.
TEXT_TYPES = (
    "text/plain",
    "text/csv",
    "text/tab-separated-values",
    "application/json",
    "application/xml",
)
NO_DECODER = "no decoder for "
BAD_UTF8 = "not valid UTF-8"
NO_TEXT = "the decoder gave no text"
HALF_PAIRS = re.compile("[\ud800-\udfff]")  # fixed value: characters that UTF-8 cannot hold


def _binary_reader(spark: SparkSession, pattern: str | None):
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def read_binary_files(
    spark: SparkSession, path: str | list[str], pattern: str | None = None
) -> DataFrame:
    """``(path, modificationTime, length, content)``, one row per file, subfolders included.

    Spark packs files into tasks by size. A file that no binary value can hold is never opened: the
    limit reaches the scan. :func:`too_large_files` lists those, and every job does so.
    """
    return _binary_reader(spark, pattern).load(path).where(F.col("length") <= MAX_FILE_BYTES)


def too_large_files(
    spark: SparkSession, path: str | list[str], pattern: str | None = None
) -> DataFrame:
    """``(key, reason)`` of the files that :func:`read_binary_files` leaves out."""
    return (
        _binary_reader(spark, pattern)
        .load(path)
        .where(F.col("length") > MAX_FILE_BYTES)
        .select(
            F.col("path").alias("key"),
            F.concat(F.lit("too large: "), F.col("length").cast("string")).alias("reason"),
        )
    )


def html_text(content: bytes, name: str) -> str:
    """The text of a page, with a line break at each block."""
    parts = []
    for kind, value in markup_events(content.decode("utf-8", "replace")):
        if kind not in (START, END):
            parts.append(value)
        elif value in BLOCK_TAGS or value == "br":
            parts.append("\n")
    return "".join(parts)


DEFAULT_DECODERS: dict[str, Decoder] = {"text/html": html_text}


def decode_documents(
    files: DataFrame,
    decoders: Mapping[str, Decoder] | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """``(path, text, error)`` for each of ``files(path, content)``.

    ``decoders`` maps a media type to its decoder. A file that has none, or whose decoder fails,
    gets NULL text and an error; the other files are not affected.
    """
    chosen = dict(DEFAULT_DECODERS if decoders is None else decoders)
    kind = F.col("kind")
    typed = files.select("path", "content", file_type("path", types).alias("kind"))
    plain = kind.isin(*[t for t in TEXT_TYPES if t not in chosen])
    plain_text = F.when(plain, F.try_validate_utf8(F.col("content").cast("string")))
    kept = ("path", "kind", plain_text.alias("plain_text"), F.col("content").isNull().alias("absent"))
    failed = (
        F.when(plain & ~F.col("absent") & F.col("plain_text").isNull(), F.lit(BAD_UTF8))
        .when(~kind.isin(*chosen) & ~plain, F.concat(F.lit(NO_DECODER), kind))
    )
    if not chosen:
        return typed.select(*kept).select(
            "path", F.col("plain_text").alias("text"), failed.alias("error")
        )

    @F.pandas_udf("text string, error string")
    def decode(content: pd.Series, path: pd.Series, kinds: pd.Series) -> pd.DataFrame:
        texts: list[str | None] = []
        errors: list[str | None] = []
        for body, name, media in zip(content, path, kinds):
            text = error = None
            if body is not None:
                try:
                    text = chosen[media](bytes(body), name)
                    if text is None:
                        error = NO_TEXT
                    else:
                        text = HALF_PAIRS.sub("\ufffd", text)
                except Exception as problem:  # a broken file must not stop the others
                    error = f"{type(problem).__name__}: {problem}"
            texts.append(text)
            errors.append(error)
        return pd.DataFrame({"text": texts, "error": errors}, dtype=object)

    # A filter on the outcome must not be moved below the decoder: it would decode twice.
    decode = decode.asNondeterministic()
    # Only the bytes that need a decoder cross over to Python.
    custom = F.when(kind.isin(*chosen), F.col("content"))
    return typed.select(*kept, decode(custom, "path", "kind").alias("decoded")).select(
        "path",
        F.coalesce("plain_text", "decoded.text").alias("text"),
        F.coalesce(failed, "decoded.error").alias("error"),
    )
