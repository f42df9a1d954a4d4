"""Documents to text."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.functions.names import file_name
from gleanwork.functions.text import flat_lower, lower_text, trim_lines
from gleanwork.sinks.tables import list_unread, run_day, write_snapshot
from gleanwork.sources.documents import (
    Decoder,
    decode_documents,
    read_binary_files,
    too_large_files,
)
from gleanwork.workspace import materialise


def document_text(decoded: DataFrame, layout: str = "lines") -> DataFrame:
    """``(filename, pdftext)`` of ``decoded(path, text)``, in lower case.

    ``layout="lines"`` keeps the lines and trims each; ``"flat"`` puts the text on one line.
    """
    if layout == "lines":
        text = lower_text(trim_lines("text"))
    elif layout == "flat":
        text = flat_lower("text")
    else:
        raise ValueError(f"layout is 'lines' or 'flat', not {layout!r}")
    # Wherever there is text the result cannot be NULL. Saying so lets a later "is not null" look at
    # the decoded text alone, where it would otherwise build the whole result a second time.
    result = F.when(F.col("text").isNotNull(), F.coalesce(text, F.lit("")))
    return decoded.select(file_name("path").alias("filename"), result.alias("pdftext"))


def documents_view(documents: DataFrame, name: str | None = None) -> DataFrame:
    """The documents that have text, by SQL; with ``name`` all of them are published as that view."""
    if name is not None:
        documents.createOrReplaceTempView(name)
    return documents.sparkSession.sql(
        "SELECT filename, pdftext FROM {documents} WHERE pdftext IS NOT NULL", documents=documents
    )


def run_documents(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    run_date: str | datetime.date | None = None,
    layout: str = "lines",
    decoders: Mapping[str, Decoder] | None = None,
    pattern: str | None = None,
    rejects_target: str | None = None,
    keep_rejects: bool = True,
    lossless: bool = False,
    max_records_per_file: int = 0,
    atomic: bool = False,
) -> str:
    """Decode all files below ``source`` and write a dated snapshot of their text.

    The files without text are listed with the reason in ``rejects_target``, by default a folder
    ``_rejects`` in the target. The decoded table is staged for that, so no file is decoded twice;
    ``keep_rejects=False`` saves the stage and the list. A file whose bytes no value of Spark can
    hold is listed either way, and never stops the others.
    """
    run_date = run_day(run_date)
    decoded = decode_documents(read_binary_files(spark, source, pattern), decoders)
    failed = None
    if keep_rejects:
        decoded = materialise(decoded, "documents")
        failed = decoded.where("error IS NOT NULL").select(
            F.col("path").alias("key"), F.col("error").alias("reason")
        )
    oversized = too_large_files(spark, source, pattern)
    list_unread(failed, oversized, target, rejects_target, "documents", run_date)
    texts = document_text(decoded.where("error IS NULL"), layout)
    return write_snapshot(
        documents_view(texts),
        target,
        run_date,
        lossless=lossless,
        max_records_per_file=max_records_per_file,
        atomic=atomic,
    )
