"""Nested payloads to flat rows, for both datasets."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.operators.payloads import (
    flatten_payloads,
    parse_payloads,
    payload_rejects,
    request_list,
    unanswered_keys,
)
from gleanwork.sinks.tables import (
    rejects_path,
    run_day,
    write_by_key,
    write_rejects,
    write_snapshot,
)
from gleanwork.sources.delimited import read_keys
from gleanwork.workspace import materialise

UNANSWERED = "no answer with status 200"


def run_requests(
    spark: SparkSession,
    keys: str | list[str],
    base: str,
    target: str,
    dataset: str = "by_offense",
    run_date: str | datetime.date | None = None,
    first: int = 1995,
    last: int = 2018,
    rejects_target: str | None = None,
    keep_rejects: bool = True,
    lossless: bool = False,
    max_records_per_file: int = 0,
    atomic: bool = False,
) -> str:
    """Write the address to fetch for each key of a key list, without the access secret.

    An empty cell is no key and gets no address; the rejects say how many there are,
    unless ``keep_rejects`` is off.
    """
    run_date = run_day(run_date)
    cells = read_keys(spark, keys)
    is_key = F.coalesce(F.col("key") != "", F.lit(False))
    if (listed := rejects_path(target, rejects_target, keep_rejects)) is not None:
        empty = cells.where(~is_key).groupBy(F.lit("").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        reason = F.concat(F.lit("empty cells: "), F.col("n").cast("string"))
        write_rejects(empty.select("key", reason.alias("reason")), listed, "requests", run_date)
    named = cells.where(is_key)
    requests = request_list(named, base, dataset, first, last)
    return write_snapshot(
        requests, target, run_date, lossless=lossless, max_records_per_file=max_records_per_file, atomic=atomic
    )


def run_payloads(
    responses: DataFrame,
    target: str,
    dataset: str = "by_offense",
    run_date: str | datetime.date | None = None,
    keys: DataFrame | None = None,
    layout: str = "snapshot",
    mode: str = "overwrite",
    rejects_target: str | None = None,
    keep_rejects: bool = True,
    lossless: bool = False,
    max_records_per_file: int = 0,
    atomic: bool = False,
) -> str:
    """Flatten all payloads and write them, in one job for all keys.

    ``layout="snapshot"`` writes without a shuffle; ``"by_key"`` gives every key its own folder.
    The day's folder is replaced, so a repeated run does not double its rows; ``mode="append"``
    adds to it instead. With ``atomic`` a day changes only when a run is complete.

    Unusable answers are listed in ``rejects_target``, by default a folder ``_rejects`` in the
    target; with ``keys``, so are the keys without a good answer. The parsed answers are staged for
    that, so each is parsed once. With ``keep_rejects=False`` there is no list and no stage.
    """
    if layout not in ("snapshot", "by_key"):
        raise ValueError(f"layout is 'snapshot' or 'by_key', not {layout!r}")
    run_date = run_day(run_date)
    listed = rejects_path(target, rejects_target, keep_rejects)
    if listed is not None:
        responses = materialise(parse_payloads(responses), dataset)
        refused = payload_rejects(responses)
        if keys is not None:
            silent = unanswered_keys(keys, responses)
            refused = refused.unionByName(silent.withColumn("reason", F.lit(UNANSWERED)))
        write_rejects(refused, listed, dataset, run_date, mode)
    rows = flatten_payloads(responses)
    options = {"lossless": lossless, "max_records_per_file": max_records_per_file, "atomic": atomic}
    if layout == "by_key":
        return write_by_key(rows, target, dataset, run_date=run_date, mode=mode, **options)
    return write_snapshot(rows, target, run_date, mode=mode, **options)
