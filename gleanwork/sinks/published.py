"""Days that a failed run cannot destroy: attempts, and a manifest that names those that count.

``target/_attempts/run_date=yyyy-MM-dd/attempt=…`` holds what one run wrote, ``target/_manifest`` one small
file per finished run. A run writes its attempt first and its line of the manifest last, as one file, so a run
that fails at any point leaves the day as it was. Readers go through the manifest: of each day the
latest attempt that replaced it counts, and those that added to it since. Attempts that count no longer are left
to a retention rule.
"""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ATTEMPTS, MANIFEST = "_attempts", "_manifest"
MANIFEST_TYPE = "run_date date, attempt string, adds boolean, finished long"


@contextmanager
def attempt(spark: SparkSession, target: str, run_date: str, adds: bool = False) -> Iterator[str]:
    """A fresh folder to write in; when the block ends without an error, it becomes the day, or a part of it."""
    root, name = target.rstrip("/"), uuid.uuid4().hex
    yield f"{root}/{ATTEMPTS}/run_date={run_date}/attempt={name}"
    line = (datetime.date.fromisoformat(run_date), name, adds, time.time_ns())
    spark.createDataFrame([line], MANIFEST_TYPE).repartition(1).write.mode("append").parquet(f"{root}/{MANIFEST}")


def current_attempts(spark: SparkSession, target: str) -> DataFrame:
    """``(run_date, attempt)`` of what counts: a line of the manifest for each run, so as good as nothing."""
    lines = spark.read.schema(MANIFEST_TYPE).parquet(f"{target.rstrip('/')}/{MANIFEST}")
    place = F.struct("finished", "attempt")
    replaced = F.max(F.when(~F.col("adds"), place)).over(Window.partitionBy("run_date"))
    never = F.struct(F.lit(-1).cast("long").alias("finished"), F.lit("").alias("attempt"))
    dated = lines.select("*", place.alias("place"), F.coalesce(replaced, never).alias("replaced"))
    # A plain comparison is what lets the optimizer prune the folders of all other attempts.
    return dated.where("place >= replaced").select("run_date", "attempt")


def read_published(
    spark: SparkSession, target: str, read: Callable[[str], DataFrame]
) -> DataFrame:
    """What counts of a target, with its ``run_date``.

    ``read`` reads a folder with the columns ``run_date`` and ``attempt`` in its paths, for example
    ``spark.read.parquet``. Attempts that don't count are pruned, not read and filtered.
    """
    stored = read(f"{target.rstrip('/')}/{ATTEMPTS}")
    stored = stored.withColumn("run_date", F.col("run_date").cast("date")).withColumn("attempt", F.col("attempt").cast("string"))
    return stored.join(current_attempts(spark, target), ["run_date", "attempt"], "left_semi").drop("attempt")
