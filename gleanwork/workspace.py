"""The shared folder for intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="gleanwork-")


def shared_dir(spark: SparkSession) -> str:
    """A folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; a cluster must name the folder, because a
    machine-local temporary folder would split the output over the executors.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", None)  # a session that hides it is not taken for a local one
    if master is not None and master.split("[")[0] == "local":
        return _local_folder()
    raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a re-parse.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
