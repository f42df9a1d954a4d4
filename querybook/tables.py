"""Access to the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = "2024-02-29"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to as many tasks as a shuffle has: a small table is one row group, so one task reads it."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
