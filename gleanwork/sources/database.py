"""Query results from a database, read by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_database(
    spark: SparkSession,
    url: str,
    query: str,
    options: dict[str, str] | None = None,
    split_column: str | None = None,
    num_partitions: int = 16,
    fetch_size: int = 5000,
) -> DataFrame:
    """The result of ``query``. With a numeric ``split_column`` it is read in parallel slices.

    The slice bounds come from one min/max query that the database answers itself. Credentials go
    in ``options`` (``user``, ``password``, ``driver``) and are never part of the data.
    """
    reader = (
        spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    ).options(**(options or {}))
    if split_column is None:
        return reader.option("query", query).load()

    bounds = (
        spark.read.format("jdbc")
        .option("url", url)
        .options(**(options or {}))
        .option(
            "query",
            f"SELECT MIN({split_column}) AS lo, MAX({split_column}) AS hi FROM ({query}) whole",
        )
        .load()
        .select(F.col("lo").cast("bigint"), F.col("hi").cast("bigint"))
        .first()
    )
    sliced = reader.option("dbtable", f"({query}) whole")
    if bounds[0] is None or bounds[0] == bounds[1]:
        return sliced.load()
    return (
        sliced.option("partitionColumn", split_column)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", num_partitions)
        .load()
    )
