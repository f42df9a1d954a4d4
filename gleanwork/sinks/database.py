"""Append to a database table over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.readwriter import DataFrameWriter


def jdbc_writer(
    df: DataFrame,
    url: str,
    table: str,
    options: dict[str, str] | None = None,
    num_partitions: int = 16,
    batch_size: int = 5000,
) -> DataFrameWriter:
    """A writer with a bounded number of connections, however large the cluster is.

    The explicit repartition keeps the work before the write parallel; letting the writer coalesce
    would pull that work into the few connection tasks as well.
    """
    return (
        df.repartition(num_partitions)
        .write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .options(**(options or {}))
        .mode("append")
    )


def write_database(
    df: DataFrame,
    url: str,
    table: str,
    options: dict[str, str] | None = None,
    num_partitions: int = 16,
    batch_size: int = 5000,
) -> None:
    """Append the rows. Each task is one transaction, and a failure raises.

    A task that is repeated after its commit would append its rows again: give the table a unique
    key, so that the repeat fails loudly.
    """
    jdbc_writer(df, url, table, options, num_partitions, batch_size).save()
