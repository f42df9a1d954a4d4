from __future__ import annotations

import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import gleanwork  # noqa: E402
import querybook  # noqa: E402

for package in (gleanwork, querybook):
    cloudpickle.register_pickle_by_value(package)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a Column function to texts and return the results in their order."""

    def run(function, values, kind="string"):
        frame = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        return [row[0] for row in frame.orderBy("i").select(function("v")).collect()]

    return run


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
