"""Collect scattered records and flatten them into clean, dated tables on Spark.

Everything here is a ``DataFrame -> DataFrame`` or ``Column -> Column`` function.
See the README for the map from job to function.
"""

from gleanwork import functions, operators, plans, sinks, sources

__all__ = ["functions", "operators", "plans", "sinks", "sources"]
