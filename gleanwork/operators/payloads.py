"""Nested JSON payloads, one document per key, flattened to one row per data element.

Input is a table of landed answers, ``(key STRING, status INT, body STRING)``. The whole table is
parsed and flattened in one narrow pass: no shuffle, so a key with a third of all rows costs no
more than any other.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions.names import request_path
from gleanwork.operators.columns import join_guarded, quoted

# The schema of a payload.
PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("data_year", T.LongType()),
                        T.StructField("key", T.StringType()),
                        T.StructField("month_num", T.LongType()),
                        T.StructField("value", T.LongType()),
                    ]
                )
            ),
        ),
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("noun", T.StringType()),
        T.StructField("precise_data", T.ArrayType(T.StringType())),
        T.StructField("short_title", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("ui_restriction", T.StringType()),
        T.StructField("ui_type", T.StringType()),
    ]
)

# The output name of each text array.
JOINED_ARRAYS = {"keys": "key_array", "precise_data": "precise_array"}

OK = "ok"
NO_DATA = "no data"
EMPTY_BODY = "empty body"
MALFORMED = "malformed body"
_UNPARSED = "_unparsed"


def response_ok(responses: DataFrame) -> DataFrame:
    """Only the answers with status 200."""
    return responses.where(F.col("status") == 200)


def _has_data(data: Column, skip: str) -> Column:
    if skip == "first":
        return F.get(data, F.lit(0)).isNotNull()
    if skip == "all":
        return F.coalesce(F.size(F.array_compact(data)) > 0, F.lit(False))
    raise ValueError(f"skip is 'first' or 'all', not {skip!r}")


def parse_payloads(responses: DataFrame, schema: T.StructType = PAYLOAD_SCHEMA) -> DataFrame:
    """``(key, status, doc)``; a body is parsed only where the status is 200, and only once.

    The operators below take this table in place of the answers, so one stored parse can serve
    several of them.

    The one-element explode is there for the optimizer: filters on the document cannot be moved
    below a generator, where each would parse the body again, while filters on the key still can.
    """
    with_unparsed = T.StructType([*schema.fields, T.StructField(_UNPARSED, T.StringType())])
    body = F.when(F.col("status") == 200, F.col("body"))
    doc = F.from_json(body, with_unparsed, {"columnNameOfCorruptRecord": _UNPARSED})
    return responses.select("key", "status", F.explode(F.array(doc)).alias("doc"))


def _parsed(answers: DataFrame, schema: T.StructType) -> DataFrame:
    return answers if "doc" in answers.columns else parse_payloads(answers, schema)


def classify_payloads(
    responses: DataFrame, schema: T.StructType = PAYLOAD_SCHEMA, skip: str = "first"
) -> DataFrame:
    """``(key, status, outcome, inexact)`` for every answer.

    ``outcome`` is ``ok``, ``no data``, ``empty body``, ``malformed body`` or ``status N``.
    ``inexact`` marks usable payloads in which a field of the wrong type was read as NULL.
    """
    doc = F.col("doc")
    unparsed = doc[_UNPARSED].isNotNull()
    outcome = (
        F.when(F.col("status").isNull(), F.lit("status unknown"))
        .when(F.col("status") != 200, F.concat(F.lit("status "), F.col("status").cast("string")))
        .when(doc.isNull(), F.lit(EMPTY_BODY))
        .when(unparsed & doc["data"].isNull(), F.lit(MALFORMED))
        .when(_has_data(doc["data"], skip), F.lit(OK))
        .otherwise(F.lit(NO_DATA))
    )
    return (
        _parsed(responses, schema)
        .select("key", "status", outcome.alias("outcome"), unparsed.alias("_unparsed"))
        .select(
            "key",
            "status",
            "outcome",
            (F.col("outcome").eqNullSafe(OK) & F.col("_unparsed")).alias("inexact"),
        )
    )


def flatten_payloads(
    responses: DataFrame, schema: T.StructType = PAYLOAD_SCHEMA, skip: str = "first"
) -> DataFrame:
    """One row per data element: key, plain fields, joined text arrays, element fields.

    A payload whose first data element is NULL, or that has none, gives no row. With
    ``skip="all"`` only a payload without any non-NULL element is left out. Raises where two of the
    columns would have one name.
    """
    doc = F.col("doc")
    fields = [f.name for f in schema.fields if f.name != "data" and f.name not in JOINED_ARRAYS]
    joined = [(old, new) for old, new in JOINED_ARRAYS.items() if old in schema.names]
    names = ["ORI", *fields, *(new for _, new in joined), *schema["data"].dataType.elementType.names]
    if twice := sorted(name for name, n in Counter(map(str.lower, names)).items() if n > 1):
        raise ValueError(f"columns with one name: {twice}")
    data = F.when(_has_data(doc["data"], skip), doc["data"])
    shaped = _parsed(response_ok(responses), schema).select(
        F.col("key").alias("ORI"),
        *[doc[name].alias(name) for name in fields],
        *[join_guarded(doc[old]).alias(new) for old, new in joined],
        data.alias("data_array"),
    )
    return shaped.select(
        *[quoted(name) for name in shaped.columns if name != "data_array"],
        F.inline("data_array"),
    )


def payload_rejects(responses: DataFrame, schema: T.StructType = PAYLOAD_SCHEMA) -> DataFrame:
    """``(key, reason)`` of every answer that is no usable document.

    A valid payload without data is not a reject; :func:`payload_quality` counts those.
    """
    return (
        classify_payloads(responses, schema)
        .where(~F.col("outcome").isin(OK, NO_DATA))
        .select("key", F.col("outcome").alias("reason"))
    )


def payload_quality(
    responses: DataFrame, schema: T.StructType = PAYLOAD_SCHEMA, skip: str = "first"
) -> DataFrame:
    """How many answers had each outcome, and how many of them are inexact."""
    return (
        classify_payloads(responses, schema, skip)
        .groupBy("outcome")
        .agg(
            F.count(F.lit(1)).alias("answers"),
            F.count_if("inexact").alias("inexact"),
        )
    )


def request_list(
    keys: DataFrame,
    base: str,
    dataset: str = "by_offense",
    first: int = 1995,
    last: int = 2018,
) -> DataFrame:
    """The address to fetch for each key."""
    return keys.select("key", request_path(base, "key", dataset, first, last).alias("request"))


def unanswered_keys(keys: DataFrame, responses: DataFrame) -> DataFrame:
    """The distinct keys that have no answer with status 200.

    Both sides are reduced to distinct keys before they meet, so a key with many answers sends at
    most one row per task through the shuffle.
    """
    answered = response_ok(responses).select("key").dropDuplicates()
    return keys.select("key").dropDuplicates().join(answered, "key", "left_anti")
