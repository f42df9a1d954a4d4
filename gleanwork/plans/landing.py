"""Landed web responses to stored objects."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame

from gleanwork.operators.responses import (
    CHUNK_BYTES,
    response_chunks,
    response_rejects,
    route_responses,
    routed_responses,
)
from gleanwork.sinks.tables import land_objects, rejects_path, run_day, write_rejects


def landed_objects(
    responses: DataFrame,
    prefix: str,
    run_date: str | datetime.date | None = None,
    escape_quotes: bool = True,
    nested: str = "descendant",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``(url, route, filename, object_key, response_no, chunk, content)`` of every response that can be stored."""
    routed = routed_responses(route_responses(responses, prefix, run_date))
    return response_chunks(routed, escape_quotes, nested, chunk_bytes).select(
        "url", "route", "filename", "object_key", "response_no", "chunk", "content"
    )


def run_landing(
    responses: DataFrame,
    prefix: str,
    target: str,
    run_date: str | datetime.date | None = None,
    escape_quotes: bool = True,
    rejects_target: str | None = None,
    keep_rejects: bool = True,
    nested: str = "descendant",
    chunk_bytes: int = CHUNK_BYTES,
    atomic: bool = False,
) -> str:
    """Store all responses in one job, in numbered chunks of ``chunk_bytes`` bytes at most.

    Those without route or name are listed in ``rejects_target``, by default a folder ``_rejects``
    in the target, unless ``keep_rejects`` is off. That pass reads only headers, never the bodies.
    """
    run_date = run_day(run_date)
    listed = rejects_path(target, rejects_target, keep_rejects)
    if listed is not None:
        headers = responses.drop("body")
        write_rejects(
            response_rejects(route_responses(headers, prefix, run_date)),
            listed,
            "responses",
            run_date,
        )
    objects = landed_objects(responses, prefix, run_date, escape_quotes, nested, chunk_bytes)
    return land_objects(objects, target, run_date, atomic)
