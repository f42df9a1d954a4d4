"""DataFrame operators."""

from gleanwork.operators.columns import (
    align_columns,
    cell_keys,
    distinct_rows,
    exclude_titles,
    explode_keeping_empty,
    join_guarded,
    normalise_columns,
    scrub_table,
)
from gleanwork.operators.html_tables import csv_body, csv_line, html_csv, html_rows, table_rows
from gleanwork.operators.payloads import (
    PAYLOAD_SCHEMA,
    classify_payloads,
    flatten_payloads,
    parse_payloads,
    payload_quality,
    payload_rejects,
    request_list,
    response_ok,
    unanswered_keys,
)
from gleanwork.operators.responses import (
    join_chunks,
    response_chunks,
    response_rejects,
    route_responses,
    routed_responses,
)

__all__ = [
    "PAYLOAD_SCHEMA",
    "align_columns",
    "cell_keys",
    "classify_payloads",
    "csv_body",
    "csv_line",
    "distinct_rows",
    "exclude_titles",
    "explode_keeping_empty",
    "flatten_payloads",
    "html_csv",
    "html_rows",
    "join_chunks",
    "join_guarded",
    "normalise_columns",
    "parse_payloads",
    "payload_quality",
    "payload_rejects",
    "request_list",
    "response_chunks",
    "response_ok",
    "response_rejects",
    "route_responses",
    "routed_responses",
    "scrub_table",
    "table_rows",
    "unanswered_keys",
]
