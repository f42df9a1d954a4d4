"""Scalar functions: ``Column -> Column``, all inside Spark's expression engine."""

from gleanwork.functions.names import (
    csv_header_file_name,
    file_name,
    file_type,
    header_file_names,
    html_object_name,
    object_key,
    request_path,
    run_stamp,
    sheet_slug,
    workbook_slug,
)
from gleanwork.functions.text import (
    collapse_lines,
    flat_lower,
    grouped_integer,
    lower_text,
    scrub_newlines,
    trim_controls,
    trim_lines,
    type_tagged_text,
)

__all__ = [
    "collapse_lines",
    "csv_header_file_name",
    "file_name",
    "file_type",
    "flat_lower",
    "grouped_integer",
    "header_file_names",
    "html_object_name",
    "lower_text",
    "object_key",
    "request_path",
    "run_stamp",
    "scrub_newlines",
    "sheet_slug",
    "trim_controls",
    "trim_lines",
    "type_tagged_text",
    "workbook_slug",
]
