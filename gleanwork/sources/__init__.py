"""Readers. Each lists many files, tables or sheets in one Spark job."""

from gleanwork.sources.database import read_database
from gleanwork.sources.delimited import read_delimited, read_keys
from gleanwork.sources.documents import (
    decode_documents,
    html_text,
    read_binary_files,
    too_large_files,
)
from gleanwork.sources.grids import (
    csv_grid_rows,
    grid_rejects,
    json_grid_rows,
    scrub_cells,
    sheet_listing,
    sheet_rows,
    to_wide,
    widest_row,
    workbook_rows,
    workbook_rows_by_sheet,
)
from gleanwork.sources.images import image_rejects, image_sizes, image_text, read_images, unreadable_images
from gleanwork.sources.split_csv import split_csv_rows

__all__ = [
    "csv_grid_rows",
    "decode_documents",
    "grid_rejects",
    "html_text",
    "image_rejects",
    "image_sizes",
    "image_text",
    "json_grid_rows",
    "read_binary_files",
    "read_database",
    "read_delimited",
    "read_images",
    "read_keys",
    "scrub_cells",
    "sheet_listing",
    "sheet_rows",
    "split_csv_rows",
    "to_wide",
    "too_large_files",
    "widest_row",
    "workbook_rows",
    "workbook_rows_by_sheet",
    "unreadable_images",
]
