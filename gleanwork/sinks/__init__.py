"""Writers. A failed write raises; rows that cannot be used go to a rejects table."""

from gleanwork.sinks.database import jdbc_writer, write_database
from gleanwork.sinks.published import current_attempts, read_published
from gleanwork.sinks.tables import (
    land_objects,
    preview,
    read_history,
    read_orc,
    read_snapshot,
    rejects,
    snapshot_path,
    write_by_key,
    write_by_sheet,
    write_lines_by_sheet,
    write_long_by_sheet,
    write_orc,
    write_rejects,
    write_snapshot,
)

__all__ = [
    "current_attempts",
    "jdbc_writer",
    "land_objects",
    "preview",
    "read_history",
    "read_orc",
    "read_published",
    "read_snapshot",
    "rejects",
    "snapshot_path",
    "write_by_key",
    "write_by_sheet",
    "write_database",
    "write_lines_by_sheet",
    "write_long_by_sheet",
    "write_orc",
    "write_rejects",
    "write_snapshot",
]
