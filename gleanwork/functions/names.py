"""File, sheet, object and request names."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwork.functions.text import _col, trim_controls

# The media type of a file, by the end of its name.
FILE_TYPES = {
    "bmp": "image/bmp",
    "bz2": "application/x-bzip2",
    "css": "text/css",
    "csv": "text/csv",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "eml": "message/rfc822",
    "epub": "application/epub+zip",
    "gif": "image/gif",
    "gz": "application/gzip",
    "htm": "text/html",
    "html": "text/html",
    "ico": "image/vnd.microsoft.icon",
    "jpeg": "image/jpeg",
    "jpg": "image/jpeg",
    "js": "application/javascript",
    "json": "application/json",
    "mp3": "audio/mpeg",
    "mp4": "video/mp4",
    "odp": "application/vnd.oasis.opendocument.presentation",
    "ods": "application/vnd.oasis.opendocument.spreadsheet",
    "odt": "application/vnd.oasis.opendocument.text",
    "pdf": "application/pdf",
    "png": "image/png",
    "ppt": "application/vnd.ms-powerpoint",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "ps": "application/postscript",
    "psd": "image/vnd.adobe.photoshop",
    "rtf": "application/rtf",
    "svg": "image/svg+xml",
    "tar": "application/x-tar",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "tsv": "text/tab-separated-values",
    "txt": "text/plain",
    "wav": "audio/vnd.wave",
    "webp": "image/webp",
    "xhtml": "application/xhtml+xml",
    "xls": "application/vnd.ms-excel",
    "xlsm": "application/vnd.ms-excel.sheet.macroenabled.12",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xml": "application/xml",
    "zip": "application/zip",
}
UNKNOWN_TYPE = "application/octet-stream"

# The request path of each dataset, around the key and the years.
REQUEST_PATHS = {
    "by_offense": ("arrest/agencies/offense/{key}/all/{first}/{last}"),
    "by_race": ("arrest/agencies/{key}/all/race/{first}/{last}"),
}


def file_name(path: Column | str) -> Column:
    """The last segment of a path or address, in lower case; slashes at the end do not count."""
    return F.lower(F.substring_index(F.rtrim(_col(path), F.lit("/")), "/", -1))


def sheet_slug(title: Column | str) -> Column:
    """Spaces become ``_``, then lower case, then trim: blanks at the edges stay as ``_``."""
    return trim_controls(F.lower(F.replace(_col(title), F.lit(" "), F.lit("_"))))


def workbook_slug(title: Column | str) -> Column:
    """Spaces and hyphens become ``_``; the case stays."""
    return F.translate(_col(title), " -", "__")


QUOTED = r'"(?:[^"\\]|\\.)*+"'
#: A header element up to its first ``filename``: the parameters before it are read whole.
FILE_NAME_PARAMETER = (
    r'(?i)^[^;"]*+(?:;\s*+(?!filename\s*=)[^=;"]*+(?:=\s*+(?:' + QUOTED + r'|[^;"]*+)[^;"]*+)?)*+'
    r';\s*filename\s*=\s*(?:"((?:[^"\\]|\\.)*+)"|([^;"]*+))'
)


def csv_header_file_name(header: Column | str) -> Column:
    """What follows the last ``=`` of a content-disposition header, without quotes."""
    tail = F.substring_index(F.rtrim(_col(header), F.lit("=")), "=", -1)
    return F.replace(tail, F.lit('"'), F.lit(""))


def header_file_names(header: Column | str) -> Column:
    """The first ``filename`` parameter of each element of a content-disposition header, as an array.

    Elements are parted by commas, parameters by semicolons; within quotes neither counts, and a
    backslash takes the next character as it is. Blanks around an unquoted name don't belong to it.
    """
    elements = F.regexp_extract_all(_col(header), F.lit(f'(?:{QUOTED}|[^",])++'), F.lit(0))

    def name(element: Column) -> Column:
        quoted = F.regexp_extract(element, FILE_NAME_PARAMETER, 1)
        plain = F.trim(F.regexp_extract(element, FILE_NAME_PARAMETER, 2))
        return F.when(quoted != "", F.regexp_replace(quoted, r"\\(.)", "$1")).otherwise(plain)

    return F.filter(F.transform(elements, name), lambda found: found != "")


def html_object_name(url: Column | str) -> Column:
    """A name that depends on the address only, so a second run writes the same object."""
    return F.concat(F.lit("html-"), F.sha2(_col(url).cast("binary"), 256))


def run_stamp(run_date: str | datetime.date | None = None) -> Column:
    """The run date as ``yyyy-MM-dd``."""
    day = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
    return F.date_format(day, "yyyy-MM-dd")


def object_key(
    prefix: str, name: Column | str, run_date: str | datetime.date | None = None
) -> Column:
    """``prefix/date/name``; NULL where there is no name."""
    return F.concat(F.lit(prefix), F.lit("/"), run_stamp(run_date), F.lit("/"), _col(name))


def request_path(
    base: str, key: Column | str, dataset: str = "by_offense", first: int = 1995, last: int = 2018
) -> Column:
    """The address to ask for one key. The access secret is never part of it."""
    before, after = REQUEST_PATHS[dataset].format(key="\0", first=first, last=last).split("\0")
    return F.concat(F.lit(base + before), _col(key), F.lit(after))


def file_type(path: Column | str, types: Mapping[str, str] | None = None) -> Column:
    """The media type by file name. ``types`` adds to or replaces entries of ``FILE_TYPES``.

    The table has a fixed size, so it is a constant in the plan and not a join.
    """
    table = {**FILE_TYPES, **(types or {})}
    name = F.substring_index(F.substring_index(_col(path), "?", 1), "/", -1)
    extension = F.lower(F.regexp_extract(name, r"\.([^.#]+)(?:#[^.]*)?$", 1))
    lookup = F.create_map(*[F.lit(item) for pair in table.items() for item in pair])
    return F.when(_col(path).isNull(), F.lit(None)).otherwise(
        F.coalesce(F.try_element_at(lookup, extension), F.lit(UNKNOWN_TYPE))
    )
