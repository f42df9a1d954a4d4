"""Queries over the test tables, each with the SQL that must give the same rows.

``BOOK`` maps a name to ``(query, sql)``; ``sql`` is None where plain SQL cannot say it.
"""

from querybook import columns, documents, grids, payloads, responses, sinks, text

BOOK = {
    name: pair
    for module in (payloads, columns, text, responses, documents, grids, sinks)
    for name, pair in module.BOOK.items()
}

__all__ = ["BOOK"]
