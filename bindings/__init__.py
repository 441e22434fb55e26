"""The operators bound to the test tables, each next to the SQL that must agree with it."""

from __future__ import annotations


def all_queries() -> dict:
    """Query name to (Spark function, SQL or None)."""
    from bindings import landing, regions, reports, texts, warehousing

    found: dict = {}
    for module in (reports, texts, landing, warehousing, regions):
        found.update(module.QUERIES)
    return found
