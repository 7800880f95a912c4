"""Names of all queries of the core and their SQL twins."""

from __future__ import annotations

from . import catalog_queries


def queries() -> dict:
    return dict(catalog_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(catalog_queries.SQL)
