"""All queries of the library and the SQL that they are checked against."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) under its name, with its SQL if it has one."""

    def register(f: Callable) -> Callable:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return register


from . import algebra, aligned, catalog, expressions, ingest, matchups, models, pyramids, readers, regrids, statistics, swaths, tiles  # noqa: E402, F401
