"""Registry of named queries: Spark plan + DuckDB oracle text.

Each registered callable takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the whole tables of ``sf_dir``.  Its oracle is SQL over the
same views (see :mod:`hiermatch.sources.views`); queries whose result is not
SQL-expressible register no oracle and are checked by unit tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from ..sources.views import oracle_ctes

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, views: tuple = ()):
    """Decorator: register a query and, when given, its oracle SQL over ``views``."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = compose(sql, views)
        return fn

    return deco


def compose(sql: str, views: tuple) -> str:
    """Prefix view CTEs to ``sql``; ``sql`` may start with its own ``WITH``."""
    body = sql.strip()
    if not views:
        return body
    head = oracle_ctes(views).rstrip()
    if body[:4].upper() == "WITH":
        return head + ",\n" + body[4:].lstrip()
    return head + "\n" + body
