"""Where queries are entered, with the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def enter(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return enter


def live_sql(*columns: str) -> str:
    """The live items with the given columns, each item once."""
    return f"(SELECT DISTINCT item_id, {', '.join(columns)} FROM zotero_items WHERE NOT coalesce(deleted, false))"


def once_sql(table: str, *columns: str) -> str:
    return f"(SELECT DISTINCT {', '.join(columns) or '*'} FROM {table})"
