"""The registered queries: each name with its plan and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.plans import aggregates, filters, functions, joins, outer, scans, vectors  # noqa: F401
from foliant.plans.registry import QUERIES, SQL, Query


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES["src4_items_with_text"](spark, folder)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
