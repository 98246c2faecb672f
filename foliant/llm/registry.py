"""The queries of this subpackage."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("survivors", "langid", "charforms", "scanfix", "nearcopies", "names", "pieces", "packing", "mixing", "sentences")


def _modules():
    return [importlib.import_module(f"foliant.llm.{m}") for m in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _modules():
        out.update(m.SQL)
    return out
