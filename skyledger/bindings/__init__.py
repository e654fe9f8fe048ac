"""The operators bound to the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ("routes", "flights", "timetable", "consolidation", "values", "pages", "collection", "files", "written")


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name in MODULES:
        found.update(import_module(f"{__name__}.{name}").QUERIES)
    return found


def all_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in MODULES:
        found.update(import_module(f"{__name__}.{name}").SQL)
    return found
