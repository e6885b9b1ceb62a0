"""Registry of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftloom.functions.numbers import round_py
from shiftloom.plans.oracle import with_tables
from shiftloom.sources.bindings import Plant

# Day ranges that cover all shifts and all events of the given tables.
FIRST, LAST = "1995-01-01", "2001-12-31"
EVENT_FIRST, EVENT_LAST = "2023-12-31", "2024-02-29"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(plant)`` under ``key``, with the SQL that must give the same rows."""

    def add(fn: Callable[[Plant], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"registered twice: {key}")
        QUERIES[key] = lambda spark, folder: fn(Plant(spark, folder))
        if sql is not None:
            ORACLES[key] = with_tables(sql)
        return fn

    return add


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Sums of doubles depend on the order of addition in their last digits; compare them rounded."""
    return df.withColumns({c: round_py(F.col(f"`{c}`"), places) for c in columns})
