"""Named queries over the shared tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import load, prepare, spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


# Tables of long texts: every use is heavy per row.
HEAVY = {"documents", "pages"}


class Tables:
    """Attribute access to the tables of one folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        table = load(self.spark, self.sf_dir, name)
        return spread(table) if name in HEAVY else table


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key``."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(prepare(spark), sf_dir))
        if sql is not None:
            SQL[key] = sql
        return fn

    return register
