"""Where queries register, each with the SQL that says the same in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship
from ..sources.derive import derived, oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Derived and base tables by name: t.feed_queue."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        ship(spark)

    def __getattr__(self, name: str) -> DataFrame:
        return derived(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None, *uses: str) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables as a query; uses are the derived tables that its SQL names."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = oracle(sql, *uses)
        return f

    return add
