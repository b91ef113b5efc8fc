"""Named queries over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query; without ``sql`` it is covered by tests instead."""

    def add(func):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = func
        if sql is not None:
            ORACLES[name] = sql
        return func

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
