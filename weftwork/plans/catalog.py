"""All named queries."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftwork.plans import catalog_events, catalog_io, catalog_pages, catalog_state, catalog_streams, catalog_tables, catalog_urls  # noqa: F401
from weftwork.plans.registry import ORACLES, QUERIES


def _in_utc(func):
    @functools.wraps(func)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return func(spark, folder)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _in_utc(func) for name, func in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
