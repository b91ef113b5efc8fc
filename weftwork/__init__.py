"""Spark jobs that turn crawled pages into clean, audited, queryable tables."""

__version__ = "0.1.0"
