"""One-row results next to each other, and the newest values of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    """``first`` with the columns of one-row aggregates added to every row.

    Each aggregate is a scalar subquery: computed once, joined with nothing.
    """
    out = first
    for other in others:
        names = out.columns
        row = other.select(F.struct(*other.columns).alias("row")).scalar()
        out = out.select(*names, row.alias("_row")).select(*names, *[F.col("_row")[c].alias(c) for c in other.columns])
    return out


def newest_values(changes: DataFrame, key: str, order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: ``_new``, a struct of each column's newest non-null value. Combines before the shuffle."""
    names = [c for c in changes.columns if c != key] if columns is None else columns
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in names]
    return changes.groupBy(key).agg(F.struct(*newest).alias("_new"))
