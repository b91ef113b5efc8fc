"""User functions over partitions, with errors as data."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_rows(df: DataFrame, func: Callable[[dict], object], result: T.DataType, columns: list[str] | None = None, name: str = "result") -> DataFrame:
    """Adds ``func(row)`` and ``error``: a row that fails gets a null result and its message.

    Rows travel in Arrow batches; Spark's partitions and cores give the
    concurrency. ``columns`` limits what the function sees.
    """
    given = columns or df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(name, result), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results, errors = [], []
            for values in batch[given].itertuples(index=False, name=None):
                try:
                    results.append(func(dict(zip(given, values))))
                    errors.append(None)
                except Exception as problem:  # noqa: BLE001 - the error is the result
                    results.append(None)
                    errors.append(f"{type(problem).__name__}: {problem}")
            yield batch.assign(**{name: pd.Series(results, index=batch.index, dtype=object), "error": errors})

    return df.mapInPandas(run, schema)


def map_values(df: DataFrame, func: Callable[[dict], object], result: T.DataType, **kw) -> DataFrame:
    """``map_rows`` without the error text: failures become null."""
    return map_rows(df, func, result, **kw).drop("error")


def outcomes(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("error").isNull()).alias("success"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def explode_with(df: DataFrame, func: Callable[[dict], list[dict]], schema: T.StructType, columns: list[str], keep: list[str]) -> DataFrame:
    """One row to many: ``func`` returns a list of records of ``schema``."""
    out = T.StructType([*[df.schema[k] for k in keep], *schema.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                {**{k: row[k] for k in keep}, **record}
                for row in batch.to_dict("records") for record in func({c: row[c] for c in columns})
            ]
            yield pd.DataFrame(rows, columns=out.names)

    return df.mapInPandas(run, out)
