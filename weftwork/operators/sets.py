"""Set operations on tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key), key, "left_semi")


def compare(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Sizes of both differences and the intersection in one join."""
    a, b = left.select(key).distinct().withColumn("_a", F.lit(1)), right.select(key).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.agg(
        F.count_if(F.col("_b").isNull()).alias("only_left"), F.count_if(F.col("_a").isNull()).alias("only_right"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("common"),
    )


def bag_union(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; missing columns are null, repeats stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def embedded_mods(builds: DataFrame) -> DataFrame:
    """The modifications inside builds as rows."""
    return builds.select("build_id", F.explode("modifications").alias("m")).select("build_id", "m.*")


def all_mods(standalone: DataFrame, builds: DataFrame) -> DataFrame:
    """Mods of the file and of the builds together; one in both counts twice."""
    return bag_union(standalone, embedded_mods(builds))


def url_union(*tables: DataFrame, column: str = "url") -> DataFrame:
    return reduce(DataFrame.union, [t.select(column) for t in tables]).distinct().orderBy(column)


def without_bad_files(log: DataFrame, pages: DataFrame, key: str = "filename", reason: str = "reason") -> DataFrame:
    """Progress rows whose page is not corrupt, to be written to a new place."""
    bad = pages.where(F.col(reason) != "valid").select(key).distinct()
    return log.join(bad, key, "left_anti")
