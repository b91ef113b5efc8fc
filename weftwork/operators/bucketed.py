"""State as a table of hash buckets that a merge rewrites one by one.

A change touches its key's bucket alone, so a merge reads and writes the buckets that have changed keys and leaves all
others where they are: copy on write. Each version has a small manifest that says in which version's folder each bucket
lies; a reader of a version sees that version, whatever is written meanwhile, and a repeated merge replaces its own folder.

    path/data/version=V/bucket=B   the rows of a bucket as version V left them
    path/manifest/version=V        (bucket, held): the version whose folder holds the bucket
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.operators import state
from weftwork.session import checkpointed

BUCKETS = 256


def hashed(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def _write(rows: DataFrame, path: str, version: int) -> None:
    # All rows of a bucket in one file each; buckets are even, since they are hashes of unique keys.
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/version={version}")


def create(rows: DataFrame, path: str, bucket: Column) -> None:
    """Version 0 of a table, from rows with unique keys."""
    rows = checkpointed(rows.withColumn("bucket", bucket.cast("bigint")))
    _write(rows, path, 0)
    held = rows.select("bucket").distinct().withColumn("held", F.lit(0))
    held.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version=0")


def manifest(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("bucket bigint, held int").parquet(f"{path}/manifest/version={version}")


def read(spark: SparkSession, path: str, version: int, schema: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets, with bucket and held. Folders of other buckets are not read."""
    parts = manifest(spark, path, version)
    if buckets is not None:
        parts = parts.where(F.col("bucket").isin(list(buckets)))
    held = parts.groupBy("held").agg(F.collect_list("bucket").alias("buckets")).collect()  # as many rows as versions still in use
    data = spark.read.schema(f"{schema}, version int, bucket bigint").parquet(f"{path}/data").withColumnRenamed("version", "held")
    wanted = F.lit(False)
    for r in held:
        wanted = wanted | ((F.col("held") == r.held) & F.col("bucket").isin(r.buckets))
    return data.where(wanted)


def merge(spark: SparkSession, path: str, version: int, schema: str, changes: DataFrame, key: str, bucket: Column, apply: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Writes version ``version + 1``: ``apply`` (rows, changes) to the buckets that hold changed keys; returns their numbers.

    ``apply`` must keep every key in its bucket, as upserts and deletes by ``key`` do.
    """
    changes = checkpointed(changes.withColumn("bucket", bucket.cast("bigint")))
    touched = sorted(r.bucket for r in changes.select("bucket").distinct().collect())  # of the number of buckets at most
    rows = read(spark, path, version, schema, touched).drop("held", "bucket")
    names = rows.columns
    out = apply(rows, changes.drop("bucket")).select(*names)
    _write(out.withColumn("bucket", bucket.cast("bigint")), path, version + 1)
    before = manifest(spark, path, version).where(~F.col("bucket").isin(touched))
    now = spark.createDataFrame([(b, version + 1) for b in touched], "bucket bigint, held int")
    before.union(now).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version + 1}")
    return touched


def upsert(spark: SparkSession, path: str, version: int, schema: str, changes: DataFrame, key: str, order: Sequence[str], bucket: Column) -> list[int]:
    """``state.upsert`` into the touched buckets."""
    return merge(spark, path, version, schema, changes, key, bucket, lambda rows, new: state.upsert(rows, new, key, order).drop("action"))


def delete(spark: SparkSession, path: str, version: int, schema: str, keys: DataFrame, key: str, bucket: Column) -> list[int]:
    return merge(spark, path, version, schema, keys, key, bucket, lambda rows, gone: state.delete(gone, key, rows)[0])
