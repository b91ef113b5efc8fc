"""Keys a stream has ever seen, as a table instead of state that grows in the executors for ever.

Keys lie in folders by hash bucket, and each bucket has a Bloom filter. The filters settle most new keys without reading
any; the others are looked up in the buckets they fall into, and no other bucket is read. All is written by batch number,
so a repeated batch replaces itself.

    path/rows/batch_id=N           first rows of the keys that batch N brought
    path/keys/batch_id=N/bucket=B  those keys
    path/filters/batch_id=N        one Bloom filter for each bucket with keys; those of the last two batches stay
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftwork.session import checkpointed, remove

BUCKETS = 64
FILTER_BYTES = 1 << 17  # a bucket of 100,000 keys is read for one new key in 150
PROBES = 5
_KEYS = "key string, bucket bigint"


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), key), F.lit(buckets))


def _places(low: np.ndarray, high: np.ndarray, size: int) -> np.ndarray:
    """The bits of each key, one row per probe, from its two hashes."""
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((low.view(np.uint64) + steps * (high.view(np.uint64) | np.uint64(1))) % np.uint64(size * 8)).astype(np.int64)


def _bits(filters: pa.Table, size: int) -> np.ndarray:
    raw = filters.column("bits")[0].as_py() if filters.num_rows else bytes(size)
    return np.frombuffer(raw, np.uint8).copy()


def _tester(size: int):
    def run(keys: pa.Table, filters: pa.Table) -> pa.Table:
        bits = _bits(filters, size)
        at = _places(np.asarray(keys.column("low")), np.asarray(keys.column("high")), size)
        maybe = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=0)
        return keys.append_column("maybe", pa.array(maybe, pa.bool_()))

    return run


def _filler(size: int):
    def run(keys: pa.Table, filters: pa.Table) -> pa.Table:
        bits = _bits(filters, size)
        at = _places(np.asarray(keys.column("low")), np.asarray(keys.column("high")), size).reshape(-1)
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        bucket = (keys if keys.num_rows else filters).column("bucket")[0].as_py()
        return pa.table({"bucket": pa.array([bucket], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    return run


def add_batch(batch: DataFrame, key: str, path: str, batch_id: int, order: list[str] | None = None, buckets: int = BUCKETS, filter_bytes: int = FILTER_BYTES) -> None:
    """Writes the first row of each key of ``batch`` that no earlier batch had.

    The first is the smallest by ``order`` and then by all columns. A null key is a key like any other.
    """
    spark = batch.sparkSession
    order = [*(order or []), *[c for c in batch.columns if c not in (order or [])]]
    firsts = batch.groupBy(key).agg(F.min_by(F.struct(*batch.columns), F.struct(*order)).alias("_row"))
    named = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null")).alias("key")
    firsts = checkpointed(firsts.select(named, "_row").withColumns({"bucket": _bucket(F.col("key"), buckets), "low": F.xxhash64("key"), "high": F.xxhash64(F.lit(1), F.col("key"))}))
    filters = spark.read.parquet(f"{path}/filters/batch_id={batch_id - 1}") if batch_id else spark.createDataFrame([], "bucket bigint, bits binary")

    keys = firsts.select("key", "bucket", "low", "high")
    tested = keys.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(_tester(filter_bytes), f"{_KEYS}, low bigint, high bigint, maybe boolean")
    tested = checkpointed(tested)
    maybe = tested.where("maybe")
    touched = [r.bucket for r in maybe.select("bucket").distinct().collect()]  # of ``buckets`` at most
    fresh = tested.where("NOT maybe")
    if touched:
        fresh = fresh.union(maybe.join(known_keys(spark, path, touched, batch_id), ["key", "bucket"], "left_anti"))
    fresh.select("key", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/keys/batch_id={batch_id}")
    written = _read(spark, f"{path}/keys/batch_id={batch_id}")
    firsts.join(written, ["key", "bucket"], "left_semi").select("_row.*").write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
    added = firsts.select("key", "bucket", "low", "high").join(written, ["key", "bucket"], "left_semi")
    filled = added.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(_filler(filter_bytes), "bucket bigint, bits binary")
    filled.write.mode("overwrite").parquet(f"{path}/filters/batch_id={batch_id}")
    remove(spark, f"{path}/filters/batch_id={batch_id - 2}")


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_KEYS).parquet(path)


def known_keys(spark: SparkSession, path: str, touched: list[int], before: int) -> DataFrame:
    """The keys that batches before ``before`` left in the buckets ``touched``; no other folder is read."""
    known = spark.read.schema(f"{_KEYS}, batch_id bigint").parquet(f"{path}/keys")
    return known.where(F.col("bucket").isin(touched) & (F.col("batch_id") < before)).select("key", "bucket")


def write_first_seen(stream: DataFrame, key: str, path: str, checkpoint: str, order: list[str] | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Each key once, however late it comes again: processes what has arrived and stops."""

    def store(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch, key, path, batch_id, order, buckets)

    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
