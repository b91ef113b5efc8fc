"""The progress, quota, alert and metric logic over growing logs.

Each stream has a batch twin in ``operators``; the tests hold them to the same
answers. Keyed state is one small record per source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from weftwork import schemas, vocab
from weftwork.operators import aggregates, extraction, scan, windows
from weftwork.session import remove

# State operators keep their values in RocksDB, which spills to disk.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def read_progress(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.PROGRESS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(schemas.LOG).json(path)


def status_counters(log: DataFrame, keys: list[str]) -> DataFrame:
    """Running counts per source; write in update or complete mode."""
    return aggregates.progress_counts(log, keys)


def daily_quota(log: DataFrame, limit: int, keys: list[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Requests per source and day, and whether the day's limit is used up."""
    days = log.withWatermark(ts, delay).groupBy(F.window(ts, "1 day"), *keys).agg(F.count(F.lit(1)).alias("count"))
    return days.select(F.to_date("window.start").alias("day"), *keys, "count", (F.col("count") >= limit).alias("limit_reached"))


def metric_windows(http: DataFrame, every: str = "1 hour", delay: str = "10 minutes", ts: str = "timestamp", keys: list[str] | None = None) -> DataFrame:
    """Request metrics per interval, written once the watermark has passed it."""
    marked = http.withWatermark(ts, delay).withColumn("interval", F.window(ts, every))
    return aggregates.http_metrics(marked, ["interval", *(keys or [])])


def error_breaker(log: DataFrame, keys: list[str], limit: int = 10, every: str = "1 hour", delay: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Intervals with more errors than the limit."""
    errors = log.where(F.col("is_error")).withWatermark(ts, delay)
    counts = errors.groupBy(F.window(ts, every), *keys).agg(F.count(F.lit(1)).alias("errors"))
    return counts.where(F.col("errors") > limit).select(F.col("window.start").alias("start"), *keys, "errors")


def idle_gaps(log: DataFrame, keys: list[str], ts: str = "ts", gap: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Stretches of activity; each ends where a source stalled for longer than the gap."""
    stretches = log.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"))
    return stretches.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("stalled_at"), "events")


class StallTimer(StatefulProcessor):
    """A row when a source has been silent for the stall time while work remains.

    Times are milliseconds. The state holds the newest row, so that older rows, however admissible, move nothing; of
    rows of one time the one with least work left counts.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "ms bigint, remaining bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = tuple(int(x) for x in self.newest.get()) if self.newest.exists() else None
        newest = before
        for frame in rows:
            top = frame.sort_values(["ms", "remaining"], ascending=[True, False]).iloc[-1]
            row = (int(top["ms"]), int(top["remaining"]))
            if newest is None or row[0] > newest[0] or (row[0] == newest[0] and row[1] < newest[1]):
                newest = row
        if newest != before:
            if before is not None:
                self.handle.deleteTimer(before[0] + self.wait)
            if newest[1] > 0:
                self.handle.registerTimer(newest[0] + self.wait)
            self.newest.update(newest)
        yield pd.DataFrame({"source": pd.Series(dtype="object"), "stalled_ms": pd.Series(dtype="int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"source": [key[0]], "stalled_ms": [expiredTimerInfo.getExpiryTimeInMs()]})

    wait = vocab.STALL_MINUTES * 60_000

    def close(self) -> None:
        pass


def stall_alerts(log: DataFrame, delay: str = "1 minute") -> DataFrame:
    rows = log.where("ts IS NOT NULL").withWatermark("ts", delay)
    rows = rows.select("source", "ts", F.unix_millis("ts").alias("ms"), F.coalesce("remaining", F.lit(0)).alias("remaining"))
    found = rows.groupBy("source").transformWithStateInPandas(StallTimer(), "source string, stalled_ms bigint", "Append", "EventTime")
    return found.select("source", F.timestamp_millis("stalled_ms").alias("stalled_at"))


def _write_in_order(log: DataFrame, path: str, checkpoint: str, columns: dict[str, tuple], shape) -> StreamingQuery:
    """Ordered logic per source over triggers; no source has to fit one task.

    Each trigger is a distributed batch job: what a range segment does to the state that enters it composes with the
    other segments (``scan.scans_and_state``), and the state each source left the last trigger with is a small table that
    enters the first of them. Folders below ``path`` carry the batch number, so a repeated batch replaces itself:
    ``rows/`` has what ``shape`` makes of the rows, ``state/`` the sources of the last two batches.
    """
    spark = log.sparkSession

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("source", "event_id", "ts", "status")
        before = spark.read.parquet(f"{path}/state/batch_id={batch_id - 1}") if batch_id else None
        out, state = scan.scans_and_state(rows, ["source"], ["ts", "event_id"], columns, before)
        shape(out).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        state.write.mode("overwrite").parquet(f"{path}/state/batch_id={batch_id}")
        remove(spark, f"{path}/state/batch_id={batch_id - 2}")

    query = log.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def write_block_runs(log: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """(source, event_id, ts, status) → consecutive blocks up to each row, the wait they call for and the stop flag."""
    status = F.col("status")
    columns = {"run": ("since", status == "blocked", status == "success")}
    return _write_in_order(log, path, checkpoint, columns, lambda rows: windows.with_backoff(rows).select("source", "event_id", "status", "run", "backoff_s", "should_stop"))


def write_status_alerts(log: DataFrame, path: str, checkpoint: str, into: Sequence[str] = ("blocked", "error", "hitl")) -> StreamingQuery:
    """(source, event_id, ts, status) → one row where a source enters a status that needs attention."""

    def alerts(rows: DataFrame) -> DataFrame:
        entered = F.col("status").isin(list(into)) & ~F.col("previous_status").eqNullSafe(F.col("status"))
        return rows.where(entered).select("source", "event_id", "status", "previous_status")

    return _write_in_order(log, path, checkpoint, {"previous_status": ("previous", "status")}, alerts)


def extract_builds(pages: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Build records of newly arrived pages."""
    return extraction.builds(pages, vehicles)


def write_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> StreamingQuery:
    """Processes what has arrived and stops; run it again for what comes later.

    Complete mode rewrites the result with every batch. Update mode keeps one
    folder per batch, so that a repeated batch replaces itself.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.format(fmt).start(path)
    else:
        def store(batch: DataFrame, batch_id: int) -> None:
            target = path if mode == "complete" else f"{path}/batch_id={batch_id}"
            batch.write.mode("overwrite").format(fmt).save(target)

        query = writer.foreachBatch(store).start()
    query.awaitTermination()
    return query


def collect_available(stream: DataFrame, name: str, checkpoint: str | None = None, mode: str = "append") -> DataFrame:
    """The same into a memory table, for tests and small results."""
    writer = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    writer.start().awaitTermination()
    return stream.sparkSession.table(name)
