"""Streams over the events table, run to the end of what is there.

Each run writes to a new folder below the shared checkpoint folder and the
query reads the result back from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.plans import standins
from weftwork.plans.catalog_events import _RUN
from weftwork.plans.registry import query, table
from weftwork.plans.standins import with_ctes
from weftwork.session import checkpoint_dir
from weftwork.sources import writers
from weftwork.streaming import seen, streams

# As many files as one trigger should read; the table given here is one file.
_GLOB = "event[s].parquet"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/{_GLOB}")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(stream: DataFrame, mode: str = "append") -> DataFrame:
    spark = stream.sparkSession
    streams.use_rocksdb(spark)
    home = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = stream.schema
    streams.write_available(stream, f"{home}/out", f"{home}/checkpoint", mode)
    return spark.read.schema(schema).parquet(f"{home}/out")


def _run_in_order(write, stream: DataFrame) -> DataFrame:
    spark = stream.sparkSession
    home = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    write(stream, f"{home}/out", f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/out/rows").drop("batch_id")


@query("stream_status_counts", with_ctes("log", "SELECT source, count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'blocked') AS blocked FROM log GROUP BY source"))
def stream_status_counts(spark, sf):
    """Running counters per source; the last state of each is kept."""
    return _run(streams.status_counters(standins.log_of(_events(spark, sf)), ["source"]), "complete")


@query("stream_progress_log", with_ctes("log", "SELECT status, count(*) AS n FROM log GROUP BY 1"))
def stream_progress_log(spark, sf):
    """A fetch log in JSON lines, read as it grows: some of its files come after the stream has stopped once."""
    home = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = standins.log(spark, sf).withColumn("timestamp", F.col("ts").cast("timestamp"))
    for part in range(2):
        writers.append_progress(rows.where(F.col("event_id") % 2 == part), f"{home}/log")
        streams.write_available(streams.read_progress(spark, f"{home}/log", 3), f"{home}/out", f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/out").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("stream_dedup", "SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY ALL")
def stream_dedup(spark, sf):
    """Each key once, ever."""
    keyed = _events(spark, sf).withColumn("key", F.concat_ws("/", "user_id", "event_type"))
    out = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    seen.write_first_seen(keyed.select("key", "ts", "user_id", "event_type"), "key", out, f"{out}/checkpoint", ["ts"])
    return spark.read.parquet(f"{out}/rows").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


_LAST = "SELECT max(ts) FROM events"


@query("stream_daily_quota", f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, user_id, count(*) AS "count", count(*) >= 3 AS limit_reached FROM events GROUP BY 1, 2
HAVING date_trunc('day', min(ts)) + INTERVAL 1 DAY <= ({_LAST}) - INTERVAL 1 HOUR""")
def stream_daily_quota(spark, sf):
    """Requests per user and day for days the watermark has closed."""
    out = _run(streams.daily_quota(_events(spark, sf), 3, ["user_id"]))
    return out.select(F.col("day").cast("string").alias("day"), "user_id", "count", "limit_reached")


@query("stream_metric_windows", with_ctes("http", f"""
SELECT strftime(date_trunc('hour', timestamp), '%Y-%m-%d %H') AS hour, count(*) AS total_requests, count(*) FILTER (WHERE status_code BETWEEN 200 AND 299) AS successful_requests, count(*) FILTER (WHERE is_blocked) AS blocked_requests, CAST(sum(response_body_size) AS BIGINT) AS bytes_downloaded
FROM http GROUP BY 1 HAVING date_trunc('hour', min(timestamp)) + INTERVAL 1 HOUR <= ({_LAST}) - INTERVAL 10 MINUTE"""))
def stream_metric_windows(spark, sf):
    http = standins.http_of(_events(spark, sf))
    out = _run(streams.metric_windows(http))
    return out.select(F.date_format("interval.start", "yyyy-MM-dd HH").alias("hour"), "total_requests", "successful_requests", "blocked_requests", "bytes_downloaded")


@query("stream_error_breaker", f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1
HAVING count(*) > 10 AND date_trunc('day', min(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events WHERE event_type = 'error') - INTERVAL 10 MINUTE""")
def stream_error_breaker(spark, sf):
    """Days with more than ten errors."""
    marked = _events(spark, sf).withColumn("is_error", F.col("event_type") == "error")
    out = _run(streams.error_breaker(marked, [], every="1 day"))
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "errors")


@query("stream_idle_gaps", f"""
WITH g AS (SELECT user_id, ts, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 172800000000, true) AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, count(*) FILTER (WHERE opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS events FROM s GROUP BY user_id, n HAVING max(ts) + INTERVAL 2 DAY <= ({_LAST}) - INTERVAL 1 HOUR""")
def stream_idle_gaps(spark, sf):
    """Stretches of activity per user that ended with two silent days."""
    out = _run(streams.idle_gaps(_events(spark, sf), ["user_id"], gap="2 days"))
    return out.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "events")


@query("stream_block_runs", with_ctes("log", _RUN + "SELECT event_id, source, status, run, least(300 * 2 ** run, 1800)::BIGINT AS backoff_s, run >= 5 AS should_stop FROM r"))
def stream_block_runs(spark, sf):
    """Consecutive blocks over triggers, whatever the size of a source."""
    return _run_in_order(streams.write_block_runs, standins.log_of(_events(spark, sf)))


@query("stream_transitions", """
SELECT event_id, source, status, previous_status FROM (SELECT event_id, 'site_' || user_id AS source, CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'blocked' ELSE 'ok' END AS status, lag(CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'blocked' ELSE 'ok' END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_status FROM events)
WHERE status IN ('error', 'blocked') AND status IS DISTINCT FROM previous_status""")
def stream_transitions(spark, sf):
    kind = F.col("event_type")
    status = F.when(kind == "error", "error").when(kind == "signup", "blocked").otherwise("ok")
    rows = _events(spark, sf).select(F.concat(F.lit("site_"), F.col("user_id").cast("string")).alias("source"), "event_id", "ts", status.alias("status"))
    return _run_in_order(streams.write_status_alerts, rows)


@query("stream_stall_alerts", """
WITH n AS (SELECT user_id, epoch_us(ts) // 1000 AS ms, event_id % 3 AS remaining FROM events),
l AS (SELECT user_id, max(ms) AS ms, (array_agg(remaining ORDER BY ms DESC, remaining))[1] AS remaining FROM n GROUP BY 1)
SELECT 'site_' || user_id AS source, make_timestamp((ms + 600000) * 1000) AS stalled_at FROM l WHERE remaining > 0 AND ms + 600000 < (SELECT max(ms) - 60000 FROM n)""")
def stream_stall_alerts(spark, sf):
    """Sources silent for ten minutes with work left, found by event-time timers."""
    rows = _events(spark, sf).select(F.concat(F.lit("site_"), F.col("user_id").cast("string")).alias("source"), "ts", (F.col("event_id") % 3).alias("remaining"))
    return _run(streams.stall_alerts(rows))


@query("stream_page_builds", with_ctes("dirty", "SELECT CAST(md5_number_upper(trim(url)) % 9223372036854775808 AS BIGINT) AS build_id, url AS source_url FROM pages"))
def stream_page_builds(spark, sf):
    """Build records of pages as they arrive."""
    pages = table(spark, sf, "pages")
    arriving = spark.readStream.schema(pages.schema).parquet(f"{sf}/page[s].parquet").withColumn("slug", F.lit("none"))
    nation = table(spark, sf, "nation")
    vehicles = nation.select(F.col("n_name").alias("slug"), F.lit("BMW").alias("make"), F.col("n_name").alias("model"), F.lit("").alias("package_name"))
    return _run(streams.extract_builds(arriving, vehicles).drop("gallery_images")).select("build_id", "source_url")
