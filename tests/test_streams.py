"""Streams in several triggers against their batch twins."""

import pytest
from pyspark.sql import functions as F

from weftwork import schemas
from weftwork.operators import aggregates, windows
from weftwork.streaming import seen, streams


@pytest.fixture(scope="module")
def log(spark):
    streams.use_rocksdb(spark)
    source = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string")))
    status = F.when(F.pmod(F.xxhash64("id"), F.lit(4)) == 0, "success").when(F.pmod(F.xxhash64("id"), F.lit(7)) == 0, "failed").otherwise("blocked")
    return spark.range(300).select(source.alias("source"), F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), status.alias("status"))


@pytest.fixture(scope="module")
def folder(spark, log, tmp_path_factory):
    """The log as three files that arrive one after the other."""
    path = tmp_path_factory.mktemp("log")
    for i in range(3):
        log.where(F.col("event_id").between(i * 100, i * 100 + 99)).coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


def arriving(spark, folder, log):
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def expected_runs(log):
    status = F.col("status")
    runs = windows.run_lengths(log, ["source"], ["ts", "event_id"], status == "blocked", status == "success")
    return windows.with_backoff(runs).select("source", "event_id", "status", "run", "backoff_s", "should_stop")


def test_block_runs_over_triggers(spark, log, folder, tmp_path):
    streams.write_block_runs(arriving(spark, folder, log), str(tmp_path / "out"), str(tmp_path / "cp"))
    out = spark.read.parquet(str(tmp_path / "out/rows")).select("source", "event_id", "status", "run", "backoff_s", "should_stop")
    assert rows(out) == rows(expected_runs(log))
    assert sorted(p.name for p in (tmp_path / "out/state").iterdir()) == ["batch_id=1", "batch_id=2"]


def test_alerts_over_triggers(spark, log, folder, tmp_path):
    streams.write_status_alerts(arriving(spark, folder, log), str(tmp_path / "out"), str(tmp_path / "cp"))
    want = windows.transitions(log, ["source"], ["ts", "event_id"], into=["blocked", "error", "hitl"]).select("source", "event_id", "status", "previous_status")
    out = spark.read.parquet(str(tmp_path / "out/rows")).drop("batch_id")
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


def test_counters_in_update_mode(spark, log, folder, tmp_path):
    streams.write_available(streams.status_counters(arriving(spark, folder, log), ["source"]), str(tmp_path / "out"), str(tmp_path / "cp"), "update")
    out = spark.read.parquet(str(tmp_path / "out"))
    last = aggregates.latest_row(out, ["source"], ["batch_id"], ["success", "failed", "blocked"])
    assert rows(last) == rows(aggregates.progress_counts(log, ["source"]))


def test_first_seen_across_triggers(spark, log, folder, tmp_path):
    keyed = arriving(spark, folder, log).select("source", "ts", "event_id")
    seen.write_first_seen(keyed, "source", str(tmp_path / "out"), str(tmp_path / "cp"), ["ts"])
    first = log.groupBy("source").agg(F.min("event_id"))
    assert rows(spark.read.parquet(str(tmp_path / "out/rows")).select("source", "event_id")) == rows(first)


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    out, schema = str(tmp_path), "url string, n int"
    put = lambda rows_, n: seen.add_batch(spark.createDataFrame(rows_, schema), "url", out, n, ["n"], buckets=3)
    put([("a", 2), ("b", 1), ("a", 1), (None, 7)], 0)
    put([("a", 0), ("c", 3), (None, 1)], 1)
    put([("a", 0), ("c", 4), (None, 1), ("null", 5), ("=", 6)], 1)
    put([(f"k{i}", i) for i in range(50)] + [("c", 1), ("", 9)], 2)
    got = {(r.batch_id, r.url, r.n) for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {(0, "a", 1), (0, "b", 1), (0, None, 7), (1, "c", 4), (1, "null", 5), (1, "=", 6), (2, "", 9)} | {(2, f"k{i}", i) for i in range(50)}


def test_full_filters_lose_nothing(spark, tmp_path):
    """A filter of one byte takes every key for seen; the buckets then tell."""
    for n in range(3):
        batch = spark.range(n * 20, n * 20 + 40).select(F.col("id").cast("string").alias("url"))
        seen.add_batch(batch, "url", str(tmp_path), n, buckets=4, filter_bytes=1)
    got = [(int(r.url), r.batch_id) for r in spark.read.parquet(f"{tmp_path}/rows").collect()]
    assert sorted(got) == [(i, 0 if i < 40 else 1 if i < 60 else 2) for i in range(80)]


def test_only_touched_buckets_are_read(spark, tmp_path):
    for n in range(2):
        seen.add_batch(spark.range(n * 500, n * 500 + 500).select(F.col("id").cast("string").alias("url")), "url", str(tmp_path), n, buckets=8)
    known = seen.known_keys(spark, str(tmp_path), [3], 2)
    assert all("bucket=3" in f for f in known.inputFiles()) or "PartitionFilters: [isnotnull(bucket" in known._jdf.queryExecution().toString()
    assert known.count() == spark.read.parquet(f"{tmp_path}/keys").where("bucket = 3").count()


def test_stall_alert(spark, tmp_path):
    streams.use_rocksdb(spark)
    schema = "source string, ts timestamp, remaining int"

    def put(rows_):
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    from datetime import datetime

    put([("a", datetime(2024, 1, 1, 0, 0), 3), ("b", datetime(2024, 1, 1, 0, 0), 0)])
    put([("c", datetime(2024, 1, 1, 2, 0), 1)])
    put([("c", datetime(2024, 1, 1, 2, 1), 1)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.write_available(streams.stall_alerts(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert {(r.source, r.stalled_at) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("a", datetime(2024, 1, 1, 0, 10))}


def test_late_rows_do_not_move_a_stall_timer(spark, tmp_path):
    streams.use_rocksdb(spark)
    from datetime import datetime

    at = lambda h, m: datetime(2024, 1, 1, h, m)
    for row in [("a", at(0, 5), 3), ("a", at(0, 4), 3), ("c", at(2, 0), 1), ("c", at(2, 1), 1)]:
        spark.createDataFrame([row], "source string, ts timestamp, remaining int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("source string, ts timestamp, remaining int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.write_available(streams.stall_alerts(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert {(r.source, r.stalled_at) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("a", at(0, 15))}


def test_a_url_seen_long_ago_is_not_new(spark, tmp_path):
    for day in (1, 20, 2):
        spark.sql(f"SELECT 'u' AS url, TIMESTAMP'2024-01-{day:02d} 00:00:00' AS ts").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("url string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen.write_first_seen(stream, "url", str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out/rows")).count() == 1


def test_progress_reader(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"url": "u", "status": "success", "timestamp": "2024-01-01T00:00:00Z"}\n')
    out = streams.collect_available(streams.read_progress(spark, str(tmp_path / "in"), 1), "progress_rows", str(tmp_path / "cp"))
    assert out.count() == 1 and out.columns == [c.split()[0] for c in schemas.PROGRESS.split(", ")]
