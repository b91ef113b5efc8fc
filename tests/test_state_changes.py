from pyspark.sql import functions as F

from weftwork.operators import aggregates, joins, state
from weftwork.sources.writers import url_envelopes


def test_partial_changes_of_one_key_all_count(spark):
    old = spark.createDataFrame([("k", "old", "x", 0), ("l", "same", "y", 0)], "id string, status string, amount string, at int")
    changes = spark.createDataFrame([("k", "new", None, 1), ("k", None, "b", 2), ("m", "first", None, 1)], "id string, status string, amount string, at int")
    got = {r.id: (r.status, r.amount, r.at, r.action) for r in state.upsert(old, changes, "id", ["at"]).collect()}
    assert got == {"k": ("new", "b", 2, "updated"), "l": ("same", "y", 0, "kept"), "m": ("first", None, 1, "created")}


def test_every_change_has_a_history_row(spark):
    old = spark.createDataFrame([("k", "old")], "id string, status string")
    changes = spark.createDataFrame([("k", "a", 1), ("k", "b", 2), ("m", "c", 1), ("m", "d", 2)], "id string, status string, at int")
    got = state.history(old, changes, "id", ["at"], F.col("at"), ["status"]).collect()
    assert len({r[0] for r in got}) == 4
    assert sorted((r[1], r.action, r.status) for r in got) == [("k", "updated", "a"), ("k", "updated", "b"), ("m", "created", "c"), ("m", "updated", "d")]


def test_repeated_keys_do_not_double_rows(spark):
    old = spark.createDataFrame([("k", "old", 1)], "id string, status string, n int")
    changes = spark.createDataFrame([("k", "a", None, 1), ("k", None, 5, 2), ("x", "b", 1, 1)], "id string, status string, n int, at int")
    assert [tuple(r) for r in state.apply_changes(old, changes, "id", ["at"]).collect()] == [("k", "a", 5)]
    merged = joins.upsert_entities(old, changes, "id", ["status", "n"], ["at"]).collect()
    assert sorted(tuple(r) for r in merged) == [("k", "a", 5, "updated"), ("x", "b", 1, "created")]


def test_retries_at_one_time_have_one_outcome(spark):
    old = spark.createDataFrame([("k", "blocked", 0, None, None)], "id string, status string, attempts int, last_attempt int, last_method string")
    for order in (("a", "b"), ("b", "a")):
        events = spark.createDataFrame([("k", 1, m) for m in order], "id string, ts int, method string")
        assert tuple(state.retries(old, events, "id").first()) == ("k", "in_progress", 2, 1, "b")


def test_envelopes_are_counted_per_source(spark):
    urls = spark.range(30).select(F.when(F.col("id") < 20, "a").otherwise("b").alias("source"), F.concat(F.lit("u"), "id").alias("url"))
    parts = url_envelopes(urls, batch=4).withColumn("lastUpdated", F.lit("2024-01-01"))
    assert sorted((r.source, r.actual, r.count_check) for r in aggregates.declared_counts(parts).collect()) == [("a", 20, "ok"), ("b", 10, "ok")]


def test_a_merge_rewrites_touched_buckets_alone(spark, tmp_path):
    from weftwork.operators import bucketed

    path, schema, bucket = str(tmp_path), "k bigint, v string", bucketed.hashed("k", 8)
    bucketed.create(spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v")), path, bucket)
    changes = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (200, "n", 1)], "k bigint, v string, n int")
    touched = bucketed.upsert(spark, path, 0, schema, changes, "k", ["n"], bucket)
    assert bucketed.upsert(spark, path, 0, schema, changes, "k", ["n"], bucket) == touched and len(touched) <= 2
    assert sorted(p.name for p in (tmp_path / "data/version=1").iterdir() if p.is_dir()) == [f"bucket={b}" for b in touched]
    rows = {r.k: r.v for r in bucketed.read(spark, path, 1, schema).collect()}
    assert rows == {i: "c" if i == 1 else "a" for i in range(100)} | {200: "n"}
    gone = bucketed.delete(spark, path, 1, schema, spark.createDataFrame([(5,), (900,)], "k bigint"), "k", bucket)
    now = bucketed.read(spark, path, 2, schema)
    assert {r.k for r in now.collect()} == set(rows) - {5} and {r.bucket for r in now.where("held = 2").collect()} <= set(gone)
    assert {r.k: r.v for r in bucketed.read(spark, path, 0, schema).collect()} == {i: "a" for i in range(100)}
