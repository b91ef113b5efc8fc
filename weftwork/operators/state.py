"""Mutable state on immutable files: a change log is the truth, the current table is its fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.functions.records import count_where, completion
from weftwork.functions.urls import netloc, scheme, source_id_from_url
from weftwork.operators.rows import newest_values


def upsert(state: DataFrame, changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The changes per key laid over the state, each column's newest non-null value; ``action`` is created, updated or kept.

    Columns missing from the changes, and nulls in all changes of a key, keep their old value.
    """
    newest = newest_values(changes, key, order)
    old = state.withColumn("_old", F.lit(True))
    joined = old.join(newest, key, "full_outer")
    values = [F.coalesce(F.col(f"_new.{c}"), F.col(c)).alias(c) if c in changes.columns else F.col(c) for c in state.columns if c != key]
    action = F.when(F.col("_new").isNull(), "kept").when(F.col("_old").isNull(), "created").otherwise("updated")
    return joined.select(key, *values, action.alias("action"))


def fold(log: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Current row per key from the change log."""
    newest = log.groupBy(key).agg(F.max_by(F.struct(*log.columns), F.struct(*order)).alias("_row"))
    return newest.select("_row.*")


def history(state: DataFrame, changes: DataFrame, key: str, order: Sequence[str], at: Column, details: Sequence[str] = ()) -> DataFrame:
    """One history row for each change: the first of a key that the state lacks is created, all others are updated.

    The id is made of the key, its time and its place in the order, not of a counter.
    """
    place = F.struct(*order)
    first = changes.groupBy(key).agg(F.min(place).alias("_first")).join(state.select(key), key, "left_anti")
    action = F.when(F.col("_first") == place, "created").otherwise("updated")
    rows = changes.join(first, key, "left").withColumn("action", action)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, *order)]
    return rows.select(F.md5(F.concat_ws("|", *parts, at.cast("string"), "action")).alias("id"), key, "action", at.alias("timestamp"), *details)


def story_counts(states: DataFrame, stories: str = "stories") -> DataFrame:
    """Adds totals, completed and status from an array of stories."""
    return states.withColumns({
        "stories_total": F.size(stories), "stories_completed": count_where(stories, lambda s: s["passes"]),
        "status": completion(stories, lambda s: s["passes"]),
    })


def get(state: DataFrame, key: str, value) -> DataFrame:
    return state.where(F.col(key) == value).limit(1)


def apply_changes(state: DataFrame, changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Each field's newest non-null change wins, others keep the state; unknown keys are ignored. Rows stay as many as they are."""
    names = [c for c in changes.columns if c != key and c in state.columns]
    out = state.join(newest_values(changes, key, order, names), key, "left")
    return out.select(*[F.coalesce(F.col(f"_new.{c}"), F.col(c)).alias(c) if c in names else F.col(c) for c in state.columns])


def delete(keys: DataFrame, key: str, *tables: DataFrame) -> list[DataFrame]:
    """The tables without the given keys: state, history and whatever else hangs on them."""
    gone = keys.select(key).distinct()
    return [t.join(gone, key, "left_anti") for t in tables]


def retries(state: DataFrame, events: DataFrame, key: str, status: str = "in_progress") -> DataFrame:
    """Retry events (key, ts, method) folded in: status, attempts, last attempt and method."""
    # Map-side combinable: a key with very many retries sends one row per task.
    seen = events.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.max("ts").alias("_last"), F.max_by("method", F.struct("ts", "method")).alias("_method")
    )
    out = state.join(seen, key, "left")
    hit = F.col("_n").isNotNull()
    return out.withColumns({
        "status": F.when(hit, status).otherwise(F.col("status")),
        "attempts": F.coalesce(F.col("attempts"), F.lit(0)) + F.coalesce(F.col("_n"), F.lit(0)),
        "last_attempt": F.coalesce("_last", "last_attempt"), "last_method": F.coalesce("_method", "last_method"),
    }).select(*state.columns)


def tables(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables()]


def drop_view(spark: SparkSession, name: str) -> None:
    spark.catalog.dropTempView(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def resume_points(checkpoints: DataFrame, keys: Sequence[str] = ("run_id",), order: Sequence[str] = ("saved_at", "checkpoint_id")) -> DataFrame:
    """The latest checkpoint per run."""
    newest = checkpoints.groupBy(*keys).agg(F.max_by(F.struct(*checkpoints.columns), F.struct(*order)).alias("_row"))
    return newest.select("_row.*")


def register_sources(state: DataFrame, new: DataFrame, key: str = "source_id", url: str = "url") -> DataFrame:
    """Rows for sites not in the queue yet, with starting values; unusable URLs are left out."""
    usable = new.where((scheme(url) != "") & (netloc(url) != ""))
    named = usable.withColumn(key, source_id_from_url(url))
    first = named.groupBy(key).agg(F.min(url).alias(url))
    fresh = first.join(state.select(key), key, "left_anti")
    counters = ["expected_urls", "urls_found", "html_scraped", "html_failed", "html_blocked", "builds", "mods"]
    domain = F.replace(netloc(url), F.lit("www."), F.lit(""))
    return fresh.select(
        key, F.initcap(F.replace(domain, F.lit("."), F.lit(" "))).alias("name"), url,
        F.concat(F.lit("data/"), key).alias("output_dir"), F.lit("pending").alias("status"), F.lit(5).alias("priority"),
        F.lit(0).alias("attempted"), *[F.lit(0).cast("bigint").alias(c) for c in counters],
    )
