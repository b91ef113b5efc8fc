"""Ranking, runs, sessions, quotas and other logic that depends on order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import buckets
from weftwork.operators import scan


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "rank", **kw) -> DataFrame:
    return scan.row_numbers(df, keys, order, name, **kw)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, by all other columns if none is given."""
    order = list(order or [c for c in df.columns if c not in keys])
    return scan.first_row(df, keys, order)


def distinct_on_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before, after and removed."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("before"), F.count(F.lit(1)).alias("after"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
    )


def dedupe_by(df: DataFrame, key: Column, position: str) -> DataFrame:
    """First row per derived key in position order; the original values stay."""
    rows = df.select(key.alias("_key"), F.struct(*df.columns).alias("_row"), F.col(position).alias("_at"))
    return rows.groupBy("_key").agg(F.min_by("_row", "_at").alias("_row")).select("_row.*")


def repeats(df: DataFrame, keys: Sequence[str], order: str, name: str = "is_repeat") -> DataFrame:
    """Marks rows that are not the first of their key; ``order`` is unique."""
    first = df.groupBy(*keys).agg(F.min(order).alias("_first"))
    first = first.select("_first", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    match = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(first, match, "left").select(*df.columns, (F.col(order) != F.col("_first")).alias(name))


def run_lengths(events: DataFrame, keys: Sequence[str], order: Sequence, hit: Column, reset: Column, name: str = "run", segments: int | None = None) -> DataFrame:
    """Consecutive hits up to each row; a reset starts again at 0, other rows leave the count."""
    return scan.scans(events, keys, list(order), {name: ("since", hit, reset)}, segments)


def with_backoff(runs: DataFrame, run: str = "run") -> DataFrame:
    """Wait before the next request, and whether to give up, from the run length."""
    return runs.withColumns({"backoff_s": buckets.backoff_seconds(run), "should_stop": F.col(run) >= vocab.STOP_AFTER_BLOCKS})


def transitions(events: DataFrame, keys: Sequence[str], order: Sequence, status: str = "status", into: Sequence[str] = ("blocked", "error", "hitl"), **kw) -> DataFrame:
    """Rows where the status changes to one that needs attention."""
    out = scan.previous(events, keys, order, {"previous_status": status}, **kw)
    return out.where(F.col(status).isin(list(into)) & ~F.col("previous_status").eqNullSafe(F.col(status)))


def first_seen(found: DataFrame, url: str = "url", page: str = "page", keys: Sequence[str] = ()) -> DataFrame:
    """New URLs per page, counting each URL on its first page only, with a running total."""
    first = found.groupBy(*keys, url).agg(F.min(page).alias(page))
    fresh = first.groupBy(*keys, page).agg(F.count(F.lit(1)).alias("new_urls"))
    pages = found.groupBy(*keys, page).agg(F.countDistinct(url).alias("found_urls"))
    joined = pages.join(fresh, [*keys, page], "left").fillna(0, ["new_urls"])
    return scan.running(joined, keys, [page], {"total_urls": ("sum", F.col("new_urls"))})


def stop_pages(per_page: DataFrame, quiet: int = 2, keys: Sequence[str] = (), page: str = "page") -> DataFrame:
    """The first page at which ``quiet`` pages in a row brought nothing new."""
    nothing = F.col("new_urls") == 0
    runs = run_lengths(per_page, keys, [page], nothing, ~nothing)
    return runs.where(F.col("run") >= quiet).groupBy(*keys).agg(F.min(page).alias("stop_page"))


def batches(df: DataFrame, order: Sequence, size: int, keys: Sequence[str] = (), name: str = "batch", **kw) -> DataFrame:
    """Batch number per row, ``size`` rows each, from 0."""
    out = scan.row_numbers(df, keys, order, "_n", **kw)
    return out.withColumn(name, F.floor((F.col("_n") - 1) / size)).drop("_n")


def sessions(events: DataFrame, keys: Sequence[str], order: Sequence, blocked: Column, pages: int = vocab.SESSION_PAGES, segments: int | None = None) -> DataFrame:
    """Fetch sessions: a block ends one, and so does every ``pages``-th page after the last block."""
    out = scan.scans(events, keys, list(order), {
        "block_sessions": ("sum", blocked.cast("bigint")), "session_part": ("since_before", F.lit(1), blocked),
    }, segments)
    # A session opens after a block, so the blocks before the row count, not the row's own.
    own = F.coalesce(blocked.cast("bigint"), F.lit(0))
    return out.withColumns({"block_sessions": F.coalesce("block_sessions", F.lit(0)) - own, "session_part": F.floor(F.col("session_part") / pages)})


def within_quota(events: DataFrame, n: int, order: Sequence, ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows of each day."""
    dated = events.withColumn("day", F.to_date(ts))
    return scan.first_rows(dated, [*keys, "day"], order, n, "day_rank")


def stalled(events: DataFrame, as_of: Column, keys: Sequence[str] = ("source",), ts: str = "ts", minutes: int = vocab.STALL_MINUTES, remaining: DataFrame | None = None) -> DataFrame:
    """Sources whose last update is too old while work remains (``remaining``: keys, remaining)."""
    last = events.groupBy(*keys).agg(F.max(ts).alias("last_update"))
    out = last.withColumns({"age_s": buckets.age_seconds("last_update", as_of), "stalled": buckets.is_stale("last_update", as_of, minutes)})
    if remaining is not None:
        out = out.join(remaining, list(keys)).withColumn("stalled", F.col("stalled") & (F.col("remaining") > 0))
    return out


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, name: str = "rank") -> DataFrame:
    """The newest ``n`` rows per key (retention, history)."""
    return scan.first_rows(df, keys, [F.col(o).desc() for o in order], n, name)


def iteration_durations(iterations: DataFrame) -> DataFrame:
    """Milliseconds per iteration and so far per run."""
    timed = iterations.withColumn("duration_ms", F.timestamp_diff("MILLISECOND", F.col("started_at"), F.col("ended_at")))
    return scan.running(timed, ["run_id"], ["started_at", "iteration_id"], {"total_ms": ("sum", F.col("duration_ms"))})
