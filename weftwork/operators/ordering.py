"""Queues, top-k, pages of results, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import buckets
from weftwork.operators import scan
from weftwork.operators.rows import beside


def priority() -> Column:
    return F.coalesce(F.col("priority"), F.lit(vocab.DEFAULT_PRIORITY))


def next_source(sources: DataFrame, statuses: Sequence[str] = ("pending", "in_progress"), skip_blocked: bool = False) -> DataFrame:
    """The one source to work on next: lowest priority value, then name."""
    rows = sources.where(F.col("status").isin(list(statuses)))
    if skip_blocked:
        rows = rows.where(F.col("status") != "blocked")
    return rows.orderBy(priority(), "name").limit(1)


def next_in_file_order(sources: DataFrame, position: str) -> DataFrame:
    """Started sources first, then waiting ones, in file order."""
    rank = F.when(F.col("status") == "in_progress", 0).when(F.col("status") == "pending", 1)
    return sources.where(rank.isNotNull()).orderBy(rank, position).limit(1)


def most_recent(df: DataFrame, status: str, updated: str, tie: str) -> DataFrame:
    return df.where(F.col("status") == status).orderBy(F.col(updated).desc(), tie).limit(1)


def sort_key(mode: str) -> list[Column]:
    """Sort columns of a source list by mode; ties by name."""
    def zero(name):
        return F.coalesce(F.col(name), F.lit(0))

    progress = F.coalesce(F.try_divide(zero("html_scraped"), F.col("urls_found")), F.lit(0.0))
    keys = {
        "name": [], "urls": [zero("urls_found").desc()], "html": [zero("html_scraped").desc()],
        "builds": [zero("builds").desc()], "progress": [progress.desc()], "status": [buckets.status_rank("status")],
    }
    return [*keys[mode], F.col("name")]


def sorted_sources(sources: DataFrame, mode: str = "status") -> DataFrame:
    return sources.orderBy(*sort_key(mode))


def result_page(df: DataFrame, order: Sequence, number: int, size: int) -> DataFrame:
    """Page ``number`` (from 0) with the rows that remain after it.

    Sorted and cut by Spark's top-k; the total is one more aggregate.
    """
    order = scan.order_columns(order)
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    page = df.orderBy(*order).offset(number * size).limit(size)
    rest = F.greatest(F.col("_total") - (number + 1) * size, F.lit(0))
    return beside(page, total).withColumn("remaining", rest).drop("_total")


def write_ranked(df: DataFrame, order: Sequence, path: str) -> None:
    """Stores rows in order, a folder for each range of them, with the rows before each: an index by position.

    Built once, it gives any page by reading the folder or two that hold it (``ranked_page``).
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = scan.order_columns(order)
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    ranged.write.mode("overwrite").partitionBy("_range").parquet(f"{path}/rows")
    sizes = df.sparkSession.read.parquet(f"{path}/rows").groupBy("_range").agg(F.count(F.lit(1)).alias("size"))
    # One row for each range.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def ranked_page(spark: SparkSession, path: str, order: Sequence, number: int, size: int) -> DataFrame:
    """Page ``number`` (from 0) of what ``write_ranked`` stored, with the rows that remain after it; only its ranges are read."""
    index = spark.read.parquet(f"{path}/index").collect()  # one row for each range
    first, last = number * size, (number + 1) * size
    ranges = [r for r in index if r.before < last and r.before + r["size"] > first]
    total = max((r.before + r["size"] for r in index), default=0)
    rows = spark.read.parquet(f"{path}/rows").where(F.col("_range").isin([r["_range"] for r in ranges])).drop("_range")
    page = rows.orderBy(*scan.order_columns(order)).offset(first - min((r.before for r in ranges), default=first)).limit(size)
    return page.withColumn("remaining", F.lit(max(total - last, 0)).cast("bigint"))


def worst_sources(report: DataFrame, n: int = 20) -> DataFrame:
    return report.orderBy(F.col("issues").desc(), "quality", "source").limit(n)


def sample(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """The same ``n`` pseudo-random rows every time, by the hash of key and seed."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key).limit(n)


def extrapolated(sampled: DataFrame, population: DataFrame, counters: Sequence[str]) -> DataFrame:
    """Counts over a sample scaled to the population, rounded down.

    ``sampled`` is one row with the counters and ``sample_size``; ``population``
    one row with ``population``.
    """
    ratio = F.try_divide(F.col("population"), F.col("sample_size"))
    return beside(sampled, population).withColumns({c: F.floor(F.col(c) * ratio) for c in counters})


def latest_patterns(patterns: DataFrame, n: int, stage: str | None = None) -> DataFrame:
    rows = patterns if stage is None else patterns.where(F.col("stage") == stage)
    return rows.orderBy(F.col("created_at").desc(), "id").limit(n)


def after(df: DataFrame, order: Sequence, done: int, **kw) -> DataFrame:
    """What is left when the first ``done`` rows are finished."""
    return scan.row_numbers(df, [], order, "_n", **kw).where(F.col("_n") > done).drop("_n")


def select_sources(sources: DataFrame, chosen: DataFrame) -> DataFrame:
    """Chosen sources start with priority 1; others give way."""
    marked = sources.join(chosen.select("source").distinct().withColumn("_chosen", F.lit(True)), "source", "left")
    picked = F.col("_chosen").isNotNull()
    current = F.coalesce(F.col("priority"), F.lit(5))
    return marked.withColumns({
        "status": F.when(picked, "in_progress").otherwise(F.col("status")),
        "priority": F.when(picked, 1).when(current < 5, 5).otherwise(F.col("priority")),
    }).drop("_chosen")


def auto_priority(sources: DataFrame) -> DataFrame:
    """Found but not fetched: 1; waiting without a priority: 5; the rest keep theirs."""
    ready = (F.coalesce(F.col("urls_found"), F.lit(0)) > 0) & (F.coalesce(F.col("html_scraped"), F.lit(0)) == 0)
    waiting = (F.col("status") == "pending") & F.col("priority").isNull()
    return sources.withColumn("priority", F.when(ready, 1).when(waiting, 5).otherwise(F.col("priority")))
