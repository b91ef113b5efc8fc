"""Writing tables out. Every sink is a distributed write; nothing passes the driver."""

from __future__ import annotations

import os
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftwork.functions.urls import page_filename
from weftwork.operators.joins import with_inventory
from weftwork.session import checkpoint_dir, checkpointed

_SUFFIXES = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".jsonl": "json"}


def export(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite") -> None:
    """Parquet, CSV with header or JSON lines; the format from the suffix if not given."""
    fmt = fmt or _SUFFIXES.get(os.path.splitext(path)[1].lower())
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError(f"Unsupported export format: {fmt or path}")
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


def export_table(spark: SparkSession, table: str, path: str, fmt: str | None = None) -> None:
    export(spark.table(table), path, fmt)


def export_query(spark: SparkSession, query: str, path: str, fmt: str | None = None, params=None) -> None:
    export(spark.sql(query, args=params) if params else spark.sql(query), path, fmt)


FOLDERS_PER_TASK = 200


def by_folder(df: DataFrame, *columns: str, rows: int = 1_000_000) -> DataFrame:
    """Rows of one folder together before a partitioned write, as a folder costs far more than its bytes.

    A task gets about ``FOLDERS_PER_TASK`` folders, however little they hold; a folder of over ``rows`` rows is dealt out by
    the hash of its rows, so that no task holds a large one.
    """
    counts = checkpointed(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")))
    size = counts.agg(F.count(F.lit(1)).alias("folders"), F.sum("_n").alias("rows")).first()
    hot = counts.where(F.col("_n") > rows).select(*[F.col(c).alias(f"_hot_{c}") for c in columns], F.ceil(F.col("_n") / rows).alias("_parts"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in columns])
    row = F.xxhash64(*[f"`{c}`" for c, kind in df.dtypes if "map<" not in kind])
    dealt = df.join(F.broadcast(hot), same, "left").withColumn("_part", F.when(F.col("_parts").isNotNull(), F.pmod(row, "_parts")))
    tasks = max(1, -(-size["folders"] // FOLDERS_PER_TASK), -(-(size["rows"] or 0) // rows))
    return dealt.repartition(tasks, *columns, "_part").select(*df.columns)


FOLDERS_PER_JOB = 20_000


def write_text_folders(df: DataFrame, path: str, column: str, rows: int = 1_000_000) -> None:
    """Texts as ``{path}/batch={n}/{column}={value}/``; a job writes one batch, about ``FOLDERS_PER_JOB`` folders.

    The driver keeps names and figures of each folder a job writes until it ends. Rows are stored by batch first, so that a
    job reads no others.
    """
    spark, stored = df.sparkSession, f"{checkpoint_dir(df.sparkSession)}/batches-{uuid.uuid4().hex}"
    batches = max(1, -(-df.agg(F.approx_count_distinct(column)).first()[0] // FOLDERS_PER_JOB))
    dealt = df.withColumn("batch", F.pmod(F.xxhash64(column), F.lit(batches)).cast("int"))
    dealt.hint("rebalance", "batch").write.partitionBy("batch").parquet(stored)
    held = spark.read.schema(T.StructType([*df.schema, T.StructField("batch", T.IntegerType())])).parquet(stored)
    for batch in range(batches):
        own = by_folder(held.where(F.col("batch") == batch).drop("batch"), column, rows=rows)
        own.write.partitionBy(column).text(f"{path}/batch={batch}")


def export_urls_by_source(urls: DataFrame, path: str) -> None:
    """One CSV folder per source."""
    by_folder(urls, "source").write.mode("overwrite").partitionBy("source").option("header", True).csv(path)


def save_urls(urls: DataFrame, path: str, source: str, as_of: Column | None = None) -> None:
    """URL records with file names, and one row of metadata next to them."""
    urls.select("url", page_filename("url").alias("filename")).write.mode("overwrite").json(f"{path}/urls")
    url_metadata(urls, source, as_of).write.mode("overwrite").json(f"{path}/urls_meta")


def url_metadata(urls: DataFrame, source: str, as_of: Column | None = None) -> DataFrame:
    when = as_of if as_of is not None else F.current_timestamp()
    return urls.agg(F.count(F.lit(1)).alias("totalCount")).select("totalCount", when.alias("lastUpdated"), F.lit(source).alias("source"))


def url_envelopes(urls: DataFrame, batch: int = 100_000) -> DataFrame:
    """Envelopes ``{source, part, totalCount, urls}`` with at most about ``batch`` URLs each.

    A source of any size is split by the hash of its URLs, so no task and no
    JSON document holds a whole source; totalCount is the source's own.
    """
    totals = urls.groupBy("source").agg(F.count(F.lit(1)).alias("totalCount"))
    parts = F.ceil(F.col("totalCount") / batch)
    spread = urls.join(totals, "source").withColumn("part", F.pmod(F.xxhash64("url"), parts))
    row = F.struct("url", *(["filename"] if "filename" in urls.columns else []))
    return spread.groupBy("source", "part", "totalCount").agg(F.array_sort(F.collect_list(row)).alias("urls"))


def write_envelopes(urls: DataFrame, path: str) -> None:
    by_folder(url_envelopes(urls), "source", rows=10).write.mode("overwrite").partitionBy("source").json(path)


def sorted_urls(urls: DataFrame) -> DataFrame:
    """Distinct URLs in order; a range sort, spread over tasks."""
    return urls.select("url").distinct().orderBy("url")


def write_manifest(completed: DataFrame, files: DataFrame, path: str) -> None:
    """Completed URLs with the size of their stored page, or that it is missing."""
    with_inventory(completed, files).write.mode("overwrite").json(path)


def save_graph(entities: DataFrame, relations: DataFrame, path: str) -> None:
    entities.write.mode("overwrite").parquet(f"{path}/entities")
    relations.write.mode("overwrite").parquet(f"{path}/relations")


def graph_views(entities: DataFrame, relations: DataFrame) -> None:
    """Session views over the graph: sources with counters, and named relations."""
    from weftwork.operators import graph

    entities.createOrReplaceTempView("entities")
    relations.createOrReplaceTempView("relations")
    graph.source_view(entities).createOrReplaceTempView("source_summary")
    graph.named_relations(relations, entities).createOrReplaceTempView("entity_relationships")


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def append_progress(records: DataFrame, path: str) -> None:
    records.select("url", "filename", "status", "error", "timestamp").write.mode("append").json(path)


def append_events(events: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Typed events, laid out by type and day so that readers can skip files."""
    dated = events.withColumn("date", F.to_date(ts))
    by_folder(dated, "event_type", "date").write.mode("append").partitionBy("event_type", "date").parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)
