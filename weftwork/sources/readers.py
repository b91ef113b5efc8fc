"""Reading files of any of the known forms into tables."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftwork import schemas
from weftwork.functions import urls
from weftwork.operators.filters import url_of_entry
from weftwork.operators.scan import first_rows
from weftwork.session import checkpoint_dir

WRAPPERS = ["builds", "mods", "urls", "data", "items", "records"]
_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


# --- generic ingest --------------------------------------------------------


def read_jsonl(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_csv(spark: SparkSession, path) -> DataFrame:
    """Header and types from the file; give quoted fields both quoting styles."""
    return spark.read.csv(path, header=True, inferSchema=True, escape='"', multiLine=True)


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def read_json(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    """JSON documents: a list, or an object with a list under a known key, or one record.

    Strings in a list come back as column ``value``.
    """
    reader = spark.read.option("multiLine", True)
    raw = (reader.schema(schema) if schema else reader).json(path)
    for key in WRAPPERS:
        if key in raw.columns and isinstance(raw.schema[key].dataType, T.ArrayType):
            rows = raw.select(F.explode(key).alias("value"))
            return rows.select("value.*") if isinstance(rows.schema["value"].dataType, T.StructType) else rows
    if raw.columns == ["_corrupt_record"]:
        # A bare list of strings is not a record; read it as text.
        whole = spark.read.text(path, wholetext=True)
        return whole.select(F.explode(F.from_json("value", "array<string>")).alias("value"))
    return raw


_READERS = {".json": read_json, ".jsonl": read_jsonl, ".csv": read_csv, ".parquet": read_parquet}


def read_any(spark: SparkSession, path: str) -> DataFrame:
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in _READERS:
        raise ValueError(f"Unsupported file format: {suffix}")
    return _READERS[suffix](spark, path)


def import_file(spark: SparkSession, path: str, table: str, if_exists: str = "replace") -> int:
    """Reads a file by suffix into a table; ``if_exists``: replace, append or fail. Returns its rows."""
    if if_exists not in _MODES:
        raise ValueError(f"if_exists must be one of {sorted(_MODES)}")
    read_any(spark, path).write.mode(_MODES[if_exists]).saveAsTable(table)
    return spark.table(table).count()


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def register_pandas(spark: SparkSession, frame, name: str) -> DataFrame:
    return register(spark.createDataFrame(frame), name)


def numbers(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n)


# --- many files ------------------------------------------------------------

FILES_PER_READ, FOLDERS_PER_LOOKUP, LOOKUPS = 20_000, 200, 8


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def few_listing_tasks(spark: SparkSession) -> dict[str, str]:
    """A few tasks for each core list the files; Spark's own setting is a task for each path up to 10,000."""
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    """What a glob finds. Lists are fetched in parts and let go at once, as Python would keep them until it happens to collect its garbage."""
    jvm, let_go, path = spark._jvm, spark.sparkContext._gateway.detach, spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    if not found:
        return []
    paths, names = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found), []
    held = jvm.scala.runtime.ScalaRunTime.genericWrapArray(paths)
    let_go(found)
    for start in range(0, len(paths), FILES_PER_READ):
        part = held.slice(start, start + FILES_PER_READ)
        names += part.mkString("\0").split("\0")
        let_go(part)
    let_go(held)
    let_go(paths)
    return names


def _any_of(root: str, paths: list[str], below: str = "") -> str:
    """One pattern for just these paths, or for what a pattern finds below them.

    Hadoop resolves braces that hold folders into one pattern each and drops a backslash there; names need a second one.
    """
    below = re.sub(r"([\\,])", r"\\\1", below)
    return root + "{" + ",".join(re.sub(r"([\\{}\[\]*?,])", r"\\\\\\\1", p[len(root):]) + below for p in paths) + "}"


def file_batches(spark: SparkSession, pattern: str) -> Iterator[str]:
    """Patterns for ``FILES_PER_READ`` files each that together find what ``pattern`` finds.

    Folders are looked up level by level, on the last one by ``LOOKUPS`` threads with ``FOLDERS_PER_LOOKUP`` each, so that the driver holds no
    more than the names of one folder's folders besides the batch. Folders within braces are looked up at once.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(pattern).getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path("/")).toString()
    steps = [""]
    for part in [pattern] if re.search(r"\{.*/.*\}", pattern) else re.split("(?=/)", pattern):
        steps[-1] += part
        if re.search(r"[{}\[\]*?]", part):
            steps.append("")
    first, *rest = [step for step in steps if step]
    found = iter(_glob(spark, first))
    for i, step in enumerate(rest, 1):
        found = _below(spark, root, found, step, FOLDERS_PER_LOOKUP if i == len(rest) else 1)
    while batch := list(islice(found, FILES_PER_READ)):
        yield _any_of(root, batch)


def _below(spark: SparkSession, root: str, folders: Iterator[str], step: str, at_once: int) -> Iterator[str]:
    threads = LOOKUPS if at_once > 1 else 1
    with ThreadPoolExecutor(threads) as pool:
        while some := list(islice(folders, at_once * threads)):
            groups = [_any_of(root, some[i:i + at_once], step) for i in range(0, len(some), at_once)]
            for found in pool.map(partial(_glob, spark), groups):
                yield from found


# --- per-source data -------------------------------------------------------


def source_of_path(path) -> Column:
    """The folder above the file names the source, also where the file is itself a folder of part files."""
    return F.regexp_extract(urls._col(path), r"([^/]+)/(?:[^/]+\.jsonl?/part-)?[^/]+$", 1)


def with_source(df: DataFrame) -> DataFrame:
    return df.select("*", source_of_path(F.col("_metadata.file_path")).alias("source"))


def _lines(spark: SparkSession, path, schema: str) -> DataFrame:
    """Non-blank lines as (value, r, source); ``r._corrupt_record`` is set where a line is not JSON.

    Parsed from text, so that counts do not depend on which columns are read.
    """
    text = spark.read.text(path).select("value", source_of_path(F.col("_metadata.file_path")).alias("source"))
    parsed = F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return text.where(F.trim("value") != "").withColumn("r", parsed)


def _good(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("r._corrupt_record").isNull()).select("r.*", "source").drop("_corrupt_record")


def read_records(spark: SparkSession, pattern: str, schema: str, wrapper: str | None = None, fmt: str = "jsonl") -> DataFrame:
    """Records of all sources under a glob, with the source from the path.

    ``fmt`` json reads envelopes ``{wrapper: [...]}`` and bare lists alike.
    """
    if fmt == "jsonl":
        return _good(_lines(spark, pattern, schema))
    text = spark.read.text(pattern, wholetext=True)
    text = text.select("value", source_of_path(F.col("_metadata.file_path")).alias("source"))
    row = T.StructType.fromDDL(schema)
    bare = F.from_json("value", T.ArrayType(row))
    inside = F.from_json(F.get_json_object("value", f"$.{wrapper}"), T.ArrayType(row)) if wrapper else bare
    body = F.when(F.ltrim("value").startswith("["), bare).otherwise(inside)
    return text.select("source", F.explode(body).alias("r")).select("r.*", "source")


def read_dual(spark: SparkSession, folder: str, name: str, schema: str, prefer: str = "jsonl") -> DataFrame:
    """Records stored as ``{name}.jsonl`` or ``{name}.json``; per source the preferred form wins.

    Either is a file or a folder of files, each of which holds lines or one document.
    """
    parts = []
    for fmt in ("jsonl", "json"):
        pattern = f"{folder}/*/{name}.{fmt}"
        try:
            parts.append(read_records(spark, pattern, schema, name, fmt).withColumn("_rank", F.lit(0 if fmt == prefer else 1)))
        except Exception as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
    if not parts:
        raise FileNotFoundError(f"no {name}.jsonl or {name}.json under {folder}")
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    best = both.groupBy("source").agg(F.min("_rank").alias("_rank"))
    return both.join(best, ["source", "_rank"], "left_semi").drop("_rank")


def read_urls(spark: SparkSession, pattern: str) -> DataFrame:
    """(url, source) from ``urls.json`` envelopes or lists of strings or objects.

    Every file costs the driver some kilobytes from its listing to the end of its reading, so batches of files are read one
    after the other and their rows stored. A file weighs little in a task, and none is kept in Spark's cache of listings.
    """
    stored = f"{checkpoint_dir(spark)}/urls-{uuid.uuid4().hex}"
    small = {"spark.sql.files.openCostInBytes": "64k", "spark.sql.hive.filesourcePartitionFileCacheSize": "0"}
    with settings(spark, few_listing_tasks(spark) | small):
        batch = None
        for batch in file_batches(spark, pattern):
            _urls_in(spark, batch).write.mode("append").parquet(stored)
        if batch is None:
            return _urls_in(spark, pattern)  # nothing found: Spark's own error
    return spark.read.schema("url string, source string").parquet(stored)


def _urls_in(spark: SparkSession, pattern: str) -> DataFrame:
    text = spark.read.text(pattern, wholetext=True)
    text = text.select("value", source_of_path(F.col("_metadata.file_path")).alias("source"))
    entries = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.get_json_object("value", "$.urls"))
    listed = text.select("source", F.explode(F.from_json(entries, "array<string>")).alias("entry"))
    return listed.select(url_of_entry("entry").alias("url"), "source").where("url is not null")


def read_url_envelopes(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per ``urls.json``: urls, totalCount, lastUpdated, source."""
    df = spark.read.schema("urls array<string>, totalCount bigint, lastUpdated string").option("multiLine", True).json(pattern)
    return with_source(df)


def read_tolerant(spark: SparkSession, path, schema: str) -> DataFrame:
    """JSON lines; blank and unreadable lines are skipped."""
    return _good(_lines(spark, path, schema)).drop("source")


def read_with_rejects(spark: SparkSession, path, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that could not be read."""
    lines = _lines(spark, path, schema)
    return _good(lines).drop("source"), lines.where(F.col("r._corrupt_record").isNotNull()).select(F.col("value").alias("line"))


def read_progress(spark: SparkSession, path) -> DataFrame:
    """The append-only fetch log, with its source."""
    return _good(_lines(spark, path, schemas.PROGRESS))


def read_failures(spark: SparkSession, path: str, form: str) -> DataFrame:
    """(source, url, error) from any of the log forms: ``jsonl``, ``json`` or ``checkpoint``."""
    if form == "jsonl":
        log = read_progress(spark, path)
        return log.where(F.col("status").isin("failed", "blocked")).select("source", "url", "error")
    if form == "json":
        schema = "failedUrls array<struct<url:string,error:string>>"
        raw = with_source(spark.read.schema(schema).option("multiLine", True).json(path))
        return raw.select("source", F.explode("failedUrls").alias("f")).select("source", "f.url", "f.error")
    if form == "checkpoint":
        schema = "failed_urls array<string>, blocked_urls array<string>"
        raw = with_source(spark.read.schema(schema).option("multiLine", True).json(path))
        parts = [raw.select("source", F.explode(c).alias("url"), F.lit(e).alias("error")) for c, e in (("failed_urls", "failed"), ("blocked_urls", "blocked"))]
        return parts[0].union(parts[1])
    raise ValueError(f"unknown log form: {form}")


def read_csv_urls(spark: SparkSession, files: dict[str, str | None]) -> DataFrame:
    """(source, url) from CSV files with differing URL columns: ``{path: column}``; None skips a file."""
    parts = []
    for path, column in files.items():
        if column is None:
            continue
        df = spark.read.csv(path, header=True, escape='"', multiLine=True)
        if column in df.columns:
            source = urls.source_id_from_file(F.lit(os.path.basename(path)))
            parts.append(df.select(source.alias("source"), F.trim(F.col(f"`{column}`")).alias("url")))
    if not parts:
        return spark.createDataFrame([], "source string, url string")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.where(F.col("url").startswith("http")).distinct()


def read_urls_by_source(spark: SparkSession, path: str) -> DataFrame:
    """(source, url) from a folder per source of CSV files with a header, however many folders there are.

    The columns are given, as Spark would look at every file anew to find them.
    """
    with settings(spark, few_listing_tasks(spark)):
        return spark.read.schema("url string, source string").csv(path, header=True).select("source", "url")


def read_pages(spark: SparkSession, pattern: str) -> DataFrame:
    """Stored pages as (path, name, content, length): one row per file, bytes untouched."""
    df = spark.read.format("binaryFile").load(pattern)
    return df.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), source_of_pages("path").alias("source"), "modificationTime", "length", "content")


def source_of_pages(path) -> Column:
    """``…/{source}/html/{file}``."""
    return F.regexp_extract(urls._col(path), r"([^/]+)/html/[^/]+$", 1)


def file_inventory(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Every file below a folder: path, suffix, size, time. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(
        "path", name.alias("filename"), F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("suffix"), "length", "modificationTime"
    )


def read_log(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(schemas.LOG).json(path)


def log_tail(log: DataFrame, n: int, ts: str = "timestamp", tie: str = "message") -> DataFrame:
    """The newest ``n`` lines, newest first."""
    return log.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(n)


def log_tails(log: DataFrame, keys: list[str], n: int, ts: str = "timestamp", tie: str = "message") -> DataFrame:
    return first_rows(log, keys, [F.col(ts).desc(), F.col(tie).desc()], n)


_ENTITY = "struct<id:string,type:string,name:string,observations:array<string>,properties:string,createdAt:string,updatedAt:string>"
_RELATION = "struct<id:string,`from`:string,`to`:string,type:string,properties:string,createdAt:string>"
GRAPH = f"entities map<string,{_ENTITY}>, relations array<{_RELATION}>"


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entities (a map by id) and relations (a list) of stored graph documents."""
    return graph_tables(spark.read.schema(GRAPH).option("multiLine", True).json(path))


def graph_tables(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    entities = documents.select(F.explode("entities").alias("key", "e")).select(
        "e.id", "e.type", "e.name", "e.observations", "e.properties",
        F.try_to_timestamp("e.createdAt").alias("created_at"), F.try_to_timestamp("e.updatedAt").alias("updated_at"),
    )
    relations = documents.select(F.explode("relations").alias("r")).select(
        "r.id", F.col("r.from").alias("from_id"), F.col("r.to").alias("to_id"), F.col("r.type").alias("relation_type"),
        "r.properties", F.try_to_timestamp("r.createdAt").alias("created_at"),
    )
    return entities, relations


def api_items(payloads: DataFrame, column: str, base: str | None = None) -> DataFrame:
    """URLs of API answers: a list, or ``items`` / ``results`` / ``data``; url, link or href."""
    body = F.col(column)
    listed = F.when(F.ltrim(body).startswith("["), body).otherwise(
        F.coalesce(*[F.get_json_object(body, f"$.{k}") for k in ("items", "results", "data")])
    )
    entries = payloads.select(F.explode(F.from_json(listed, "array<string>")).alias("e"))
    url = F.coalesce(*[F.nullif(F.get_json_object("e", f"$.{k}"), F.lit("")) for k in ("url", "link", "href")])
    if base:
        url = F.when(url.startswith("/"), F.concat(F.lit(base.rstrip("/")), url)).otherwise(url)
    return entries.select(url.alias("url")).where("url is not null")
