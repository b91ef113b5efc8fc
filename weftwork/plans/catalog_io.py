"""Round trips: the given tables written in each form and read back.

Every query writes to a new folder below the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.operators import filters
from weftwork.operators.rows import beside
from weftwork.plans import standins
from weftwork.plans.registry import query, table
from weftwork.plans.standins import with_ctes
from weftwork.session import checkpoint_dir
from weftwork.sources import readers, writers


def _home(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/io-{uuid.uuid4().hex}"


_CUSTOMERS = "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer"


def _customers(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@query("io_parquet", _CUSTOMERS)
def io_parquet(spark, sf):
    path = f"{_home(spark)}/t.parquet"
    writers.export(_customers(spark, sf), path)
    return readers.read_any(spark, path)


@query("io_csv", "SELECT CAST(c_custkey AS INT) AS c_custkey, c_name || ', \"x\"' AS c_name, c_mktsegment, c_acctbal FROM customer")
def io_csv(spark, sf):
    """Commas and quotes inside fields survive; header and types come from the file."""
    path = f"{_home(spark)}/t.csv"
    writers.export(_customers(spark, sf).withColumn("c_name", F.concat("c_name", F.lit(', "x"'))), path)
    return readers.read_csv(spark, path)


@query("io_jsonl", _CUSTOMERS)
def io_jsonl(spark, sf):
    path = f"{_home(spark)}/t.jsonl"
    writers.export(_customers(spark, sf), path)
    return readers.read_jsonl(spark, path, "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double")


@query("io_query_export", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 1000 GROUP BY 1")
def io_query_export(spark, sf):
    path = f"{_home(spark)}/q.parquet"
    readers.register(_customers(spark, sf), "customer_export")
    writers.export_query(spark, "SELECT c_mktsegment, count(*) AS n FROM customer_export WHERE c_acctbal > :low GROUP BY 1", path, params={"low": 1000})
    return readers.read_parquet(spark, path)


@query("io_json_documents", _CUSTOMERS)
def io_json_documents(spark, sf):
    """Wrapped documents of bounded size, one per key range, unwrapped again."""
    path = f"{_home(spark)}/docs"
    part = F.expr("c_custkey div 50")
    documents = _customers(spark, sf).groupBy(part.alias("part")).agg(F.collect_list(F.struct("c_custkey", "c_name", "c_mktsegment", "c_acctbal")).alias("items"))
    documents.select(F.to_json(F.struct("items")).alias("value"), "part").write.partitionBy("part").text(path)
    record = "struct<c_custkey:bigint,c_name:string,c_mktsegment:string,c_acctbal:double>"
    return readers.read_json(spark, f"{path}/*", f"items array<{record}>")


@query("io_builds_by_source", with_ctes("builds", "SELECT source, build_id, make, model FROM builds"))
def io_builds_by_source(spark, sf):
    """Records of many sources under one glob; the source comes from the folder."""
    path = _home(spark)
    standins.builds(spark, sf).select("source", "build_id", "make", "model", F.col("source").alias("folder")).write.partitionBy("folder").json(path)
    rows = readers.read_records(spark, f"{path}/*/*.json", "build_id bigint, make string, model string")
    return rows.withColumn("source", F.regexp_replace("source", "^folder=", ""))


@query("io_url_lists", with_ctes("log", "SELECT DISTINCT source, url FROM log"))
def io_url_lists(spark, sf):
    """URL envelopes per source, read back as (url, source)."""
    path = _home(spark)
    urls = standins.log(spark, sf).select("source", "url").distinct()
    envelopes = writers.url_envelopes(urls)
    rows = envelopes.select(F.to_json(F.struct("urls", "totalCount")).alias("value"), F.col("source").alias("folder"))
    writers.write_text_folders(rows, path, "folder", rows=10)
    return readers.read_urls(spark, f"{path}/*/*/*.txt").select("url", F.regexp_replace("source", "^folder=", "").alias("source"))


@query("io_url_csv", with_ctes("log", "SELECT DISTINCT source, url FROM log"))
def io_url_csv(spark, sf):
    path = _home(spark)
    writers.export_urls_by_source(standins.log(spark, sf).select("source", "url").distinct(), path)
    return readers.read_urls_by_source(spark, path)


@query("io_progress_log", with_ctes("log", "SELECT url, filename, status, error FROM log UNION ALL SELECT url, filename, status, error FROM log WHERE status = 'blocked'"))
def io_progress_log(spark, sf):
    """Two appends to a fetch log, read with unreadable lines between them."""
    path = _home(spark)
    rows = standins.log(spark, sf).withColumn("timestamp", F.col("ts").cast("timestamp"))
    writers.append_progress(rows, path)
    writers.append_progress(rows.where("status = 'blocked'"), path)
    rows.where("status = 'failed'").select(F.lit("{broken").alias("value")).write.mode("append").text(path)
    return readers.read_progress(spark, path).select("url", "filename", "status", "error")


@query("io_failures", with_ctes("log", "SELECT url, error FROM log WHERE status IN ('failed', 'blocked')"))
def io_failures(spark, sf):
    path = _home(spark)
    writers.append_progress(standins.log(spark, sf).withColumn("timestamp", F.col("ts").cast("timestamp")), path)
    return readers.read_failures(spark, path, "jsonl").select("url", "error")


_DOCUMENT = 100_000  # records of a wrapped document


def _move(spark, source, target):
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path(source)):
        files.mkdirs(path(target).getParent())
        files.rename(path(source), path(target))


def _dual(spark, sf, prefer):
    """Sites 0 to 4 as JSON lines, 3 to 6 as wrapped documents: 3 and 4 have both.

    A site's lines lie in as many files as tasks wrote them, its documents in files of one document with at most about
    ``_DOCUMENT`` records each, so no task and no document holds a whole site.
    """
    path, orders = _home(spark), table(spark, sf, "orders").select((F.col("o_custkey") % 7).alias("site"), "o_orderkey")
    lines = orders.where("site < 5").select("site", F.to_json(F.struct("o_orderkey", F.lit("jsonl").alias("form"))).alias("value"))
    lines.write.partitionBy("site").text(f"{path}.lines")
    whole = orders.where("site > 2").withColumn("form", F.lit("json"))
    parts = max(1, -(-whole.count() // _DOCUMENT))
    wrapped = whole.groupBy("site", F.pmod(F.xxhash64("o_orderkey"), F.lit(parts)).alias("part")).agg(F.collect_list(F.struct("o_orderkey", "form")).alias("builds"))
    wrapped.select("site", F.to_json(F.struct("builds")).alias("value")).write.partitionBy("site").option("maxRecordsPerFile", 1).text(f"{path}.documents")
    for site in range(7):
        _move(spark, f"{path}.lines/site={site}", f"{path}/s{site}/builds.jsonl")
        _move(spark, f"{path}.documents/site={site}", f"{path}/s{site}/builds.json")
    return readers.read_dual(spark, path, "builds", "o_orderkey bigint, form string", prefer).groupBy("form").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("io_dual_lines_first", "SELECT form, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM (SELECT o_orderkey, CASE WHEN o_custkey % 7 < 5 THEN 'jsonl' ELSE 'json' END AS form FROM orders) GROUP BY 1")
def io_dual_lines_first(spark, sf):
    return _dual(spark, sf, "jsonl")


@query("io_dual_documents_first", "SELECT form, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM (SELECT o_orderkey, CASE WHEN o_custkey % 7 > 2 THEN 'json' ELSE 'jsonl' END AS form FROM orders) GROUP BY 1")
def io_dual_documents_first(spark, sf):
    return _dual(spark, sf, "json")


@query("io_csv_urls", "SELECT CASE page_id % 3 WHEN 0 THEN 'first' ELSE 'second' END AS source, trim(url) AS url, count(*) AS n FROM (SELECT DISTINCT page_id % 3 AS page_id, trim(url) AS url FROM pages WHERE page_id % 3 < 2 AND trim(url) LIKE 'http%') GROUP BY ALL")
def io_csv_urls(spark, sf):
    """URLs from CSV files whose columns have different names; a file without such a column is skipped."""
    path, pages = _home(spark), table(spark, sf, "pages")
    for part, (name, column) in enumerate((("first", "link"), ("second", "URL"), ("third", "other"))):
        pages.where(f"page_id % 3 = {part}").select("page_id", F.col("url").alias(column)).write.csv(f"{path}/{name}.csv", header=True, escape='"')
    files = {f"{path}/first.csv": "link", f"{path}/second.csv": "URL", f"{path}/third.csv": None}
    return readers.read_csv_urls(spark, files).groupBy("source", "url").agg(F.count(F.lit(1)).alias("n"))


@query("io_event_store", "SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-10' GROUP BY ALL")
def io_event_store(spark, sf):
    """Events laid out by type and day; the filter reads only the folders it needs."""
    path = _home(spark)
    writers.append_events(table(spark, sf, "events").withColumnRenamed("ts", "timestamp"), path)
    stored = readers.read_parquet(spark, path).where("event_type = 'click' and date >= '2024-01-10'")
    return stored.groupBy("event_type", F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"))


@query("io_structured_log", "SELECT event_type AS level, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def io_structured_log(spark, sf):
    path = _home(spark)
    rows = table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.col("event_type").alias("level"), F.lit("m").alias("message"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("data"),
    )
    writers.append_log(rows, path)
    log = readers.read_log(spark, path)
    return log.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.col("data")["user"]).alias("users"))


@query("io_saved_urls", "SELECT url, count(*) OVER () AS total FROM pages")
def io_saved_urls(spark, sf):
    path = _home(spark)
    writers.save_urls(table(spark, sf, "pages"), path, "all", F.lit("2024-01-01"))
    meta = spark.read.json(f"{path}/urls_meta").select(F.col("totalCount").alias("total"))
    return beside(spark.read.json(f"{path}/urls").select("url"), meta)


@query("io_page_files", "SELECT CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS bytes, count(DISTINCT page_id % 20) AS sources FROM pages")
def io_page_files(spark, sf):
    """Stored page files with their sizes and sources, without decoding them."""
    path = _home(spark)
    pages = table(spark, sf, "pages").select("html", (F.col("page_id") % 20).alias("site"))
    pages.write.partitionBy("site").option("lineSep", "\n").text(path)
    files = readers.file_inventory(spark, path, "*.txt")
    return files.agg(F.sum("length").alias("bytes"), F.countDistinct(readers.source_of_path("path")).alias("sources"))


@query("io_manifest", "SELECT d.doc_id || '.html' AS filename, p.page_id IS NOT NULL AS file_exists FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id")
def io_manifest(spark, sf):
    path = _home(spark)
    done = table(spark, sf, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".html")).alias("filename"))
    files = table(spark, sf, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("filename"), F.octet_length("html").alias("length"))
    writers.write_manifest(done, files, path)
    return spark.read.schema("filename string, file_exists boolean").json(path)


@query("io_graph", with_ctes("entities relations", "SELECT a.name AS from_entity, relation_type, b.name AS to_entity FROM relations r JOIN entities a ON r.from_id = a.id JOIN entities b ON r.to_id = b.id"))
def io_graph(spark, sf):
    """The graph as two stored tables with its views."""
    path = _home(spark)
    entities = standins.entities(spark, sf).withColumn("properties", F.lit("{}"))
    writers.save_graph(entities, standins.relations(spark, sf), path)
    writers.graph_views(readers.read_parquet(spark, f"{path}/entities"), readers.read_parquet(spark, f"{path}/relations"))
    return filters.execute(spark, "SELECT from_entity, relation_type, to_entity FROM entity_relationships")


@query("io_graph_documents", "SELECT 's' || s_suppkey AS id, s_name AS name, 's' || s_suppkey AS from_id, 'n' || s_nationkey AS to_id FROM supplier")
def io_graph_documents(spark, sf):
    """Graph documents (entity map and relation list), one per supplier, read into the two tables."""
    path = _home(spark)
    c = F.col
    key = F.concat(F.lit("s"), c("s_suppkey").cast("string"))
    entity = F.struct(key.alias("id"), F.lit("supplier").alias("type"), c("s_name").alias("name"), F.array(F.lit("o")).alias("observations"))
    relation = F.struct(F.concat(F.lit("r"), key).alias("id"), key.alias("from"), F.concat(F.lit("n"), c("s_nationkey").cast("string")).alias("to"), F.lit("in").alias("type"))
    table(spark, sf, "supplier").select(F.create_map(key, entity).alias("entities"), F.array(relation).alias("relations")).write.json(path)
    documents = f"{path}/*.json"
    entities, relations = readers.graph_tables(spark.read.schema(readers.GRAPH).json(documents))
    named = entities.select("id", "name").join(relations.select("from_id", "to_id"), F.col("id") == F.col("from_id"))
    return named


@query("io_inline_rows", "SELECT c_custkey, c_custkey % 3 AS k, CASE c_custkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS label FROM customer")
def io_inline_rows(spark, sf):
    """A literal table next to a given one."""
    labels = filters.execute(spark, "SELECT * FROM VALUES (0L, 'a'), (1L, 'b'), (2L, 'c') AS t(k, label)")
    rows = table(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") % 3).alias("k"))
    return rows.join(labels, "k")


@query("io_number_table", "SELECT o_custkey AS id, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT i, 0 FROM range((SELECT max(o_custkey) + 1 FROM orders)) t(i) WHERE i NOT IN (SELECT o_custkey FROM orders)")
def io_number_table(spark, sf):
    """A generated range up to the largest customer, joined with the orders it counts."""
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.max("id")).first()[0]
    return readers.numbers(spark, 0 if top is None else top + 1).join(counts, "id", "left").fillna(0, ["n"])


@query("io_report", with_ctes("log", "SELECT source, count(*) AS total FROM log GROUP BY 1"))
def io_report(spark, sf):
    path = _home(spark)
    writers.write_report(standins.log(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("total")), path)
    return spark.read.schema("source string, total bigint").json(path)

