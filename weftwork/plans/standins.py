"""Tables of the crawl domain, derived from the given tables.

The given tables hold no sources, fetch logs, builds or mods; these projections
stand in for them. They are plain CASE arithmetic in SQL that Spark and the
checking engine read alike, so that each operator under test is the only part
written twice. Every row of the given table takes part.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.plans.registry import table

# --- URLs and pages --------------------------------------------------------

DIRTY_URL = """CASE page_id % 6
  WHEN 0 THEN replace(url, 'example', 'EXAMPLE')
  WHEN 1 THEN replace(url, '#top', '') || (CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END) || 'fbclid=z9&b=2&a=1'
  WHEN 2 THEN '  ' || url || ' '
  WHEN 3 THEN replace(url, '://', '://www.')
  WHEN 4 THEN url || '/'
  ELSE url END"""

URL_POOL_SQL = f"""SELECT page_id * 2 AS position, url FROM pages
  UNION ALL SELECT page_id * 2 + 1 AS position, {DIRTY_URL} AS url FROM pages"""

# One variant of markup per rule that classifiers look for.
DIRTY_HTML = """CASE page_id % 14
  WHEN 0 THEN ''
  WHEN 1 THEN substr(html, 30)
  WHEN 2 THEN '<html><head></head><body>' || repeat('é', 120) || '</body></html>'
  WHEN 3 THEN html || '<p>Access denied. 403 Forbidden. Too many requests, captcha</p>'
  WHEN 4 THEN html || 'Page 2 of 45 <a class="x" rel="next" href="/list?page=3">Next</a> <a href="/list?page=44">44</a>'
  WHEN 5 THEN html || 'Showing 1-20 of 1,234 results <div data-infinite="1"></div>'
  WHEN 6 THEN html || '<button class="b">Load more</button>'
  WHEN 7 THEN '<!DOCTYPE html><html><head><title>Just a moment...</title></head><body>cloudflare challenge ray id checking your browser</body></html>'
  WHEN 8 THEN html || '404 not found, this page does not exist, members only, coming soon'
  WHEN 9 THEN 'nothing here'
  WHEN 10 THEN html || '<meta property="og:title" content="Car &amp; more | Shop"><meta property="og:image" content="https://img.example.com/og.jpg"><link rel="canonical" href="https://shop.example.com/c"><meta name="description" content="A fine car"><script type="application/ld+json">{"a": 1}</script>'
  WHEN 11 THEN html || '<table><tr><th>Part</th><th>Price</th></tr><tr><td>Wheel</td><td>10</td></tr><tr><td>Seat</td><td>20</td></tr></table><div data-lot="77" data-price="1200" data-status="sold"></div>'
  WHEN 12 THEN html || '<div class="wp-block-gallery"><img src="https://img.example.com/a.jpg"><img src="https://img.example.com/b.jpg"></div><div class="wp-block-image"><img src="https://img.example.com/a.jpg"><img src="/c.jpg"></div>'
  ELSE html || '<ul class="wp-block-list"><li><a href="/x">Milltek cat back exhaust</a></li><li>KW coilover set</li><li>Click here to order</li><li>KW Coilover Set</li></ul><div class="wc-block-grid__product-title">ECU remap stage 2</div><h2 class="wp-block-heading">Carbon upgrades</h2><p>The package includes, Carbon splitter, Carbon diffuser, small wing.</p>'
  END"""

STATUS_CODE = "CASE page_id % 9 WHEN 0 THEN 403 WHEN 1 THEN 429 WHEN 2 THEN 503 WHEN 3 THEN 522 WHEN 4 THEN 404 WHEN 5 THEN 500 ELSE 200 END"

DIRTY_PAGES_SQL = f"SELECT page_id, url, {DIRTY_HTML} AS html, {STATUS_CODE} AS status_code, CAST(page_id % 20 AS STRING) AS page_group FROM pages"

# --- fetch log and queue ---------------------------------------------------

LOG_SQL = """SELECT event_id, ts, 'site_' || CAST(user_id AS STRING) AS source,
  'https://site-' || CAST(user_id AS STRING) || '.example.com/item/' || CAST(k % 40 AS STRING) AS url,
  CAST(k % 40 AS STRING) || '.html' AS filename,
  CASE WHEN event_type <> 'error' THEN 'success' WHEN value > 40 THEN 'blocked' ELSE 'failed' END AS status,
  CASE WHEN event_type <> 'error' THEN NULL ELSE CASE k % 11
    WHEN 0 THEN 'getaddrinfo failed to resolve' WHEN 1 THEN 'Connection timed out' WHEN 2 THEN 'HTTP 403 Forbidden'
    WHEN 3 THEN '429 Too Many Requests' WHEN 4 THEN 'Cloudflare challenge' WHEN 5 THEN 'HTTP 502 Bad Gateway'
    WHEN 6 THEN '404 gone' WHEN 7 THEN 'SSL certificate expired' WHEN 8 THEN 'connection reset'
    WHEN 9 THEN 'read timeout' ELSE 'strange' END END AS error,
  value, event_type, k
FROM (SELECT *, {K} AS k FROM events)"""
_SPARK_K = "CAST(get_json_object(props, '$.k') AS INT)"
_DUCK_K = "CAST(json_extract_string(props, '$.k') AS INT)"
LOG_ORACLE = LOG_SQL.replace("{K}", _DUCK_K)

SOURCES_SQL = """SELECT source, source AS source_id, 'Site ' || substr(source, 6) AS name,
  CASE n % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'blocked' WHEN 3 THEN 'completed' ELSE 'skip' END AS status,
  CASE WHEN u % 7 = 0 THEN NULL ELSE u % 10 + 1 END AS priority,
  'data/' || source AS output_dir, u AS position,
  CASE WHEN u % 11 = 0 THEN NULL ELSE n END AS urls_found, n + u % 3 AS expected_urls,
  CASE WHEN u % 13 = 0 THEN 0 ELSE ok END AS html_scraped, bad AS html_failed,
  CASE WHEN u % 3 = 0 THEN blocked ELSE 0 END AS html_blocked,
  CASE WHEN u % 4 = 0 THEN NULL ELSE ok / 4 - ok / 4 % 1 END AS builds_raw,
  CASE WHEN u % 4 = 0 THEN NULL ELSE ok % 5 END AS builds, CASE WHEN u % 6 = 0 THEN NULL ELSE ok % 3 END AS mods
FROM (SELECT source, CAST(substr(source, 6) AS INT) AS u, count(*) AS n,
    count(CASE WHEN status = 'success' THEN 1 END) AS ok, count(CASE WHEN status = 'failed' THEN 1 END) AS bad,
    count(CASE WHEN status = 'blocked' THEN 1 END) AS blocked
  FROM log GROUP BY source)""".replace("  CASE WHEN u % 4 = 0 THEN NULL ELSE ok / 4 - ok / 4 % 1 END AS builds_raw,\n", "")

# --- builds and mods -------------------------------------------------------

BUILDS_SQL = """SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS build_id,
  o_orderkey AS row_id, 'src' || CAST(o_custkey % 20 AS STRING) AS source,
  CASE o_orderkey % 8 WHEN 0 THEN 'listing' WHEN 1 THEN 'auction' WHEN 2 THEN 'build_thread' WHEN 3 THEN 'project'
    WHEN 4 THEN 'gallery' WHEN 5 THEN 'article' WHEN 6 THEN 'showcase' END AS source_type,
  CASE o_orderkey % 7 WHEN 0 THEN 'Track' WHEN 1 THEN 'Drift' WHEN 2 THEN 'OEM+' WHEN 3 THEN 'Show'
    WHEN 4 THEN 'Tuner Package' WHEN 5 THEN 'Classic' ELSE 'JDM' END AS build_type,
  'shop' AS build_source,
  CASE WHEN o_orderkey % 13 = 0 THEN 'ftp://shop.example.com/' ELSE 'https://shop.example.com/showcase/b' || CAST(o_orderkey AS STRING) END AS source_url,
  CASE WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderkey % 29 = 0 THEN '19x5' WHEN o_orderkey % 37 = 0 THEN '1850'
    ELSE CAST(year(o_orderdate) AS STRING) END AS year,
  CASE o_orderkey % 6 WHEN 0 THEN 'Ford' WHEN 1 THEN 'BMW' WHEN 2 THEN 'n/a' WHEN 3 THEN 'Zastava' WHEN 4 THEN 'toyota ' END AS make,
  CASE o_orderkey % 5 WHEN 0 THEN 'M3 Touring' WHEN 1 THEN 'X5' WHEN 2 THEN 'Supra' WHEN 3 THEN 'test' ELSE 'F-150' END AS model,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'Build ' || o_orderpriority END AS build_title,
  repeat('story ', CAST(o_orderkey % 20 AS INT)) AS build_story,
  CASE o_orderkey % 4 WHEN 0 THEN 'Manual' WHEN 1 THEN 'Automatic' WHEN 2 THEN 'Tiptronic' END AS transmission,
  CASE o_orderkey % 4 WHEN 0 THEN 'RWD' WHEN 1 THEN '6WD' WHEN 2 THEN 'AWD' END AS drivetrain,
  CASE o_orderkey % 9 WHEN 0 THEN '1HGCM82633A004352' WHEN 1 THEN 'BADVIN' END AS vin,
  (o_orderkey % 12) / 10.0E0 AS extraction_confidence, o_orderkey % 3 = 0 AS for_sale,
  CASE o_orderkey % 5 WHEN 0 THEN 'Stock' WHEN 1 THEN 'Lightly Modified' WHEN 2 THEN 'Moderately Modified'
    WHEN 3 THEN 'Wild' ELSE 'Heavily Modified' END AS modification_level,
  CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'https://img.example.com/a.jpg'
    WHEN 2 THEN 'https://img.example.com/no-image.png|broken' ELSE 'https://img.example.com/b.jpg|https://img.example.com/c.jpg|https://img.example.com/spacer.gif' END AS images,
  o_orderdate AS ts
FROM orders"""

MODS_SQL = """SELECT l_orderkey AS build_id, 'src' || CAST(l_suppkey % 20 AS STRING) AS source, l_linenumber AS line,
  CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN 'tbd' ELSE 'part ' || CAST(l_partkey % 300 AS STRING) END AS name,
  CASE l_suppkey % 7 WHEN 0 THEN 'Engine' WHEN 1 THEN 'Exhaust' WHEN 2 THEN 'Suspension' WHEN 3 THEN 'Wheel'
    WHEN 4 THEN 'Turbo' WHEN 5 THEN 'Weird Stuff' END AS category,
  CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'KW' WHEN 2 THEN 'Milltek' WHEN 3 THEN 'na' ELSE 'Harrop' END AS brand
FROM lineitem"""

# --- event store -----------------------------------------------------------

HTTP_SQL = """SELECT event_id, 'run_' || CAST(user_id % 12 AS STRING) AS run_id, ts AS timestamp, user_id,
  CASE event_type WHEN 'error' THEN (CASE WHEN value > 40 THEN 403 WHEN value > 20 THEN 429 WHEN value > 10 THEN 503 ELSE 500 END)
    WHEN 'signup' THEN 301 ELSE 200 END AS status_code,
  CASE WHEN event_type = 'error' AND value < 3 THEN 'timeout' END AS error_type,
  event_type = 'error' AND value > 10 AS is_blocked, CAST(floor(value * 10) AS BIGINT) AS duration_ms,
  CAST(floor(value * 100) AS BIGINT) AS response_body_size, CASE WHEN event_type = 'click' THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS request_body_size
FROM events"""
LLM_SQL = """SELECT event_id, 'run_' || CAST(user_id % 12 AS STRING) AS run_id, CAST(floor(value) AS BIGINT) AS prompt_tokens,
  CASE WHEN value > 50 THEN NULL ELSE CAST(floor(value * 2) AS BIGINT) END AS response_tokens, value / 1000 AS cost_usd
FROM events WHERE event_type = 'purchase'"""
DECISIONS_SQL = """SELECT event_id AS decision_id, 'run_' || CAST(user_id % 12 AS STRING) AS run_id, ts AS timestamp,
  CAST(floor(value) AS BIGINT) AS urls_discovered, CAST(floor(value / 2) AS BIGINT) AS urls_scraped,
  CAST(floor(value / 4) AS BIGINT) AS builds_extracted, CAST(floor(value / 8) AS BIGINT) AS mods_extracted
FROM events WHERE event_type = 'view'"""

# --- graph -----------------------------------------------------------------

ENTITIES_SQL = """SELECT 'r' || CAST(r_regionkey AS STRING) AS id, 'region' AS type, r_name AS name, '' AS notes FROM region
  UNION ALL SELECT 'n' || CAST(n_nationkey AS STRING), 'nation', n_name, 'in region ' || CAST(n_regionkey AS STRING) FROM nation
  UNION ALL SELECT 's' || CAST(s_suppkey AS STRING), 'supplier', s_name, 'balance ' || CAST(s_nationkey AS STRING) || '|nation ' || CAST(s_nationkey AS STRING) FROM supplier
  UNION ALL SELECT 'c' || CAST(c_custkey AS STRING), 'customer', c_name, 'segment ' || c_mktsegment FROM customer"""
RELATIONS_SQL = """SELECT 'rn' || CAST(n_nationkey AS STRING) AS id, 'r' || CAST(n_regionkey AS STRING) AS from_id, 'n' || CAST(n_nationkey AS STRING) AS to_id, 'contains' AS relation_type FROM nation
  UNION ALL SELECT 'ns' || CAST(s_suppkey AS STRING), 'n' || CAST(s_nationkey AS STRING), 's' || CAST(s_suppkey AS STRING), 'has_supplier' FROM supplier
  UNION ALL SELECT 'nc' || CAST(c_custkey AS STRING), 'n' || CAST(c_nationkey AS STRING), 'c' || CAST(c_custkey AS STRING), 'has_customer' FROM customer
  UNION ALL SELECT 'co' || CAST(o_orderkey AS STRING), 'c' || CAST(o_custkey AS STRING), 'o' || CAST(o_orderkey AS STRING), 'ordered' FROM orders"""

ORACLE_CTES = {
    "url_pool": URL_POOL_SQL, "dirty": DIRTY_PAGES_SQL, "log": LOG_ORACLE, "sources": SOURCES_SQL, "builds": BUILDS_SQL,
    "mods": MODS_SQL, "http": HTTP_SQL, "llm": LLM_SQL, "decisions": DECISIONS_SQL, "entities": ENTITIES_SQL, "relations": RELATIONS_SQL,
}
_NEEDS = {"sources": ["log"]}


def with_ctes(names: str, sql: str, **more: str) -> str:
    """The SQL with the named stand-ins (space separated) in front."""
    order: list[str] = []
    for name in names.split():
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in order:
                order.append(needed)
    ctes = [f"{n} AS ({ORACLE_CTES[n]})" for n in order] + [f"{n} AS ({body})" for n, body in more.items()]
    body = sql.lstrip()
    return "WITH " + ",\n".join(ctes) + ("" if body.startswith(",") else "\n") + body


def _sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    text = text.replace("{", "{{").replace("}", "}}")
    for name in frames:
        text = re.sub(rf"FROM {name}\b", f"FROM {{{name}}}", text)
    return spark.sql(text, **frames)


def url_pool(spark, folder) -> DataFrame:
    return _sql(spark, URL_POOL_SQL, pages=table(spark, folder, "pages"))


def dirty_pages(spark, folder) -> DataFrame:
    return _sql(spark, DIRTY_PAGES_SQL, pages=table(spark, folder, "pages"))


def log(spark, folder) -> DataFrame:
    return log_of(table(spark, folder, "events"))


def log_of(events: DataFrame) -> DataFrame:
    """The log projection of any events table, batch or stream."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.withColumn("k", k).selectExpr(*_projection(LOG_SQL))


def http_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(*_projection(HTTP_SQL))


def _projection(text: str) -> list[str]:
    """The select list of a stand-in, cut at top-level commas."""
    body = text[len("SELECT "):text.rindex("\nFROM ")]
    parts, depth, quoted, start = [], 0, False, 0
    for i, ch in enumerate(body):
        if ch == "'":
            quoted = not quoted
        elif not quoted and ch in "()":
            depth += 1 if ch == "(" else -1
        elif not quoted and depth == 0 and ch == ",":
            parts.append(body[start:i].strip())
            start = i + 1
    return [*parts, body[start:].strip()]


def sources(spark, folder) -> DataFrame:
    return _sql(spark, SOURCES_SQL, log=log(spark, folder))


def builds(spark, folder) -> DataFrame:
    """Build rows; ``gallery_images`` as an array, no modifications yet."""
    rows = _sql(spark, BUILDS_SQL, orders=table(spark, folder, "orders"))
    return rows.withColumn("gallery_images", F.filter(F.split("images", r"\|"), lambda x: x != "")).withColumn(
        "modifications", F.lit(None).cast("array<struct<name:string,category:string,brand:string>>")
    )


def mods(spark, folder) -> DataFrame:
    return _sql(spark, MODS_SQL, lineitem=table(spark, folder, "lineitem"))


def builds_with_mods(spark, folder) -> DataFrame:
    """Builds with the line items of their order as modifications (at most seven per order)."""
    items = mods(spark, folder).groupBy("build_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("line", "name", "category", "brand"))), lambda x: F.struct(x["name"].alias("name"), x["category"].alias("category"), x["brand"].alias("brand"))).alias("modifications")
    )
    rows = builds(spark, folder).drop("modifications")
    return rows.join(items.withColumnRenamed("build_id", "row_id"), "row_id", "left")


def http(spark, folder) -> DataFrame:
    return _sql(spark, HTTP_SQL, events=table(spark, folder, "events"))


def llm(spark, folder) -> DataFrame:
    return _sql(spark, LLM_SQL, events=table(spark, folder, "events"))


def decisions(spark, folder) -> DataFrame:
    return _sql(spark, DECISIONS_SQL, events=table(spark, folder, "events"))


def entities(spark, folder) -> DataFrame:
    t = {n: table(spark, folder, n) for n in ("region", "nation", "supplier", "customer")}
    rows = _sql(spark, ENTITIES_SQL, **t)
    return rows.withColumn("observations", F.filter(F.split("notes", r"\|"), lambda x: x != "")).drop("notes")


def relations(spark, folder) -> DataFrame:
    t = {n: table(spark, folder, n) for n in ("nation", "supplier", "customer", "orders")}
    return _sql(spark, RELATIONS_SQL, **t)
