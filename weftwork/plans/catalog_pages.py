"""Queries on page content and free text."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import pages as P
from weftwork.functions import text as X
from weftwork.operators import aggregates, filters
from weftwork.operators.similar import similarity
from weftwork.plans import jobs, standins
from weftwork.plans.catalog_urls import sql_build_id
from weftwork.plans.similar_sql import GESTALT
from weftwork.plans.registry import query, table
from weftwork.plans.standins import with_ctes


def sql_quote(text):
    return text.replace("'", "''")


def sql_any(column, patterns):
    return f"regexp_matches({column}, '(?i)" + "|".join(f"(?:{sql_quote(p)})" for p in patterns) + "')"


def _drop(column, tag, by):
    return f"regexp_replace({column}, '(?is)<{tag}\\b[^>]*>.*?</{tag}>', '{by}', 'g')"


def _collapse(column):
    return f"trim(regexp_replace({column}, '\\s+', ' ', 'g'))"


def _decode(column):
    for entity, plain in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]:
        column = f"replace({column}, '{entity}', '{plain}')"
    return column


def _strip(column):
    return _collapse(_decode(f"regexp_replace({column}, '(?s)<[^>]*>', ' ', 'g')"))


# --- text and links --------------------------------------------------------

_FULL = "html"
for _tag in ("script", "style", "head", "noscript"):
    _FULL = _drop(_FULL, _tag, " ")
_FULL = _collapse(_decode(f"regexp_replace(regexp_replace({_FULL}, '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g')"))
_TAGS = _collapse(f"regexp_replace({_drop(_drop('html', 'script', ''), 'style', '')}, '<[^>]+>', ' ', 'g')")


@query("page_text", f"SELECT page_id, {_FULL} AS text FROM pages")
def page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.visible_text("html").alias("text"))


@query("page_text_tags_only", f"SELECT page_id, {_TAGS} AS text FROM pages")
def page_text_tags_only(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.visible_text("html", tags_only=True).alias("text"))


@query("page_text_lines")
def page_text_lines(spark, sf):
    text = X.visible_text("html", preserve_structure=True)
    return table(spark, sf, "pages").select("page_id", F.size(F.split(text, "\n")).alias("lines"), F.md5(text).alias("digest"))


@query("page_text_parsed")
def page_text_parsed(spark, sf):
    """Visible text through an HTML parser in Arrow batches."""
    return table(spark, sf, "pages").select("page_id", X.visible_text_parsed()("html").alias("text"))


_ANCHOR = "unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*\\bhref\\s*=\\s*[\"''][^\"'']+[\"''][^>]*>.*?</a>', 0))"


@query("page_links", f"""
SELECT page_id, regexp_extract(tag, '(?is)^<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1) AS href, {_strip('tag')} AS text, count(*) AS n
FROM (SELECT page_id, {_ANCHOR} AS tag FROM pages) GROUP BY 1, 2, 3""")
def page_links(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.explode(P.links("html")).alias("l"))
    return rows.groupBy("page_id", F.col("l.href").alias("href"), F.col("l.text").alias("text")).agg(F.count(F.lit(1)).alias("n"))


@query("page_links_internal", f"""
SELECT page_id, count(*) AS links, count(*) FILTER (WHERE starts_with(href, '/')) AS internal
FROM (SELECT page_id, regexp_extract(tag, '(?is)\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1) AS href FROM (SELECT page_id, {_ANCHOR} AS tag FROM pages)) GROUP BY 1""")
def page_links_internal(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.explode(P.links("html", F.col("url"))).alias("l"))
    return rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("links"), F.count_if("l.is_internal").alias("internal"))


@query("page_head", with_ctes("dirty", f"""
SELECT page_id, nullif({_strip("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '') AS title,
  {_strip("regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)")} AS heading,
  CASE WHEN page_id % 14 = 10 THEN 'A fine car' ELSE '' END AS description,
  CASE WHEN page_id % 14 = 10 THEN 'https://shop.example.com/c' ELSE '' END AS canonical,
  CASE WHEN page_id % 14 = 10 THEN 'Car & more | Shop' END AS og_title, CASE WHEN page_id % 14 = 10 THEN '{{"a": 1}}' END AS json_ld FROM dirty"""))
def page_head(spark, sf):
    return standins.dirty_pages(spark, sf).select(
        "page_id", P.title("html").alias("title"), P.heading("html").alias("heading"), P.description("html").alias("description"),
        P.canonical_link("html").alias("canonical"), F.element_at(P.open_graph("html"), "title").alias("og_title"), P.json_ld("html").alias("json_ld"),
    )


# --- pagination ------------------------------------------------------------

_PAGE_LINKS = "list_transform(regexp_extract_all(html, '(?i)<a[^>]*href=[\"''][^\"'']*[?&]page=(\\d+)[^\"'']*[\"'']', 1), lambda x: CAST(x AS BIGINT))"
_INFINITE = sql_any("html", vocab.INFINITE_SCROLL_PATTERNS)
_LAST = "nullif(regexp_extract(html, '(?i)page\\s+(\\d+)\\s+of\\s+(\\d+)', 2), '')"


@query("page_pagination", with_ctes("dirty", f"""
SELECT page_id, CASE WHEN {_INFINITE} THEN 'infinite_scroll' WHEN {_LAST} IS NOT NULL OR len({_PAGE_LINKS}) > 0 THEN 'numeric'
    WHEN {sql_any('html', vocab.LOAD_MORE_PATTERNS)} THEN 'load_more' ELSE 'unknown' END AS pagination_type,
  greatest(CAST({_LAST} AS BIGINT), list_max({_PAGE_LINKS})) AS total_pages,
  CAST(replace(nullif(regexp_extract(html, '(?i)showing\\s+[\\d,]+[-\\s]+[\\d,]+\\s+of\\s+([\\d,]+)', 1), ''), ',', '') AS BIGINT) AS total_items,
  CASE WHEN page_id % 14 = 4 THEN regexp_extract(url, '^(https?://[^/]+)', 1) || '/list?page=3' END AS next_page_url FROM dirty"""))
def page_pagination(spark, sf):
    rows = standins.dirty_pages(spark, sf).select("page_id", P.pagination("html", "url").alias("p"))
    return rows.select("page_id", "p.pagination_type", "p.total_pages", "p.total_items", "p.next_page_url")


@query("page_next_and_total", with_ctes("dirty", f"""
SELECT page_id, {sql_any('html', vocab.NEXT_PAGE_PATTERNS)} AS has_next,
  coalesce(list_max(list_transform(regexp_extract_all(html, '(?i)href=["''][^"'']*[?&]page=(\\d+)', 1), lambda x: CAST(x AS BIGINT))), 1) AS total_pages FROM dirty"""))
def page_next_and_total(spark, sf):
    return standins.dirty_pages(spark, sf).select("page_id", P.has_next_page("html").alias("has_next"), P.total_pages("html").alias("total_pages"))


# --- corruption, errors, blocks --------------------------------------------

_START = "lower(regexp_replace(html, '^\\s+', ''))"
_BODY = "regexp_extract(html, '(?is)^\\s*<html><head></head><body>(.*)$', 1)"
_NON_ASCII = "length(regexp_replace({0}, '[\\x00-\\x7F]', '', 'g'))"
_REASON = f"""CASE WHEN html = '' THEN 'empty' WHEN {_BODY} <> '' AND {_NON_ASCII.format(_BODY)} > 0.3 * length({_BODY}) THEN 'binary_wrapped'
  WHEN NOT (starts_with({_START}, '<!doctype') OR starts_with({_START}, '<html') OR starts_with({_START}, '<?xml')) THEN 'missing_doctype'
  WHEN 0.5 * {_NON_ASCII.format('html')} > 0.15 * length(html) THEN 'high_garbage'
  WHEN contains({_START}, 'cloudflare') AND contains({_START}, 'challenge') THEN 'cloudflare_challenge' ELSE 'valid' END"""


@query("page_corruption", with_ctes("dirty", f"SELECT page_id, {_REASON} AS reason FROM dirty"))
def page_corruption(spark, sf):
    return standins.dirty_pages(spark, sf).select("page_id", P.text_corruption("html").alias("reason"))


@query("page_byte_corruption", with_ctes("dirty", f"""
SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'gzip_compressed' WHEN page_id % 10 = 1 THEN 'zstd_compressed' WHEN page_id % 10 = 2 THEN 'binary_data'
  WHEN page_id % 10 = 3 THEN 'brotli_compressed' WHEN html = '' THEN 'empty' WHEN octet_length(encode(html)) < 50 THEN 'too_small' ELSE {_REASON} END AS reason FROM dirty"""))
def page_byte_corruption(spark, sf):
    """The byte-level test: compression marks and broken encoding are put in front of some pages."""
    marks = {0: "1F8B08", 1: "28B52FFD", 2: "41FF42", 3: "1B0208FF"}
    mark = F
    for rest, value in marks.items():
        mark = mark.when(F.col("page_id") % 10 == rest, F.unhex(F.lit(value)))
    padding = F.encode(F.repeat(F.lit("x"), 60), "UTF-8")
    content = F.coalesce(F.concat(mark.otherwise(None), padding), F.encode("html", "UTF-8"))
    return standins.dirty_pages(spark, sf).select("page_id", P.byte_corruption(content).alias("reason"))


@query("corruption_report", with_ctes("dirty", f"""
, r AS (SELECT page_id, url, octet_length(encode(html)) AS size, {_REASON} AS reason FROM dirty)
SELECT reason, count(*) AS "count", round(sum(size) / 1048576.0, 2) AS total_mb, round(avg(size) / 1024, 1) AS avg_kb,
  array_to_string(list_sort(list(DISTINCT url))[1:5], ' ') AS samples FROM r GROUP BY reason"""))
def corruption_report(spark, sf):
    rows = standins.dirty_pages(spark, sf).select("url", F.octet_length("html").alias("size"), P.text_corruption("html").alias("reason"))
    return aggregates.corruption_report(rows, "reason", "url", "size").withColumn("samples", F.array_join("samples", " "))


_LABELS = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(html, '(?i){sql_quote(p)}') THEN '{n}' END" for p, n in vocab.ERROR_PATTERNS) + "], lambda x: x IS NOT NULL)"


@query("page_error_labels", with_ctes("dirty", f"SELECT page_id, array_to_string({_LABELS}, ',') AS labels, len({_LABELS}) >= 3 AS error_page FROM dirty"))
def page_error_labels(spark, sf):
    rows = standins.dirty_pages(spark, sf).select("page_id", P.error_labels("html").alias("labels"))
    return rows.select("page_id", F.array_join("labels", ",").alias("labels"), P.is_error_page("labels").alias("error_page"))


@query("error_label_counts", with_ctes("dirty", f'SELECT label, count(*) AS "count" FROM (SELECT unnest({_LABELS}) AS label FROM dirty) GROUP BY 1'))
def error_label_counts(spark, sf):
    return aggregates.label_counts(standins.dirty_pages(spark, sf), P.error_labels("html"))


_LOW = "lower(html)"
_CF = "page_id % 3 = 0"
_CHECKS = [(k, " AND ".join(f"contains({_LOW}, '{sql_quote(p)}')" for p in ps), note) for k, ps, note in vocab.BLOCK_CHECKS]
_KIND = (
    "CASE WHEN status_code = 403 THEN 'http_403' WHEN status_code = 429 THEN 'rate_limit' WHEN status_code = 503 THEN 'service_unavailable' "
    f"WHEN status_code = 522 THEN 'cloudflare_error' WHEN {_CF} AND status_code >= 400 THEN 'cloudflare' "
    + " ".join(f"WHEN {test} THEN '{kind}'" for kind, test, _ in _CHECKS)
    + " WHEN length(html) > 0 AND length(html) < 500 AND status_code >= 400 THEN 'short_response' END"
)
_INDICATORS = (
    "list_filter([CASE WHEN status_code = 403 THEN 'HTTP 403 Forbidden' WHEN status_code = 429 THEN 'HTTP 429 Too Many Requests' "
    "WHEN status_code = 503 THEN 'HTTP 503 Service Unavailable' WHEN status_code = 522 THEN 'Cloudflare error 522' END, "
    f"CASE WHEN {_CF} THEN 'Cloudflare header: cf-ray' END, "
    + ", ".join(f"CASE WHEN {test} THEN '{sql_quote(note)}' END" for _, test, note in _CHECKS)
    + ", CASE WHEN length(html) > 0 AND length(html) < 500 AND status_code >= 400 THEN 'Very short response content' END], lambda x: x IS NOT NULL)"
)


def _headers():
    server = F.create_map(F.lit("Server"), F.lit("x"))
    return F.when(F.col("page_id") % 3 == 0, F.create_map(F.lit("CF-Ray"), F.lit("1"), F.lit("Server"), F.lit("x"))).otherwise(server)


@query("page_block_report", with_ctes("dirty", f"""
SELECT page_id, kind IS NOT NULL AS is_blocked, kind AS block_type, indicators, coalesce(kind IN ('captcha', 'ddos_protection'), false) AS should_stop,
  coalesce(kind NOT IN ('captcha', 'ddos_protection'), false) AS should_rotate
FROM (SELECT page_id, {_KIND} AS kind, array_to_string({_INDICATORS}, '; ') AS indicators FROM dirty)"""))
def page_block_report(spark, sf):
    rows = standins.dirty_pages(spark, sf).select("page_id", P.block_report("html", "status_code", _headers()).alias("b"))
    return rows.select("page_id", "b.is_blocked", "b.block_type", F.array_join("b.indicators", "; ").alias("indicators"), "b.should_stop", "b.should_rotate")


_WORDS = " OR ".join(f"contains({_LOW}, '{p}')" for p in vocab.BLOCK_PHRASES_SHORT)
_WORDS10 = " OR ".join(f"contains({_LOW}, '{p}')" for p in vocab.BLOCK_PHRASES)


@query("page_is_blocked", with_ctes("dirty", f"""
SELECT page_id, status_code IN (403, 429, 503) OR ({_CF} AND status_code >= 400) OR {_WORDS} AS blocked,
  status_code IN (403, 429, 503, 520, 521, 522, 523, 524) OR (status_code < 400 AND ({_WORDS10})) AS fetch_blocked FROM dirty"""))
def page_is_blocked(spark, sf):
    cf = F.size(P.cloudflare_headers(_headers())) > 0
    return standins.dirty_pages(spark, sf).select(
        "page_id", P.is_blocked("status_code", "html", cf).alias("blocked"), P.is_blocked_fetch("status_code", "html").alias("fetch_blocked")
    )


@query("challenge_state", with_ctes("dirty", f"""
SELECT page_id, c AS is_challenge, t AS is_turnstile, CASE WHEN t THEN 'turnstile' WHEN c THEN 'interstitial' END AS challenge_type
FROM (SELECT page_id, {sql_any('html', vocab.CHALLENGE_PATTERNS)} AS c, {sql_any('html', vocab.TURNSTILE_PATTERNS)} AS t FROM dirty)"""))
def challenge_state(spark, sf):
    return standins.dirty_pages(spark, sf).select("page_id", P.challenge_state("html").alias("s")).select("page_id", "s.*")


# --- extraction ------------------------------------------------------------


@query("lot_attributes", with_ctes("dirty", """
SELECT page_id, nullif(regexp_extract(html, 'data-lot="(\\d+)"', 1), '') AS lot_number, nullif(regexp_extract(html, 'data-price="([^"]*)"', 1), '') AS price,
  nullif(regexp_extract(html, 'data-status="([^"]*)"', 1), '') AS status FROM dirty"""))
def lot_attributes(spark, sf):
    return standins.dirty_pages(spark, sf).select("page_id", P.lot_attributes("html").alias("l")).select("page_id", "l.*")


@query("page_images", with_ctes("dirty", """
SELECT page_id, CASE page_id % 14 WHEN 10 THEN 'https://img.example.com/og.jpg' WHEN 12 THEN 'https://img.example.com/a.jpg https://img.example.com/b.jpg' ELSE '' END AS images FROM dirty"""))
def page_images(spark, sf):
    return standins.dirty_pages(spark, sf).select("page_id", F.array_join(P.page_images("html"), " ").alias("images"))


@query("page_tables", with_ctes("dirty", """
SELECT page_id, r.row_no AS row_no, 'Part|Price' AS headers, r.cells AS cells FROM dirty, (VALUES (0, 'Wheel|10'), (1, 'Seat|20')) AS r(row_no, cells) WHERE page_id % 14 = 11"""))
def page_tables(spark, sf):
    tables = standins.dirty_pages(spark, sf).select("page_id", F.explode(P.tables("html")).alias("t"))
    rows = tables.select("page_id", "t.headers", F.posexplode("t.rows").alias("row_no", "cells"))
    return rows.select("page_id", "row_no", F.array_join("headers", "|").alias("headers"), F.array_join("cells", "|").alias("cells"))


_VEHICLES = "SELECT n_name AS slug, CASE n_regionkey WHEN 0 THEN 'BMW' WHEN 1 THEN 'KW' ELSE 'Ford' END AS make, 'M' || n_nationkey AS model, 'P' || n_regionkey AS package_name FROM nation"
_BUILT = f"""SELECT {sql_build_id('url')} AS build_id, url, page_id, slug, coalesce(make, '') AS make, coalesce(model, '') AS model, coalesce(package_name, '') AS package_name, html
  FROM (SELECT *, 'NATION_' || (page_id % 40) AS slug FROM dirty) d LEFT JOIN ({_VEHICLES}) v USING (slug)"""


def _vehicles(spark, sf):
    c = F.col
    make = F.when(c("n_regionkey") == 0, "BMW").when(c("n_regionkey") == 1, "KW").otherwise("Ford")
    return table(spark, sf, "nation").select(
        c("n_name").alias("slug"), make.alias("make"), F.concat(F.lit("M"), c("n_nationkey").cast("string")).alias("model"),
        F.concat(F.lit("P"), c("n_regionkey").cast("string")).alias("package_name"),
    )


def _slugged(spark, sf):
    return standins.dirty_pages(spark, sf).withColumn("slug", F.concat(F.lit("NATION_"), (F.col("page_id") % 40).cast("string")))


@query("page_builds", with_ctes("dirty", f"""
SELECT build_id, url AS source_url, make, model,
  CASE WHEN make <> '' THEN make || ' ' || model || ' ' || package_name WHEN page_id % 14 = 10 THEN 'Car & more'
    ELSE trim(split_part({_strip("regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)")}, '|', 1)) END AS build_title,
  CASE WHEN make <> '' THEN 0.95 ELSE 0.7 END::DOUBLE AS extraction_confidence, CASE page_id % 14 WHEN 10 THEN 1 WHEN 12 THEN 2 ELSE 0 END AS images FROM ({_BUILT})"""))
def page_builds(spark, sf):
    """Build records from page heads, headings, images and a vehicle look-up."""
    builds, _ = jobs.extract(_slugged(spark, sf), _vehicles(spark, sf))
    return builds.select("build_id", "source_url", "make", "model", "build_title", "extraction_confidence", F.size("gallery_images").alias("images"))


@query("page_mods", with_ctes("dirty", f"""
SELECT build_id, m.name AS mod_name, m.brand AS brand, m.category AS category, CAST(m.conf AS DOUBLE) AS confidence FROM ({_BUILT}) b,
  (VALUES ('Milltek cat back exhaust', 'Milltek', 'Exhaust', 0.9, false), ('KW coilover set', 'KW', 'Suspension', 0.9, false),
    ('ECU remap stage 2', '{vocab.DEFAULT_BRAND}', 'Engine', 0.8, true), ('Carbon splitter', '{vocab.DEFAULT_BRAND}', 'Exterior', 0.7, false),
    ('Carbon diffuser', '{vocab.DEFAULT_BRAND}', 'Exterior', 0.7, false), ('The package includes', '{vocab.DEFAULT_BRAND}', 'Other', 0.7, false)) AS m(name, brand, category, conf, product)
WHERE page_id % 14 = 13 AND (NOT m.product OR make = '')"""))
def page_mods(spark, sf):
    """Modifications from lists, product titles and headings, each name once per build."""
    _, mods = jobs.extract(_slugged(spark, sf), _vehicles(spark, sf))
    return mods.select("build_id", "mod_name", "brand", "category", "confidence")


@query("page_body_sizes", """
SELECT page_id, octet_length(encode(html)) AS size, octet_length(encode(html)) >= 10000 AS compressed FROM pages""")
def page_body_sizes(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", P.body_stats("html").alias("s")).select("page_id", "s.*")
    return rows.withColumn("size", F.col("size").cast("bigint"))


@query("page_audit", with_ctes("dirty", f"""
SELECT page_group AS source, count(*) AS pages, count(*) FILTER (WHERE n = 0) AS empty_pages, count(*) FILTER (WHERE n > 0 AND n < 500) AS tiny_pages,
  count(*) FILTER (WHERE n >= 500 AND n < 2000) AS small_pages, count(*) FILTER (WHERE n = 0 OR bad) AS error_pages, CAST(sum(n) AS BIGINT) AS bytes,
  count(*) FILTER (WHERE n > 0 AND NOT bad) AS valid_pages, round(count(*) FILTER (WHERE n > 0 AND NOT bad) * 100.0 / count(*), 4)::DOUBLE AS valid_pct
FROM (SELECT page_group, octet_length(encode(html)) AS n, len({_LABELS}) >= 3 AS bad FROM dirty) GROUP BY 1"""))
def page_audit(spark, sf):
    pages = standins.dirty_pages(spark, sf).withColumnRenamed("page_group", "source")
    return jobs.page_audit(pages)


# --- free text -------------------------------------------------------------


@query("doc_emails_urls", f"""
SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{vocab.EMAIL}', 0))), ' ') AS emails,
  array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{sql_quote(vocab.URL_IN_TEXT)}', 0))), ' ') AS urls FROM documents""")
def doc_emails_urls(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(F.array_sort(X.find_emails("text")), " ").alias("emails"), F.array_join(F.array_sort(X.find_urls("text")), " ").alias("urls")
    )


@query("email_check", f"""
SELECT doc_id, count(*) AS words, count(*) FILTER (WHERE regexp_matches(word, '^{vocab.EMAIL}$')) AS emails
FROM (SELECT doc_id, unnest(string_split(text, ' ')) || CASE WHEN doc_id % 2 = 0 THEN '@example.com' ELSE '' END AS word FROM documents) GROUP BY 1""")
def email_check(spark, sf):
    """Every word of every text put to the address test; half of them with a host behind."""
    host = F.when(F.col("doc_id") % 2 == 0, "@example.com").otherwise("")
    words = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("word"), host.alias("host"))
    return words.groupBy("doc_id").agg(F.count(F.lit(1)).alias("words"), F.count_if(X.is_email(F.concat("word", "host"))).alias("emails"))


_SECRET = "text || CASE doc_id % 5 WHEN 0 THEN ' Authorization: Bearer abc.def' WHEN 1 THEN ' api_key=\"sk-123\" x' WHEN 2 THEN ' password: hunter2 end' WHEN 3 THEN ' set-cookie: a=b; c=d' ELSE ' token=t0k secret:zz' END"
_REDACTED = _SECRET
for _p, _r in vocab.SECRET_PATTERNS:
    _REDACTED = f"regexp_replace({_REDACTED}, '(?i){sql_quote(_p)}', '{_r}', 'g')"


@query("doc_redact", f"SELECT doc_id, {_REDACTED} AS text FROM documents")
def doc_redact(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.redact(F.expr(_SECRET)).alias("text"))


@query("header_redact", """
SELECT event_id, '[REDACTED]' AS auth, event_type AS agent, CASE WHEN event_type = 'click' THEN '[REDACTED]' ELSE props END AS extra FROM events""")
def header_redact(spark, sf):
    key = F.when(F.col("event_type") == "click", "X-API-Key").otherwise("X-Trace")
    headers = F.create_map(F.lit("Authorization"), F.lit("Bearer x"), F.lit("User-Agent"), F.col("event_type"), key, F.col("props"))
    rows = table(spark, sf, "events").select("event_id", X.redact_headers(headers).alias("h"), key.alias("key"))
    return rows.select("event_id", F.element_at("h", "Authorization").alias("auth"), F.element_at("h", "User-Agent").alias("agent"), F.element_at("h", F.col("key")).alias("extra"))


_GARBAGE = "(?i)" + "|".join(sql_quote(p).replace(r"[\W\d]", "[^a-zA-Z_]") for p in vocab.GARBAGE_PATTERNS)
_VALUES = "CASE o_orderkey % 9 WHEN 0 THEN 'N/A' WHEN 1 THEN '  tbd ' WHEN 2 THEN '123-45' WHEN 3 THEN 'ab' WHEN 4 THEN 'Lorem ipsum dolor' WHEN 5 THEN 'placeholder text' WHEN 6 THEN 'Error' WHEN 7 THEN o_orderpriority END"


@query("doc_garbage", f"""
SELECT o_orderkey, coalesce(regexp_matches(regexp_replace(v, '^\\s+|\\s+$', '', 'g'), '{_GARBAGE}'), true) AS garbage FROM (SELECT o_orderkey, {_VALUES} AS v FROM orders)""")
def doc_garbage(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.is_garbage(F.expr(_VALUES)).alias("garbage"))


@query("ansi_strip", "SELECT doc_id, text FROM documents")
def ansi_strip(spark, sf):
    """Colour codes are put between the words and must all come off again."""
    coloured = F.concat(F.lit("\x1b[31;1m"), F.regexp_replace("text", " ", "\x1b[0m \x1b[4m"), F.lit("\x1b[K"))
    return table(spark, sf, "documents").select("doc_id", X.strip_ansi(coloured).alias("text"))


@query("name_normalize", """
SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(n), '^(hks|trust|greddy|apexi|cusco|tein|bc racing|kw|bilstein|eibach|h&r|borla|magnaflow|flowmaster|msd|edelbrock|holley|k&n|aem|injen|mishimoto|brembo|wilwood|apr|stoptech|hawk)\\s+', ''),
  '\\d+(\\.\\d+)?\\s*(mm|inch|"|'')?\\s*', '', 'g'), '\\b(kit|set|assembly|system|upgrade|performance|racing|sport|pro|series|v\\d|mk\\d|gen\\d)\\b', '', 'g'), '\\s+', ' ', 'g')) AS clean
FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'KW ' WHEN 1 THEN 'BC Racing ' WHEN 2 THEN '18.5 inch ' ELSE '' END || p_name || CASE p_partkey % 3 WHEN 0 THEN ' Kit' WHEN 1 THEN ' 20mm  Sport' ELSE '' END AS n FROM part)""")
def name_normalize(spark, sf):
    n = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'KW ' WHEN 1 THEN 'BC Racing ' WHEN 2 THEN '18.5 inch ' ELSE '' END || p_name || CASE p_partkey % 3 WHEN 0 THEN ' Kit' WHEN 1 THEN ' 20mm  Sport' ELSE '' END")
    return table(spark, sf, "part").select("p_partkey", X.normalize_name(n).alias("clean"))


@query("similarity_pairs", f"""
WITH RECURSIVE names AS (SELECT DISTINCT p_name, p_type FROM part), pairs AS (SELECT DISTINCT lower(p_name) AS t, lower(p_type) AS c FROM names), {GESTALT}
SELECT p_name, p_type, round(ratio, 6) AS score FROM names JOIN gestalt ON t = lower(p_name) AND c = lower(p_type)""")
def similarity_pairs(spark, sf):
    """Similarity of each distinct part name with its type, in Arrow batches."""
    pairs = table(spark, sf, "part").select("p_name", "p_type").distinct()
    return pairs.select("p_name", "p_type", F.round(similarity(F.col("p_name"), F.col("p_type")), 6).alias("score"))


_MODEL = "CASE event_id % 5 WHEN 0 THEN 'Claude-x' WHEN 1 THEN 'gemini-1' WHEN 2 THEN 'PaLM' WHEN 3 THEN 'gpt-4' ELSE 'llama' END"
_PATH = "CASE event_id % 4 WHEN 0 THEN 'data/' || event_type || '.JSON' WHEN 1 THEN 'a.b/readme' WHEN 2 THEN '.hidden' ELSE 'x/y.tar.gz' END"


@query("event_enrichment", f"""
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'anthropic' WHEN 1 THEN 'google' WHEN 2 THEN 'google' WHEN 3 THEN 'openai' END AS provider,
  CASE event_id % 4 WHEN 0 THEN 'json' WHEN 3 THEN 'gz' END AS file_type FROM events""")
def event_enrichment(spark, sf):
    """Vendor from model name and type from file path, where not given."""
    rows = table(spark, sf, "events").select("event_id", F.expr(_MODEL).alias("model"), F.expr(_PATH).alias("file_path"), F.lit(None).cast("string").alias("provider"), F.lit(None).cast("string").alias("file_type"))
    return filters.file_event(filters.llm_event(rows)).select("event_id", "provider", "file_type")


_REPLY = "CASE turn % 5 WHEN 0 THEN 'PASS all good' WHEN 1 THEN 'Result: FAIL: button gone' WHEN 2 THEN 'Yes it is visible and present' WHEN 3 THEN 'I cannot say' ELSE text END"
_NEG = " + ".join(f"CAST(contains(lower(r), '{sql_quote(w)}') AS INT)" for w in vocab.NEGATIVE_INDICATORS)
_POS = " + ".join(f"CAST(contains(lower(r), '{sql_quote(w)}') AS INT)" for w in vocab.POSITIVE_INDICATORS)


@query("reply_verdict", f"""
SELECT conv_id, turn, CASE WHEN starts_with(upper(r), 'PASS') THEN true WHEN contains(lower(r), 'fail') THEN false ELSE {_POS} > {_NEG} END AS passed,
  CAST(CASE WHEN starts_with(upper(r), 'PASS') THEN 0.9 WHEN contains(lower(r), 'fail') THEN 0.8 WHEN {_POS} > {_NEG} THEN 0.6 ELSE 0.5 END AS DOUBLE) AS confidence
FROM (SELECT conv_id, turn, regexp_replace({_REPLY}, '^\\s+|\\s+$', '', 'g') AS r FROM conversations)""")
def reply_verdict(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", X.verdict(F.expr(_REPLY)).alias("v"))
    return rows.select("conv_id", "turn", "v.passed", "v.confidence")


@query("capital_items", """
SELECT doc_id, 3 AS n, 'Carbon hood|Rear wing|Ti exhaust' AS items FROM documents""")
def capital_items(spark, sf):
    text = F.concat(F.lit("Carbon hood, Rear wing, small bits, Ti exhaust, Abc, "), F.lower(F.regexp_replace("text", "[,.]", " ")))
    rows = table(spark, sf, "documents").select("doc_id", X.capitalised_items(text).alias("i"))
    return rows.select("doc_id", F.size("i").alias("n"), F.array_join("i", "|").alias("items"))


@query("log_advice", with_ctes("log", """
SELECT event_id, CASE WHEN e LIKE '%403%' OR e LIKE '%forbidden%' THEN 'blocked' WHEN e LIKE '%429%' OR e LIKE '%rate limit%' OR e LIKE '%too many%' THEN 'rate_limit'
  WHEN e LIKE '%captcha%' OR e LIKE '%challenge%' OR e LIKE '%verify%' THEN 'captcha' WHEN e LIKE '%timeout%' OR e LIKE '%timed out%' THEN 'network'
  WHEN e LIKE '%selector%' OR e LIKE '%not found%' OR e LIKE '%none%' THEN 'selector_change' WHEN e LIKE '%cloudflare%' OR e LIKE '%cf\\_%' ESCAPE '\\' THEN 'blocked'
  WHEN e LIKE '%login%' OR e LIKE '%auth%' OR e LIKE '%sign in%' THEN 'auth' ELSE status END AS category,
  (CASE WHEN error LIKE '%403%' OR error LIKE '%Forbidden%' THEN 1 ELSE 0 END + CASE WHEN error LIKE '%429%' OR error LIKE '%rate limit%' THEN 1 ELSE 0 END
   + CASE WHEN error LIKE '%timeout%' OR error LIKE '%ETIMEDOUT%' THEN 1 ELSE 0 END + CASE WHEN error LIKE '%Cloudflare%' OR error LIKE '%challenge%' THEN 1 ELSE 0 END) AS symptoms
FROM (SELECT *, lower(error) AS e FROM log WHERE error IS NOT NULL)"""))
def log_advice(spark, sf):
    rows = standins.log(spark, sf).where("error is not null")
    return rows.select("event_id", filters.log_category("error", "status")["category"].alias("category"), F.size(filters.log_symptoms("error")).alias("symptoms"))


