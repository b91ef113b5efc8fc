"""Queries on URLs and links."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import pages as P
from weftwork.functions import urls as U
from weftwork.operators import aggregates, joins, ordering, sets, windows
from weftwork.plans import jobs, standins
from weftwork.plans.registry import query, table
from weftwork.plans.standins import with_ctes
from weftwork.session import checkpoint_dir
from weftwork.sources.writers import url_envelopes

_TRACKING = ", ".join(f"'{p}'" for p in vocab.TRACKING_PARAMS)
_LIGHT = ", ".join(f"'{p}'" for p in vocab.LIGHT_TRACKING_PARAMS)
_BASE = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?"


def sql_scheme(u):
    return rf"lower(regexp_extract({u}, '^([a-zA-Z][a-zA-Z0-9+.\-]*):', 1))"


def sql_netloc(u):
    return f"regexp_extract({u}, '{_BASE}//([^/?#]*)', 1)"


def sql_host(u):
    return f"lower({sql_netloc(u)})"


def sql_path(u):
    return f"regexp_extract({u}, '{_BASE}(?://[^/?#]*)?([^?#]*)', 1)"


def sql_query(u):
    return rf"regexp_extract({u}, '^[^?#]*\?([^#]*)', 1)"


def sql_canonical(u):
    t = f"trim({u})"
    path = f"regexp_replace(regexp_replace({sql_path(t)}, ';[^/]*$', ''), '/+$', '')"
    kept = f"list_filter(string_split({sql_query(t)}, '&'), lambda p: p <> '' AND lower(split_part(p, '=', 1)) NOT IN ({_TRACKING}))"
    q = f"array_to_string(list_sort({kept}), '&')"
    return (
        f"({sql_scheme(t)} || '://' || regexp_replace({sql_host(t)}, '^www\\.', '') || (CASE WHEN {path} = '' THEN '/' ELSE {path} END)"
        f" || (CASE WHEN {q} = '' THEN '' ELSE '?' || {q} END))"
    )


def sql_light(u):
    kept = f"list_filter(string_split({sql_query(u)}, '&'), lambda p: lower(split_part(p, '=', 1)) NOT IN ({_LIGHT}))"
    q = f"array_to_string({kept}, '&')"
    return f"({sql_scheme(u)} || '://' || {sql_host(u)} || {sql_path(u)} || (CASE WHEN {q} = '' THEN '' ELSE '?' || {q} END))"


def sql_build_id(u):
    return f"CAST(md5_number_upper(trim({u})) % 9223372036854775808 AS BIGINT)"


@query("host_top10", f"""
WITH ranked AS (
  SELECT url, {sql_canonical('url')} AS canonical, row_number() OVER (PARTITION BY {sql_canonical('url')} ORDER BY page_id) AS rn FROM pages)
SELECT regexp_replace({sql_host('url')}, '^www\\.', '') AS host, count(*) AS pages, min({sql_build_id('canonical')}) AS min_build_id
FROM ranked WHERE rn = 1 GROUP BY 1 ORDER BY pages DESC, host LIMIT 10""")
def host_top10(spark, sf):
    """Pages per site, each page once: canonical URL, id, deduplication, group, top ten."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    unique = windows.dedupe_by(pages, U.canonical_url("url"), "page_id")
    tagged = unique.select(U.site_host("url").alias("host"), U.build_id(U.canonical_url("url")).alias("id"))
    counts = tagged.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.min("id").alias("min_build_id"))
    return counts.orderBy(F.desc("pages"), "host").limit(10)


@query("url_canonical", with_ctes("url_pool", f"SELECT position, {sql_canonical('url')} AS canonical FROM url_pool"))
def url_canonical(spark, sf):
    return standins.url_pool(spark, sf).select("position", U.canonical_url("url").alias("canonical"))


@query("url_normalize_light", with_ctes("url_pool", f"""
SELECT url, count(*) AS n FROM (SELECT {sql_light('url')} AS url FROM url_pool WHERE url NOT LIKE ' %') GROUP BY 1"""))
def url_normalize_light(spark, sf):
    pool = standins.url_pool(spark, sf).where(~F.col("url").startswith(" "))
    return pool.groupBy(U.light_url("url").alias("url")).agg(F.count(F.lit(1)).alias("n"))


@query("url_dedup", with_ctes("url_pool", f"""
SELECT position, url FROM (SELECT *, row_number() OVER (PARTITION BY {sql_canonical('url')} ORDER BY position) AS rn FROM url_pool) WHERE rn = 1"""))
def url_dedup(spark, sf):
    return windows.dedupe_by(standins.url_pool(spark, sf), U.canonical_url("url"), "position")


_LABELS = f"string_split({sql_host('url')}, '.')"


@query("url_registered_domain", f"""
SELECT page_id, {sql_host('url')} AS full_host,
  CASE WHEN len({_LABELS}) <= 2 THEN {sql_host('url')}
    WHEN {_LABELS}[-2] IN ('co','com','org','net','gov','edu') THEN array_to_string({_LABELS}[-3:], '.')
    ELSE array_to_string({_LABELS}[-2:], '.') END AS domain FROM pages""")
def url_registered_domain(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.registered_domain("url", True).alias("full_host"), U.registered_domain("url").alias("domain"))


@query("url_host_path", with_ctes("url_pool", f"SELECT position, {sql_host('url')} AS url_domain, {sql_path('url')} AS url_path FROM url_pool"))
def url_host_path(spark, sf):
    return standins.url_pool(spark, sf).select("position", U.host("url").alias("url_domain"), U.path("url").alias("url_path"))


_JOINED = f"concat_ws('_', nullif(replace({sql_netloc('url')}, '.', '_'), ''), nullif(replace(regexp_replace({sql_path('url')}, '^/+|/+$', '', 'g'), '/', '_'), ''))"
_SAFE = f"regexp_replace(regexp_replace({_JOINED}, '[^a-zA-Z0-9_\\-]', '_', 'g'), '_+', '_', 'g')"


@query("url_safe_path", f"""
SELECT page_id, {_SAFE} AS whole, CASE WHEN length({_SAFE}) > 25 THEN substr({_SAFE}, 1, 16) || '_' || substr(md5(url), 1, 8) ELSE {_SAFE} END AS cut FROM pages""")
def url_safe_path(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.safe_path("url").alias("whole"), U.safe_path("url", 25).alias("cut"))


_BROKEN = "CASE position % 5 WHEN 0 THEN replace(url, 'http', 'ftp') WHEN 1 THEN regexp_replace(url, '^[a-z]+:', '') WHEN 2 THEN 'mailto:someone' ELSE url END"


@query("url_validity", with_ctes("url_pool", f"""
SELECT position, {sql_scheme('u')} IN ('http', 'https') AND {sql_netloc('u')} <> '' AS web_url,
  {sql_scheme('u')} <> '' AND {sql_netloc('u')} <> '' AS any_url FROM (SELECT position, {_BROKEN} AS u FROM url_pool)"""))
def url_validity(spark, sf):
    broken = standins.url_pool(spark, sf).select("position", F.expr(_BROKEN).alias("u"))
    return broken.select("position", U.is_valid_url("u").alias("web_url"), U.is_valid_url("u", web_only=False).alias("any_url"))


@query("url_build_id", with_ctes("url_pool", f"SELECT position, {sql_build_id('url')} AS build_id FROM url_pool"))
def url_build_id(spark, sf):
    return standins.url_pool(spark, sf).select("position", U.build_id("url").alias("build_id"))


_SEGMENT = f"string_split(regexp_replace({sql_path('url')}, '^/+|/+$', '', 'g'), '/')[-1]"


@query("url_filename", with_ctes("url_pool", f"""
SELECT position, substr(regexp_replace(CASE WHEN {_SEGMENT} = '' THEN 'index' ELSE {_SEGMENT} END, '[^a-zA-Z0-9-]', '-', 'g'), 1, 100)
  || '-' || substr(md5(url), 1, 8) || '.html' AS filename FROM url_pool"""))
def url_filename(spark, sf):
    return standins.url_pool(spark, sf).select("position", U.page_filename("url").alias("filename"))


@query("url_slugs", f"""
SELECT page_id, replace(regexp_replace(regexp_replace({sql_path('u')}, '^/+|/+$', '', 'g'), '^build-threads/', ''), '/', '-') || '.html' AS path_slug,
  nullif(regexp_extract(s, '/showcase/([^/]+)/?', 1), '') AS showcase_slug,
  CASE WHEN page_id % 3 = 0 THEN 'car_.html' END AS item_filename, CASE WHEN page_id % 3 = 0 THEN CAST(page_id AS VARCHAR) END AS item_id
FROM (SELECT page_id, replace(url, '/en/', '/build-threads/') AS u,
  CASE WHEN page_id % 3 = 0 THEN 'https://a.example.com/showcase/car-.' || page_id || '/' ELSE url END AS s FROM pages)""")
def url_slugs(spark, sf):
    rows = table(spark, sf, "pages").select(
        "page_id", F.replace("url", F.lit("/en/"), F.lit("/build-threads/")).alias("u"),
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://a.example.com/showcase/car-."), F.col("page_id").cast("string"), F.lit("/"))).otherwise(F.col("url")).alias("s"),
    )
    item = U.showcase_item("s")
    return rows.select(
        "page_id", U.path_slug("u").alias("path_slug"), U.showcase_slug("s").alias("showcase_slug"),
        item["filename"].alias("item_filename"), item["item_id"].alias("item_id"),
    )


@query("url_source_ids", f"""
SELECT source_id, count(*) AS urls, min(file_id) AS file_id FROM (
  SELECT regexp_replace(replace({sql_netloc('url')}, 'www.', ''), '[.\\-]', '_', 'g') AS source_id,
    lower(regexp_replace(replace({sql_netloc('url')} || ' List.csv', '.csv', ''), '[- ]', '_', 'g')) AS file_id FROM pages) GROUP BY 1""")
def url_source_ids(spark, sf):
    rows = table(spark, sf, "pages").select(
        U.source_id_from_url("url").alias("source_id"), U.source_id_from_file(F.concat(U.netloc("url"), F.lit(" List.csv"))).alias("file_id")
    )
    return rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("urls"), F.min("file_id").alias("file_id"))


def sql_template(p):
    return f"regexp_replace(regexp_replace(regexp_replace({p}, '/\\d+/?', '/{{id}}/', 'g'), '/[a-f0-9-]{{36}}/?', '/{{uuid}}/', 'g'), '(?i)/[a-z0-9-]{{10,}}/?$', '/{{slug}}/', 'g')"


_HREFS = "unnest(regexp_extract_all(html, '(?i)href=[\"'']([^\"'']+)[\"'']', 1))"
_ROOT = f"({sql_scheme('url')} || '://' || {sql_netloc('url')})"
_LINKS = f"SELECT page_id, CASE WHEN starts_with(href, '/') THEN {_ROOT} || href ELSE href END AS link, url FROM (SELECT page_id, url, {_HREFS} AS href FROM pages) WHERE NOT starts_with(href, 'javascript:') AND NOT starts_with(href, '#') AND NOT starts_with(href, 'mailto:')"
_SAME = f"{sql_netloc('link')} = {sql_netloc('url')}"


@query("url_templates_top15", f"""
WITH links AS ({_LINKS}), tagged AS (SELECT link, {sql_template(sql_path('link'))} AS pattern FROM links WHERE {_SAME}),
counts AS (SELECT pattern, count(*) AS "count" FROM tagged GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)
SELECT c.pattern, c."count", (SELECT array_to_string(list_sort(list(link ORDER BY link))[1:3], ' ') FROM (SELECT DISTINCT link FROM tagged t WHERE t.pattern = c.pattern)) AS examples FROM counts c""")
def url_templates_top15(spark, sf):
    found = jobs.link_patterns(table(spark, sf, "pages"))
    return found.select("pattern", "count", F.array_join("examples", " ").alias("examples"))


_HREF_CASES = "CASE page_id % 8 WHEN 0 THEN '/a/b' WHEN 1 THEN '//cdn.example.com/x' WHEN 2 THEN 'https://other.example.com/y' WHEN 3 THEN '?page=9' WHEN 4 THEN '#part' WHEN 5 THEN 'next/item' WHEN 6 THEN '../up' ELSE '/a/./b/../c?q=1' END"
_FOLDER = f"regexp_replace({sql_path('url')}, '[^/]*$', '')"
_UP = f"regexp_replace({_FOLDER}, '[^/]+/$', '')"
_WITHQ = f"(CASE WHEN {sql_query('url')} = '' THEN '' ELSE '?' || {sql_query('url')} END)"


@query("url_resolve", f"""
SELECT page_id, CASE page_id % 8 WHEN 0 THEN {_ROOT} || '/a/b' WHEN 1 THEN {sql_scheme('url')} || '://cdn.example.com/x'
  WHEN 2 THEN 'https://other.example.com/y' WHEN 3 THEN {_ROOT} || {sql_path('url')} || '?page=9'
  WHEN 4 THEN {_ROOT} || {sql_path('url')} || {_WITHQ} || '#part' WHEN 5 THEN {_ROOT} || {_FOLDER} || 'next/item'
  WHEN 6 THEN {_ROOT} || {_UP} || 'up' ELSE {_ROOT} || '/a/c?q=1' END AS absolute FROM pages""")
def url_resolve(spark, sf):
    rows = table(spark, sf, "pages").withColumn("href", F.expr(_HREF_CASES))
    return rows.select("page_id", U.resolve("href", "url").alias("absolute"))


_TESTED = "CASE position % 7 WHEN 0 THEN url || '/page/3/' WHEN 1 THEN url || '/category/x' WHEN 2 THEN url || '/uploads/a.JPG' WHEN 3 THEN url || '/pic.png' WHEN 4 THEN url || '/search?q=1' ELSE url END"


@query("url_tests", with_ctes("url_pool", f"""
SELECT position, regexp_matches(u, '(?i)/page/\\d+/?$|/category/|/tag/|/author/|/search\\?|\\?page=') AS listing,
  regexp_matches(u, '(?i)/media/|/attachment|/uploads/|/images/|\\.(jpg|jpeg|png|gif|webp|pdf|mp4|mp3)$') AS media
FROM (SELECT position, {_TESTED} AS u FROM url_pool)"""))
def url_tests(spark, sf):
    rows = standins.url_pool(spark, sf).select("position", F.expr(_TESTED).alias("u"))
    return rows.select("position", U.is_listing_url("u").alias("listing"), U.is_media_url("u").alias("media"))


@query("item_links", f"""
SELECT page_id, array_to_string(list_sort(list(DISTINCT {_ROOT} || regexp_replace(href, '#.*$', ''))), ' ') AS items
FROM (SELECT page_id, url, unnest(regexp_extract_all(replace(html, 'href="/', 'href="/listing/'), '(?i)href="([^"]*(?:/vehicle/|/listing/|/item/|/detail/)[^"]*)"', 1)) AS href FROM pages) GROUP BY page_id""")
def item_links(spark, sf):
    html = F.replace("html", F.lit('href="/'), F.lit('href="/listing/'))
    rows = table(spark, sf, "pages").select("page_id", P.links_in_family(html, "url", vocab.ITEM_LINK_PATTERNS["listing"]).alias("items"))
    return rows.where(F.size("items") > 0).select("page_id", F.array_join(F.array_sort("items"), " ").alias("items"))


@query("gallery_links", f"""
SELECT page_id, count(DISTINCT href) AS items FROM (SELECT page_id, unnest(regexp_extract_all(replace(html, 'href="/', 'href="/gallery/'), '(?i)href="([^"]*(?:/gallery/|/portfolio/|/project/|/build/|/vehicle/)[^"]*)"', 1)) AS href FROM pages)
WHERE NOT contains(lower(href), '/wp-') GROUP BY page_id""")
def gallery_links(spark, sf):
    html = F.replace("html", F.lit('href="/'), F.lit('href="/gallery/'))
    found = P.links_in_family(html, "url", vocab.ITEM_LINK_PATTERNS["gallery"], skip=vocab.GALLERY_SKIP)
    return table(spark, sf, "pages").select("page_id", F.size(found).cast("bigint").alias("items")).where("items > 0")


@query("page_urls", f"""
SELECT page_id, n AS page, CASE WHEN n = 1 THEN {_ROOT} || '/inventory/' ELSE {_ROOT} || '/inventory/page/' || n || '/' END AS path_url,
  CASE WHEN n = 1 THEN {_ROOT} || '/inventory/' ELSE {_ROOT} || '/inventory/?page=' || n END AS query_url
FROM pages, unnest(range(1, page_id % 4 + 2)) AS r(n)""")
def page_urls(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", "url", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("page_id") % 4 + 1)).alias("page"))
    path = F.lit("/inventory/")
    return rows.select("page_id", "page", U.page_url("url", path, "page").alias("path_url"), U.page_url("url", path, "page", "query").alias("query_url"))


@query("links_matching", f"""
WITH links AS ({_LINKS})
SELECT DISTINCT rtrim({sql_scheme('link')} || '://' || {sql_netloc('link')} || {sql_path('link')}, '/') || '/' AS url FROM links WHERE {_SAME} AND regexp_matches({sql_path('link')}, '(?i)^/[a-m][a-z]+$')""")
def links_matching(spark, sf):
    """Internal links whose path fits a pattern, cleaned, each once."""
    links = table(spark, sf, "pages").select(F.explode(P.internal_links("html", "url", skip_mail=False)).alias("link"))
    kept = links.where(U.path("link").rlike("(?i)^/[a-m][a-z]+$"))
    return kept.select(U.folder_url("link").alias("url")).distinct()


@query("url_quality_checks", with_ctes("url_pool", f"""
SELECT count(*) AS total, count(DISTINCT url) AS distinct_urls, count(*) - count(DISTINCT url) AS duplicates,
  count(*) FILTER (WHERE NOT ({sql_scheme('url')} IN ('http', 'https') AND {sql_netloc('url')} <> '')) AS invalid,
  count(*) FILTER (WHERE regexp_matches(url, '(?i)/page/\\d+/?$|/category/|/tag/|/author/|/search\\?|\\?page=')) AS listing_urls,
  count(*) FILTER (WHERE regexp_matches(url, '(?i)/media/|/attachment|/uploads/|/images/|\\.(jpg|jpeg|png|gif|webp|pdf|mp4|mp3)$')) AS media_urls,
  count(DISTINCT regexp_replace({sql_host('url')}, '^www\\.', '')) AS domains FROM url_pool"""))
def url_quality_checks(spark, sf):
    return aggregates.url_quality(standins.url_pool(spark, sf))


@query("url_suite", with_ctes("log", f"""
, q AS (SELECT source, count(*) AS total, count(DISTINCT url) AS distinct_urls, count(DISTINCT {sql_host('url')}) AS domains,
  count(*) FILTER (WHERE regexp_matches(url, '(?i)/media/|/attachment|/uploads/|/images/|\\.(jpg|jpeg|png|gif|webp|pdf|mp4|mp3)$')) AS media_urls FROM log GROUP BY source)
SELECT source, 'count' AS "check", total AS value, CASE WHEN total < 10 THEN 'fail' WHEN total < 50 THEN 'warn' ELSE 'pass' END AS result FROM q
UNION ALL SELECT source, 'validity', 0, 'pass' FROM q
UNION ALL SELECT source, 'uniqueness', total - distinct_urls, CASE WHEN total = distinct_urls THEN 'pass' ELSE 'warn' END FROM q
UNION ALL SELECT source, 'patterns', 0, 'pass' FROM q
UNION ALL SELECT source, 'same_domain', domains, CASE WHEN domains = 1 THEN 'pass' WHEN domains <= 3 THEN 'warn' ELSE 'fail' END FROM q
UNION ALL SELECT source, 'media', media_urls, CASE WHEN media_urls = 0 THEN 'pass' WHEN media_urls * 100.0 / total < 10 THEN 'warn' ELSE 'fail' END FROM q"""))
def url_suite(spark, sf):
    return jobs.url_suite(standins.log(spark, sf), ["source"])


@query("url_union_sorted", with_ctes("url_pool", """
SELECT url FROM (SELECT url FROM url_pool UNION SELECT url FROM pages)"""))
def url_union_sorted(spark, sf):
    return sets.url_union(standins.url_pool(spark, sf), table(spark, sf, "pages"))


@query("url_new_only", with_ctes("url_pool", """
SELECT DISTINCT url FROM url_pool WHERE url NOT IN (SELECT url FROM pages)"""))
def url_new_only(spark, sf):
    return sets.difference(standins.url_pool(spark, sf), table(spark, sf, "pages"), "url")


@query("url_batches", """
SELECT page_id, CAST(floor((row_number() OVER (ORDER BY url, page_id) - 1) / 10) AS BIGINT) AS batch FROM pages""")
def url_batches(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return windows.batches(pages, ["url", "page_id"], 10).select("page_id", "batch")


@query("remaining_urls", """
SELECT page_id FROM (SELECT page_id, row_number() OVER (ORDER BY url, page_id) AS n FROM pages) WHERE n > 17""")
def remaining_urls(spark, sf):
    return ordering.after(table(spark, sf, "pages").select("page_id", "url"), ["url", "page_id"], 17).select("page_id")


@query("theta_contains", f"""
WITH slugs AS (SELECT page_id, {_SEGMENT} AS slug FROM pages), b AS (SELECT {_SEGMENT} AS slug, min(page_id) AS first_id FROM pages GROUP BY 1)
SELECT s.page_id, b.first_id AS build_page FROM slugs s LEFT JOIN b ON s.slug = b.slug AND b.slug <> ''""")
def theta_contains(spark, sf):
    """Page to build by slug: the slug is derived on both sides and joined on equality."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    slug = F.element_at(F.split(F.regexp_replace(U.path("url"), "^/+|/+$", ""), "/"), -1)
    builds = pages.select(F.col("page_id").alias("build_id"), "url")
    matched = joins.match_by_slug(pages, builds, slug, slug)
    return matched.select("page_id", F.col("build.build_id").alias("build_page"))


@query("suffix_match", """
SELECT r_name AS source_id, n_name AS output_dir FROM region r JOIN nation n ON ('data/' || n_name || '/' || (SELECT r_name FROM region x WHERE x.r_regionkey = n.n_regionkey)) LIKE '%' || r.r_name""")
def suffix_match(spark, sf):
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    named = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    sources = named.select(F.col("n_name").alias("output_dir"), F.concat(F.lit("data/"), "n_name", F.lit("/"), "r_name").alias("path"))
    found = joins.match_by_suffix(region.select(F.col("r_name").alias("source_id")), sources, "source_id", "path")
    return found.where("output_dir is not null").select("source_id", "output_dir")


@query("slug_lookup", f"""
SELECT p.page_id, c.c_mktsegment AS make, coalesce(c.c_name, 'none') AS model
FROM (SELECT page_id, TRY_CAST({_SEGMENT} AS BIGINT) AS slug FROM pages) p LEFT JOIN customer c ON p.slug = c.c_custkey""")
def slug_lookup(spark, sf):
    slug = F.element_at(F.split(F.regexp_replace(U.path("url"), "^/+|/+$", ""), "/"), -1).try_cast("bigint")
    dim = table(spark, sf, "customer").select(F.col("c_custkey").alias("slug"), F.col("c_mktsegment").alias("make"), F.col("c_name").alias("model"))
    rows = table(spark, sf, "pages").select("page_id", slug.alias("slug"))
    return joins.lookup(rows, dim, "slug", {"model": "none"}).select("page_id", "make", "model")


@query("new_per_page", """
WITH found AS (SELECT l_partkey % 500 AS url, CAST(l_orderkey / 50 AS BIGINT) AS page FROM lineitem),
first AS (SELECT url, min(page) AS page FROM found GROUP BY 1), pages_ AS (SELECT page, count(DISTINCT url) AS found_urls FROM found GROUP BY 1)
SELECT p.page, p.found_urls, count(f.url) AS new_urls, CAST(sum(count(f.url)) OVER (ORDER BY p.page) AS BIGINT) AS total_urls
FROM pages_ p LEFT JOIN first f ON p.page = f.page GROUP BY p.page, p.found_urls""".replace("CAST(l_orderkey / 50 AS BIGINT)", "l_orderkey // 50"))
def new_per_page(spark, sf):
    """New URLs per page of a discovery and the running total."""
    found = table(spark, sf, "lineitem").select((F.col("l_partkey") % 500).alias("url"), F.expr("l_orderkey div 50").alias("page"))
    return windows.first_seen(found)


@query("stop_pages", """
WITH found AS (SELECT l_partkey % 500 AS url, l_orderkey // 50 AS page FROM lineitem),
first AS (SELECT url, min(page) AS page FROM found GROUP BY 1),
per AS (SELECT p.page, count(f.url) AS fresh FROM (SELECT DISTINCT page FROM found) p LEFT JOIN first f ON p.page = f.page GROUP BY 1),
lagged AS (SELECT page, fresh, lag(fresh) OVER (ORDER BY page) AS before FROM per)
SELECT min(page) AS stop_page FROM lagged WHERE fresh = 0 AND before = 0""")
def stop_pages(spark, sf):
    found = table(spark, sf, "lineitem").select((F.col("l_partkey") % 500).alias("url"), F.expr("l_orderkey div 50").alias("page"))
    return windows.stop_pages(windows.first_seen(found), quiet=2)


@query("declared_counts", with_ctes("log", """
SELECT source, n AS actual, CASE WHEN n % 3 = 0 THEN NULL WHEN n % 3 = 1 THEN n + 1 ELSE n END AS declared,
  CASE WHEN n % 3 = 0 THEN 'missing' WHEN n % 3 = 1 THEN 'mismatch' ELSE 'ok' END AS count_check,
  CASE WHEN n % 2 = 0 THEN 'missing' ELSE 'ok' END AS updated_check FROM (SELECT source, count(DISTINCT url) AS n FROM log GROUP BY source)"""))
def declared_counts(spark, sf):
    """Declared against actual URL counts of sources in envelopes of about ten URLs."""
    n = F.col("totalCount")
    envelopes = url_envelopes(standins.log(spark, sf).select("source", "url").distinct(), batch=10).select(
        "source", "urls", F.when(n % 3 == 0, None).when(n % 3 == 1, n + 1).otherwise(n).alias("totalCount"),
        F.when(n % 2 == 0, None).otherwise(F.lit("2024-01-01")).alias("lastUpdated"),
    )
    out = aggregates.declared_counts(envelopes)
    return out.withColumns({"actual": F.col("actual").cast("bigint"), "declared": F.col("declared").cast("bigint")})


@query("pages_of_results", """
SELECT page_id, url, greatest((SELECT count(*) FROM pages) - 30, 0) AS remaining FROM (SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT 10 OFFSET 20)""")
def pages_of_results(spark, sf):
    """The third page of ten results, with what remains after it."""
    return ordering.result_page(table(spark, sf, "pages").select("page_id", "url"), ["url", "page_id"], 2, 10)


@query("pages_of_results_late", """
SELECT page_id, url, greatest((SELECT count(*) FROM pages) - (n + 1) * 7, 0) AS remaining FROM (SELECT page_id, url, (SELECT count(*) FROM pages) // 7 - 1 AS n, row_number() OVER (ORDER BY url DESC, page_id) AS rn FROM pages)
WHERE rn > n * 7 AND rn <= (n + 1) * 7""")
def pages_of_results_late(spark, sf):
    """The last full page of seven results, read through an index by position."""
    pages, path = table(spark, sf, "pages").select("page_id", "url"), f"{checkpoint_dir(spark)}/ranked-{uuid.uuid4().hex}"
    order = [F.col("url").desc(), "page_id"]
    ordering.write_ranked(pages, order, path)
    return ordering.ranked_page(spark, path, order, pages.count() // 7 - 1, 7)
