"""Queries on events, fetch logs, source queues, runs and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import buckets, pages
from weftwork.operators import aggregates as A
from weftwork.operators import filters, joins, ordering, scan, sets, windows
from weftwork.plans import jobs, standins
from weftwork.plans.catalog_tables import sql_share
from weftwork.plans.registry import query, table
from weftwork.plans.standins import with_ctes

AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"


def _as_of():
    return F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")


# --- metrics ---------------------------------------------------------------

_HTTP = """count(*) AS total_requests, count(*) FILTER (WHERE status_code BETWEEN 200 AND 299) AS successful_requests,
  count(*) FILTER (WHERE status_code >= 400 OR error_type IS NOT NULL) AS failed_requests, count(*) FILTER (WHERE is_blocked) AS blocked_requests,
  CAST(round(avg(duration_ms), 0) AS BIGINT) AS avg_latency_ms, CAST(coalesce(sum(response_body_size), 0) AS BIGINT) AS bytes_downloaded, CAST(coalesce(sum(request_body_size), 0) AS BIGINT) AS bytes_uploaded"""
_LLM = """count(*) AS llm_calls, CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS llm_tokens_in, CAST(coalesce(sum(response_tokens), 0) AS BIGINT) AS llm_tokens_out, round(coalesce(sum(cost_usd), 0), 6) AS llm_cost_usd"""


@query("http_metrics", with_ctes("http", f"SELECT run_id, {_HTTP} FROM http GROUP BY run_id"))
def http_metrics(spark, sf):
    return A.http_metrics(standins.http(spark, sf), ["run_id"])


@query("llm_metrics", with_ctes("llm", f"SELECT run_id, {_LLM} FROM llm GROUP BY run_id"))
def llm_metrics(spark, sf):
    return A.llm_metrics(standins.llm(spark, sf), ["run_id"]).withColumn("llm_cost_usd", F.round("llm_cost_usd", 6))


@query("metrics_snapshot", with_ctes("http llm decisions", f"""
SELECT h.*, coalesce(l.llm_calls, 0) AS llm_calls, coalesce(l.llm_tokens_in, 0) AS llm_tokens_in, coalesce(l.llm_tokens_out, 0) AS llm_tokens_out, coalesce(l.llm_cost_usd, 0) AS llm_cost_usd,
  d.urls_discovered, d.urls_scraped, d.builds_extracted, d.mods_extracted
FROM (SELECT run_id, {_HTTP} FROM http GROUP BY run_id) h LEFT JOIN (SELECT run_id, {_LLM} FROM llm GROUP BY run_id) l USING (run_id)
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY timestamp DESC, decision_id DESC) AS rn FROM decisions) WHERE rn = 1) d USING (run_id)"""))
def metrics_snapshot(spark, sf):
    out = A.metrics_snapshot(standins.http(spark, sf), standins.llm(spark, sf), standins.decisions(spark, sf))
    return out.withColumn("llm_cost_usd", F.round("llm_cost_usd", 6))


_RUNS = "SELECT 'run_' || (user_id % 12) AS run_id, event_id AS iteration_id, ts AS started_at, ts + CAST(floor(value) AS INT) * INTERVAL 1 SECOND AS ended_at, CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup' THEN 'running' ELSE 'success' END AS status FROM events"


def _iterations(spark, sf):
    kind = F.col("event_type")
    status = F.when(kind == "error", "failed").when(kind == "signup", "running").otherwise("success")
    return table(spark, sf, "events").select(
        F.concat(F.lit("run_"), (F.col("user_id") % 12).cast("string")).alias("run_id"), F.col("event_id").alias("iteration_id"), F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(secs=F.floor("value").cast("decimal(18,6)"))).alias("ended_at"), status.alias("status"),
    )


@query("run_rollup", f"SELECT run_id, count(*) AS total_iterations, count(*) FILTER (WHERE status = 'success') AS completed, count(*) FILTER (WHERE status = 'failed') AS failed FROM ({_RUNS}) GROUP BY run_id")
def run_rollup(spark, sf):
    return A.run_rollup(_iterations(spark, sf))


@query("iteration_durations", f"""
SELECT run_id, iteration_id, date_diff('millisecond', started_at, ended_at) AS duration_ms,
  CAST(sum(date_diff('millisecond', started_at, ended_at)) OVER (PARTITION BY run_id ORDER BY started_at, iteration_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_ms FROM ({_RUNS})""")
def iteration_durations(spark, sf):
    return windows.iteration_durations(_iterations(spark, sf)).select("run_id", "iteration_id", "duration_ms", "total_ms")


@query("status_counts", """
SELECT count(*) AS total, count(*) FILTER (WHERE s = 'active') AS active, count(*) FILTER (WHERE s = 'complete') AS complete, count(*) FILTER (WHERE s = 'blocked') AS blocked,
  CAST(coalesce(sum(k), 0) AS BIGINT) AS total_stories, CAST(coalesce(sum(CASE WHEN s = 'complete' THEN k END), 0) AS BIGINT) AS completed_stories
FROM (SELECT CASE event_type WHEN 'error' THEN 'blocked' WHEN 'purchase' THEN 'complete' ELSE 'active' END AS s, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""")
def status_counts(spark, sf):
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    status = F.when(kind == "error", "blocked").when(kind == "purchase", "complete").otherwise("active")
    rows = table(spark, sf, "events").select(status.alias("status"), k.alias("stories_total"), F.when(status == "complete", k).alias("stories_completed"))
    return A.status_summary(rows)


@query("daily_counts", 'SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS "count" FROM events GROUP BY 1, 2')
def daily_counts(spark, sf):
    out = A.daily_counts(table(spark, sf, "events"), keys=["event_type"])
    return out.withColumn("day", F.col("day").cast("string"))


@query("outcome_totals", """
SELECT count(*) FILTER (WHERE event_type <> 'error') AS success, count(*) FILTER (WHERE event_type = 'error') AS failed, round(sum(value), 4) AS elapsed, round(avg(value), 6) AS average_time FROM events""")
def outcome_totals(spark, sf):
    rows = table(spark, sf, "events").select((F.col("event_type") != "error").alias("success"), F.col("value").alias("duration"))
    return A.outcome_totals(rows).withColumns({"elapsed": F.round("elapsed", 4), "average_time": F.round("average_time", 6)})


@query("pass_rate", "SELECT avg((event_type <> 'error')::INT) AS pass_rate FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 100)")
def pass_rate(spark, sf):
    rows = table(spark, sf, "events").select("ts", "event_id", (F.col("event_type") != "error").alias("passed"))
    return A.pass_rate(rows, ["ts", "event_id"])


@query("http_event_store", with_ctes("http", """
SELECT event_id, status_code IN (403, 429, 503) AS is_blocked, CASE status_code WHEN 403 THEN 'forbidden' WHEN 429 THEN 'rate_limit' WHEN 503 THEN 'service_unavailable' END AS blocked_reason,
  'site-' || user_id || '.example.com' AS url_domain, '/p/' || event_id AS url_path, CAST(length(CAST(event_id AS VARCHAR)) * 3000 AS BIGINT) AS response_body_size, length(CAST(event_id AS VARCHAR)) * 3000 >= 10000 AS response_body_compressed,
  CASE WHEN user_id % 2 = 0 THEN 'own' ELSE 'iteration' END AS source_id, '{"Cookie":"[REDACTED]"}' AS request_headers FROM http"""))
def http_event_store(spark, sf):
    c = F.col
    rows = standins.http(spark, sf).select(
        "event_id", "status_code", F.lit("GET").alias("method"),
        F.concat(F.lit("https://Site-"), c("user_id").cast("string"), F.lit(".example.com/p/"), c("event_id").cast("string"), F.lit("?q=1")).alias("url"),
        F.create_map(F.lit("Cookie"), F.lit("a=b")).alias("request_headers"), F.create_map(F.lit("Server"), F.lit("x")).alias("response_headers"),
        F.lit(None).cast("string").alias("request_body"), F.repeat(c("event_id").cast("string"), F.lit(3000)).alias("response_body"),
        F.lit(False).alias("is_blocked"), F.lit(None).cast("string").alias("blocked_reason"), F.when(c("user_id") % 2 == 0, "own").alias("source_id"),
        F.lit("html").alias("stage"), F.lit("iteration").alias("iteration_source_id"), F.lit("urls").alias("iteration_stage"),
    )
    out = filters.http_event(rows)
    return out.select("event_id", "is_blocked", "blocked_reason", "url_domain", "url_path", c("response_body_size").cast("bigint").alias("response_body_size"), "response_body_compressed", "source_id", "request_headers")


@query("block_reason", with_ctes("http", "SELECT event_id, CASE status_code WHEN 403 THEN 'forbidden' WHEN 429 THEN 'rate_limit' WHEN 503 THEN 'service_unavailable' END AS reason FROM http"))
def block_reason(spark, sf):
    return standins.http(spark, sf).select("event_id", pages.block_reason("status_code").alias("reason"))


# --- fetch progress --------------------------------------------------------

_PROGRESS = """, u AS (SELECT source, count(*) AS total_urls FROM (SELECT DISTINCT source, url FROM log WHERE k % 3 > 0) GROUP BY 1),
l AS (SELECT source, count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'blocked') AS blocked FROM log WHERE k % 4 = 0 GROUP BY 1),
p AS (SELECT u.source, total_urls, coalesce(success, 0) AS success, coalesce(failed, 0) AS failed, coalesce(blocked, 0) AS blocked FROM u LEFT JOIN l USING (source)),
stats AS (SELECT *, greatest(0, total_urls - success - failed - blocked) AS pending, coalesce(round((success + failed + blocked)::DOUBLE / total_urls * 100, 1), 0) AS completion_percentage,
  CASE WHEN blocked > 0 THEN 'blocked' WHEN total_urls - success - failed - blocked <= 0 THEN 'complete' WHEN success + failed > 0 THEN 'in_progress' ELSE 'not_started' END AS overall_status FROM p)
"""


def _urls_and_log(spark, sf):
    rows = standins.log(spark, sf)
    urls = rows.where("k % 3 > 0").select("source", "url").distinct()
    return urls, rows.where("k % 4 = 0")


@query("progress_stats", with_ctes("log", _PROGRESS + "SELECT * FROM stats"))
def progress_stats(spark, sf):
    return A.progress_stats(*_urls_and_log(spark, sf))


@query("pending_urls", with_ctes("log", "SELECT DISTINCT source, url FROM log WHERE k % 3 > 0 AND url NOT IN (SELECT url FROM log WHERE k % 4 = 0 AND status = 'success')"))
def pending_urls(spark, sf):
    return joins.pending(*_urls_and_log(spark, sf)).select("source", "url")


@query("pending_counts", with_ctes("log", """
, u AS (SELECT DISTINCT source, url FROM log WHERE k % 3 > 0), d AS (SELECT DISTINCT url FROM log WHERE k % 4 = 0 AND status = 'success')
SELECT count(*) AS total_urls, count(*) FILTER (WHERE url NOT IN (FROM d)) AS pending_urls, count(*) FILTER (WHERE url NOT IN (FROM d)) > 100 AS has_more, (SELECT count(*) FROM d) AS already_scraped FROM u"""))
def pending_counts(spark, sf):
    return joins.pending_counts(*_urls_and_log(spark, sf))


@query("pending_docs", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def pending_docs(spark, sf):
    done = table(spark, sf, "labels").withColumn("status", F.when(F.col("quality") == 1, "success").otherwise("failed"))
    return joins.pending(table(spark, sf, "documents").select("doc_id", "lang"), done, "doc_id")


_CLASS = """CASE WHEN e LIKE '%resolve%' OR e LIKE '%nodename%' OR e LIKE '%getaddrinfo%' THEN 'dns' WHEN e LIKE '%timeout%' OR e LIKE '%timed out%' THEN 'timeout' WHEN error LIKE '%403%' THEN 'blocked_403' WHEN error LIKE '%429%' THEN 'blocked_429'
  WHEN e LIKE '%cloudflare%' OR e LIKE '%captcha%' THEN 'cloudflare' WHEN regexp_matches(error, '50[0-4]') THEN 'server_5xx' WHEN error LIKE '%404%' THEN 'not_found' WHEN e LIKE '%ssl%' OR e LIKE '%certificate%' THEN 'ssl' WHEN e LIKE '%connect%' THEN 'connection' ELSE 'other' END"""
_FAILS = f", f AS (SELECT source, event_id, {_CLASS} AS error_class, CASE WHEN regexp_matches(e, 'resolve|nodename|getaddrinfo') THEN 'dns' WHEN regexp_matches(error, '403|429') OR regexp_matches(e, 'cloudflare|blocked') THEN 'blocked' WHEN e LIKE '%timeout%' THEN 'timeout' WHEN regexp_matches(error, '500|502|503|504') THEN 'server' ELSE 'other' END AS coarse FROM (SELECT *, lower(error) AS e FROM log WHERE status IN ('failed', 'blocked')))\n"


@query("error_histogram", with_ctes("log", _FAILS + f'SELECT error_class, count(*) AS "count", (SELECT count(*) FROM f) AS failed, {sql_share("count(*)", "(SELECT count(*) FROM f)")} AS pct FROM f GROUP BY 1'))
def error_histogram(spark, sf):
    return A.error_histogram(standins.log(spark, sf).where(F.col("status").isin("failed", "blocked")))


@query("error_dominance", with_ctes("log", _FAILS + """
SELECT source, count(*) AS failed, count(*) FILTER (WHERE error_class = 'dns') AS dns, count(*) FILTER (WHERE error_class IN ('blocked_403', 'blocked_429', 'cloudflare')) AS blocked,
  count(*) FILTER (WHERE error_class = 'dns') > count(*) * 0.8 AS site_down, count(*) FILTER (WHERE error_class IN ('blocked_403', 'blocked_429', 'cloudflare')) > count(*) * 0.5 AS site_blocking FROM f GROUP BY 1"""))
def error_dominance(spark, sf):
    return A.error_dominance(standins.log(spark, sf).where(F.col("status").isin("failed", "blocked")), keys=["source"])


@query("error_verdict", with_ctes("log", _FAILS + """
SELECT source, count(*) AS failed, count(*) FILTER (WHERE coarse = 'dns') AS dns, count(*) FILTER (WHERE coarse = 'blocked') AS blocked, count(*) FILTER (WHERE coarse = 'timeout') AS timeout, count(*) FILTER (WHERE coarse = 'server') AS server, count(*) FILTER (WHERE coarse = 'other') AS other,
  CASE WHEN count(*) FILTER (WHERE coarse = 'blocked') > count(*) * 0.3 THEN 'blocking' WHEN count(*) FILTER (WHERE coarse = 'dns') > count(*) * 0.8 THEN 'down' ELSE 'errors' END AS verdict FROM f GROUP BY 1"""))
def error_verdict(spark, sf):
    return A.error_verdict(standins.log(spark, sf).where(F.col("status").isin("failed", "blocked")), keys=["source"])


@query("action_lookup", with_ctes("log", _FAILS + "SELECT source, error_class, count(*) AS \"count\", CASE error_class " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.FETCH_ERROR_ADVICE.items()) + " END AS advice FROM f GROUP BY 1, 2"))
def action_lookup(spark, sf):
    return jobs.failure_advice(standins.log(spark, sf)).select("source", "error_class", "count", "advice")


@query("fetch_diagnosis", with_ctes("log", _PROGRESS.rstrip() + f"""
, f AS (SELECT source, {_CLASS} AS c FROM (SELECT *, lower(error) AS e FROM log WHERE k % 4 = 0 AND status IN ('failed', 'blocked'))),
last AS (SELECT source, max(ts) AS t FROM log WHERE k % 4 = 0 GROUP BY 1),
g AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE c IN ('blocked_403', 'blocked_429', 'cloudflare')) AS b FROM f GROUP BY 1)
SELECT s.source, coalesce(g.b, 0) AS block_errors, coalesce(date_diff('second', last.t, {AS_OF}) > 600 AND s.pending > 0, false) AS stalled,
  CASE WHEN coalesce(g.b, 0) > 0 THEN 'critical' WHEN s.failed + s.blocked > 0 OR coalesce(date_diff('second', last.t, {AS_OF}) > 600 AND s.pending > 0, false) THEN 'issues' WHEN completion_percentage >= 95 THEN 'complete' ELSE 'in_progress' END AS verdict
FROM stats s LEFT JOIN g USING (source) LEFT JOIN last USING (source)"""))
def fetch_diagnosis(spark, sf):
    return jobs.fetch_diagnosis(*_urls_and_log(spark, sf), _as_of()).select("source", "block_errors", "stalled", "verdict")


@query("run_health", with_ctes("log", _PROGRESS.rstrip() + """
, f AS (SELECT source, CASE WHEN regexp_matches(lower(error), 'resolve|nodename|getaddrinfo') THEN 'dns' WHEN regexp_matches(error, '403|429') OR regexp_matches(lower(error), 'cloudflare|blocked') THEN 'blocked' ELSE 'x' END AS c FROM log WHERE k % 4 = 0 AND status IN ('failed', 'blocked')),
g AS (SELECT source, CASE WHEN count(*) FILTER (WHERE c = 'blocked') > count(*) * 0.3 THEN 'blocking' WHEN count(*) FILTER (WHERE c = 'dns') > count(*) * 0.8 THEN 'down' ELSE 'errors' END AS verdict FROM f GROUP BY 1)
SELECT s.source, total_urls, success, round(success::DOUBLE / total_urls * 100, 1) AS progress_pct, CASE WHEN success * 100.0 / total_urls >= 95 THEN 'complete' WHEN success * 100.0 / total_urls >= 50 THEN 'half' WHEN success > 0 THEN 'started' ELSE 'not_started' END AS band,
  coalesce(g.verdict, 'clean') AS verdict FROM stats s LEFT JOIN g USING (source)"""))
def run_health(spark, sf):
    return jobs.run_health(*_urls_and_log(spark, sf))


@query("output_checks", """
SELECT event_type AS stage, count(*) FILTER (WHERE CASE WHEN event_type = 'view' THEN NULL ELSE user_id END IS NOT NULL) AS "count", count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 600 MINUTE) AS recent,
  NOT (event_type = 'view' OR date_diff('second', max(ts), TIMESTAMP '2024-01-30 12:00:00') > 36000) AS valid, CASE WHEN event_type = 'view' THEN 'empty' WHEN date_diff('second', max(ts), TIMESTAMP '2024-01-30 12:00:00') > 36000 THEN 'stale' END AS error
FROM events WHERE ts <= TIMESTAMP '2024-01-30 12:00:00' GROUP BY event_type""")
def output_checks(spark, sf):
    events = table(spark, sf, "events").where(F.col("ts") <= _as_of()).withColumn("user_id", F.when(F.col("event_type") != "view", F.col("user_id")))
    parts = [jobs.output_checks(kind, events.where(F.col("event_type") == kind), "user_id", "ts", _as_of(), 600) for kind in ("click", "error", "purchase", "signup", "view")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("stage_issues", with_ctes("log", """
, c AS (SELECT source, count(*) AS urls, count(*) FILTER (WHERE status = 'success') AS pages, count(*) FILTER (WHERE value < 5) AS small_pages, count(*) FILTER (WHERE event_type = 'purchase') AS builds,
  count(*) FILTER (WHERE event_type = 'purchase' AND value < 20) AS incomplete_builds, count(*) FILTER (WHERE event_type = 'purchase' AND value > 60) AS builds_with_mods FROM log GROUP BY 1)
SELECT source, stage, issue, severity FROM c, LATERAL (VALUES ('html_scrape', 'Many small pages', 'MEDIUM', small_pages > pages * 0.1), ('html_scrape', 'Low completion rate', 'MEDIUM', pages > 0 AND pages::DOUBLE / urls < 0.8), ('html_scrape', 'No pages', 'HIGH', pages = 0),
  ('build_extraction', 'No builds', 'HIGH', builds = 0), ('build_extraction', 'Builds miss year, make or model', 'MEDIUM', incomplete_builds > builds * 0.2), ('mod_extraction', 'No modifications', 'MEDIUM', builds > 0 AND builds_with_mods = 0)) AS v(stage, issue, severity, hit) WHERE hit"""))
def stage_issues(spark, sf):
    c = F.col
    counts = standins.log(spark, sf).groupBy("source").agg(
        F.count(F.lit(1)).alias("urls"), F.count_if(c("status") == "success").alias("pages"), F.count_if(c("value") < 5).alias("small_pages"), F.count_if(c("event_type") == "purchase").alias("builds"),
        F.count_if((c("event_type") == "purchase") & (c("value") < 20)).alias("incomplete_builds"), F.count_if((c("event_type") == "purchase") & (c("value") > 60)).alias("builds_with_mods"),
    )
    return jobs.stage_issues(counts)


@query("log_cleanup", with_ctes("log", "SELECT event_id FROM log WHERE filename NOT IN (SELECT page_id || '.html' FROM pages WHERE page_id % 14 IN (0, 1, 2, 7, 9)) AND k % 40 < 14"))
def log_cleanup(spark, sf):
    """Progress rows of corrupt pages removed, to be fetched again."""
    named = standins.dirty_pages(spark, sf).select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("filename"), pages.text_corruption(F.when(F.col("page_id") % 14 == 3, F.lit("<html>ok")).otherwise(F.regexp_replace("html", r"[^\x00-\x7F]", "a"))).alias("reason"))
    named = named.withColumn("reason", F.when(F.regexp_extract("filename", r"^(\d+)", 1).cast("int") % 14 == 2, "binary").otherwise(F.col("reason")))
    return sets.without_bad_files(standins.log(spark, sf).where("k % 40 < 14"), named).select("event_id")


# --- sources ---------------------------------------------------------------

_CORRECT = """CASE WHEN coalesce(urls_found, 0) = 0 THEN 'pending' WHEN html_blocked > 0 THEN 'blocked' WHEN html_scraped + html_failed + html_blocked < urls_found THEN 'in_progress' WHEN coalesce(builds, 0) > 0 AND coalesce(mods, 0) > 0 THEN 'completed' ELSE 'in_progress' END"""
_SUMMARY = f"""count(*) AS total_sources, count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE status = 'in_progress') AS in_progress, count(*) FILTER (WHERE status = 'blocked') AS blocked, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'skip') AS skip,
  CAST(coalesce(sum(urls_found), 0) AS BIGINT) AS total_urls_found, CAST(coalesce(sum(html_scraped), 0) AS BIGINT) AS total_html_scraped, CAST(coalesce(sum(builds), 0) AS BIGINT) AS total_builds, CAST(coalesce(sum(mods), 0) AS BIGINT) AS total_mods,
  count(*) FILTER (WHERE status <> {_CORRECT} AND status <> 'skip') AS status_mismatches, coalesce(round(CASE WHEN coalesce(sum(urls_found), 0) = 0 THEN NULL ELSE coalesce(sum(html_scraped), 0)::DOUBLE / sum(urls_found) END * 100, 1), 0) AS overall_pct"""


@query("source_summary", with_ctes("sources", f"SELECT {_SUMMARY} FROM sources"))
def source_summary(spark, sf):
    return A.source_summary(standins.sources(spark, sf))


@query("source_summary_by_priority", with_ctes("sources", f"SELECT priority, {_SUMMARY} FROM sources GROUP BY priority"))
def source_summary_by_priority(spark, sf):
    return A.source_summary(standins.sources(spark, sf), ["priority"])


@query("blocked_list", with_ctes("sources", "SELECT source, name, urls_found, html_blocked FROM sources WHERE status = 'blocked' OR coalesce(html_blocked, 0) > 0"))
def blocked_list(spark, sf):
    return filters.blocked_sources(standins.sources(spark, sf)).select("source", "name", "urls_found", "html_blocked")


@query("correct_status", with_ctes("sources", f"""
SELECT source, {_CORRECT} AS by_default, CASE WHEN coalesce(urls_found, 0) = 0 THEN 'pending' WHEN html_blocked > 0 THEN 'blocked' WHEN html_scraped < urls_found THEN 'in_progress' WHEN builds IS NOT NULL THEN 'completed' ELSE 'in_progress' END AS builds_known,
  CASE WHEN coalesce(urls_found, 0) = 0 THEN 'pending' WHEN html_blocked > 0 THEN 'blocked' WHEN html_scraped + html_failed + html_blocked < urls_found THEN 'in_progress' WHEN builds IS NOT NULL AND mods IS NOT NULL AND expected_urls = urls_found AND html_scraped + html_failed + html_blocked = urls_found THEN 'completed' ELSE 'in_progress' END AS all_known FROM sources"""))
def correct_status(spark, sf):
    args = ("urls_found", "html_scraped", "html_failed", "html_blocked", "builds", "mods")
    return standins.sources(spark, sf).select(
        "source", buckets.correct_status(*args).alias("by_default"), buckets.correct_status(*args, rule="builds_known").alias("builds_known"),
        buckets.correct_status(*args, rule="all_known", expected="expected_urls").alias("all_known"),
    )


@query("next_action", with_ctes("sources", """
SELECT source, CASE WHEN mods IS NOT NULL THEN 'complete' WHEN urls_found IS NULL OR urls_found = 0 THEN 'discover_urls' WHEN coalesce(html_scraped, 0) < urls_found THEN 'scrape_pages' WHEN builds IS NULL THEN 'extract_builds' ELSE 'extract_mods' END AS action FROM sources"""))
def next_action(spark, sf):
    return standins.sources(spark, sf).select("source", buckets.next_action("urls_found", "html_scraped", "builds", "mods").alias("action"))


@query("needs_work", with_ctes("sources", """
SELECT source FROM sources WHERE status IN ('pending', 'in_progress', 'blocked') OR urls_found IS NULL OR html_scraped IS NULL OR html_scraped < urls_found OR (html_scraped IS NOT NULL AND builds IS NULL)"""))
def needs_work(spark, sf):
    return standins.sources(spark, sf).where(filters.needs_work()).select("source")


@query("failing_sources", with_ctes("sources", "SELECT source, html_failed + html_blocked AS failures, urls_found FROM sources WHERE html_failed + html_blocked > 5 AND urls_found > 0"))
def failing_sources(spark, sf):
    return filters.failing(standins.sources(spark, sf), 5).select("source", "failures", "urls_found")


@query("status_filters", with_ctes("sources", "SELECT 'one' AS f, source FROM sources WHERE status = 'pending' UNION ALL SELECT 'set', source FROM sources WHERE status IN ('pending', 'in_progress') UNION ALL SELECT 'recent', source FROM (SELECT DISTINCT source FROM log WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 600 MINUTE)"))
def status_filters(spark, sf):
    rows = standins.sources(spark, sf)
    one, some = filters.with_status(rows, "pending"), filters.with_status_in(rows, ["pending", "in_progress", "blocked"], skip_blocked=True)
    fresh = filters.recent(standins.log(spark, sf), "ts", _as_of(), 600).select("source").distinct()
    return one.select(F.lit("one").alias("f"), "source").union(some.select(F.lit("set").alias("f"), "source")).union(fresh.select(F.lit("recent").alias("f"), "source"))


@query("source_search", with_ctes("sources", "SELECT source FROM sources WHERE lower(name) LIKE '%site 1%' OR lower(source_id) LIKE '%site 1%'"))
def source_search(spark, sf):
    return filters.search_sources(standins.sources(spark, sf), "SITE 1").select("source")


@query("next_source", with_ctes("sources", "SELECT source, priority FROM sources WHERE status IN ('pending', 'in_progress') ORDER BY coalesce(priority, 999), name LIMIT 1"))
def next_source(spark, sf):
    return ordering.next_source(standins.sources(spark, sf)).select("source", "priority")


@query("next_in_order", with_ctes("sources", "SELECT source FROM sources WHERE status IN ('in_progress', 'pending') ORDER BY CASE status WHEN 'in_progress' THEN 0 ELSE 1 END, position LIMIT 1"))
def next_in_order(spark, sf):
    return ordering.next_in_file_order(standins.sources(spark, sf), "position").select("source")


_MODES = {
    "name": "name", "urls": "coalesce(urls_found, 0) DESC, name", "builds": "coalesce(builds, 0) DESC, name",
    "progress": "coalesce(coalesce(html_scraped, 0)::DOUBLE / nullif(urls_found, 0), 0) DESC, name",
    "status": "CASE status WHEN 'in_progress' THEN 0 WHEN 'pending' THEN 1 WHEN 'blocked' THEN 2 WHEN 'completed' THEN 3 ELSE 99 END, name",
}


@query("multi_sort", with_ctes("sources", " UNION ALL ".join(f"SELECT '{m}' AS mode, source, row_number() OVER (ORDER BY {o}, source) AS place FROM sources" for m, o in _MODES.items())))
def multi_sort(spark, sf):
    """All sources with their place under each sort mode."""
    rows = standins.sources(spark, sf)
    one = {"place": ("sum", F.lit(1).cast("bigint"))}
    parts = [scan.running(rows, [], [*ordering.sort_key(m), F.col("source")], one).select(F.lit(m).alias("mode"), "source", "place") for m in _MODES]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@query("queue_priority", with_ctes("sources", """
SELECT source, CASE WHEN coalesce(urls_found, 0) > 0 AND coalesce(html_scraped, 0) = 0 THEN 1 WHEN status = 'pending' AND priority IS NULL THEN 5 ELSE priority END AS auto,
  CASE WHEN position % 9 = 0 THEN 1 WHEN coalesce(priority, 5) < 5 THEN 5 ELSE priority END AS selected, CASE WHEN position % 9 = 0 THEN 'in_progress' ELSE status END AS new_status FROM sources"""))
def queue_priority(spark, sf):
    rows = standins.sources(spark, sf)
    auto = ordering.auto_priority(rows).select("source", F.col("priority").alias("auto"))
    chosen = ordering.select_sources(rows, rows.where("position % 9 = 0")).select("source", F.col("priority").alias("selected"), F.col("status").alias("new_status"))
    return auto.join(chosen, "source")


@query("counter_check", with_ctes("sources", """
SELECT source, CASE WHEN coalesce(urls_found, 0) = 0 THEN 'missing' WHEN urls_found < expected_urls THEN 'incomplete' ELSE 'ok' END AS counter_check FROM sources"""))
def counter_check(spark, sf):
    return jobs.source_counters_check(standins.sources(spark, sf))


@query("counter_differences", with_ctes("sources", """
SELECT s.source, coalesce(urls_found, 0) - coalesce(n, 0) AS urls_found_difference, coalesce(html_scraped, 0) - coalesce(ok, 0) AS html_scraped_difference
FROM sources s LEFT JOIN (SELECT source, count(*) AS n, count(*) FILTER (WHERE status = 'success') AS ok FROM log WHERE k % 2 = 0 GROUP BY 1) a USING (source)"""))
def counter_differences(spark, sf):
    actual = standins.log(spark, sf).where("k % 2 = 0").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "success").alias("ok"))
    out = joins.counter_differences(standins.sources(spark, sf), actual, {"urls_found": "n", "html_scraped": "ok"})
    return out.select("source", "urls_found_difference", "html_scraped_difference")


@query("source_sync", with_ctes("sources", """
, a AS (SELECT source, count(*) FILTER (WHERE k % 2 = 0) AS urls, count(*) FILTER (WHERE status = 'success' AND k % 2 = 1) AS pages, count(*) FILTER (WHERE event_type = 'purchase' AND value > 90) AS builds_n FROM log GROUP BY 1)
SELECT source, CASE WHEN a.urls > 0 THEN a.urls ELSE urls_found END AS urls_found, CASE WHEN pages > 0 THEN pages ELSE html_scraped END AS html_scraped,
  CASE WHEN builds_n > 0 AND status <> 'completed' THEN 'completed' WHEN builds_n = 0 AND pages > 0 AND urls > 0 AND pages >= urls AND status = 'pending' THEN 'in_progress' ELSE status END AS new_status FROM sources JOIN a USING (source)"""))
def source_sync(spark, sf):
    log = standins.log(spark, sf)
    tables = {"urls": log.where("k % 2 = 0"), "pages": log.where("status = 'success' and k % 2 = 1"), "builds": log.where("event_type = 'purchase' and value > 90"), "mods": log.where("value < 0")}
    stored = standins.sources(spark, sf).withColumnsRenamed({"builds": "builds_stored", "mods": "mods_stored"})
    return jobs.sync_sources(stored, tables).select("source", "urls_found", "html_scraped", "new_status")


# --- windows ---------------------------------------------------------------


@query("row_number_rank", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rank FROM orders")
def row_number_rank(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = windows.ranked(orders, ["o_custkey"], [F.col("o_orderdate").desc(), "o_orderkey"])
    return out.select("o_orderkey", "rank")


@query("distinct_on", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1")
def distinct_on(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")
    return windows.distinct_on(orders, ["o_custkey", "o_orderpriority"], ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("distinct_on_counts", "SELECT count(*) AS \"before\", count(DISTINCT (o_custkey, o_orderpriority)) AS \"after\", count(*) - count(DISTINCT (o_custkey, o_orderpriority)) AS removed FROM orders")
def distinct_on_counts(spark, sf):
    return windows.distinct_on_counts(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"])


@query("latest_per_key", "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_per_key(spark, sf):
    return A.latest_row(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"])


@query("repeat_flag", "SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) > 1 AS is_repeat FROM events")
def repeat_flag(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return windows.repeats(events, ["user_id", "event_type"], "event_id").select("event_id", "is_repeat")


_RUN = """, a AS (SELECT *, count(*) FILTER (WHERE status = 'success') OVER (PARTITION BY source ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM log),
r AS (SELECT *, count(*) FILTER (WHERE status = 'blocked') OVER (PARTITION BY source, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM a)
"""


def _runs(spark, sf):
    status = F.col("status")
    return windows.run_lengths(standins.log(spark, sf).select("event_id", "source", "ts", "status"), ["source"], ["ts", "event_id"], status == "blocked", status == "success")


@query("consecutive_runs", with_ctes("log", _RUN + "SELECT event_id, source, status, run FROM r"))
def consecutive_runs(spark, sf):
    return _runs(spark, sf).select("event_id", "source", "status", "run")


@query("backoff", with_ctes("log", _RUN + "SELECT event_id, least(300 * 2 ** run, 1800)::BIGINT AS backoff_s, run >= 5 AS should_stop FROM r"))
def backoff(spark, sf):
    return windows.with_backoff(_runs(spark, sf)).select("event_id", "backoff_s", "should_stop")


_STATE = "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'blocked' ELSE 'ok' END"


@query("status_transitions", f"""
SELECT event_id, status, previous_status FROM (SELECT event_id, {_STATE} AS status, lag({_STATE}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_status FROM events) WHERE status IN ('blocked', 'error', 'hitl') AND status IS DISTINCT FROM previous_status""")
def status_transitions(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts", F.expr(_STATE).alias("status"))
    return windows.transitions(rows, ["user_id"], ["ts", "event_id"]).select("event_id", "status", "previous_status")


@query("batches", "SELECT event_id, user_id, CAST(floor((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) / 25) AS BIGINT) AS batch FROM events")
def batches(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return windows.batches(events, ["ts", "event_id"], 25, ["user_id"]).select("event_id", "user_id", "batch")


@query("session_buckets", with_ctes("log", """
, n AS (SELECT *, row_number() OVER w AS rn, coalesce(lag(status = 'blocked') OVER w, false) AS opens FROM log WINDOW w AS (PARTITION BY source ORDER BY ts, event_id)),
s AS (SELECT *, count(*) FILTER (WHERE opens) OVER w AS block_sessions, coalesce(max(CASE WHEN opens THEN rn - 1 END) OVER w, 0) AS start FROM n WINDOW w AS (PARTITION BY source ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, block_sessions, CAST(floor((rn - start - 1) / 10) AS BIGINT) AS session_part FROM s"""))
def session_buckets(spark, sf):
    rows = standins.log(spark, sf).select("event_id", "source", "ts", "status")
    out = windows.sessions(rows, ["source"], ["ts", "event_id"], F.col("status") == "blocked", pages=10)
    return out.select("event_id", "block_sessions", "session_part")


@query("daily_quota", "SELECT event_id, CAST(day AS VARCHAR) AS day, day_rank FROM (SELECT event_id, CAST(ts AS DATE) AS day, CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS INT) AS day_rank FROM events) WHERE day_rank <= 50")
def daily_quota(spark, sf):
    out = windows.within_quota(table(spark, sf, "events").select("event_id", "ts"), 50, ["ts", "event_id"])
    return out.select("event_id", F.col("day").cast("string").alias("day"), "day_rank")


@query("stalls", with_ctes("log", f"""
SELECT source, CAST(trunc((epoch_us({AS_OF}) - epoch_us(max(ts))) / 1000000) AS BIGINT) AS age_s, epoch_us({AS_OF}) - epoch_us(max(ts)) > 600999999 AND count(*) % 3 > 0 AS stalled FROM log GROUP BY source"""))
def stalls(spark, sf):
    rows = standins.log(spark, sf)
    remaining = rows.groupBy("source").agg((F.count(F.lit(1)) % 3).alias("remaining"))
    return windows.stalled(rows, _as_of(), remaining=remaining).select("source", "age_s", "stalled")


@query("history_newest", "SELECT user_id, event_id, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events) WHERE rank <= 5")
def history_newest(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return windows.newest(events, ["user_id"], ["ts", "event_id"], 5).select("user_id", "event_id", "rank")


@query("snapshot_retention", "SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rank FROM events) WHERE rank <= 3")
def snapshot_retention(spark, sf):
    events = table(spark, sf, "events").select("event_type", "event_id", "ts")
    return windows.newest(events, ["event_type"], ["ts", "event_id"], 3).select("event_type", "event_id")


@query("ages", f"""
SELECT event_id, date_diff('second', ts, {AS_OF}) // 60 AS minutes, CASE WHEN s < 60 THEN 'just now' WHEN s < 3600 THEN s // 60 || 'm ago' WHEN s < 86400 THEN s // 3600 || 'h ago' ELSE s // 86400 || 'd ago' END AS ago, s > 600 AS stale
FROM (SELECT event_id, ts, (epoch_us({AS_OF}) - epoch_us(ts)) // 1000000 AS s FROM events) WHERE ts <= {AS_OF}""".replace("date_diff('second', ts, TIMESTAMP '2024-01-30 12:00:00') // 60", "s // 60"))
def ages(spark, sf):
    rows = table(spark, sf, "events").where(F.col("ts") <= _as_of())
    return rows.select("event_id", buckets.age_minutes("ts", _as_of()).alias("minutes"), buckets.time_ago("ts", _as_of()).alias("ago"), buckets.is_stale("ts", _as_of()).alias("stale"))


@query("iso_times", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso, CASE event_id % 3 WHEN 0 THEN NULL ELSE epoch_ms(date_trunc('second', ts)) // 1000 END AS parsed FROM events")
def iso_times(spark, sf):
    raw = F.when(F.col("event_id") % 3 == 0, "not a time").when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss+00:00"))
    return table(spark, sf, "events").select("event_id", buckets.iso_time("ts").alias("iso"), F.unix_timestamp(buckets.parse_time(raw)).alias("parsed"))


@query("log_tail", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def log_tail(spark, sf):
    from weftwork.sources.readers import log_tail as tail

    return tail(table(spark, sf, "events").select("event_id", "ts"), 20, "ts", "event_id").select("event_id")


@query("log_by_source", with_ctes("log", "SELECT event_id FROM (SELECT event_id, source || ' stage ' AS x, CASE WHEN event_id % 10 = 0 THEN ' ---- ' WHEN event_id % 10 = 1 THEN 'Iteration 4' ELSE 'fetch ' || replace(source, '_', '-') || ' ' || status END AS m FROM log) WHERE contains(lower(m), 'site_1') OR contains(lower(m), 'site-1') OR contains(lower(m), 'iteration') OR contains(lower(m), 'stage') OR regexp_matches(m, '^\\s*[-=]+\\s*$')"))
def log_by_source(spark, sf):
    i = F.col("event_id") % 10
    message = F.when(i == 0, " ---- ").when(i == 1, "Iteration 4").otherwise(F.concat(F.lit("fetch "), F.replace("source", F.lit("_"), F.lit("-")), F.lit(" "), F.col("status")))
    lines = standins.log(spark, sf).select("event_id", message.alias("message"))
    return filters.log_for_source(lines, "site_1").select("event_id")


@query("session_flags", """
SELECT user_id, bool_or(event_type = 'signup') AS success, bool_or(event_type = 'purchase' AND value > 200) AS critical, count(*) FILTER (WHERE event_type = 'error') AS error_lines,
  bool_or(event_type = 'purchase' AND value > 200) OR count(*) FILTER (WHERE event_type = 'error') > 10 AS breaker FROM events GROUP BY user_id""")
def session_flags(spark, sf):
    kind = F.col("event_type")
    message = (
        F.when(kind == "signup", "all Done!").when(kind == "error", "ERROR: x")
        .when((kind == "purchase") & (F.col("value") > 200), "Segmentation fault").otherwise("fine")
    )
    return filters.session_flags(table(spark, sf, "events").select("user_id", message.alias("message")), ["user_id"])


@query("last_log_lines", with_ctes("log sources", """
, hits AS (SELECT s.source_id, l.event_id, 'line ' || l.source || ' ' || l.status AS message, row_number() OVER (PARTITION BY s.source_id ORDER BY l.event_id DESC) AS rn FROM sources s JOIN log l ON contains(lower('line ' || l.source || ' ' || l.status), lower(s.source_id)))
SELECT source_id, string_agg(message, chr(10) ORDER BY event_id) AS log_tail, count(*) AS lines FROM hits WHERE rn <= 20 GROUP BY 1"""))
def last_log_lines(spark, sf):
    """The last twenty lines that mention each source; ids also match inside longer ids, as substrings do."""
    lines = standins.log(spark, sf).select(F.col("event_id").alias("line_no"), F.concat(F.lit("line "), "source", F.lit(" "), "status").alias("message"))
    return joins.last_log_lines(standins.sources(spark, sf), lines)


@query("sample_extrapolate", """
, s AS (SELECT * FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || 'x'), doc_id LIMIT 100)
SELECT CAST(floor(count(*) FILTER (WHERE n_chars < 500) * ((SELECT count(*) FROM documents)::DOUBLE / count(*))) AS BIGINT) AS small, CAST(floor(count(*) FILTER (WHERE lang = 'en') * ((SELECT count(*) FROM documents)::DOUBLE / count(*))) AS BIGINT) AS english FROM s""".replace(", s AS", "WITH s AS", 1))
def sample_extrapolate(spark, sf):
    """A repeatable sample of 100 with its counts scaled up: the sampling operator itself."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    taken = ordering.sample(docs, "doc_id", 100, "x")
    counted = taken.agg(F.count(F.lit(1)).alias("sample_size"), F.count_if(F.col("n_chars") < 500).alias("small"), F.count_if(F.col("lang") == "en").alias("english"))
    return ordering.extrapolated(counted, docs.agg(F.count(F.lit(1)).alias("population")), ["small", "english"]).select("small", "english")


@query("hash_sample", "SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ''), doc_id LIMIT 50")
def hash_sample(spark, sf):
    return ordering.sample(table(spark, sf, "documents").select("doc_id"), "doc_id", 50)


@query("latest_patterns", "SELECT event_id FROM events WHERE event_type = 'click' ORDER BY ts DESC, event_id LIMIT 10")
def latest_patterns(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("created_at"), F.col("event_type").alias("stage"))
    return ordering.latest_patterns(rows, 10, "click").select(F.col("id").alias("event_id"))


@query("most_recent_active", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate DESC, o_orderkey LIMIT 1")
def most_recent_active(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("status"))
    return ordering.most_recent(rows, "O", "o_orderdate", "o_orderkey").select("o_orderkey")


@query("hot_group_windows", """
SELECT event_id, row_number() OVER (PARTITION BY CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END ORDER BY ts, event_id) AS at,
  CAST(sum(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM events""")
def hot_group_windows(spark, sf):
    """Running values where one key holds a third of all rows, computed in range segments."""
    key = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    rows = table(spark, sf, "events").select("event_id", "ts", key.alias("key"), F.floor("value").alias("v"))
    out = scan.running(rows, ["key"], ["ts", "event_id"], {"at": ("sum", F.lit(1).cast("bigint")), "total": ("sum", F.col("v"))})
    return out.select("event_id", "at", "total")
