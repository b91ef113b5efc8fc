"""Queries on state folds, graphs, id reconciliation, JSON and categories."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import records
from weftwork.operators import aggregates as A
from weftwork.operators import bucketed, categories, filters, graph, joins, sets, state, udfs
from weftwork.plans import jobs, standins
from weftwork.plans.registry import query, table
from weftwork.plans.similar_sql import GESTALT, cascade
from weftwork.plans.standins import with_ctes
from weftwork.session import checkpoint_dir

# --- state -----------------------------------------------------------------

_STATE = "SELECT user_id, max_by(event_type, event_id) AS status, max_by(value, event_id) AS amount, max(ts) AS updated_at FROM events WHERE event_id % 3 > 0 AND user_id % 5 > 0 GROUP BY 1"
_NEW = "SELECT user_id, max_by(event_type, (ts, event_id)) AS status, max_by(CASE WHEN event_type = 'click' THEN NULL ELSE value END, (ts, event_id)) AS amount, max(ts) AS updated_at, true AS hit FROM events WHERE event_id % 3 = 0 AND user_id % 7 > 0 GROUP BY 1"


def _state(spark, sf):
    events = table(spark, sf, "events").where("event_id % 3 > 0 and user_id % 5 > 0")
    return events.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("status"), F.max_by("value", "event_id").alias("amount"), F.max("ts").alias("updated_at"))


def _changes(spark, sf):
    events = table(spark, sf, "events").where("event_id % 3 = 0 and user_id % 7 > 0")
    return events.select("user_id", F.col("event_type").alias("status"), F.when(F.col("event_type") != "click", F.col("value")).alias("amount"), F.col("ts").alias("updated_at"), "event_id")


# Per column the newest value that is not null, so that every partial change of a key counts.
_LAST = "(array_agg({0} ORDER BY ts DESC, event_id DESC) FILTER (WHERE {0} IS NOT NULL))[1] AS {0}"
_UPSERT = f"""WITH s AS ({_STATE}), n AS (SELECT user_id, event_type AS status, CASE WHEN event_type = 'click' THEN NULL ELSE value END AS amount, ts AS updated_at, ts, event_id FROM events WHERE event_id % 3 = 0 AND user_id % 7 > 0),
c AS (SELECT user_id, {_LAST.format("status")}, {_LAST.format("amount")}, {_LAST.format("updated_at")} FROM n GROUP BY 1),
up AS (SELECT coalesce(c.user_id, s.user_id) AS user_id, coalesce(c.status, s.status) AS status, coalesce(c.amount, s.amount) AS amount, coalesce(c.updated_at, s.updated_at) AS updated_at,
  CASE WHEN c.user_id IS NULL THEN 'kept' WHEN s.user_id IS NULL THEN 'created' ELSE 'updated' END AS action FROM s FULL JOIN c ON s.user_id = c.user_id)
"""


@query("state_upsert", _UPSERT + "SELECT user_id, status, amount, updated_at, action FROM up")
def state_upsert(spark, sf):
    return state.upsert(_state(spark, sf), _changes(spark, sf), "user_id", ["updated_at", "event_id"])


_SCHEMA = "user_id bigint, status string, amount double, updated_at timestamp"


@query("state_merge", _UPSERT.replace("user_id % 7 > 0", "user_id % 7 > 0 AND user_id % 16 < 5").rstrip() + """,
t AS (SELECT DISTINCT user_id % 16 AS bucket FROM n), kept AS (SELECT * FROM up WHERE user_id % 48 <> 3)
SELECT user_id, status, amount, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at, CAST(CASE WHEN user_id % 16 = 3 THEN 2 WHEN user_id % 16 IN (SELECT bucket FROM t) THEN 1 ELSE 0 END AS INT) AS held FROM kept""")
def state_merge(spark, sf):
    """Upsert and delete into bucketed state; ``held`` is the version that last rewrote a row's bucket."""
    path, bucket = f"{checkpoint_dir(spark)}/state-{uuid.uuid4().hex}", F.col("user_id") % 16
    bucketed.create(_state(spark, sf), path, bucket)
    bucketed.upsert(spark, path, 0, _SCHEMA, _changes(spark, sf).where("user_id % 16 < 5"), "user_id", ["updated_at", "event_id"], bucket)
    gone = table(spark, sf, "events").where("user_id % 48 = 3").select("user_id")
    bucketed.delete(spark, path, 1, _SCHEMA, gone, "user_id", bucket)
    out = bucketed.read(spark, path, 2, _SCHEMA)
    return out.select("user_id", "status", "amount", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"), "held")


@query("catalog_tables", "SELECT 'catalog_kept' AS name, count(*) AS n FROM nation")
def catalog_tables(spark, sf):
    """Two tables registered, one dropped, the rest listed with its rows."""
    for name in ("catalog_kept", "catalog_gone"):
        table(spark, sf, "nation").createOrReplaceTempView(name)
    state.drop_view(spark, "catalog_gone")
    names = [n for n in state.tables(spark) if n.startswith("catalog_")]
    return reduce(DataFrame.union, [spark.table(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in names])


@query("state_history", _UPSERT + """, h AS (SELECT n.user_id, CASE WHEN s.user_id IS NULL AND row_number() OVER (PARTITION BY n.user_id ORDER BY ts, event_id) = 1 THEN 'created' ELSE 'updated' END AS action
  FROM n LEFT JOIN s ON n.user_id = s.user_id) SELECT user_id, action, count(*) AS n FROM h GROUP BY ALL""")
def state_history(spark, sf):
    done = state.history(_state(spark, sf), _changes(spark, sf), "user_id", ["updated_at", "event_id"], F.col("updated_at"))
    return done.groupBy("user_id", "action").agg(F.countDistinct("id").alias("n"))


@query("state_fold", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def state_fold(spark, sf):
    return state.fold(table(spark, sf, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("state_get", "SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42")
def state_get(spark, sf):
    return state.get(table(spark, sf, "customer"), "c_custkey", 42).select("c_custkey", "c_name")


@query("state_changes", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'X' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 8 = 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer""")
def state_changes(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    changes = customers.where("c_custkey % 4 = 0").select("c_custkey", F.lit("X").alias("c_mktsegment"), F.when(F.col("c_custkey") % 8 == 0, F.lit(0.0)).alias("c_acctbal"))
    early = changes.withColumns({"c_mktsegment": F.lit("W"), "seq": F.lit(1)})
    late = changes.withColumns({"c_acctbal": F.lit(None).cast("double"), "seq": F.lit(2)})
    return state.apply_changes(customers, early.unionByName(late), "c_custkey", ["seq"])


@query("state_delete", """
SELECT 'customer' AS t, count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def state_delete(spark, sf):
    """Keys removed from the state and, with it, from everything that hangs on them."""
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    keys = orders.where("o_orderstatus = 'P'").select("c_custkey")
    customers, kept = state.delete(keys, "c_custkey", table(spark, sf, "customer"), orders)
    return customers.agg(F.count(F.lit(1)).alias("n")).select(F.lit("customer").alias("t"), "n").union(kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("orders").alias("t"), "n"))


@query("retry_fold", """
SELECT c_custkey, CASE WHEN n IS NULL THEN 'blocked' ELSE 'in_progress' END AS status, CAST(c_custkey % 3 + coalesce(n, 0) AS BIGINT) AS attempts, last AS last_attempt, method AS last_method
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last, (array_agg(o_orderpriority ORDER BY o_orderdate DESC, o_orderpriority DESC))[1] AS method FROM orders GROUP BY 1) r ON c_custkey = o_custkey""")
def retry_fold(spark, sf):
    current = table(spark, sf, "customer").select(
        "c_custkey", F.lit("blocked").alias("status"), (F.col("c_custkey") % 3).alias("attempts"), F.lit(None).cast("timestamp_ntz").alias("last_attempt"), F.lit(None).cast("string").alias("last_method"),
    )
    events = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("method"))
    return state.retries(current, events, "c_custkey")


@query("resume_points", "SELECT user_id, event_id AS checkpoint_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type = 'view') WHERE rn = 1")
def resume_points(spark, sf):
    saved = table(spark, sf, "events").where("event_type = 'view'").select("user_id", F.col("event_id").alias("checkpoint_id"), F.col("ts").alias("saved_at"))
    return state.resume_points(saved, ["user_id"]).select("user_id", "checkpoint_id")


@query("register_sources", r"""
SELECT DISTINCT regexp_replace(replace(regexp_extract(url, '^https?://([^/?#]*)', 1), 'www.', ''), '[.\-]', '_', 'g') AS source_id, 'pending' AS status, 5 AS priority FROM pages
WHERE regexp_replace(replace(regexp_extract(url, '^https?://([^/?#]*)', 1), 'www.', ''), '[.\-]', '_', 'g') NOT IN (SELECT regexp_replace(replace(regexp_extract(url, '^https?://([^/?#]*)', 1), 'www.', ''), '[.\-]', '_', 'g') FROM pages WHERE page_id % 2 = 0)""")
def register_sources(spark, sf):
    from weftwork.functions.urls import source_id_from_url

    pages = table(spark, sf, "pages")
    known = pages.where("page_id % 2 = 0").select(source_id_from_url("url").alias("source_id"))
    return state.register_sources(known, pages.select("url")).select("source_id", "status", "priority")


# --- arrays of stories (conversations folded) ------------------------------


def _stories(spark, sf):
    """Turns of a conversation as an array; a conversation is short."""
    story = F.struct(F.col("turn").alias("id"), F.col("role").alias("title"), (F.length("text") % 3).alias("priority"), (F.length("text") > 200).alias("passes"))
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(story)).alias("stories"))


@query("array_count", """
SELECT conv_id, count(*)::INT AS stories_total, count(*) FILTER (WHERE length(text) > 200)::INT AS stories_completed, CASE WHEN bool_and(length(text) > 200) THEN 'complete' ELSE 'active' END AS status FROM conversations GROUP BY 1""")
def array_count(spark, sf):
    return state.story_counts(_stories(spark, sf)).drop("stories")


@query("array_update", """
SELECT conv_id, count(*) FILTER (WHERE turn = 1 OR length(text) > 200)::INT AS passed, string_agg(CASE WHEN turn = 1 THEN 'changed' ELSE role END, ',' ORDER BY turn) AS titles FROM conversations GROUP BY 1""")
def array_update(spark, sf):
    updated = _stories(spark, sf).withColumn("stories", records.update_element("stories", "id", 1, passes=True, title="changed"))
    return updated.select(
        "conv_id", records.count_where("stories", lambda s: s["passes"]).alias("passed"), F.array_join(F.transform("stories", lambda s: s["title"]), ",").alias("titles")
    )


@query("next_open_story", """
SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) % 3, turn) AS rn FROM conversations WHERE length(text) <= 200) WHERE rn = 1""")
def next_open_story(spark, sf):
    found = _stories(spark, sf).select("conv_id", records.next_open("stories").alias("s")).where("s is not null")
    return found.select("conv_id", F.col("s.id").alias("turn"))


@query("story_verification", """
SELECT count(*) * 2 AS total, count(*) FILTER (WHERE n >= 3) + count(*) FILTER (WHERE has_user) AS passed, count(*) * 2 - count(*) FILTER (WHERE n >= 3) - count(*) FILTER (WHERE has_user) AS failed, bool_and(n >= 3 AND has_user) AS all_passed
FROM (SELECT conv_id, count(*) AS n, bool_or(contains(text, 'the')) AS has_user FROM conversations GROUP BY 1)""")
def story_verification(spark, sf):
    """Assertions as rows: enough turns, and the word in some turn."""
    docs = table(spark, sf, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list("text").alias("turns"))).alias("doc"))
    checks = F.array(records.assertion("doc", "count_gte", 3, "$.turns"), records.assertion("doc", "contains_text", "the"))
    return A.batch_assertions(docs.select(F.explode(checks).alias("passed")))


# --- JSON ------------------------------------------------------------------


@query("json_path_project", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, json_extract_string('{"pipeline": {"urlsFound": ' || (event_id % 9) || '}}', '$.pipeline.urlsFound')::INT AS urls_found FROM events""")
def json_path_project(spark, sf):
    rows = table(spark, sf, "events").withColumn("doc", F.concat(F.lit('{"pipeline": {"urlsFound": '), (F.col("event_id") % 9).cast("string"), F.lit("}}")))
    out = filters.json_fields(rows, "props", {"k": ("$.k", "int")})
    return filters.json_fields(out, "doc", {"urls_found": ("$.pipeline.urlsFound", "int")}).select("event_id", "k", "urls_found")


@query("json_assertions", """
SELECT event_id, event_id % 6 <> 0 AS valid, event_id % 6 <> 0 AND k >= 50 AS gte, event_id % 6 <> 0 AND k = 7 AS eq, contains(props, '9') AS has_nine, event_id % 6 <> 0 AS has_field FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""")
def json_assertions(spark, sf):
    doc = F.when(F.col("event_id") % 6 == 0, F.replace("props", F.lit("}"), F.lit(""))).otherwise(F.col("props"))
    rows = table(spark, sf, "events").withColumn("doc", doc)
    return rows.select(
        "event_id", records.assertion("doc", "json_valid").alias("valid"), records.assertion("doc", "count_gte", 50, "$.k").alias("gte"), records.assertion("doc", "count_eq", 7, "$.k").alias("eq"),
        records.assertion("doc", "contains_text", "9").alias("has_nine"), records.assertion("doc", "json_has_field", path="$.k").alias("has_field"),
    )


@query("url_entries", "SELECT page_id, url FROM pages")
def url_entries(spark, sf):
    """Entries as strings, quoted strings and objects all give the URL."""
    entry = F.when(F.col("page_id") % 3 == 0, F.to_json(F.struct("url", F.lit("f").alias("filename")))).when(F.col("page_id") % 3 == 1, F.concat(F.lit('"'), "url", F.lit('"'))).otherwise(F.col("url"))
    return table(spark, sf, "pages").select("page_id", filters.url_of_entry(entry).alias("url"))


@query("api_items", "SELECT url FROM pages UNION ALL SELECT 'https://site.example.com/p/' || event_id FROM events")
def api_items(spark, sf):
    """Items of API answers in each of the wrappers, with url, link or href, absolute or rooted."""
    from weftwork.sources.readers import api_items as items

    pages = table(spark, sf, "pages").select(F.concat(F.lit('[{"link": "'), "url", F.lit('"}]')).alias("p"))
    wrapper = F.when(F.col("event_id") % 3 == 0, "items").when(F.col("event_id") % 3 == 1, "results").otherwise("data")
    field = F.when(F.col("event_id") % 2 == 0, "url").otherwise("href")
    events = table(spark, sf, "events").select(F.concat(F.lit('{"'), wrapper, F.lit('": [{"'), field, F.lit('": "/p/'), F.col("event_id").cast("string"), F.lit('"}]}')).alias("p"))
    return items(pages.union(events), "p", "https://site.example.com/")


@query("struct_merge", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE c_mktsegment END AS a, c_name AS b, CASE WHEN c_custkey % 2 = 0 THEN 'x' END AS extra FROM customer")
def struct_merge(spark, sf):
    old = F.struct(F.col("c_mktsegment").alias("a"), F.col("c_name").alias("b"))
    new = F.struct(F.when(F.col("c_custkey") % 2 == 0, "new").alias("a"), F.lit(None).cast("string").alias("b"))
    maps = records.merge_maps(F.create_map(F.lit("k"), F.col("c_name")), F.when(F.col("c_custkey") % 2 == 0, F.create_map(F.lit("e"), F.lit("x"))).otherwise(F.create_map(F.lit("k"), F.lit("y"))))
    rows = table(spark, sf, "customer").select("c_custkey", records.merge_structs(old, new, ["a", "b"]).alias("m"), maps.alias("mm"))
    return rows.select("c_custkey", "m.a", "m.b", F.try_element_at("mm", F.lit("e")).alias("extra"))


@query("header_keys", "SELECT event_id, event_type IN ('click', 'view') AS has_cf FROM events")
def header_keys(spark, sf):
    name = F.when(F.col("event_type") == "click", "CF-RAY").when(F.col("event_type") == "view", "Cf-Cache-Status").otherwise("Server")
    return table(spark, sf, "events").select("event_id", records.has_header(F.create_map(name, F.lit("1")), vocab.CLOUDFLARE_HEADERS).alias("has_cf"))


# --- ids -------------------------------------------------------------------


@query("reconcile_ids", """
WITH l AS (SELECT DISTINCT doc_id FROM documents WHERE doc_id % 3 > 0), r AS (SELECT DISTINCT doc_id FROM labels)
SELECT (SELECT count(*) FROM l) AS left_ids, (SELECT count(*) FROM r) AS right_ids, (SELECT count(*) FROM l JOIN r USING (doc_id)) AS matched, (SELECT count(*) FROM l WHERE doc_id NOT IN (FROM r)) AS missing, (SELECT count(*) FROM r WHERE doc_id NOT IN (FROM l)) AS orphans,
  round((SELECT count(*) FROM l JOIN r USING (doc_id))::DOUBLE / (SELECT count(*) FROM l) * 100, 1) AS extraction_rate_pct, CASE WHEN (SELECT count(*) FROM l WHERE doc_id NOT IN (FROM r)) * 100.0 / (SELECT count(*) FROM l) > 20 THEN 'critical' WHEN (SELECT count(*) FROM l WHERE doc_id NOT IN (FROM r)) * 100.0 / (SELECT count(*) FROM l) > 5 THEN 'warning' ELSE 'ok' END AS missing_severity""")
def reconcile_ids(spark, sf):
    return joins.reconcile(table(spark, sf, "documents").where("doc_id % 3 > 0"), table(spark, sf, "labels"), "doc_id")


@query("id_set_sizes", """
SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) AS only_left, (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents WHERE doc_id % 2 = 0)) - (SELECT count(*) FROM labels WHERE doc_id % 2 = 1) AS only_right, (SELECT count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)) AS common""")
def id_set_sizes(spark, sf):
    return sets.compare(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query("orphan_labels", "SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def orphan_labels(spark, sf):
    return joins.orphans(table(spark, sf, "labels"), table(spark, sf, "documents").where("lang = 'en'"), "doc_id").select("doc_id", "quality")


@query("entity_sync", """
SELECT coalesce(n.k, o.k) AS k, coalesce(n.name, o.name) AS name, CASE WHEN n.k IS NULL THEN 'kept' WHEN o.k IS NULL THEN 'created' ELSE 'updated' END AS outcome
FROM (SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_custkey % 2 = 0) o FULL JOIN (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'early' ELSE 'new ' || c_mktsegment END AS name FROM customer WHERE c_custkey % 3 = 0) n ON o.k = n.k""")
def entity_sync(spark, sf):
    customers = table(spark, sf, "customer")
    old = customers.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    new = customers.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("new "), "c_mktsegment")).alias("name"))
    both = new.withColumn("seq", F.lit(2)).union(new.select("k", F.lit("early"), F.lit(1)))
    return joins.upsert_entities(old, both, "k", ["name"], ["seq"])


# --- graph -----------------------------------------------------------------


@query("relation_names", with_ctes("entities relations", """
SELECT a.name AS from_entity, a.type AS from_type, relation_type, b.name AS to_entity, b.type AS to_type FROM relations r JOIN entities a ON r.from_id = a.id JOIN entities b ON r.to_id = b.id"""))
def relation_names(spark, sf):
    return graph.named_relations(standins.relations(spark, sf), standins.entities(spark, sf))


_FOUND = "SELECT id FROM entities WHERE type <> 'customer' AND (contains(lower(name), '_1') OR contains(lower(notes), 'region 2'))"


@query("graph_edges_or", with_ctes("entities relations", f"SELECT id, from_id, to_id, relation_type FROM relations WHERE from_id IN ({_FOUND}) OR to_id IN ({_FOUND})"))
def graph_edges_or(spark, sf):
    entities = standins.entities(spark, sf)
    found = filters.search_entities(entities.where("type <> 'customer'"), term="_1").union(filters.search_entities(entities, "nation", "Region 2"))
    return graph.touching(standins.relations(spark, sf), found)


@query("graph_edges_and", with_ctes("entities relations", "SELECT id, relation_type FROM relations WHERE from_id IN (SELECT id FROM entities WHERE type IN ('nation', 'supplier')) AND to_id IN (SELECT id FROM entities WHERE type IN ('nation', 'supplier'))"))
def graph_edges_and(spark, sf):
    nodes = standins.entities(spark, sf).where("type in ('nation', 'supplier')")
    return graph.within(standins.relations(spark, sf), nodes).select("id", "relation_type")


@query("graph_stats", with_ctes("entities relations", """
, o AS (SELECT type, CASE WHEN notes = '' THEN 0 ELSE len(string_split(notes, '|')) END AS n FROM entities)
SELECT 'entity' AS part, type AS name, count(*)::DOUBLE AS value FROM o GROUP BY type UNION ALL SELECT 'relation', relation_type, count(*)::DOUBLE FROM relations GROUP BY 2
UNION ALL SELECT 'observations', 'total', sum(n)::DOUBLE FROM o UNION ALL SELECT 'observations', 'average', round(sum(n)::DOUBLE / count(*), 1) FROM o"""))
def graph_stats(spark, sf):
    return graph.stats(standins.entities(spark, sf), standins.relations(spark, sf))


@query("graph_build", with_ctes("builds mods", """
, b AS (SELECT * FROM builds WHERE build_id = row_id), m AS (SELECT mods.* FROM mods JOIN b USING (build_id))
SELECT 'entity' AS part, 'source' AS name, count(DISTINCT source)::DOUBLE AS value FROM b UNION ALL SELECT 'entity', 'build', count(*)::DOUBLE FROM b UNION ALL SELECT 'entity', 'modification', count(*)::DOUBLE FROM m
UNION ALL SELECT 'relation', 'contains_build', count(*)::DOUBLE FROM b UNION ALL SELECT 'relation', 'has_modification', count(*)::DOUBLE FROM m
UNION ALL SELECT 'observations', 'total', (SELECT count(build_type) + count(nullif(modification_level, '')) FROM b) + (SELECT count(brand) + count(category) FROM m)::DOUBLE
UNION ALL SELECT 'observations', 'average', round(((SELECT count(build_type) + count(nullif(modification_level, '')) FROM b) + (SELECT count(brand) + count(category) FROM m))::DOUBLE / ((SELECT count(DISTINCT source) + count(*) FROM b) + (SELECT count(*) FROM m)), 1)"""))
def graph_build(spark, sf):
    """Sources, builds and modifications as entities with both kinds of relation, counted."""
    builds = standins.builds_with_mods(spark, sf).where("build_id = row_id")
    _, _, stats = jobs.build_graph(builds)
    return stats


@query("build_titles", with_ctes("builds", """
SELECT row_id, coalesce(nullif(build_title, ''), nullif(trim(coalesce(year, '') || ' ' || coalesce(make, '') || ' ' || coalesce(model, '')), ''), 'Unknown Build') AS title FROM builds"""))
def build_titles(spark, sf):
    return standins.builds(spark, sf).select("row_id", filters.build_title().alias("title"))


@query("graph_source_view", """
SELECT s_name AS name, CASE s_suppkey % 3 WHEN 0 THEN 'pending' ELSE 'completed' END AS status, CAST(s_suppkey AS INT) AS urls_found, CAST(s_suppkey % 7 AS INT) AS html_scraped, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS INT) END AS builds, CAST(NULL AS INT) AS mods FROM supplier""")
def graph_source_view(spark, sf):
    c = F.col
    inner = F.struct(c("s_suppkey").alias("urlsFound"), (c("s_suppkey") % 7).alias("htmlScraped"), F.when(c("s_suppkey") % 2 == 0, c("s_nationkey")).alias("builds"))
    status = F.when(c("s_suppkey") % 3 == 0, "pending").otherwise("completed")
    rows = table(spark, sf, "supplier").select(F.lit("source").alias("type"), c("s_name").alias("name"), F.to_json(F.struct(status.alias("status"), inner.alias("pipeline"))).alias("properties"))
    return graph.source_view(rows)


@query("graph_observations", with_ctes("entities", """
SELECT e.id, (CASE WHEN notes = '' THEN 0 ELSE len(string_split(notes, '|')) END + coalesce(n, 0))::INT AS observations FROM entities e LEFT JOIN (SELECT 'c' || o_custkey AS id, count(*) AS n FROM orders GROUP BY 1) o USING (id)"""))
def graph_observations(spark, sf):
    notes = table(spark, sf, "orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("id"), F.col("o_orderdate").alias("at"), F.col("o_orderstatus").alias("note"))
    entities = standins.entities(spark, sf)
    counted = graph.observation_rows(entities, notes).groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("observations"))
    return entities.select("id").join(counted, "id", "left").fillna(0, ["observations"])


@query("graph_append", with_ctes("entities relations", """
SELECT count(*) AS relations, (SELECT count(*) FROM entities) AS entities FROM (SELECT from_id, to_id FROM relations WHERE relation_type <> 'ordered' UNION ALL SELECT from_id, to_id FROM relations WHERE from_id IN (SELECT id FROM entities) AND to_id IN (SELECT id FROM entities))"""))
def graph_append(spark, sf):
    """New relations are kept where both ends exist; entities that exist are not doubled."""
    entities, relations = standins.entities(spark, sf), standins.relations(spark, sf)
    grown = graph.append_entities(entities.where("type <> 'nation'"), entities)
    kept = graph.append_relations(relations.where("relation_type <> 'ordered'"), relations, grown)
    from weftwork.operators.rows import beside

    return beside(kept.agg(F.count(F.lit(1)).alias("relations")), grown.agg(F.count(F.lit(1)).alias("entities")))


# --- categories ------------------------------------------------------------


def _parts(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand")


_KEYED = "SELECT DISTINCT p_name AS keyword, min(p_type) OVER (PARTITION BY p_name) AS category FROM part"


def _keywords(spark, sf):
    return _parts(spark, sf).groupBy(F.col("p_name").alias("keyword")).agg(F.min("p_type").alias("category"), F.min("p_partkey").alias("position"))


_MODS = "CASE p_partkey % 9 WHEN 0 THEN 'ECU remap ' WHEN 1 THEN 'Cat back exhaust ' WHEN 2 THEN 'Cold air kit ' WHEN 3 THEN 'Rear Wing ' WHEN 4 THEN 'KW lowering ' WHEN 5 THEN 'Alloy ' WHEN 6 THEN 'Akrapovic pedal ' WHEN 7 THEN 'Coolant ' ELSE '' END || p_name"
_CATEGORY = "CASE " + " ".join(f"WHEN regexp_matches(lower(m), '{'|'.join(p)}') THEN '{c}'" for c, p in vocab.CATEGORY_PATTERNS) + " ELSE 'Other' END"
_BRAND = "CASE " + " ".join(f"WHEN contains(upper(m), '{b.upper()}') THEN '{b}'" for b in vocab.KNOWN_BRANDS) + f" ELSE '{vocab.DEFAULT_BRAND}' END"


@query("category_regex", f"SELECT p_partkey, {_CATEGORY} AS category, {_BRAND} AS brand FROM (SELECT p_partkey, {_MODS} AS m FROM part)")
def category_regex(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.expr(_MODS).alias("m"))
    return rows.select("p_partkey", categories.pattern_category("m").alias("category"), categories.brand("m").alias("brand"))


_WORDS = "SELECT DISTINCT w FROM (SELECT unnest(string_split(lower(text), ' ')) AS w FROM benchmark) WHERE length(w) >= 5"


@query("keyword_join", f"""
WITH t AS (SELECT doc_id, lower(text) AS t FROM documents), w AS ({_WORDS})
SELECT doc_id, w AS keyword FROM t JOIN w ON contains(t, w) WHERE length(w) >= 8 OR regexp_matches(' ' || t || ' ', '[^\\p{{L}}\\p{{N}}]' || regexp_escape(w) || '[^\\p{{L}}\\p{{N}}]')""")
def keyword_join(spark, sf):
    """Dictionary words in whole documents: alone, or inside words from eight letters on."""
    from weftwork.operators.terms import terms_of

    words = table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("w")).where("length(w) >= 5")
    found = terms_of(table(spark, sf, "documents"), "doc_id", "text", words, "w", 5, 8)
    return found.select("doc_id", F.col("term").alias("keyword"))


@query("component_exact", f"""
WITH k AS ({_KEYED}) SELECT p.p_partkey, k.category FROM part p LEFT JOIN k ON lower(p.p_name) = lower(k.keyword)""")
def component_exact(spark, sf):
    index = _keywords(spark, sf).select(F.lower("keyword").alias("_word"), "category")
    return joins.lookup(_parts(spark, sf).withColumn("_word", F.lower("p_name")), index, "_word").select("p_partkey", "category")


@query("category_members", f"WITH k AS ({_KEYED}) SELECT keyword AS component FROM k WHERE category = 'ECONOMY'")
def category_members(spark, sf):
    return categories.members(_keywords(spark, sf).withColumnRenamed("keyword", "component"), "ECONOMY")


@query("category_vocabulary", "SELECT DISTINCT p_type AS category FROM part UNION SELECT p_brand FROM part")
def category_vocabulary(spark, sf):
    part = table(spark, sf, "part")
    return categories.vocabulary(part.select(F.col("p_type").alias("category")), part.select(F.col("p_brand").alias("category")))


@query("taxonomy_rows", "SELECT p_name AS component, p_type AS category, count(*) AS n FROM part GROUP BY ALL")
def taxonomy_rows(spark, sf):
    """A taxonomy document per part row, read back as (component, category)."""
    docs = table(spark, sf, "part").select(F.to_json(F.create_map("p_type", F.array("p_name"))).alias("value"))
    return categories.taxonomy(docs).groupBy("component", "category").agg(F.count(F.lit(1)).alias("n"))


@query("word_overlap", f"""
WITH k AS (SELECT lower(p_name) AS keyword, min(p_type) AS category FROM part GROUP BY 1), n AS (SELECT DISTINCT lower(p_name) AS t FROM part),
s AS (SELECT t, category, CASE WHEN contains(t, keyword) THEN least(length(keyword)::DOUBLE / length(t) + 0.5, 1.0)
  WHEN len(list_filter(list_intersect(string_split(t, ' '), string_split(keyword, ' ')), lambda w: length(w) >= 4)) > 0
  THEN len(list_filter(list_intersect(string_split(t, ' '), string_split(keyword, ' ')), lambda w: length(w) >= 4))::DOUBLE / greatest(len(string_split(t, ' ')), len(string_split(keyword, ' '))) END AS score FROM n, k)
SELECT t, category, round(max(score), 6) AS score FROM s WHERE score IS NOT NULL GROUP BY ALL""")
def word_overlap(spark, sf):
    names = table(spark, sf, "part").select(F.lower("p_name").alias("t"))
    out = categories.word_overlap(names, "t", _keywords(spark, sf))
    return out.select("t", "category", F.round("score", 6).alias("score"))


_WORDS_OF_PARTS = "SELECT lower(p_name) AS keyword, min(p_type) AS category, min(p_partkey) AS position FROM part GROUP BY 1"


@query("fuzzy_components", f"""
WITH RECURSIVE kw AS ({_WORDS_OF_PARTS}), pairs AS (SELECT DISTINCT lower(p_name || ' ' || p_brand) AS t, keyword AS c FROM part, kw), {GESTALT}
SELECT t, c AS component, category, round(ratio, 6) AS score FROM gestalt JOIN kw ON keyword = c WHERE ratio >= 0.5
QUALIFY row_number() OVER (PARTITION BY t ORDER BY ratio DESC, position) = 1""")
def fuzzy_components(spark, sf):
    """The most similar component of each distinct part name with its brand."""
    components = _keywords(spark, sf).withColumnRenamed("keyword", "component")
    names = table(spark, sf, "part").select(F.lower(F.concat("p_name", F.lit(" "), "p_brand")).alias("t"))
    out = categories.best_component(names, "t", components)
    return out.select("t", "component", "category", F.round("score", 6).alias("score"))


def _cascade(spark, sf, names):
    keywords = _keywords(spark, sf)
    found = categories.detect(table(spark, sf, "part").select(F.expr(names).alias("mod_name")), "mod_name", keywords.withColumnRenamed("keyword", "component"), keywords)
    return found.select("mod_name", "category", F.round("confidence", 6).alias("confidence"))


_KIT = "p_name || ' kit ' || p_type"


@query("category_cascade", cascade(f"SELECT {_KIT} AS mod_name FROM part", _WORDS_OF_PARTS))
def category_cascade(spark, sf):
    """The category cascade for each distinct part name: keywords settle all of them."""
    return _cascade(spark, sf, _KIT)


# Names as they are, cut, turned round, with one word kept, and without any: every step of the cascade settles some.
_MANGLED = """CASE p_partkey % 7 WHEN 0 THEN p_name WHEN 1 THEN 'KW ' || p_name || ' kit' WHEN 2 THEN substr(p_name, 2) || 's' WHEN 3 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
  WHEN 4 THEN 'brand new ' || split_part(p_name, ' ', 2) WHEN 5 THEN reverse(p_name) || ' 0815' ELSE 'x' || p_partkey % 3 END"""


@query("category_cascade_mangled", cascade(f"SELECT {_MANGLED} AS mod_name FROM part", _WORDS_OF_PARTS))
def category_cascade_mangled(spark, sf):
    """The same for names that are not in the dictionary as they stand."""
    return _cascade(spark, sf, _MANGLED)


# --- functions over partitions ---------------------------------------------


@query("map_with_errors", "SELECT event_id, CASE WHEN value < 5 THEN NULL ELSE CAST(event_id % 7 AS BIGINT) * 2 END AS result, CASE WHEN value < 5 THEN 'ValueError: small' END AS error FROM events")
def map_with_errors(spark, sf):
    from pyspark.sql import types as T

    def double(row):
        if row["value"] < 5:
            raise ValueError("small")
        return int(row["event_id"] % 7) * 2

    return udfs.map_rows(table(spark, sf, "events").select("event_id", "value"), double, T.LongType()).select("event_id", "result", "error")


@query("explode_with", 'SELECT page_id, r.i AS "at", CAST(r.i * page_id AS BIGINT) AS product FROM pages, unnest(range(page_id % 4)) AS r(i)')
def explode_with(spark, sf):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("at", T.LongType()), T.StructField("product", T.LongType())])
    pages = table(spark, sf, "pages").select("page_id")
    return udfs.explode_with(pages, lambda r: [{"at": i, "product": i * r["page_id"]} for i in range(r["page_id"] % 4)], schema, ["page_id"], ["page_id"])
