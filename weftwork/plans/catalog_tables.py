"""Queries on builds, mods, sources and plain tables: counts, profiles, scores, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import buckets, records
from weftwork.operators import aggregates as A
from weftwork.operators import filters, joins, scan, sets
from weftwork.plans import jobs, standins
from weftwork.plans.catalog_pages import _REASON, sql_quote
from weftwork.plans.registry import query, table
from weftwork.plans.standins import with_ctes


def sql_list(words):
    return ", ".join(f"'{sql_quote(w)}'" for w in words)


def sql_garbage(column):
    pattern = "(?i)" + "|".join(sql_quote(p).replace(r"[\W\d]", "[^a-zA-Z_]") for p in vocab.GARBAGE_PATTERNS)
    return f"coalesce(regexp_matches(regexp_replace({column}, '^\\s+|\\s+$', '', 'g'), '{pattern}'), true)"


def sql_set(column):
    return f"coalesce(CAST({column} AS VARCHAR) <> '', false)"


def sql_share(part, whole, digits=1):
    return f"round(CASE WHEN ({whole}) = 0 THEN NULL ELSE CAST({part} AS DOUBLE) / ({whole}) END * 100, {digits})"


# --- generic ---------------------------------------------------------------


@query("build_stats", with_ctes("builds", """
SELECT 'total' AS part, NULL AS value, count(*) AS "count" FROM builds
UNION ALL (SELECT 'make', make, count(*) FROM builds WHERE make IS NOT NULL GROUP BY make ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL (SELECT 'year', year, count(*) FROM builds WHERE year IS NOT NULL GROUP BY year ORDER BY 2 DESC LIMIT 10)
UNION ALL SELECT 'source', source, count(*) FROM builds GROUP BY source"""))
def build_stats(spark, sf):
    stats = A.build_stats(standins.builds(spark, sf))

    def part(name, df, value):
        return df.select(F.lit(name).alias("part"), value.alias("value"), F.col(df.columns[-1]).alias("count"))

    return (
        part("total", stats["total"], F.lit(None).cast("string")).union(part("make", stats["by_make"], F.col("make")))
        .union(part("year", stats["by_year"], F.col("year"))).union(part("source", stats["by_source"], F.col("source")))
    )


@query("group_all", """
SELECT p_type, p_brand, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS sizes FROM part GROUP BY ALL""")
def group_all(spark, sf):
    part = table(spark, sf, "part")
    return spark.sql("SELECT p_type, p_brand, count(*) AS parts, sum(p_size) AS sizes FROM {part} GROUP BY ALL", part=part)


@query("exclude_columns", "SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")
def exclude_columns(spark, sf):
    return filters.without(table(spark, sf, "customer"), "c_acctbal", "c_name")


@query("parameter_query", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 AND o_orderpriority = '1-URGENT' GROUP BY 1")
def parameter_query(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders_view")
    sql = "SELECT o_orderstatus, count(*) AS n FROM orders_view WHERE o_totalprice > ? AND o_orderpriority = ? GROUP BY 1"
    return filters.execute(spark, sql, [100000.0, "1-URGENT"])


@query("table_info", """
SELECT v.position, v.column_name, (SELECT count(*) FROM customer) AS row_count
FROM (VALUES (1, 'c_custkey'), (2, 'c_name'), (3, 'c_nationkey'), (4, 'c_acctbal'), (5, 'c_mktsegment')) AS v(position, column_name)""")
def table_info(spark, sf):
    return A.describe_table(table(spark, sf, "customer")).drop("column_type")


_PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, count(DISTINCT {c}) AS distinct_count, "
    f"{'round(avg(' + c + '), 6)' if n else 'NULL::DOUBLE'} AS avg, {'round(stddev(' + c + '), 6)' if n else 'NULL::DOUBLE'} AS std, count({c}) AS \"count\", 0.0::DOUBLE AS null_percentage FROM part"
    for c, n in [("p_partkey", True), ("p_name", False), ("p_brand", False), ("p_size", True), ("p_retailprice", True)]
)


@query("profile_summary", _PROFILE)
def profile_summary(spark, sf):
    """Column profile; approximate quantiles are left out of the comparison."""
    out = A.profile(table(spark, sf, "part"), ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"], exact=True)
    return out.drop("quartiles").withColumns({"avg": F.round("avg", 6), "std": F.round("std", 6)})


@query("top_with_unique", """
WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) SELECT p_brand, n AS "count", (SELECT count(*) FROM c) AS unique_values FROM c ORDER BY n DESC, p_brand LIMIT 5""")
def top_with_unique(spark, sf):
    return A.top_with_unique(table(spark, sf, "part"), "p_brand")


@query("duplicate_count", "SELECT count(*) AS total, count(DISTINCT (l_orderkey, l_partkey)) AS \"distinct\", count(*) - count(DISTINCT (l_orderkey, l_partkey)) AS duplicates FROM lineitem")
def duplicate_count(spark, sf):
    return A.duplicates(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey")


@query("bounded_samples", """
WITH n AS (SELECT p_type, count(*) AS "count" FROM part GROUP BY 1), d AS (SELECT DISTINCT p_type, p_name FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_name) AS rn FROM d)
SELECT n.p_type, n."count", string_agg(r.p_name, '|' ORDER BY r.p_name) AS samples FROM n JOIN r ON n.p_type = r.p_type AND rn <= 5 GROUP BY 1, 2""")
def bounded_samples(spark, sf):
    out = scan.bounded_samples(table(spark, sf, "part"), ["p_type"], "p_name", 5)
    return out.withColumn("samples", F.array_join("samples", "|"))


@query("typed_average", """
SELECT avg(TRY_CAST(v AS DOUBLE)) AS average, count(TRY_CAST(v AS DOUBLE)) AS "count" FROM (SELECT CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(event_id % 10 AS VARCHAR) END AS v FROM events)""")
def typed_average(spark, sf):
    value = F.when(F.col("event_type") == "error", "n/a").otherwise((F.col("event_id") % 10).cast("string"))
    return A.typed_average(table(spark, sf, "events").select(value.alias("v")), "v")


# --- builds ----------------------------------------------------------------

_MAKES = sql_list(vocab.KNOWN_MAKES)
_PRESENCE = f"""count(*) AS total_builds, count(*) FILTER (WHERE build_id <> 0) AS with_build_id, count(*) FILTER (WHERE starts_with(source_url, 'http')) AS with_url,
  count(*) FILTER (WHERE year <> '') AS with_year, count(*) FILTER (WHERE TRY_CAST(substr(year, 1, 4) AS INT) BETWEEN 1900 AND 2027) AS with_valid_year,
  count(*) FILTER (WHERE NOT {sql_garbage('make')}) AS with_make, count(*) FILTER (WHERE NOT {sql_garbage('make')} AND lower(trim(make)) IN ({_MAKES})) AS with_known_make,
  count(*) FILTER (WHERE NOT {sql_garbage('model')}) AS with_model, count(*) FILTER (WHERE NOT {sql_garbage('build_title')}) AS with_title,
  count(*) FILTER (WHERE length(build_story) > 50) AS with_story, count(*) FILTER (WHERE images <> '') AS with_images"""


@query("field_presence", with_ctes("builds", f"SELECT source, {_PRESENCE} FROM builds GROUP BY source"))
def field_presence(spark, sf):
    return A.build_profile(standins.builds(spark, sf), ["source"]).drop("with_mods")


_SCORE = "round((with_build_id * 1.0 + with_url * 1.0 + with_make * 1.0 + with_model * 1.0 + with_year * 0.5 + with_title * 0.3 + with_story * 0.3 + with_images * 0.5)::DOUBLE / total_builds / 5.6 * 100, 4)"


@query("completeness_score", with_ctes("builds", f"""
SELECT source, {_SCORE} AS completeness_score, least(with_build_id, with_url, with_make, with_model) AS valid_builds FROM (SELECT source, {_PRESENCE} FROM builds GROUP BY source)"""))
def completeness_score(spark, sf):
    return A.completeness(A.build_profile(standins.builds(spark, sf), ["source"])).select("source", "completeness_score", "valid_builds")


@query("missing_fields", with_ctes("builds", "\n UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) AS total, count(*) FILTER (WHERE NOT {sql_set(c)}) AS missing, round(count(*) FILTER (WHERE NOT {sql_set(c)})::DOUBLE / count(*) * 100, 1) AS missing_pct, "
    f"CASE WHEN count(*) FILTER (WHERE NOT {sql_set(c)})::DOUBLE / count(*) * 100 > 10 THEN 'critical' WHEN count(*) FILTER (WHERE NOT {sql_set(c)}) > 0 THEN 'warning' ELSE 'ok' END AS severity FROM builds"
    for c in ["build_id", "source_url", "year", "make", "model"])))
def missing_fields(spark, sf):
    return A.missing_fields(standins.builds(spark, sf), ["build_id", "source_url", "year", "make", "model"])


def _sql_issues():
    checks = [(f, "error", f"{f} IS NULL") for f in vocab.REQUIRED_FIELDS]
    for f, allowed, sev in [("source_type", vocab.SOURCE_TYPES, "error"), ("build_type", vocab.BUILD_TYPES, "warning"), ("transmission", vocab.TRANSMISSIONS, "error"), ("drivetrain", vocab.DRIVETRAINS, "error"), ("modification_level", vocab.MOD_LEVELS, "error")]:
        checks.append((f, sev, f"{f} NOT IN ({sql_list(allowed)})"))
    checks += [
        ("year", "error", "NOT regexp_matches(year, '^\\d{4}$')"), ("year", "warning", "regexp_matches(year, '^\\d{4}$') AND TRY_CAST(year AS INT) NOT BETWEEN 1885 AND 2028"),
        ("source_url", "error", "NOT regexp_matches(source_url, '^https?://')"), ("vin", "warning", f"NOT regexp_matches(vin, '{vocab.VIN}')"),
        ("extraction_confidence", "error", "extraction_confidence NOT BETWEEN 0 AND 1"),
        ("sale_data", "warning", "source_type IN ('listing', 'auction') AND NOT for_sale"),
        ("sale_data", "info", "source_type IN ('build_thread', 'project', 'gallery', 'article') AND for_sale"),
        ("modification_level", "info", "n > 0 AND modification_level <> CASE WHEN n <= 1 THEN 'Stock' WHEN n <= 5 THEN 'Lightly Modified' WHEN n <= 15 THEN 'Moderately Modified' ELSE 'Heavily Modified' END"),
    ]
    return checks


_ISSUE_ROWS = "\n UNION ALL ".join(f"SELECT row_id, '{f}' AS field, '{s}' AS severity FROM r WHERE {t}" for f, s, t in _sql_issues())
_ISSUE_ROWS += "\n UNION ALL SELECT build_id, 'modifications[' || (rn - 1) || ']', 'error' FROM (SELECT *, row_number() OVER (PARTITION BY build_id ORDER BY line, name NULLS FIRST, category NULLS FIRST, brand NULLS FIRST) AS rn FROM mods) WHERE name IS NULL OR category IS NULL"
_ISSUE_CTE = f""",
r AS (SELECT b.*, coalesce(m.n, 0) AS n FROM builds b LEFT JOIN (SELECT build_id AS row_key, count(*) AS n FROM mods GROUP BY 1) m ON b.row_id = m.row_key),
issues AS ({_ISSUE_ROWS})
"""


def _checked(spark, sf):
    rows = standins.builds_with_mods(spark, sf).withColumn("sale_data", F.when(F.col("for_sale"), F.struct(F.lit("active").alias("status"))))
    return rows.select("row_id", records.record_issues(2026).alias("issues"))


@query("record_validation", with_ctes("builds mods", _ISSUE_CTE + "SELECT row_id, field, severity, count(*) AS n FROM issues GROUP BY ALL"))
def record_validation(spark, sf):
    rows = _checked(spark, sf).select("row_id", F.explode("issues").alias("i"))
    return rows.groupBy("row_id", F.col("i.field").alias("field"), F.col("i.severity").alias("severity")).agg(F.count(F.lit(1)).alias("n"))


@query("severity_counts", with_ctes("builds mods", _ISSUE_CTE + 'SELECT severity, count(*) AS "count" FROM issues GROUP BY 1'))
def severity_counts(spark, sf):
    return A.issue_counts(_checked(spark, sf).withColumnRenamed("row_id", "build_id"), "severity")


@query("auto_fix", with_ctes("builds mods", _ISSUE_CTE + """
SELECT count(*) AS builds, CAST(sum(CASE WHEN n > 0 AND modification_level IS DISTINCT FROM level THEN 1 ELSE 0 END) AS BIGINT) AS levels_fixed,
  CAST(sum(CASE WHEN source_type IN ('build_thread', 'project', 'gallery', 'article') AND for_sale THEN 1 ELSE 0 END) AS BIGINT) AS sales_cleared,
  count(*) FILTER (WHERE n > 0 AND level = 'Lightly Modified') AS now_light
FROM (SELECT *, CASE WHEN n <= 1 THEN 'Stock' WHEN n <= 5 THEN 'Lightly Modified' WHEN n <= 15 THEN 'Moderately Modified' ELSE 'Heavily Modified' END AS level FROM r)"""))
def auto_fix(spark, sf):
    """Levels and sale data put right, with the number of changes."""
    rows = standins.builds_with_mods(spark, sf).withColumn("sale_data", F.when(F.col("for_sale"), F.struct(F.lit("active").alias("status"))))
    fixed = jobs.auto_fix(rows)
    return fixed.agg(
        F.count(F.lit(1)).alias("builds"), F.sum(F.col("fixed_level").cast("int")).alias("levels_fixed"), F.sum(F.col("fixed_sale").cast("int")).alias("sales_cleared"),
        F.count_if((F.size("modifications") > 0) & (F.col("modification_level") == "Lightly Modified")).alias("now_light"),
    )


@query("schema_validation", """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN '$' WHEN 1 THEN 'kind' WHEN 2 THEN 'k' WHEN 3 THEN 'kind' END AS field,
  CASE event_id % 5 WHEN 0 THEN 'Invalid JSON' WHEN 1 THEN 'Required property is missing' WHEN 2 THEN 'Is not of type bigint' WHEN 3 THEN 'Is not one of the allowed values' END AS message
FROM events WHERE event_id % 5 <> 4""")
def schema_validation(spark, sf):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("kind", T.StringType())])
    k = F.get_json_object("props", "$.k")
    doc = (
        F.when(F.col("event_id") % 5 == 0, F.lit('{"k": ')).when(F.col("event_id") % 5 == 1, F.col("props"))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit('{"k": "x'), k, F.lit('", "kind": "a"}')))
        .when(F.col("event_id") % 5 == 3, F.concat(F.lit('{"k": '), k, F.lit(', "kind": "c"}'))).otherwise(F.concat(F.lit('{"k": '), k, F.lit(', "kind": "a"}')))
    )
    issues = records.json_type_issues(doc, schema, ["k", "kind"], {"kind": ["a", "b"]})
    return table(spark, sf, "events").select("event_id", F.explode(issues).alias("i")).select("event_id", "i.field", "i.message")


@query("year_rules", with_ctes("builds", """
SELECT row_id, coalesce(TRY_CAST(substr(trim(year), 1, 4) AS INT) BETWEEN 1900 AND 2027, false) AS by_prefix,
  coalesce(TRY_CAST(trim(year) AS INT) BETWEEN 1885 AND 2028, false) AS whole, regexp_matches(year, '^\\d{4}$') AS four_digits FROM builds"""))
def year_rules(spark, sf):
    return standins.builds(spark, sf).select(
        "row_id", buckets.year_in_range("year").alias("by_prefix"), buckets.year_in_range("year", "whole", 2026).alias("whole"),
        buckets.year_in_range("year", "four_digits").alias("four_digits"),
    )


@query("enum_checks", with_ctes("builds", f"""
SELECT count(*) FILTER (WHERE source_type NOT IN ({sql_list(vocab.SOURCE_TYPES)})) AS bad_source_types, count(*) FILTER (WHERE build_type NOT IN ({sql_list(vocab.BUILD_TYPES)})) AS bad_build_types FROM builds"""))
def enum_checks(spark, sf):
    return standins.builds(spark, sf).agg(
        F.count_if(records.not_in("source_type", vocab.SOURCE_TYPES)).alias("bad_source_types"), F.count_if(records.not_in("build_type", vocab.BUILD_TYPES)).alias("bad_build_types")
    )


@query("image_profile", with_ctes("builds", """
, i AS (SELECT unnest(string_split(images, '|')) AS img FROM builds WHERE images <> ''),
t AS (SELECT count(*) AS total, count(*) FILTER (WHERE NOT contains(img, '://')) AS bad, count(*) FILTER (WHERE contains(img, '://') AND regexp_matches(img, 'no-image|spacer')) AS ph FROM i)
SELECT count(*) AS builds, count(*) FILTER (WHERE images <> '') AS builds_with_images, any_value(t.total) AS total_images, any_value(t.bad) AS invalid_images, any_value(t.ph) AS placeholder_images,
  round(any_value(t.total)::DOUBLE / count(*), 1) AS avg_images_per_build, round(count(*) FILTER (WHERE images <> '')::DOUBLE / count(*) * 100, 1) AS image_coverage_pct FROM builds, t"""))
def image_profile(spark, sf):
    return A.image_profile(standins.builds(spark, sf))


@query("image_checks", with_ctes("builds", """
SELECT row_id, CASE row_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS total, CASE WHEN row_id % 4 = 2 THEN 1 ELSE 0 END AS invalid, CASE WHEN row_id % 4 >= 2 THEN 1 ELSE 0 END AS placeholder FROM builds"""))
def image_checks(spark, sf):
    return standins.builds(spark, sf).select("row_id", records.image_checks("gallery_images").alias("c")).select("row_id", "c.*")


# --- mods ------------------------------------------------------------------


@query("category_breakdown", with_ctes("mods", 'SELECT category, count(*) AS "count" FROM mods GROUP BY 1'))
def category_breakdown(spark, sf):
    return A.category_breakdown(standins.mods(spark, sf))


@query("mod_rate", with_ctes("mods builds", f"""
SELECT count(DISTINCT build_id) AS builds_with_mods, count(*) AS total_mods, (SELECT count(*) FROM builds) AS total_builds,
  {sql_share('count(DISTINCT build_id)', '(SELECT count(*) FROM builds)')} AS mod_rate FROM mods"""))
def mod_rate(spark, sf):
    return A.mod_rate(standins.mods(spark, sf), standins.builds(spark, sf))


_AUDITED = sql_list(vocab.AUDIT_CATEGORIES)


@query("mods_profile", with_ctes("mods builds", f"""
SELECT count(*) AS total_mods, count(*) FILTER (WHERE NOT {sql_garbage('name')}) AS with_name, count(*) FILTER (WHERE NOT {sql_garbage('brand')}) AS with_brand,
  count(*) FILTER (WHERE category <> '') AS with_category, count(*) FILTER (WHERE lower(trim(category)) IN ({_AUDITED})) AS with_valid_category,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT build_id, name, category FROM mods)) AS duplicate_mods,
  least(count(*) FILTER (WHERE NOT {sql_garbage('name')}), count(*) FILTER (WHERE category <> '')) AS valid_mods,
  count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM builds b WHERE b.build_id = mods.build_id)) AS orphan_mods FROM mods"""))
def mods_profile(spark, sf):
    return A.mods_profile(standins.mods(spark, sf), standins.builds(spark, sf))


@query("mods_quality", with_ctes("mods", f"""
SELECT count(*) AS total_mods, count(*) FILTER (WHERE coalesce(trim(coalesce(nullif(name, ''), CASE WHEN line = 1 THEN 'first' END)), '') = '') AS missing_name,
  count(*) FILTER (WHERE coalesce(category, '') = '') AS missing_category, count(*) FILTER (WHERE category NOT IN ({sql_list(vocab.STANDARD_CATEGORIES)})) AS invalid_category,
  count(DISTINCT category) AS unique_categories FROM mods"""))
def mods_quality(spark, sf):
    """Three name columns: the first that is filled counts."""
    rows = standins.mods(spark, sf).withColumn("part_name", F.when(F.col("line") == 1, "first"))
    return A.mods_quality(rows)


@query("mods_bag_union", with_ctes("mods", """
SELECT build_id, name, category, 2 * count(*) AS n FROM mods WHERE build_id IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0) GROUP BY ALL"""))
def mods_bag_union(spark, sf):
    """Mods of the table and of the builds together: one in both counts twice."""
    builds = standins.builds_with_mods(spark, sf).where("build_id = row_id")
    standalone = standins.mods(spark, sf).select("build_id", "name", "category", "brand").join(builds.select("build_id"), "build_id", "left_semi")
    both = sets.all_mods(standalone, builds)
    return both.groupBy("build_id", "name", "category").agg(F.count(F.lit(1)).alias("n"))


@query("orphan_mods", with_ctes("mods builds", "SELECT build_id, line, name FROM mods WHERE build_id NOT IN (SELECT build_id FROM builds WHERE build_id IS NOT NULL)"))
def orphan_mods(spark, sf):
    return joins.orphans(standins.mods(spark, sf), standins.builds(spark, sf), "build_id").select("build_id", "line", "name")


@query("dedupe_mods", with_ctes("mods", "SELECT build_id, lower(name) AS name, min(line) AS line FROM mods WHERE name IS NOT NULL GROUP BY 1, 2"))
def dedupe_mods(spark, sf):
    from weftwork.operators.extraction import dedupe_mods as dedupe

    rows = standins.mods(spark, sf).where("name is not null").select("build_id", F.upper("name").alias("mod_name"), F.col("line").alias("position"))
    return dedupe(rows).select("build_id", F.lower("mod_name").alias("name"), F.col("position").alias("line"))


# --- stages and reports ----------------------------------------------------


def _stages(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "lang")
    labelled = d.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return {"urls": d, "pages": d.where("lang <> 'de'"), "builds": labelled, "mods": labelled.where("quality = 1")}


_STAGES = """, st AS (SELECT d.source, d.lang, l.doc_id AS lab, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
counts AS (SELECT source, count(*) AS urls, count(*) FILTER (WHERE lang <> 'de') AS pages, count(lab) AS builds, count(*) FILTER (WHERE quality = 1) AS mods FROM st GROUP BY source)
"""
_WITH_STAGES = "WITH" + _STAGES[1:]


@query("stage_progress", _WITH_STAGES + "SELECT source, urls, pages, builds, mods FROM counts")
def stage_progress(spark, sf):
    return A.stage_progress(_stages(spark, sf))


@query("stage_completeness", _WITH_STAGES + """
SELECT source, urls, pages, builds, mods, CASE WHEN pages = 0 THEN 'pages' WHEN builds = 0 THEN 'builds' WHEN mods = 0 THEN 'mods' END AS missing_stage,
  CASE WHEN pages = 0 OR builds = 0 OR mods = 0 THEN 'critical' ELSE 'ok' END AS severity FROM counts""")
def stage_completeness(spark, sf):
    stages = _stages(spark, sf)
    return A.stage_completeness(stages["urls"], stages)


@query("cross_ratios", _WITH_STAGES + """
SELECT source, urls, pages, builds, mods, round(builds::DOUBLE / nullif(pages, 0), 3) AS builds_per_page, round(mods::DOUBLE / nullif(builds, 0), 3) AS mods_per_build,
  CASE WHEN pages = 0 OR builds = 0 THEN 'skipped' WHEN builds::DOUBLE / pages < 0.5 THEN 'low' WHEN builds::DOUBLE / pages > 1.2 THEN 'high' ELSE 'ok' END AS build_check,
  CASE WHEN builds = 0 OR mods = 0 THEN 'skipped' WHEN mods::DOUBLE / builds < 0.5 THEN 'low' ELSE 'ok' END AS mod_check FROM counts""")
def cross_ratios(spark, sf):
    return A.cross_ratios(A.stage_progress(_stages(spark, sf)))


@query("coverage", _WITH_STAGES + f"""
SELECT source, urls, pages, builds, mods, {sql_share('pages', 'urls')} AS scrape_pct, CASE WHEN pages::DOUBLE / urls * 100 < 50 THEN 'critical' WHEN pages::DOUBLE / urls * 100 < 80 THEN 'warning' ELSE 'ok' END AS scrape_severity,
  {sql_share('builds', 'pages')} AS extract_pct, CASE WHEN pages = 0 THEN 'ok' WHEN builds::DOUBLE / pages * 100 < 50 THEN 'critical' WHEN builds::DOUBLE / pages * 100 < 80 THEN 'warning' ELSE 'ok' END AS extract_severity,
  CASE WHEN builds > 0 THEN {sql_share('builds', 'urls')} END AS overall_pct FROM counts""")
def coverage(spark, sf):
    return A.coverage(A.stage_progress(_stages(spark, sf)))


@query("evidence_score", _WITH_STAGES + """
SELECT source, urls, pages, builds, mods, (urls > 0)::INT + (pages > 0)::INT + (builds > 0)::INT + (mods > 0)::INT AS evidence_score,
  (urls > 0)::INT + (pages > 0)::INT + (builds > 0)::INT + (mods > 0)::INT >= 3 AS sufficient FROM counts""")
def evidence_score(spark, sf):
    return A.evidence(A.stage_progress(_stages(spark, sf)), ["urls", "pages", "builds", "mods"])


@query("artefact_stage", _WITH_STAGES + """
SELECT source, CASE WHEN builds > 0 AND mods > 0 THEN 'complete' WHEN builds > 0 THEN 'stage3_partial' WHEN pages > 0 THEN 'stage2_complete' WHEN urls > 0 THEN 'stage1_complete' ELSE 'empty' END AS stage,
  CASE WHEN pages >= urls THEN 'complete' WHEN pages > 0 THEN 'active' ELSE 'empty' END AS page_state FROM counts""")
def artefact_stage(spark, sf):
    c = F.col
    counts = A.stage_progress(_stages(spark, sf))
    return counts.select(
        "source", buckets.artefact_stage(c("urls") > 0, c("pages") > 0, c("builds") > 0, c("mods") > 0).alias("stage"), buckets.stage_state("pages", "urls").alias("page_state")
    )


_GATE_U = "SELECT count(*) AS urls, count(*) - count(DISTINCT url) AS dup_urls FROM url_pool WHERE url NOT LIKE ' %'"
_GATE = f""", u AS ({_GATE_U}), p AS (SELECT count(*) AS pages, count(*) FILTER (WHERE reason = 'empty') AS empty_pages, count(*) FILTER (WHERE reason NOT IN ('empty', 'valid')) AS corrupt_pages FROM (SELECT {_REASON} AS reason FROM dirty)),
b AS (SELECT count(*) AS builds, CAST({' + '.join(f'count(*) FILTER (WHERE {f} IS NULL)' for f in vocab.REQUIRED_FIELDS if f != 'build_source')} AS BIGINT) AS missing_fields,
  count(*) FILTER (WHERE source_type NOT IN ({sql_list(vocab.SOURCE_TYPES)})) AS bad_source_types, count(*) FILTER (WHERE build_type NOT IN ({sql_list(vocab.BUILD_TYPES)})) AS bad_build_types, count(build_id) - count(DISTINCT build_id) AS dup_ids FROM builds),
m AS (SELECT count(*) AS mods, count(*) FILTER (WHERE coalesce(name, '') = '') AS missing_names, count(*) FILTER (WHERE coalesce(category, '') = '') AS missing_categories,
  count(*) FILTER (WHERE category NOT IN ({sql_list(vocab.STANDARD_CATEGORIES)})) AS unknown_categories FROM mods)
"""


@query("stage_gate", with_ctes("url_pool dirty builds mods", _GATE + """
SELECT stage, "check", CAST(value AS DOUBLE) AS value, passed FROM u, p, b, m, LATERAL (VALUES ('urls', 'has_urls', urls, urls > 0), ('urls', 'valid_format', 0, true), ('urls', 'no_duplicates', dup_urls, dup_urls = 0),
 ('pages', 'has_pages', pages, pages > 0), ('pages', 'no_empty_pages', empty_pages, empty_pages = 0), ('pages', 'corrupt_below_10_pct', corrupt_pages, corrupt_pages <= pages * 0.1),
 ('builds', 'has_builds', builds, builds > 0), ('builds', 'required_fields', missing_fields, missing_fields = 0), ('builds', 'source_types', bad_source_types, bad_source_types = 0), ('builds', 'build_types', bad_build_types, bad_build_types = 0), ('builds', 'unique_ids', dup_ids, dup_ids = 0),
 ('mods', 'has_mods', mods, mods > 0), ('mods', 'names', missing_names, missing_names = 0), ('mods', 'categories_present', missing_categories, missing_categories <= mods * 0.5), ('mods', 'categories_known', unknown_categories, unknown_categories = 0)) AS v(stage, "check", value, passed)"""))
def stage_gate(spark, sf):
    urls = standins.url_pool(spark, sf).where(~F.col("url").startswith(" "))
    return jobs.stage_gate(urls, standins.dirty_pages(spark, sf), standins.builds(spark, sf), standins.mods(spark, sf))


_QUALITY = f""", u AS ({_GATE_U}), p AS (SELECT count(*) AS pages, count(*) FILTER (WHERE octet_length(encode(html)) > 100) AS filled FROM dirty),
b AS (SELECT count(*) AS builds, count(*) FILTER (WHERE build_id IS NOT NULL AND year <> '' AND make <> '' AND model <> '') AS complete, avg(extraction_confidence) AS confidence, count(build_id) - count(DISTINCT build_id) AS dup_ids FROM builds),
m AS (SELECT count(*) AS mods, count(*) FILTER (WHERE category <> '') AS categorised FROM mods)
"""


@query("validation_scores", with_ctes("url_pool dirty builds mods", _QUALITY + """, c AS (SELECT stage, passed FROM u, p, b, m, LATERAL (VALUES
 ('url_discovery', urls > 0), ('url_discovery', true), ('url_discovery', dup_urls = 0), ('html_scrape', pages > 0), ('html_scrape', filled::DOUBLE / pages >= 0.9), ('html_scrape', pages::DOUBLE / urls >= 0.9),
 ('build_extraction', builds > 0), ('build_extraction', complete::DOUBLE / builds >= 0.8), ('build_extraction', dup_ids = 0), ('build_extraction', confidence >= 0.7), ('mod_extraction', mods > 0), ('mod_extraction', categorised::DOUBLE / mods >= 0.7)) AS v(stage, passed))
SELECT stage, count(*) AS checks, count(*) FILTER (WHERE passed) AS passed, bool_and(passed) AS all_passed, round(avg(passed::INT) * 100, 4) AS score FROM c GROUP BY stage"""))
def validation_scores(spark, sf):
    urls = standins.url_pool(spark, sf).where(~F.col("url").startswith(" "))
    checks = jobs.validation_report(urls, standins.dirty_pages(spark, sf), standins.builds(spark, sf), standins.mods(spark, sf))
    return A.check_scores(checks, ["stage"])


_METRICS = """, q AS (SELECT metric, round(score, 4) AS score FROM u, p, b, LATERAL (VALUES ('url_validity', 100.0::DOUBLE), ('url_uniqueness', (urls - dup_urls)::DOUBLE / urls * 100), ('url_count', least(urls / 10.0::DOUBLE, 100)), ('html_coverage', pages::DOUBLE / urls * 100),
 ('html_quality', filled::DOUBLE / pages * 100), ('build_completeness', complete::DOUBLE / builds * 100), ('build_confidence', confidence * 100), ('build_count', least(builds, 100)::DOUBLE)) AS v(metric, score))
"""


@query("quality_metrics", with_ctes("url_pool dirty builds mods", _QUALITY + _METRICS + "SELECT metric, score, CASE WHEN score >= 80 THEN 'good' WHEN score >= 50 THEN 'fair' ELSE 'poor' END AS status FROM q"))
def quality_metrics(spark, sf):
    urls = standins.url_pool(spark, sf).where(~F.col("url").startswith(" "))
    return jobs.quality_scores(urls, standins.dirty_pages(spark, sf), standins.builds(spark, sf))


_WEIGHT = "CASE metric " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in vocab.QUALITY_WEIGHTS.items()) + " END"


@query("quality_report", with_ctes("url_pool dirty builds mods", _QUALITY + _METRICS + f"""
SELECT metrics, overall_score, CASE WHEN overall_score >= 90 THEN 'A' WHEN overall_score >= 80 THEN 'B' WHEN overall_score >= 70 THEN 'C' WHEN overall_score >= 60 THEN 'D' ELSE 'F' END AS grade
FROM (SELECT count(*) AS metrics, round(sum(score * {_WEIGHT}) / sum({_WEIGHT}), 4) AS overall_score FROM q)"""))
def quality_report(spark, sf):
    urls = standins.url_pool(spark, sf).where(~F.col("url").startswith(" "))
    return A.weighted_report(jobs.quality_scores(urls, standins.dirty_pages(spark, sf), standins.builds(spark, sf)))


def _audit(spark, sf):
    n = F.col("page_id")
    urls = table(spark, sf, "documents").select("source")
    pages = standins.dirty_pages(spark, sf).select(F.concat(F.lit("src"), (n % 20).cast("string")).alias("source"), "html")
    return jobs.source_audit(urls, pages, standins.builds(spark, sf), standins.mods(spark, sf))


@query("source_audit")
def source_audit(spark, sf):
    """One row per source with counts, quality, stage, health, issues; see ``audit_rollup`` for the checked sums."""
    return _audit(spark, sf)


@query("audit_rollup", with_ctes("builds mods", f"""
, presence AS (SELECT source, {_PRESENCE} FROM builds GROUP BY source), scored AS (SELECT source, total_builds, least(with_build_id, with_url, with_make, with_model) AS valid_builds, {_SCORE} AS score FROM presence)
SELECT (SELECT count(*) FROM (SELECT source FROM documents UNION SELECT source FROM builds UNION SELECT source FROM mods UNION SELECT 'src' || (page_id % 20) FROM pages)) AS total_sources,
  (SELECT count(*) FROM documents) AS total_urls, (SELECT count(*) FROM pages) AS total_pages, CAST(sum(total_builds) AS BIGINT) AS total_builds, CAST(sum(valid_builds) AS BIGINT) AS total_valid_builds,
  (SELECT count(*) FROM mods) AS total_mods, round(avg(score), 4) AS avg_completeness FROM scored"""))
def audit_rollup(spark, sf):
    return jobs.audit_rollup(_audit(spark, sf)).select(
        "total_sources", "total_urls", "total_pages", "total_builds", "total_valid_builds", "total_mods", "avg_completeness"
    )


@query("audit_advice")
def audit_advice(spark, sf):
    return jobs.recommendations(jobs.audit_rollup(_audit(spark, sf)))


@query("worst_sources")
def worst_sources(spark, sf):
    from weftwork.operators.ordering import worst_sources as worst

    return worst(_audit(spark, sf)).select("source", "issues", "quality", "health")


@query("extraction_audit", with_ctes("builds mods", f"""
, pg AS (SELECT doc_id AS build_id, text AS html FROM documents), bl AS (SELECT * FROM builds),
ids AS (SELECT DISTINCT build_id FROM bl WHERE build_id IS NOT NULL), rec AS (SELECT count(*) AS n, count(*) FILTER (WHERE build_id NOT IN (SELECT build_id FROM ids)) AS missing FROM pg),
chk AS (SELECT b.build_id, b.year <> '' AND contains(lower(p.html), b.year) AS y, coalesce(b.make <> '' AND contains(lower(p.html), lower(b.make)), false) AS mk, contains(lower(p.html), lower(b.model)) AS md FROM bl b JOIN pg p ON b.build_id = p.build_id)
SELECT 'integrity' AS "check", 'pages_without_build' AS detail, missing::DOUBLE AS value, CASE WHEN missing * 100.0 / n > 20 THEN 'critical' WHEN missing * 100.0 / n > 5 THEN 'warning' ELSE 'ok' END AS severity FROM rec
UNION ALL SELECT 'integrity', 'builds_without_page', count(*)::DOUBLE, CASE WHEN count(*) > 0 THEN 'warning' ELSE 'ok' END FROM ids WHERE build_id NOT IN (SELECT build_id FROM pg)
UNION ALL SELECT 'quality', 'duplicate_ids', (count(build_id) - count(DISTINCT build_id))::DOUBLE, CASE WHEN count(build_id) > count(DISTINCT build_id) THEN 'critical' ELSE 'ok' END FROM bl
UNION ALL SELECT 'quality', 'invalid_years', count(*)::DOUBLE, CASE WHEN count(*) > 0 THEN 'warning' ELSE 'ok' END FROM bl WHERE year <> '' AND NOT coalesce(TRY_CAST(year AS INT) BETWEEN 1885 AND 2028, false)
UNION ALL SELECT 'accuracy', 'accuracy_pct', {sql_share('count(*) FILTER (WHERE y AND mk AND md)', 'count(*)')}, CASE WHEN count(*) FILTER (WHERE y AND mk AND md)::DOUBLE / count(*) < 0.7 THEN 'warning' WHEN count(*) FILTER (WHERE y AND mk AND md)::DOUBLE / count(*) < 0.9 THEN 'info' ELSE 'ok' END FROM chk"""))
def extraction_audit(spark, sf):
    """Integrity, key quality and accuracy rows of the extraction audit; documents stand in for pages."""
    pages = table(spark, sf, "documents").select(F.col("doc_id").alias("build_id"), F.col("text").alias("html"))
    builds = standins.builds(spark, sf)
    issues = jobs.extraction_audit(pages, pages, builds, standins.mods(spark, sf))
    kept = issues.where(F.col("detail").isin("pages_without_build", "builds_without_page", "duplicate_ids", "invalid_years", "accuracy_pct"))
    return kept


@query("extraction_audit_full")
def extraction_audit_full(spark, sf):
    pages = table(spark, sf, "documents").select(F.col("doc_id").alias("build_id"), F.col("text").alias("html"))
    return jobs.extraction_audit(pages, pages, standins.builds(spark, sf), standins.mods(spark, sf))


@query("accuracy_check", with_ctes("builds", """
SELECT b.build_id, b.row_id, count(*) FILTER (WHERE contains(lower(d.text), lower(b.model))) AS found FROM builds b JOIN documents d ON b.build_id = d.doc_id GROUP BY 1, 2"""))
def accuracy_check(spark, sf):
    pages = table(spark, sf, "documents").select(F.col("doc_id").alias("build_id"), F.col("text").alias("html"))
    builds = standins.builds(spark, sf).select("build_id", "row_id", "model")
    rows = joins.verify_in_page(builds, pages, ["model", "row_id"])
    return rows.select("build_id", "row_id", F.col("model_found").cast("bigint").alias("found"))


@query("page_existence", with_ctes("builds", "SELECT row_id, EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = builds.build_id) AS has_page FROM builds"))
def page_existence(spark, sf):
    pages = table(spark, sf, "documents").select(F.col("doc_id").alias("build_id"))
    return joins.with_existence(standins.builds(spark, sf), pages, "build_id", "has_page").select("row_id", "has_page")


@query("inventory", """
SELECT CASE doc_id % 4 WHEN 0 THEN '.html' WHEN 1 THEN '.json' WHEN 2 THEN '.jsonl' ELSE '.py' END AS suffix, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY 1""")
def inventory(spark, sf):
    suffix = F.element_at(F.array(*map(F.lit, [".html", ".json", ".jsonl", ".py"])), (F.col("doc_id") % 4).cast("int") + 1)
    return A.inventory(table(spark, sf, "documents").select(suffix.alias("suffix"), F.col("n_chars").alias("length")))


@query("stored_results", """
SELECT count(*) AS entries, CAST(sum(n_chars) AS BIGINT) AS bytes, round(sum(n_chars) / 1048576.0, 2)::DOUBLE AS megabytes FROM documents""")
def stored_results(spark, sf):
    return A.stored_results(table(spark, sf, "documents").select(F.col("n_chars").alias("length")))


@query("manifest", """
SELECT d.doc_id, d.filename, f.size AS file_size_bytes, f.size IS NOT NULL AS file_exists FROM (SELECT doc_id, doc_id || '.html' AS filename FROM documents) d
LEFT JOIN (SELECT page_id || '.html' AS filename, octet_length(encode(html)) AS size FROM pages) f USING (filename)""")
def manifest(spark, sf):
    completed = table(spark, sf, "documents").select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".html")).alias("filename"))
    files = table(spark, sf, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("filename"), F.octet_length("html").cast("bigint").alias("length"))
    return joins.with_inventory(completed, files)


@query("envelope_urls", with_ctes("log", "SELECT source, url, (SELECT count(*) FROM (SELECT DISTINCT source, url FROM log) x WHERE x.source = l.source) AS totalCount FROM (SELECT DISTINCT source, url FROM log) l"))
def envelope_urls(spark, sf):
    """URLs packed into envelopes of bounded size and unpacked again: nothing may be lost."""
    from weftwork.sources.writers import url_envelopes

    urls = standins.log(spark, sf).select("source", "url").distinct()
    return url_envelopes(urls, batch=10).select("source", F.explode("urls").alias("u"), "totalCount").select("source", "u.url", "totalCount")
