"""Composite jobs: audits, gates, diagnoses, extraction and sync, built from the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import buckets, records
from weftwork.functions import pages as P
from weftwork.functions import urls as U
from weftwork.operators import aggregates as A
from weftwork.operators import extraction, graph, joins, sets, windows
from weftwork.operators.filters import fetch_advice
from weftwork.operators.rows import beside
from weftwork.operators.scan import first_rows


def _checks(counts: DataFrame, rules: list[tuple[str, str, Column, Column]], keys: list[str] = ()) -> DataFrame:
    """(keys, stage, check, value, passed) rows from one row of counts per key."""
    rows = F.array(*[
        F.struct(F.lit(stage).alias("stage"), F.lit(name).alias("check"), value.cast("double").alias("value"),
                 F.coalesce(passed, F.lit(False)).alias("passed"))
        for stage, name, value, passed in rules
    ])
    return counts.select(*keys, F.explode(rows).alias("c")).select(*keys, "c.*")


# --- audit per source ------------------------------------------------------


def page_audit(pages: DataFrame) -> DataFrame:
    """Per source: pages by size class, error pages, bytes and the share of usable pages.

    Pages are (source, html); every page is read, none is sampled.
    """
    measured = pages.select("source", F.octet_length("html").alias("size"), P.error_labels("html").alias("labels"))
    kind = P.size_class("size")
    out = measured.groupBy("source").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(kind == "empty").alias("empty_pages"),
        F.count_if(kind == "tiny").alias("tiny_pages"), F.count_if(kind == "small").alias("small_pages"),
        F.count_if((kind == "empty") | P.is_error_page("labels")).alias("error_pages"), F.sum("size").alias("bytes"),
    )
    return out.withColumns({
        "valid_pages": F.col("pages") - F.col("error_pages"),
        "valid_pct": F.round((F.col("pages") - F.col("error_pages")) / F.col("pages") * 100, 4),
    })


def source_audit(urls: DataFrame, pages: DataFrame, builds: DataFrame, mods: DataFrame) -> DataFrame:
    """One row per source: what exists, how good it is, how far it got, what is wrong."""
    def count(df, name):
        return df.groupBy("source").agg(F.count(F.lit(1)).alias(name))

    profile = A.completeness(A.build_profile(builds, ["source"])).select(
        "source", F.col("total_builds").alias("builds"), "valid_builds", "completeness_score"
    )
    # Each table is read once; what meets here is one row per source and table.
    both = sets.bag_union(count(urls, "urls"), page_audit(pages), profile, count(mods, "mods"))
    out = both.groupBy("source").agg(*[F.max(c).alias(c) for c in both.columns if c != "source"])
    numbers = [c for c in out.columns if c not in ("source", "valid_pct", "completeness_score")]
    out = out.fillna(0, numbers)
    c = F.col
    quality = F.round(buckets.mean_of_present("valid_pct", "completeness_score"), 4)
    error_pct = buckets.share_or_zero("error_pages", "pages", 4)
    out = out.withColumns({"quality": quality, "stage": buckets.artefact_stage(c("urls") > 0, c("pages") > 0, c("builds") > 0, c("mods") > 0)})
    issues = (error_pct > 50).cast("int") + F.coalesce((c("completeness_score") < 50).cast("int"), F.lit(0))
    warnings = (
        error_pct.between(20.0001, 50).cast("int") + F.coalesce(c("completeness_score").between(50, 69.9999).cast("int"), F.lit(0))
        + (_cross_bad()).cast("int")
    )
    return out.withColumns({"health": buckets.health("quality"), "issues": issues, "warnings": warnings})


def _cross_bad() -> Column:
    """Builds per page or mods per build outside their bands."""
    c = F.col
    per_page, per_build = F.try_divide(c("builds"), c("pages")), F.try_divide(c("mods"), c("builds"))
    pages_bad = (c("pages") > 0) & (c("builds") > 0) & ((per_page < 0.5) | (per_page > 1.2))
    mods_bad = (c("builds") > 0) & (c("mods") > 0) & (per_build < 0.5)
    return F.coalesce(pages_bad | mods_bad, F.lit(False))


def audit_rollup(audit: DataFrame) -> DataFrame:
    """The report over all sources: sums, sources by stage and health, mean percentages."""
    stages = ["empty", "stage1_complete", "stage2_complete", "stage3_partial", "complete"]
    healths = ["healthy", "warning", "degraded", "critical"]
    return audit.agg(
        F.count(F.lit(1)).alias("total_sources"),
        *[F.sum(c).alias(f"total_{c}") for c in ("urls", "pages", "valid_pages", "error_pages", "builds", "valid_builds", "mods", "bytes", "issues", "warnings")],
        *[F.count_if(F.col("stage") == s).alias(f"sources_{s}") for s in stages],
        *[F.count_if(F.col("health") == h).alias(f"sources_{h}") for h in healths],
        F.round(F.avg("valid_pct"), 4).alias("avg_valid_pct"), F.round(F.avg("completeness_score"), 4).alias("avg_completeness"),
    )


def recommendations(rollup: DataFrame) -> DataFrame:
    """What to do about the report, worst first."""
    c = F.col
    rules = [
        (c("sources_critical") > 0, "fix_critical_sources", c("sources_critical")),
        (buckets.share_or_zero("total_error_pages", "total_pages") > 30, "fetch_error_pages_again", c("total_error_pages")),
        (F.coalesce(c("avg_completeness"), F.lit(0.0)) < 70, "review_extraction", c("avg_completeness")),
        (c("sources_stage2_complete") > 3, "run_extraction", c("sources_stage2_complete")),
        (c("sources_empty") > 0, "remove_empty_sources", c("sources_empty")),
    ]
    found = F.array_compact(F.array(*[F.when(hit, F.struct(F.lit(i).alias("rank"), F.lit(name).alias("action"), value.cast("double").alias("value"))) for i, (hit, name, value) in enumerate(rules, 1)]))
    nothing = F.array(F.struct(F.lit(0).alias("rank"), F.lit("none").alias("action"), F.lit(None).cast("double").alias("value")))
    return rollup.select(F.explode(F.when(F.size(found) > 0, found).otherwise(nothing)).alias("r")).select("r.*")


# --- extraction audit ------------------------------------------------------


def extraction_audit(urls: DataFrame, pages: DataFrame, builds: DataFrame, mods: DataFrame, as_of_year: int = 2026) -> DataFrame:
    """Seven checks as rows (check, detail, value, severity); severity ``ok`` is no issue."""
    c = F.col
    required = ["build_id", "source_url", "year", "make", "model"]
    images = records.image_checks("gallery_images")
    counted = builds.agg(
        F.count(F.lit(1)).alias("builds"), *[F.count_if(~A.is_set(f)).alias(f"missing_{f}") for f in required],
        F.count_if(A.is_set("year") & ~buckets.year_in_range("year", "whole", as_of_year)).alias("invalid_years"),
        F.count_if(F.size("gallery_images") > 0).alias("with_images"),
        *[F.coalesce(F.sum(images[f]), F.lit(0)).alias(f"images_{f}") for f in ("total", "invalid", "placeholder")],
    )
    mods_all = sets.all_mods(mods, builds) if "modifications" in builds.columns else mods
    totals = beside(
        counted, urls.agg(F.count(F.lit(1)).alias("urls")), pages.agg(F.count(F.lit(1)).alias("pages")), _id_counts(pages, builds),
        A.mods_quality(mods_all), joins.accuracy(joins.verify_in_page(builds, pages, ["year", "make", "model"])),
    )

    def pct(part, whole):
        return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))

    def flag(test, severity):
        return F.when(test, severity).otherwise("ok")

    coverage_pct = pct(c("with_images"), c("builds"))
    scrape, extract_ = F.try_divide("pages", "urls") * 100, F.try_divide("builds", "pages") * 100
    rules = [("completeness", s, c(s), flag(c(s) == 0, "critical")) for s in ("urls", "pages", "builds")]
    missing_pct = pct(c("missing"), c("left_ids"))
    rules += [
        ("integrity", "pages_without_build", c("missing"), F.when(missing_pct > 20, "critical").when(missing_pct > 5, "warning").otherwise("ok")),
        ("integrity", "builds_without_page", c("orphans"), flag(c("orphans") > 0, "warning")),
    ]
    rules += [("quality", f"missing_{f}", c(f"missing_{f}"), buckets.severity_above(pct(c(f"missing_{f}"), c("builds")))) for f in required]
    rules += [
        ("quality", "duplicate_ids", c("duplicates"), flag(c("duplicates") > 0, "critical")),
        ("quality", "invalid_years", c("invalid_years"), flag(c("invalid_years") > 0, "warning")),
        ("mods", "missing_name", c("missing_name"), flag(c("missing_name") > c("total_mods") * 0.1, "warning")),
        ("mods", "missing_category", c("missing_category"), flag(c("missing_category") > c("total_mods") * 0.3, "warning")),
        ("mods", "invalid_category", c("invalid_category"), flag(c("invalid_category") > 0, "info")),
        ("images", "invalid", c("images_invalid"), flag(c("images_invalid") > c("images_total") * 0.1, "warning")),
        ("images", "placeholder", c("images_placeholder"), flag(c("images_placeholder") > c("images_total") * 0.2, "warning")),
        ("images", "coverage_pct", F.round(coverage_pct, 1), flag(coverage_pct < 50, "info")),
        ("accuracy", "accuracy_pct", c("accuracy_pct"), c("severity")),
        ("coverage", "scrape_pct", F.round(scrape, 1), buckets.severity_below(scrape)),
        ("coverage", "extract_pct", F.round(extract_, 1), buckets.severity_below(extract_)),
    ]
    rows = F.array(*[
        F.struct(F.lit(k).alias("check"), F.lit(d).alias("detail"), v.cast("double").alias("value"), s.alias("severity")) for k, d, v, s in rules
    ])
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def _id_counts(pages: DataFrame, builds: DataFrame) -> DataFrame:
    """Ids of pages against ids of builds, and repeated build ids, from one grouping of each."""
    a = pages.select(F.col("build_id").alias("_a")).where("_a is not null").distinct()
    b = builds.where("build_id is not null").groupBy(F.col("build_id").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    return a.join(b, F.col("_a") == F.col("_b"), "full_outer").agg(
        F.count("_a").alias("left_ids"), F.count_if(F.col("_b").isNull()).alias("missing"), F.count_if(F.col("_a").isNull()).alias("orphans"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def audit_passed(issues: DataFrame) -> DataFrame:
    return issues.agg(
        F.count_if(F.col("severity") == "critical").alias("critical"), F.count_if(F.col("severity") == "warning").alias("warnings"),
        F.coalesce(F.every(F.col("severity") != "critical"), F.lit(True)).alias("passed"),
    )


# --- gates and suites ------------------------------------------------------


def stage_gate(urls: DataFrame, pages: DataFrame, builds: DataFrame, mods: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """The four stage validators as check rows."""
    u = A.url_quality(urls).select(F.col("total").alias("urls"), F.col("invalid").alias("bad_urls"), F.col("duplicates").alias("dup_urls"))
    reasons = pages.select(P.text_corruption("html").alias("reason"))
    p = reasons.agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("reason") == "empty").alias("empty_pages"),
        F.count_if(~F.col("reason").isin("empty", "valid")).alias("corrupt_pages"),
    )
    required = [f for f in vocab.REQUIRED_FIELDS if f != "build_source"]
    b = builds.agg(
        F.count(F.lit(1)).alias("builds"),
        sum((F.count_if(F.col(f).isNull()) for f in required), F.lit(0)).alias("missing_fields"),
        F.count_if(~F.col("source_type").isin(vocab.SOURCE_TYPES)).alias("bad_source_types"),
        F.count_if(~F.col("build_type").isin(vocab.BUILD_TYPES)).alias("bad_build_types"),
    )
    d = A.duplicates(builds.where("build_id is not null"), "build_id").select(F.col("duplicates").alias("dup_ids"))
    allowed = categories or vocab.STANDARD_CATEGORIES
    m = mods.agg(
        F.count(F.lit(1)).alias("mods"), F.count_if(~A.is_set("name")).alias("missing_names"),
        F.count_if(~A.is_set("category")).alias("missing_categories"),
        F.count_if(A.is_set("category") & ~F.col("category").isin(allowed)).alias("unknown_categories"),
    )
    c = F.col
    return _checks(beside(u, p, b, d, m), [
        ("urls", "has_urls", c("urls"), c("urls") > 0), ("urls", "valid_format", c("bad_urls"), c("bad_urls") == 0),
        ("urls", "no_duplicates", c("dup_urls"), c("dup_urls") == 0),
        ("pages", "has_pages", c("pages"), c("pages") > 0), ("pages", "no_empty_pages", c("empty_pages"), c("empty_pages") == 0),
        ("pages", "corrupt_below_10_pct", c("corrupt_pages"), c("corrupt_pages") <= c("pages") * 0.1),
        ("builds", "has_builds", c("builds"), c("builds") > 0), ("builds", "required_fields", c("missing_fields"), c("missing_fields") == 0),
        ("builds", "source_types", c("bad_source_types"), c("bad_source_types") == 0),
        ("builds", "build_types", c("bad_build_types"), c("bad_build_types") == 0), ("builds", "unique_ids", c("dup_ids"), c("dup_ids") == 0),
        ("mods", "has_mods", c("mods"), c("mods") > 0), ("mods", "names", c("missing_names"), c("missing_names") == 0),
        ("mods", "categories_present", c("missing_categories"), c("missing_categories") <= c("mods") * 0.5),
        ("mods", "categories_known", c("unknown_categories"), c("unknown_categories") == 0),
    ])


def url_suite(urls: DataFrame, keys: list[str] = ()) -> DataFrame:
    """URL discovery checks per group: (check, value, result pass / warn / fail)."""
    q = A.url_quality(urls, list(keys))
    c = F.col
    media_pct = F.coalesce(F.try_divide("media_urls", "total") * 100, F.lit(0.0))
    volume = A.volume_band("total")
    rules = [
        ("count", c("total"), F.when(volume.isin("none", "too_few"), "fail").when(volume == "low", "warn").otherwise("pass")),
        ("validity", c("invalid"), F.when(c("invalid") == 0, "pass").otherwise("fail")),
        ("uniqueness", c("duplicates"), F.when(c("duplicates") == 0, "pass").otherwise("warn")),
        ("patterns", c("listing_urls"), F.when(c("listing_urls") == 0, "pass").otherwise("warn")),
        ("same_domain", c("domains"), A.domain_band("domains")),
        ("media", c("media_urls"), F.when(media_pct == 0, "pass").when(media_pct < 10, "warn").otherwise("fail")),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("check"), v.cast("bigint").alias("value"), r.alias("result")) for n, v, r in rules])
    return q.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def source_counters_check(sources: DataFrame) -> DataFrame:
    """Discovery against the queue's own counters."""
    found, expected = F.col("urls_found"), F.col("expected_urls")
    return sources.select("source", F.when(F.coalesce(found, F.lit(0)) == 0, "missing").when(found < expected, "incomplete").otherwise("ok").alias("counter_check"))


def validation_report(urls: DataFrame, pages: DataFrame, builds: DataFrame, mods: DataFrame) -> DataFrame:
    """Stage checks with shares and thresholds; score them with ``aggregates.check_scores``."""
    u = A.url_quality(urls).select(F.col("total").alias("urls"), "invalid", "duplicates")
    p = pages.agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.octet_length("html") > 100).alias("filled"))
    required = ["build_id", "year", "make", "model"]
    complete = reduce(lambda a, b: a & b, [A.is_set(f) for f in required])
    b = builds.agg(
        F.count(F.lit(1)).alias("builds"), F.count_if(complete).alias("complete"), F.avg("extraction_confidence").alias("confidence"),
        (F.count("build_id") - F.countDistinct("build_id")).alias("dup_ids"),
    )
    m = mods.agg(F.count(F.lit(1)).alias("mods"), F.count_if(A.is_set("category")).alias("categorised"))
    c = F.col

    def ratio(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    valid = ratio(c("urls") - c("invalid"), c("urls"))
    return _checks(beside(u, p, b, m), [
        ("url_discovery", "has_urls", c("urls"), c("urls") > 0), ("url_discovery", "validity", F.round(valid, 4), valid >= 0.95),
        ("url_discovery", "no_duplicates", c("duplicates"), c("duplicates") == 0),
        ("html_scrape", "has_pages", c("pages"), c("pages") > 0),
        ("html_scrape", "not_empty", F.round(ratio(c("filled"), c("pages")), 4), ratio(c("filled"), c("pages")) >= 0.9),
        ("html_scrape", "completion", F.round(ratio(c("pages"), c("urls")), 4), ratio(c("pages"), c("urls")) >= 0.9),
        ("build_extraction", "has_builds", c("builds"), c("builds") > 0),
        ("build_extraction", "required_fields", F.round(ratio(c("complete"), c("builds")), 4), ratio(c("complete"), c("builds")) >= 0.8),
        ("build_extraction", "unique_ids", c("dup_ids"), c("dup_ids") == 0),
        ("build_extraction", "confidence", F.round(c("confidence"), 4), c("confidence") >= 0.7),
        ("mod_extraction", "has_mods", c("mods"), c("mods") > 0),
        ("mod_extraction", "categorised", F.round(ratio(c("categorised"), c("mods")), 4), ratio(c("categorised"), c("mods")) >= 0.7),
    ])


def quality_scores(urls: DataFrame, pages: DataFrame, builds: DataFrame) -> DataFrame:
    """The eight metrics of the quality report as (metric, score) rows."""
    u = A.url_quality(urls).select(F.col("total").alias("urls"), "invalid", "distinct_urls")
    p = pages.agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.octet_length("html") > 100).alias("filled"))
    complete = reduce(lambda a, b: a & b, [A.is_set(f) for f in ("build_id", "year", "make", "model")])
    b = builds.agg(F.count(F.lit(1)).alias("builds"), F.count_if(complete).alias("complete"), F.avg("extraction_confidence").alias("confidence"))
    c = F.col

    def pct(part, whole):
        return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))

    scores = {
        "url_validity": pct(c("urls") - c("invalid"), c("urls")), "url_uniqueness": pct(c("distinct_urls"), c("urls")),
        "url_count": F.least(c("urls") / 10, F.lit(100.0)), "html_coverage": pct(c("pages"), c("urls")),
        "html_quality": pct(c("filled"), c("pages")), "build_completeness": pct(c("complete"), c("builds")),
        "build_confidence": F.coalesce(c("confidence"), F.lit(0.0)) * 100, "build_count": F.least(c("builds"), F.lit(100)).cast("double"),
    }
    wide = beside(u, p, b).select(*[F.round(v, 4).alias(k) for k, v in scores.items()])
    return wide.unpivot([], list(scores), "metric", "score").withColumn("status", buckets.light("score"))


def auto_fix(builds: DataFrame) -> DataFrame:
    """Years as text, levels from the mod count, no sale data on stories; what was changed is marked."""
    level = buckets.mod_level(F.size("modifications"))
    wrong_level = F.coalesce(F.size("modifications") > 0, F.lit(False)) & ~F.col("modification_level").eqNullSafe(level)
    story = F.col("source_type").isin([t for t in vocab.SOURCE_TYPES if t not in vocab.SALE_SOURCE_TYPES])
    wrong_sale = F.coalesce(story, F.lit(False)) & F.col("sale_data").isNotNull()
    number = dict(builds.dtypes)["year"] != "string"
    return builds.withColumns({
        "fixed_year": F.col("year").isNotNull() if number else F.lit(False), "fixed_level": wrong_level, "fixed_sale": wrong_sale,
        "year": F.col("year").cast("string"), "modification_level": F.when(wrong_level, level).otherwise(F.col("modification_level")),
        "sale_data": F.when(~wrong_sale, F.col("sale_data")),
    })


# --- scraper health --------------------------------------------------------


def fetch_diagnosis(urls: DataFrame, log: DataFrame, as_of: Column) -> DataFrame:
    """Per source: progress, dominant failures, stall and what they add up to."""
    stats = A.progress_stats(urls, log)
    failures = log.where(F.col("status").isin("failed", "blocked"))
    dominance = A.error_dominance(failures, keys=["source"]).select("source", F.col("dns").alias("dns_errors"), F.col("blocked").alias("block_errors"), "site_down", "site_blocking")
    stall = windows.stalled(log, as_of, remaining=stats.select("source", F.col("pending").alias("remaining"))).select("source", "last_update", "stalled")
    out = stats.join(dominance, "source", "left").join(stall, "source", "left")
    out = out.fillna(0, ["dns_errors", "block_errors"]).fillna(False, ["site_down", "site_blocking", "stalled"])
    critical = (F.col("total_urls") == 0) | (F.col("block_errors") > 0)
    issues = (F.col("failed") + F.col("blocked") > 0) | F.col("stalled")
    return out.withColumn("verdict", F.when(critical, "critical").when(issues, "issues").when(F.col("completion_percentage") >= 95, "complete").otherwise("in_progress"))


def failure_advice(log: DataFrame) -> DataFrame:
    """Failures per source and class with share and advice."""
    failures = log.where(F.col("status").isin("failed", "blocked"))
    return A.error_histogram(failures, keys=["source"]).withColumn("advice", fetch_advice("error_class"))


def run_health(urls: DataFrame, log: DataFrame) -> DataFrame:
    """Per source: progress band (95 / 50 / 0 %) and what the failures say."""
    stats = A.progress_stats(urls, log)
    pct = F.try_divide("success", "total_urls") * 100
    band = F.when(pct >= 95, "complete").when(pct >= 50, "half").when(pct > 0, "started").otherwise("not_started")
    errors = A.error_verdict(log.where(F.col("status").isin("failed", "blocked")), keys=["source"]).select("source", "verdict")
    out = stats.select("source", "total_urls", "success", buckets.share("success", "total_urls").alias("progress_pct"), band.alias("band"))
    return out.join(errors, "source", "left").fillna("clean", ["verdict"])


def output_checks(stage: str, rows: DataFrame, required: str, ts: str, as_of: Column, minutes: int = 10) -> DataFrame:
    """Is a stage's output fresh and not empty? (stage, valid, error, count, recent)"""
    counted = rows.agg(
        F.count_if(F.col(required).isNotNull()).alias("count"), F.max(ts).alias("newest"),
        F.count_if(F.col(ts) > as_of - F.make_dt_interval(mins=F.lit(minutes))).alias("recent"),
    )
    stale = F.col("newest").isNull() | buckets.is_stale("newest", as_of, minutes)
    error = F.when(F.col("count") == 0, "empty").when(stale, "stale")
    return counted.select(F.lit(stage).alias("stage"), error.isNull().alias("valid"), error.alias("error"), "count", "recent")


def stage_issues(counts: DataFrame) -> DataFrame:
    """What went wrong in a stage, from (source, urls, pages, small_pages, builds, incomplete_builds, builds_with_mods)."""
    c = F.col
    rules = [
        ("url_discovery", "No URLs found", "HIGH", c("urls") == 0),
        ("html_scrape", "No pages", "HIGH", c("pages") == 0),
        ("html_scrape", "Many small pages", "MEDIUM", c("small_pages") > c("pages") * 0.1),
        ("html_scrape", "Low completion rate", "MEDIUM", (c("pages") > 0) & (F.coalesce(F.try_divide("pages", "urls"), F.lit(0.0)) < 0.8)),
        ("build_extraction", "No builds", "HIGH", c("builds") == 0),
        ("build_extraction", "Builds miss year, make or model", "MEDIUM", c("incomplete_builds") > c("builds") * 0.2),
        ("mod_extraction", "No modifications", "MEDIUM", (c("builds") > 0) & (c("builds_with_mods") == 0)),
    ]
    found = F.array_compact(F.array(*[F.when(hit, F.struct(F.lit(s).alias("stage"), F.lit(i).alias("issue"), F.lit(v).alias("severity"))) for s, i, v, hit in rules]))
    return counts.select("source", F.explode(found).alias("i")).select("source", "i.*")


# --- extraction, sync, graph -----------------------------------------------


def extract(pages: DataFrame, vehicles: DataFrame, constants: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Pages to builds and deduplicated mods, as two lazy tables."""
    rows = extraction.builds(pages, vehicles, constants, keep=["html"])
    return rows.drop("html"), extraction.dedupe_mods(extraction.mods(rows))


def sync_sources(sources: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Counters from counted artefacts (urls, pages, builds, mods) and the status that follows."""
    counted = A.stage_progress(tables)
    out = sources.join(counted, "source", "left").fillna(0, list(tables))

    def newer(stage, stored):
        return F.when(F.col(stage) > 0, F.col(stage)).otherwise(F.col(stored))

    return out.withColumns({
        "urls_found": newer("urls", "urls_found"), "html_scraped": newer("pages", "html_scraped"),
        "new_builds": newer("builds", "builds_stored"), "new_mods": newer("mods", "mods_stored"),
        "new_status": buckets.synced_status("status", "urls", "pages", "builds"),
    })


def build_graph(builds: DataFrame, source: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities, relations and their statistics."""
    entities, relations = graph.ingest_builds(builds, source)
    return entities, relations, graph.stats(entities, relations)


def link_patterns(pages: DataFrame, top: int = 15) -> DataFrame:
    """Path patterns of internal links with true counts and three examples each."""
    links = pages.select(F.explode(P.internal_links("html", "url")).alias("link"))
    per_link = links.groupBy(U.path_template(U.path("link")).alias("pattern"), "link").agg(F.count(F.lit(1)).alias("n"))
    best = per_link.groupBy("pattern").agg(F.sum("n").alias("count")).orderBy(F.desc("count"), "pattern").limit(top)
    few = first_rows(per_link, ["pattern"], ["link"], 3).groupBy("pattern").agg(F.array_sort(F.collect_list("link")).alias("examples"))
    return best.join(few, "pattern")
