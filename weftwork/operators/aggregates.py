"""Counts, profiles and scores over tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import buckets, records
from weftwork.functions.text import is_garbage
from weftwork.functions.urls import is_listing_url, is_media_url, is_valid_url, site_host
from weftwork.operators.rows import beside
from weftwork.operators.scan import bounded_samples


def is_set(column) -> Column:
    """Not null and not empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string") != "", F.lit(False))


# --- generic ---------------------------------------------------------------


def top_groups(df: DataFrame, column: str, n: int = 10, by_value: bool = False) -> DataFrame:
    """Largest groups first, or newest values first; ties in value order."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    order = [F.col(column).desc()] if by_value else [F.col("count").desc(), F.col(column)]
    return counts.orderBy(*order).limit(n)


def group_if_present(df: DataFrame, column: str) -> DataFrame | None:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")) if column in df.columns else None


def build_stats(df: DataFrame) -> dict[str, DataFrame]:
    """Total, top makes, newest years and, where the column exists, rows per source."""
    out = {
        "total": df.agg(F.count(F.lit(1)).alias("total")),
        "by_make": top_groups(df, "make"),
        "by_year": top_groups(df, "year", by_value=True),
    }
    by_source = group_if_present(df, "source")
    if by_source is not None:
        out["by_source"] = by_source
    return out


def describe_table(df: DataFrame) -> DataFrame:
    """One row per column with its type, position and the row count of the table."""
    fields = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"))
        for i, f in enumerate(df.schema.fields, 1)
    ])
    return df.agg(F.count(F.lit(1)).alias("row_count")).select("row_count", F.explode(fields).alias("f")).select("f.*", "row_count")


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """Statistics per column: one pass, unpivoted at the end.

    ``exact`` counts distinct values exactly; one more expand per column.
    """
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct", "variant")]
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")}
    parts = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(names):
        c = F.col(name)
        distinct = F.countDistinct(c) if exact else F.approx_count_distinct(c)
        number = c.cast("double") if name in numeric else F.lit(None).cast("double")
        parts.append(F.struct(
            F.lit(name).alias("column_name"), F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max"),
            distinct.alias("distinct_count"), F.avg(number).alias("avg"), F.stddev(number).alias("std"),
            F.percentile_approx(number, [0.25, 0.5, 0.75]).alias("quartiles"), F.count(c).alias("count"),
        ).alias(f"_{i}"))
    one = df.agg(*parts)
    rows = one.select("_rows", F.explode(F.array(*[f"_{i}" for i in range(len(names))])).alias("p")).select("_rows", "p.*")
    return rows.select(
        "column_name", "min", "max", "distinct_count", "avg", "std", "quartiles", "count",
        buckets.share(F.col("_rows") - F.col("count"), "_rows", 2).alias("null_percentage"),
    )


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of each key, over the whole table."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def unpivot(df: DataFrame, keys: list[str], values: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot(keys, values, name, value)


# --- events and progress ---------------------------------------------------


def status_summary(states: DataFrame) -> DataFrame:
    """Counts by status with the sums of work items."""
    c = F.col("status")
    return states.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(c == "active").alias("active"),
        F.count_if(c == "complete").alias("complete"), F.count_if(c == "blocked").alias("blocked"),
        F.coalesce(F.sum("stories_total"), F.lit(0)).alias("total_stories"),
        F.coalesce(F.sum("stories_completed"), F.lit(0)).alias("completed_stories"),
    )


def http_metrics(events: DataFrame, keys: list[str]) -> DataFrame:
    status = F.col("status_code")
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(status.between(200, 299)).alias("successful_requests"),
        F.count_if((status >= 400) | F.col("error_type").isNotNull()).alias("failed_requests"),
        F.count_if("is_blocked").alias("blocked_requests"),
        F.round(F.avg("duration_ms"), 0).cast("bigint").alias("avg_latency_ms"),
        F.coalesce(F.sum("response_body_size"), F.lit(0)).alias("bytes_downloaded"),
        F.coalesce(F.sum("request_body_size"), F.lit(0)).alias("bytes_uploaded"),
    )


def llm_metrics(events: DataFrame, keys: list[str]) -> DataFrame:
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("llm_calls"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("llm_tokens_in"),
        F.coalesce(F.sum("response_tokens"), F.lit(0)).alias("llm_tokens_out"),
        F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("llm_cost_usd"),
    )


def latest_row(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Values of the newest row per key, as a combinable aggregate."""
    newest = F.max_by(F.struct(*columns), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def metrics_snapshot(http: DataFrame, llm: DataFrame, decisions: DataFrame) -> DataFrame:
    """One row per run: request, model and latest decision metrics."""
    counters = ["urls_discovered", "urls_scraped", "builds_extracted", "mods_extracted"]
    runs = http.select("run_id").union(llm.select("run_id")).union(decisions.select("run_id")).distinct()
    out = (
        runs.join(http_metrics(http, ["run_id"]), "run_id", "left").join(llm_metrics(llm, ["run_id"]), "run_id", "left")
        .join(latest_row(decisions, ["run_id"], ["timestamp", "decision_id"], counters), "run_id", "left")
    )
    return out.fillna(0, [c for c in out.columns if c not in ["run_id", "avg_latency_ms", *counters]])


def run_rollup(iterations: DataFrame) -> DataFrame:
    status = F.col("status")
    return iterations.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_iterations"), F.count_if(status == "success").alias("completed"),
        F.count_if(status == "failed").alias("failed"),
    )


def progress_counts(log: DataFrame, keys: list[str]) -> DataFrame:
    status = F.col("status")
    return log.groupBy(*keys).agg(
        F.count_if(status == "success").alias("success"), F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "blocked").alias("blocked"),
    )


def progress_stats(urls: DataFrame, log: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Per source: counts by outcome, what is pending, completion and overall status.

    Records are counted, not distinct URLs, and pending is never negative.
    ``pages`` (source, page_count) adds a check of stored pages against successes.
    """
    totals = urls.groupBy("source").agg(F.count(F.lit(1)).alias("total_urls"))
    out = totals.join(progress_counts(log, ["source"]), "source", "left").fillna(0, ["success", "failed", "blocked"])
    done = F.col("success") + F.col("failed") + F.col("blocked")
    out = out.withColumn("pending", F.greatest(F.lit(0), F.col("total_urls") - done))
    out = out.withColumns({
        "completion_percentage": buckets.share_or_zero(done, "total_urls"),
        "overall_status": buckets.overall_status("blocked", "pending", F.col("success") + F.col("failed"), "total_urls"),
    })
    if pages is not None:
        out = out.join(pages, "source", "left").fillna(0, ["page_count"])
        out = out.withColumn("count_mismatch", F.col("page_count") != F.col("success"))
    return out


def source_summary(sources: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sources by stored status, counter sums, share scraped and stored-status mismatches."""
    c = F.col
    counted = {s: F.count_if(c("status") == s).alias(s) for s in ["pending", "in_progress", "blocked", "completed", "skip"]}
    right = buckets.correct_status("urls_found", "html_scraped", "html_failed", "html_blocked", "builds", "mods")
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(f"total_{name}") for name in ["urls_found", "html_scraped", "builds", "mods"]]
    out = sources.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("total_sources"), *counted.values(), *sums,
        F.count_if((c("status") != right) & (c("status") != "skip")).alias("status_mismatches"),
    )
    return out.withColumn("overall_pct", buckets.share_or_zero("total_html_scraped", "total_urls_found"))


def stage_progress(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per source and stage, one column per stage."""
    parts = [df.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit(stage)) for stage, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("source").pivot("stage", list(tables)).agg(F.sum("n")).fillna(0)


def daily_counts(events: DataFrame, ts: str = "ts", keys: list[str] | None = None) -> DataFrame:
    return events.groupBy(*(keys or []), F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("count"))


def outcome_totals(results: DataFrame) -> DataFrame:
    """Success, failed, elapsed and mean time of a batch of tasks."""
    return results.agg(
        F.count_if("success").alias("success"), F.count_if(~F.col("success")).alias("failed"),
        F.sum("duration").alias("elapsed"), F.avg("duration").alias("average_time"),
    )


def pass_rate(results: DataFrame, order: list[str], last: int = 100) -> DataFrame:
    """Share of passes among the newest ``last`` results, 0 without any."""
    newest = results.orderBy(*[F.col(o).desc() for o in order]).limit(last)
    return newest.agg(F.coalesce(F.avg(F.col("passed").cast("int")), F.lit(0.0)).alias("pass_rate"))


def error_histogram(failures: DataFrame, message: str = "error", keys: list[str] | None = None, coarse: bool = False) -> DataFrame:
    """Failures per error class with their share."""
    keys = keys or []
    label = buckets.coarse_error_class(message) if coarse else buckets.fetch_error_class(message)
    counts = failures.groupBy(*keys, label.alias("error_class")).agg(F.count(F.lit(1)).alias("count"))
    # At most ten rows per key are left here.
    counts = counts.withColumn("failed", F.sum("count").over(Window.partitionBy(*keys)))
    return counts.withColumn("pct", buckets.share("count", "failed"))


def error_dominance(failures: DataFrame, message: str = "error", keys: list[str] | None = None) -> DataFrame:
    """Is the site down (over 80 % DNS) or blocking (over 50 % blocked)?"""
    label = buckets.fetch_error_class(message)
    tagged = failures.withColumn("_class", label)
    blocked = F.count_if(F.col("_class").isin("blocked_403", "blocked_429", "cloudflare"))
    out = tagged.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("failed"), F.count_if(F.col("_class") == "dns").alias("dns"), blocked.alias("blocked")
    )
    return out.withColumns({"site_down": F.col("dns") > F.col("failed") * 0.8, "site_blocking": F.col("blocked") > F.col("failed") * 0.5})


def error_verdict(failures: DataFrame, message: str = "error", keys: list[str] | None = None) -> DataFrame:
    """Five-class form: blocking above 30 %, down above 80 % DNS, errors, or clean."""
    tagged = failures.withColumn("_class", buckets.coarse_error_class(message))
    out = tagged.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("failed"),
        *[F.count_if(F.col("_class") == c).alias(c) for c in ["dns", "blocked", "timeout", "server", "other"]],
    )
    c = F.col
    return out.withColumn("verdict", F.when(c("blocked") > c("failed") * 0.3, "blocking").when(c("dns") > c("failed") * 0.8, "down").when(c("failed") > 0, "errors").otherwise("clean"))


# --- URLs ------------------------------------------------------------------


def url_quality(urls: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts behind the URL checks, whole table, one row per group."""
    per_url = urls.groupBy(*(keys or []), "url").agg(F.count(F.lit(1)).alias("n"))
    return per_url.groupBy(*(keys or [])).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_urls"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(~is_valid_url("url"), F.col("n"))), F.lit(0)).alias("invalid"),
        F.coalesce(F.sum(F.when(is_listing_url("url"), F.col("n"))), F.lit(0)).alias("listing_urls"),
        F.coalesce(F.sum(F.when(is_media_url("url"), F.col("n"))), F.lit(0)).alias("media_urls"),
        F.countDistinct(site_host("url")).alias("domains"),
    )


def volume_band(count) -> Column:
    count = F.col(count) if isinstance(count, str) else count
    return F.when(count == 0, "none").when(count < 10, "too_few").when(count < 50, "low").otherwise("ok")


def domain_band(domains) -> Column:
    domains = F.col(domains) if isinstance(domains, str) else domains
    return F.when(domains == 1, "pass").when(domains <= 3, "warn").otherwise("fail")


def declared_counts(envelopes: DataFrame) -> DataFrame:
    """Declared against actual number of URLs per source, over all of its envelopes, and missing metadata.

    Each envelope of a source declares the whole source's count; parts that differ, or have none, are a fault of the source.
    """
    sums = envelopes.groupBy("source").agg(
        F.sum(F.coalesce(F.size("urls"), F.lit(0))).alias("actual"), F.max("totalCount").alias("declared"),
        F.min("totalCount").alias("_least"), F.count_if(F.col("totalCount").isNull()).alias("_none"),
        F.count_if(F.col("lastUpdated").isNull()).alias("_undated"),
    )
    same = (F.col("declared") == F.col("actual")) & (F.col("_least") == F.col("actual"))
    return sums.select(
        "source", "actual", "declared",
        F.when(F.col("_none") > 0, "missing").when(~same, "mismatch").otherwise("ok").alias("count_check"),
        F.when(F.col("_undated") > 0, "missing").otherwise("ok").alias("updated_check"),
    )


# --- pages -----------------------------------------------------------------


def label_counts(df: DataFrame, labels: Column, keys: list[str] | None = None) -> DataFrame:
    """Rows per label of a label array; a row counts once for each entry."""
    exploded = df.select(*(keys or []), F.explode(labels).alias("label"))
    return exploded.groupBy(*(keys or []), "label").agg(F.count(F.lit(1)).alias("count"))


def corruption_report(pages: DataFrame, reason: str, name: str, size: str, samples: int = 5) -> DataFrame:
    """Per reason: pages, megabytes, mean kilobytes and a few names."""
    sizes = pages.groupBy(reason).agg(
        F.round(F.sum(size) / (1024 * 1024), 2).alias("total_mb"), F.round(F.avg(size) / 1024, 1).alias("avg_kb")
    )
    return bounded_samples(pages, [reason], name, samples).join(sizes, reason)


def inventory(files: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Files and bytes per suffix."""
    return files.groupBy(*(keys or []), "suffix").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def stored_results(files: DataFrame) -> DataFrame:
    """Entries, bytes and megabytes of a store."""
    total = F.coalesce(F.sum("length"), F.lit(0))
    return files.agg(F.count(F.lit(1)).alias("entries"), total.alias("bytes"), F.round(total / (1024 * 1024), 2).alias("megabytes"))


# --- builds and mods -------------------------------------------------------


def build_profile(builds: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """How many builds have each field, and usable at that.

    Fields: build_id, source_url, year, make, model, build_title, build_story,
    gallery_images, modifications.
    """
    c = F.col
    make, model, title = (~is_garbage(f) for f in ("make", "model", "build_title"))
    return builds.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("total_builds"),
        F.count_if(F.coalesce(c("build_id") != 0, F.lit(False))).alias("with_build_id"),
        F.count_if(c("source_url").startswith("http")).alias("with_url"),
        F.count_if(is_set("year")).alias("with_year"),
        F.count_if(buckets.year_in_range("year")).alias("with_valid_year"),
        F.count_if(make).alias("with_make"),
        F.count_if(make & F.lower(F.trim("make")).isin(vocab.KNOWN_MAKES)).alias("with_known_make"),
        F.count_if(model).alias("with_model"), F.count_if(title).alias("with_title"),
        F.count_if(F.length("build_story") > 50).alias("with_story"),
        F.count_if(F.size("gallery_images") > 0).alias("with_images"),
        F.count_if(F.size("modifications") > 0).alias("with_mods"),
    )


def completeness(profile_: DataFrame, digits: int = 4) -> DataFrame:
    """Weighted completeness (0-100) and the lower bound of valid builds."""
    weights = vocab.COMPLETENESS_WEIGHTS
    score = sum((F.try_divide(F.col(f), F.col("total_builds")) * w for f, w in weights.items()), F.lit(0.0))
    return profile_.withColumns({
        "completeness_score": F.round(F.coalesce(score / sum(weights.values()) * 100, F.lit(0.0)), digits),
        "valid_builds": F.least("with_build_id", "with_url", "with_make", "with_model"),
    })


def missing_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows without each required field, share and severity; one pass, then unpivoted."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(~is_set(f)).alias(f) for f in fields])
    rows = counts.unpivot("total", fields, "field", "missing")
    pct = F.coalesce(F.try_divide(F.col("missing"), F.col("total")) * 100, F.lit(0.0))
    return rows.withColumns({"missing_pct": F.round(pct, 1), "severity": buckets.severity_above(pct)})


def top_with_unique(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The ``n`` most common values next to the number of distinct values."""
    counts = df.where(is_set(column)).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    unique = counts.agg(F.count(F.lit(1)).alias("unique_values"))
    return beside(counts.orderBy(F.desc("count"), column).limit(n), unique)


def mods_profile(mods: DataFrame, builds: DataFrame | None = None) -> DataFrame:
    """Named, branded and categorised mods, repeats and orphans."""
    branded = F.count_if(~is_garbage("brand")).alias("b")
    # One row per repeated mod: its size gives the totals, the number of rows the repeats.
    keyed = mods.groupBy("build_id", "name", "category").agg(F.count(F.lit(1)).alias("n"), branded)

    def total(test):
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))

    named, categorised = ~is_garbage("name"), is_set("category")
    known = F.lower(F.trim("category")).isin(vocab.AUDIT_CATEGORIES)
    out = keyed.agg(
        total(F.lit(True)).alias("total_mods"), total(named).alias("with_name"), F.coalesce(F.sum("b"), F.lit(0)).alias("with_brand"),
        total(categorised).alias("with_category"), total(categorised & known).alias("with_valid_category"), F.count(F.lit(1)).alias("_distinct"),
    )
    out = out.withColumns({"duplicate_mods": F.col("total_mods") - F.col("_distinct"), "valid_mods": F.least("with_name", "with_category")}).drop("_distinct")
    if builds is not None:
        known_ids = builds.select("build_id").where("build_id is not null").distinct()
        orphans = mods.where("build_id is not null").join(known_ids, "build_id", "left_anti").agg(F.count(F.lit(1)).alias("orphan_mods"))
        out = beside(out, orphans)
    return out


def mods_quality(mods: DataFrame) -> DataFrame:
    """Missing names (any of three columns), missing and non-standard categories."""
    names = [F.nullif(F.col(c), F.lit("")) for c in ("name", "part_name", "modification") if c in mods.columns]
    name = F.coalesce(*names)
    return mods.agg(
        F.count(F.lit(1)).alias("total_mods"),
        F.count_if(F.coalesce(F.trim(name), F.lit("")) == "").alias("missing_name"),
        F.count_if(~is_set("category")).alias("missing_category"),
        F.count_if(is_set("category") & ~F.col("category").isin(vocab.STANDARD_CATEGORIES)).alias("invalid_category"),
        F.countDistinct(F.when(is_set("category"), F.col("category"))).alias("unique_categories"),
    )


def image_profile(builds: DataFrame) -> DataFrame:
    checked = builds.select(F.size("gallery_images").alias("n"), records.image_checks("gallery_images").alias("i"))
    out = checked.agg(
        F.count(F.lit(1)).alias("builds"), F.count_if(F.col("n") > 0).alias("builds_with_images"),
        F.coalesce(F.sum("i.total"), F.lit(0)).alias("total_images"),
        F.coalesce(F.sum("i.invalid"), F.lit(0)).alias("invalid_images"),
        F.coalesce(F.sum("i.placeholder"), F.lit(0)).alias("placeholder_images"),
    )
    return out.withColumns({
        "avg_images_per_build": F.round(F.try_divide("total_images", "builds"), 1),
        "image_coverage_pct": buckets.share_or_zero("builds_with_images", "builds"),
    })


def coverage(counts: DataFrame) -> DataFrame:
    """Scrape, extraction and overall share with severities, from (urls, pages, builds)."""
    scrape, extract = buckets.share("pages", "urls", 6), buckets.share("builds", "pages", 6)
    return counts.withColumns({
        "scrape_pct": buckets.share("pages", "urls"), "scrape_severity": buckets.severity_below(scrape),
        "extract_pct": buckets.share("builds", "pages"), "extract_severity": buckets.severity_below(extract),
        "overall_pct": F.when(F.col("builds") > 0, buckets.share("builds", "urls")),
    })


def category_breakdown(mods: DataFrame) -> DataFrame:
    return mods.groupBy("category").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "category")


def mod_rate(mods: DataFrame, builds: DataFrame) -> DataFrame:
    """Share of builds that have any mod."""
    with_mods = mods.agg(F.countDistinct("build_id").alias("builds_with_mods"), F.count(F.lit(1)).alias("total_mods"))
    totals = builds.agg(F.count(F.lit(1)).alias("total_builds"))
    return beside(with_mods, totals).withColumn("mod_rate", buckets.share_or_zero("builds_with_mods", "total_builds"))


def typed_average(df: DataFrame, column: str) -> DataFrame:
    """Mean over the values that are numbers."""
    number = F.col(column).try_cast("double")
    return df.agg(F.avg(number).alias("average"), F.count(number).alias("count"))


def issue_counts(issues: DataFrame, key: str) -> DataFrame:
    """Broken rules per key value, from a column ``issues`` of (field, message, severity)."""
    flat = issues.select("build_id", F.explode("issues").alias("i")).select("build_id", "i.*")
    return flat.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


# --- sources ---------------------------------------------------------------


def stage_completeness(sources: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows each source has in each stage table and the first stage that is missing."""
    out = sources.select("source").distinct().join(stage_progress(tables), "source", "left").fillna(0, list(tables))
    missing = F.coalesce(*[F.when(F.col(stage) == 0, F.lit(stage)) for stage in tables])
    return out.withColumns({"missing_stage": missing, "severity": F.when(missing.isNotNull(), "critical").otherwise("ok")})


def cross_ratios(counts: DataFrame) -> DataFrame:
    """Builds per page and mods per build, with the bands that call for a look."""
    per_page, per_build = F.try_divide("builds", "pages"), F.try_divide("mods", "builds")
    return counts.withColumns({
        "builds_per_page": F.round(per_page, 3), "mods_per_build": F.round(per_build, 3),
        "build_check": F.when((F.col("pages") == 0) | (F.col("builds") == 0), "skipped").when(per_page < 0.5, "low").when(per_page > 1.2, "high").otherwise("ok"),
        "mod_check": F.when((F.col("builds") == 0) | (F.col("mods") == 0), "skipped").when(per_build < 0.5, "low").otherwise("ok"),
    })


def evidence(counts: DataFrame, artefacts: list[str], needed: int = 3) -> DataFrame:
    """Artefacts that exist, of those expected; enough from ``needed`` on."""
    present = sum((F.coalesce(F.col(a) > 0, F.lit(False)).cast("int") for a in artefacts), F.lit(0))
    return counts.withColumns({"evidence_score": present, "sufficient": present >= needed})


def weighted_report(scores: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Weighted mean of the metrics present, and its grade; rows are (metric, score)."""
    weight = buckets_weight("metric")
    usable = F.col("score").isNotNull() & weight.isNotNull()
    total = F.sum(F.when(usable, F.col("score") * weight))
    out = scores.groupBy(*(keys or [])).agg(
        F.count_if(usable).alias("metrics"), F.round(F.coalesce(F.try_divide(total, F.sum(F.when(usable, weight))), F.lit(0.0)), 4).alias("overall_score")
    )
    return out.withColumn("grade", buckets.grade("overall_score"))


def buckets_weight(metric: str) -> Column:
    out = F
    for name, weight in vocab.QUALITY_WEIGHTS.items():
        out = out.when(F.col(metric) == name, weight)
    return out.otherwise(None)


def check_scores(checks: DataFrame, keys: list[str]) -> DataFrame:
    """Share of passed checks per stage; rows are (stage, check, passed)."""
    return checks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed"), F.every("passed").alias("all_passed"),
        F.round(F.avg(F.col("passed").cast("int")) * 100, 4).alias("score"),
    )


def batch_assertions(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"),
        F.coalesce(F.every("passed"), F.lit(True)).alias("all_passed"),
    )
