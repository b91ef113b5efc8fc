"""Dates, shares and the many small rules that turn numbers into words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions.urls import _col


def parse_time(text) -> Column:
    """ISO text (``Z``, offset or none, read as UTC) as a timestamp; null if unreadable."""
    return F.try_to_timestamp(_col(text))


def iso_time(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def age_seconds(ts, as_of) -> Column:
    return F.timestamp_diff("SECOND", _col(ts), _col(as_of))


def age_minutes(ts, as_of) -> Column:
    return F.timestamp_diff("MINUTE", _col(ts), _col(as_of))


def time_ago(ts, as_of) -> Column:
    seconds = age_seconds(ts, as_of)

    def ago(unit, letter):
        return F.concat(F.floor(seconds / unit).cast("string"), F.lit(letter + " ago"))

    return (
        F.when(seconds < 60, "just now").when(seconds < 3600, ago(60, "m"))
        .when(seconds < 86400, ago(3600, "h")).otherwise(ago(86400, "d"))
    )


def is_stale(ts, as_of, minutes: int = vocab.STALL_MINUTES) -> Column:
    return age_seconds(ts, as_of) > minutes * 60


def share(part, whole, digits: int = 1) -> Column:
    """Percentage, null for an empty whole."""
    return F.round(F.try_divide(_col(part), _col(whole)) * 100, digits)


def share_or_zero(part, whole, digits: int = 1) -> Column:
    return F.coalesce(share(part, whole, digits), F.lit(0.0))


def year_in_range(year, rule: str = "prefix", as_of_year: int = 2026) -> Column:
    """``prefix``: first four characters in 1900-2027; ``whole``: 1885 to as-of + 2; ``four_digits``: shape only."""
    text = F.trim(_col(year).cast("string"))
    if rule == "four_digits":
        return F.coalesce(text.rlike(r"^\d{4}$"), F.lit(False))
    if rule == "prefix":
        number, low, high = F.substring(text, 1, 4).try_cast("int"), 1900, 2027
    else:
        number, low, high = text.try_cast("int"), 1885, as_of_year + 2
    return F.coalesce(number.between(low, high), F.lit(False))


def mod_level(count) -> Column:
    count = _col(count)
    return (
        F.when(count <= 1, "Stock").when(count <= 5, "Lightly Modified")
        .when(count <= 15, "Moderately Modified").otherwise("Heavily Modified")
    )


def grade(score) -> Column:
    score = _col(score)
    return F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 60, "D").otherwise("F")


def light(score) -> Column:
    """Traffic light of one metric."""
    score = _col(score)
    return F.when(score >= 80, "good").when(score >= 50, "fair").otherwise("poor")


def health(quality) -> Column:
    quality = _col(quality)
    return (
        F.when(quality >= 80, "healthy").when(quality >= 60, "warning")
        .when(quality >= 40, "degraded").otherwise("critical")
    )


def mean_of_present(*scores) -> Column:
    """Mean of the scores that are not null, 0 if none is."""
    columns = [_col(s) for s in scores]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in columns), F.lit(0.0))
    present = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    return F.coalesce(F.try_divide(total, present), F.lit(0.0))


def artefact_stage(has_urls, has_pages, has_builds, has_mods) -> Column:
    """How far a source has come, from what exists."""
    return (
        F.when(_col(has_builds) & _col(has_mods), "complete").when(_col(has_builds), "stage3_partial")
        .when(_col(has_pages), "stage2_complete").when(_col(has_urls), "stage1_complete").otherwise("empty")
    )


def next_action(urls, pages, builds, mods) -> Column:
    urls, pages, builds, mods = map(_col, (urls, pages, builds, mods))
    return (
        F.when(mods.isNotNull(), "complete")
        .when(urls.isNull() | (urls == 0), "discover_urls")
        .when(F.coalesce(pages, F.lit(0)) < urls, "scrape_pages")
        .when(builds.isNull(), "extract_builds")
        .otherwise("extract_mods")
    )


def severity_below(pct, critical: float = 50, warning: float = 80) -> Column:
    """Low is bad: coverage."""
    pct = _col(pct)
    return F.when(pct < critical, "critical").when(pct < warning, "warning").otherwise("ok")


def severity_above(pct, critical: float = 10, warning: float = 0) -> Column:
    """High is bad: missing or orphaned rows."""
    pct = _col(pct)
    return F.when(pct > critical, "critical").when(pct > warning, "warning").otherwise("ok")


def correct_status(found, scraped, failed, blocked, builds, mods, rule: str = "builds_and_mods", expected=None) -> Column:
    """The status the counters call for.

    ``builds_and_mods``: complete needs builds and mods above 0 (default);
    ``builds_known``: needs builds, and compares scraped pages only;
    ``all_known``: everything attempted, expected count met, builds and mods known.
    """
    zero = F.lit(0)
    found, scraped, failed, blocked = (F.coalesce(_col(c), zero) for c in (found, scraped, failed, blocked))
    builds, mods = _col(builds), _col(mods)
    attempted = scraped + failed + blocked
    out = F.when(found == 0, "pending").when(blocked > 0, "blocked")
    if rule == "builds_known":
        return out.when(scraped < found, "in_progress").when(builds.isNotNull(), "completed").otherwise("in_progress")
    out = out.when(attempted < found, "in_progress")
    if rule == "all_known":
        met = builds.isNotNull() & mods.isNotNull() & F.coalesce(_col(expected) == found, F.lit(False)) & (attempted == found)
        return out.when(met, "completed").otherwise("in_progress")
    done = (F.coalesce(builds, zero) > 0) & (F.coalesce(mods, zero) > 0)
    return out.when(done, "completed").otherwise("in_progress")


def synced_status(status, urls, pages, builds) -> Column:
    """Status after artefact counts were taken."""
    status, urls, pages, builds = map(_col, (status, urls, pages, builds))
    return (
        F.when((builds > 0) & (status != "completed"), "completed")
        .when((builds <= 0) & (pages > 0) & (urls > 0) & (pages >= urls) & (status == "pending"), "in_progress")
        .otherwise(status)
    )


def stage_state(current, total) -> Column:
    current, total = _col(current), _col(total)
    reached = F.coalesce((total != 0) & (current >= total), F.lit(False))
    return F.when(reached, "complete").when(current > 0, "active").otherwise("empty")


def overall_status(blocked, pending, done, total) -> Column:
    """Status of a fetch log: any block counts as blocked."""
    blocked, pending, done, total = map(_col, (blocked, pending, done, total))
    return (
        F.when(blocked > 0, "blocked").when((pending == 0) & (total > 0), "complete")
        .when(done > 0, "in_progress").otherwise("not_started")
    )


def status_rank(status) -> Column:
    """Position in the queue order; unknown statuses last."""
    status = _col(status)
    out = F
    for rank, name in enumerate(vocab.STATUS_ORDER):
        out = out.when(status == name, rank)
    return out.otherwise(vocab.UNRANKED)


def backoff_seconds(consecutive) -> Column:
    """Doubles from the start value per consecutive block, up to the maximum."""
    power = F.pow(F.lit(2.0), F.least(_col(consecutive), F.lit(20)))
    return F.least(F.lit(float(vocab.BACKOFF_START_S)) * power, F.lit(float(vocab.BACKOFF_MAX_S))).cast("bigint")


def fetch_error_class(message) -> Column:
    """One of ten classes, first match wins."""
    message = F.coalesce(_col(message), F.lit(""))
    lowered = F.lower(message)
    out = F
    for name, phrases, pattern in vocab.FETCH_ERROR_CLASSES:
        hit = F.lit(False)
        for phrase in phrases:
            hit = hit | lowered.contains(phrase)
        if pattern:
            hit = message.rlike(pattern)
        out = out.when(hit, name)
    return out.otherwise("other")


def coarse_error_class(message) -> Column:
    """The five-class form."""
    message = F.coalesce(_col(message), F.lit(""))
    lowered = F.lower(message)
    return (
        F.when(lowered.rlike("resolve|nodename|getaddrinfo"), "dns")
        .when(message.rlike("403|429") | lowered.rlike("cloudflare|blocked"), "blocked")
        .when(lowered.contains("timeout"), "timeout")
        .when(message.rlike("500|502|503|504"), "server").otherwise("other")
    )


def lookup(value, table: dict[str, str], default: str) -> Column:
    """A fixed table of a few words as CASE."""
    value = _col(value)
    out = F
    for key, text in table.items():
        out = out.when(value == key, text)
    return out.otherwise(default)
