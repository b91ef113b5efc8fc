"""Projections and predicates over source, event, log and graph tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import buckets, pages, text, urls

# --- SQL access ------------------------------------------------------------


def execute(spark: SparkSession, query: str, params: Sequence | dict | None = None) -> DataFrame:
    """SQL with ``?`` or ``:name`` parameters, bound and never pasted."""
    return spark.sql(query, args=params) if params else spark.sql(query)


def query_rows(spark: SparkSession, query: str, params=None, limit: int = 10_000) -> list[dict]:
    """A small result as dicts; ``limit`` guards the driver and a larger result is an error."""
    rows = execute(spark, query, params).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; use execute() and write the result")
    return [r.asDict(recursive=True) for r in rows]


def query_scalar(spark: SparkSession, query: str, params=None):
    row = execute(spark, query, params).first()
    return row[0] if row else None


def without(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


# --- sources ---------------------------------------------------------------


def with_status(df: DataFrame, status: str | None = None) -> DataFrame:
    return df if status is None else df.where(F.col("status") == status)


def with_status_in(df: DataFrame, statuses: Sequence[str], skip_blocked: bool = False) -> DataFrame:
    out = df.where(F.col("status").isin(list(statuses)))
    return out.where(F.col("status") != "blocked") if skip_blocked else out


def needs_work() -> Column:
    """Open status, or a counter that shows an unfinished stage."""
    c = F.col
    return F.coalesce(
        c("status").isin("pending", "in_progress", "blocked") | c("urls_found").isNull()
        | (c("urls_found").isNotNull() & c("html_scraped").isNull())
        | F.coalesce(c("html_scraped") < c("urls_found"), F.lit(False))
        | (c("html_scraped").isNotNull() & c("builds").isNull()),
        F.lit(False),
    )


def failing(sources: DataFrame, threshold: int = 10) -> DataFrame:
    failures = F.coalesce(F.col("html_failed"), F.lit(0)) + F.coalesce(F.col("html_blocked"), F.lit(0))
    out = sources.withColumn("failures", failures)
    return out.where((F.col("failures") > threshold) & (F.col("urls_found") > 0))


def blocked_sources(sources: DataFrame) -> DataFrame:
    return sources.where((F.col("status") == "blocked") | (F.coalesce(F.col("html_blocked"), F.lit(0)) > 0))


def recent(df: DataFrame, ts: str, as_of: Column, minutes: int = 10) -> DataFrame:
    """Rows newer than ``minutes`` before ``as_of``; the comparison reaches the scan."""
    return df.where(F.col(ts) > as_of - F.make_dt_interval(mins=F.lit(minutes)))


# --- search ----------------------------------------------------------------


def search_entities(entities: DataFrame, kind: str | None = None, term: str | None = None) -> DataFrame:
    """Entities by type and by a term in the name or any observation."""
    out = entities if kind in (None, "all") else entities.where(F.col("type") == kind)
    if term:
        t = term.lower()
        said = F.exists("observations", lambda o: F.lower(o).contains(t))
        out = out.where(F.lower("name").contains(t) | F.coalesce(said, F.lit(False)))
    return out


def search_sources(sources: DataFrame, term: str = "") -> DataFrame:
    if not term:
        return sources
    t = term.lower()
    return sources.where(F.lower("name").contains(t) | F.coalesce(F.lower("source_id").contains(t), F.lit(False)))


# --- logs ------------------------------------------------------------------


def log_for_source(lines: DataFrame, source_id: str, message: str = "message", system_words: Sequence[str] = tuple(vocab.SYSTEM_LINE_WORDS)) -> DataFrame:
    """Lines of one source, in either spelling of its id; system lines and rulers stay."""
    if not source_id or source_id == "_all":
        return lines
    lowered = F.lower(message)
    ids = {source_id.lower(), source_id.replace("_", "-").lower(), source_id.replace("-", "_").lower()}
    return lines.where(text.contains_any(lowered, sorted(ids) + list(system_words)) | F.col(message).rlike(r"^\s*[-=]+\s*$"))


def session_flags(lines: DataFrame, keys: Sequence[str], message: str = "message", errors: int = 10) -> DataFrame:
    """Per session: success marker, critical marker, error lines, and whether the breaker trips."""
    m = F.col(message)
    out = lines.groupBy(*keys).agg(
        F.coalesce(F.bool_or(m.rlike(vocab.SUCCESS_MARKERS)), F.lit(False)).alias("success"),
        F.coalesce(F.bool_or(m.rlike(vocab.CRITICAL_MARKERS)), F.lit(False)).alias("critical"),
        F.count_if(m.rlike(vocab.ERROR_MARKERS)).alias("error_lines"),
    )
    return out.withColumn("breaker", F.col("critical") | (F.col("error_lines") > errors))


# --- graph and event projections -------------------------------------------


def build_title() -> Column:
    """Title, else year make model, else a fixed name."""
    parts = F.trim(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("year", "make", "model")]))
    return F.coalesce(F.nullif("build_title", F.lit("")), F.nullif(parts, F.lit("")), F.lit("Unknown Build"))


def json_fields(df: DataFrame, column: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Fields of a JSON column: ``{name: (path, type)}``; unreadable values are null."""
    parsed = F.try_parse_json(column)
    return df.withColumns({n: F.try_variant_get(parsed, path, kind) for n, (path, kind) in fields.items()})


def http_event(events: DataFrame) -> DataFrame:
    """Adds what the event store derives: host, path, sizes, redacted headers, block reason.

    Expects method, url, status_code, request_headers, response_headers,
    request_body, response_body, is_blocked, blocked_reason, source_id, stage and
    the iteration's iteration_source_id, iteration_stage.
    """
    c = F.col
    caught = ~F.coalesce(c("is_blocked"), F.lit(False)) & F.coalesce(c("status_code").isin(403, 429, 503), F.lit(False))
    out = events.withColumns({
        "url_domain": urls.host("url"), "url_path": urls.path("url"),
        "request_headers": F.to_json(text.redact_headers("request_headers")),
        "response_headers": F.to_json(text.redact_headers("response_headers")),
        "request_body_size": pages.body_stats("request_body")["size"],
        "request_body_compressed": pages.body_stats("request_body")["compressed"],
        "response_body_size": pages.body_stats("response_body")["size"],
        "response_body_compressed": pages.body_stats("response_body")["compressed"],
        "blocked_reason": F.when(caught, F.coalesce(c("blocked_reason"), pages.block_reason("status_code"))).otherwise(c("blocked_reason")),
        "is_blocked": F.coalesce(c("is_blocked"), F.lit(False)) | caught,
        "source_id": F.coalesce("source_id", "iteration_source_id"), "stage": F.coalesce("stage", "iteration_stage"),
    })
    return out.drop("iteration_source_id", "iteration_stage")


def llm_event(events: DataFrame) -> DataFrame:
    return events.withColumn("provider", F.coalesce("provider", text.provider("model")))


def file_event(events: DataFrame) -> DataFrame:
    return events.withColumn("file_type", F.coalesce("file_type", text.file_type("file_path")))


def decision_event(events: DataFrame, json_columns: Sequence[str] = ("related_event_ids",)) -> DataFrame:
    return events.withColumns({c: F.to_json(c) for c in json_columns})


def url_of_entry(entry) -> Column:
    """A URL entry that is either a string or an object with ``url``."""
    entry = urls._col(entry)
    inner = F.get_json_object(entry, "$.url")
    return F.coalesce(inner, F.when(~entry.startswith("{"), F.regexp_replace(entry, '^"|"$', "")))


def log_symptoms(message) -> Column:
    """What a failure log points at, as (issue, severity)."""
    message = urls._col(message)
    return F.array_compact(F.array(*[
        F.when(text.contains_any(message, words), F.struct(F.lit(issue).alias("issue"), F.lit(severity).alias("severity")))
        for words, issue, severity in vocab.LOG_SYMPTOMS
    ]))


def log_category(message, status) -> Column:
    """Category, summary and advice for a log excerpt; the status itself where nothing matches."""
    lowered = F.lower(F.coalesce(urls._col(message), F.lit("")))
    status = urls._col(status)

    def rule(out, entry):
        words, category, summary = entry
        return out.when(text.contains_any(lowered, words), F.struct(F.lit(category).alias("category"), F.lit(summary).alias("summary")))

    fallback = F.struct(status.alias("category"), F.concat(F.initcap(status), F.lit(" state detected")).alias("summary"))
    return reduce(rule, vocab.LOG_CATEGORIES, F).otherwise(fallback)


def status_advice(status) -> Column:
    return buckets.lookup(status, vocab.STATUS_ADVICE, vocab.STATUS_ADVICE_DEFAULT)


def fetch_advice(error_class) -> Column:
    return buckets.lookup(error_class, vocab.FETCH_ERROR_ADVICE, vocab.FETCH_ERROR_ADVICE_DEFAULT)
