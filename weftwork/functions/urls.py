"""URL columns: canonical forms, ids, file names, link resolution, URL tests.

Parts are cut with regular expressions rather than ``parse_url``: crawled URLs
hold spaces, pipes and raw accents that ``java.net.URI`` rejects.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftwork import vocab

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_BEFORE_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _once(parts: dict[str, Column], build: Callable[[Column], Column]) -> Column:
    """``build`` over named parts that are computed once each, however often it uses them."""
    row = F.struct(*[value.alias(name) for name, value in parts.items()])
    return F.get(F.transform(F.array(row), build), F.lit(0))


def any_match(text, patterns: list[str], ignore_case: bool = True) -> Column:
    """True where any of the patterns is found; one alternation, one scan of the text."""
    flag = "(?i)" if ignore_case else ""
    return _col(text).rlike(flag + "|".join(f"(?:{p})" for p in patterns))


def scheme(url) -> Column:
    return F.lower(F.regexp_extract(_col(url), _SCHEME, 1))


def netloc(url) -> Column:
    return F.regexp_extract(_col(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1)


def host(url) -> Column:
    return F.lower(netloc(url))


def path(url) -> Column:
    return F.regexp_extract(_col(url), _BEFORE_PATH + r"([^?#]*)", 1)


def query_string(url) -> Column:
    return F.regexp_extract(_col(url), r"^[^?#]*\?([^#]*)", 1)


def fragment(url) -> Column:
    return F.regexp_extract(_col(url), r"#(.*)$", 1)


def _unsplit(scheme_: Column, netloc_: Column, path_: Column, query_: Column, fragment_: Column) -> Column:
    rooted = F.when(path_.startswith("/") | (path_ == ""), path_).otherwise(F.concat(F.lit("/"), path_))
    opaque = (netloc_ == "") & ~scheme_.isin("", "http", "https", "ftp", "file")
    return F.concat(
        F.when(scheme_ != "", F.concat(scheme_, F.lit(":"))).otherwise(""),
        F.when(opaque, path_).when((netloc_ == "") & (scheme_ == ""), path_)
        .otherwise(F.concat(F.lit("//"), netloc_, rooted)),
        F.when(query_ != "", F.concat(F.lit("?"), query_)).otherwise(""),
        F.when(fragment_ != "", F.concat(F.lit("#"), fragment_)).otherwise(""),
    )


def _form_encode(text: Column) -> Column:
    # URLEncoder keeps "*" and escapes "~"; form encoding here is the other way round.
    encoded = F.url_encode(text)
    return F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _form_decode(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def canonical_query(query: Column, drop: list[str] | None) -> Column:
    """Parameters decoded, filtered, ordered by key (repeats keep their order) and encoded again."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda part: part != ""),
        lambda part, at: F.struct(
            _form_decode(F.substring_index(part, "=", 1)).alias("key"),
            at.alias("at"),
            _form_decode(F.regexp_replace(part, "^[^=]*=?", "")).alias("value"),
        ),
    )
    if drop:
        pairs = F.filter(pairs, lambda p: ~F.lower(p["key"]).isin(drop))
    return F.array_join(
        F.transform(
            F.array_sort(pairs),
            lambda p: F.concat(_form_encode(p["key"]), F.lit("="), _form_encode(p["value"])),
        ),
        "&",
    )


def canonical_url(
    url, remove_fragments: bool = True, remove_tracking: bool = True, lowercase_host: bool = True
) -> Column:
    """One spelling per page: the key for deduplication."""
    trimmed = F.trim(_col(url))
    host_ = host(trimmed) if lowercase_host else netloc(trimmed)
    parts = {
        "host": F.regexp_replace(host_, r"^www\.", ""),
        "path": F.regexp_replace(F.regexp_replace(path(trimmed), r";[^/]*$", ""), r"/+$", ""),
        "scheme": scheme(trimmed),
        "query": canonical_query(query_string(trimmed), vocab.TRACKING_PARAMS if remove_tracking else None),
        "fragment": F.lit("") if remove_fragments else fragment(trimmed),
    }
    built = _once(parts, lambda p: _unsplit(
        F.when(p["scheme"] == "", "https").otherwise(p["scheme"]), p["host"],
        F.when(p["path"] == "", "/").otherwise(p["path"]), p["query"], p["fragment"],
    ))
    return F.when(F.coalesce(_col(url), F.lit("")) == "", "").otherwise(built)


def light_url(url) -> Column:
    """The milder form: path and parameter order stay; tracking and fragment go."""
    url = _col(url)
    kept = F.filter(
        F.split(query_string(url), "&"),
        lambda part: ~F.lower(F.substring_index(part, "=", 1)).isin(vocab.LIGHT_TRACKING_PARAMS),
    )
    parts = {
        "scheme": scheme(url), "host": host(url), "path": F.regexp_replace(path(url), r";[^/]*$", ""), "query": F.array_join(kept, "&"),
    }
    return _once(parts, lambda p: _unsplit(p["scheme"], p["host"], p["path"], p["query"], F.lit("")))


def registered_domain(url, include_subdomain: bool = False) -> Column:
    """The last two labels of the host, three below labels such as ``co`` and ``com``."""
    host_ = host(url)
    if include_subdomain:
        return host_
    labels = F.split(host_, r"\.")
    size = F.size(labels)
    deep = F.get(labels, size - 2).isin(vocab.SECOND_LEVEL_LABELS)
    return (
        F.when(size <= 2, host_)
        .when(deep, F.substring_index(host_, ".", -3))
        .otherwise(F.substring_index(host_, ".", -2))
    )


def site_host(url) -> Column:
    """Host without a leading ``www.``."""
    return F.regexp_replace(host(url), r"^www\.", "")


def safe_path(url, max_length: int = 200) -> Column:
    """A URL as a file-system name, closed by a hash where it had to be cut."""
    url = _col(url)
    host_ = F.replace(netloc(url), F.lit("."), F.lit("_"))
    path_ = F.replace(F.regexp_replace(path(url), "^/+|/+$", ""), F.lit("/"), F.lit("_"))
    joined = F.concat_ws("_", F.when(host_ != "", host_), F.when(path_ != "", path_))
    name = F.regexp_replace(F.regexp_replace(joined, r"(?U)[^\w\-_]", "_"), "_+", "_")
    cut = F.concat(F.substring(name, 1, max_length - 9), F.lit("_"), F.substring(F.md5(url), 1, 8))
    return F.when(F.length(name) > max_length, cut).otherwise(name)


def is_valid_url(url, web_only: bool = True) -> Column:
    """Scheme and host present; ``web_only`` asks for http or https."""
    good = scheme(url).isin("http", "https") if web_only else scheme(url) != ""
    return F.coalesce(good & (netloc(url) != ""), F.lit(False))


def build_id(url) -> Column:
    """Deterministic 63-bit id: the first 8 bytes of the MD5, little-endian, top bit cleared."""
    digest = F.md5(F.trim(_col(url)))
    swapped = F.regexp_replace(digest, "^(..)(..)(..)(..)(..)(..)(..)(..).*$", "$8$7$6$5$4$3$2$1")
    return F.conv(swapped, 16, -10).cast("bigint").bitwiseAND(F.lit((1 << 63) - 1))


def page_filename(url) -> Column:
    """Last path segment, made safe, with a short hash."""
    url = _col(url)
    segment = F.element_at(F.split(F.regexp_replace(path(url), "^/+|/+$", ""), "/"), -1)
    slug = F.when(segment == "", "index").otherwise(segment)
    slug = F.substring(F.regexp_replace(slug, "[^a-zA-Z0-9-]", "-"), 1, 100)
    return F.concat(slug, F.lit("-"), F.substring(F.md5(url), 1, 8), F.lit(".html"))


def path_slug(url) -> Column:
    """The whole path joined by dashes, without a leading thread folder."""
    trimmed = F.regexp_replace(path(url), "^/+|/+$", "")
    return F.concat(F.replace(F.regexp_replace(trimmed, "^build-threads/", ""), F.lit("/"), F.lit("-")), F.lit(".html"))


def showcase_slug(url) -> Column:
    """The segment behind ``/showcase/``; null for other URLs."""
    return F.nullif(F.regexp_extract(_col(url), r"/showcase/([^/]+)/?", 1), F.lit(""))


def showcase_filename(url) -> Column:
    url = _col(url)
    other = F.regexp_replace(F.replace(F.replace(url, F.lit("https://"), F.lit("")), F.lit("/"), F.lit("_")), "_+$", "")
    return F.concat(F.coalesce(showcase_slug(url), other), F.lit(".html"))


def showcase_item(url) -> Column:
    """``{slug}.{id}`` split into url, filename and item id; null where there is no id."""
    url = _col(url)
    item = F.regexp_extract(url, r"/showcase/[^.]+\.(\d+)/", 1)
    tail = F.element_at(F.split(url, "/showcase/"), -1)
    slug = F.replace(F.replace(F.replace(tail, F.concat(F.lit("."), item), F.lit("")), F.lit("/"), F.lit("")), F.lit("-"), F.lit("_"))
    name = F.when(slug == "", F.concat(F.lit("showcase-"), item)).otherwise(slug)
    row = F.struct(
        F.substring_index(url, "?", 1).alias("url"),
        F.concat(name, F.lit(".html")).alias("filename"),
        item.alias("item_id"),
    )
    return F.when(item != "", row)


def source_id_from_file(name) -> Column:
    """``Some-File.csv`` → ``some_file``."""
    return F.lower(F.regexp_replace(F.replace(_col(name), F.lit(".csv"), F.lit("")), "[- ]", "_"))


def source_id_from_url(url) -> Column:
    """Queue id of a site: its host with dots and dashes as underscores."""
    return F.regexp_replace(F.replace(netloc(url), F.lit("www."), F.lit("")), r"[.\-]", "_")


def path_template(path_: Column) -> Column:
    """Ids, UUIDs and slugs in a path replaced by placeholders."""
    return reduce(lambda text, rule: F.regexp_replace(text, *rule), vocab.PATH_TEMPLATES, path_)


def _without_dots(path_: Column) -> Column:
    parts = F.aggregate(
        F.split(path_, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when((part == "..") & (F.size(done) > 1), F.slice(done, F.lit(1), F.size(done) - 1))
        .when(part == "..", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    joined = F.array_join(parts, "/")
    return F.when(path_.rlike(r"/\.{1,2}$"), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve(href, base) -> Column:
    """A link as an absolute URL, relative to the page it was found on."""
    parts = {"href": _col(href), "base": _col(base), "scheme": scheme(base), "host": netloc(base), "path": path(base)}
    return _once(parts, _resolved)


def _resolved(p: Column) -> Column:
    href, base, base_path = p["href"], p["base"], p["path"]
    root = F.concat(p["scheme"], F.lit("://"), p["host"])
    folder = F.regexp_replace(base_path, "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    tail = F.regexp_extract(href, r"([?#].*)$", 1)
    plain = F.regexp_replace(href, r"[?#].*$", "")
    query = query_string(base)
    return (
        F.when(href == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(p["scheme"], F.lit(":"), href))
        .when(href.startswith("/") & ~href.contains("/."), F.concat(root, href))
        .when(href.startswith("/"), F.concat(root, _without_dots(plain), tail))
        .when(href.startswith("?"), F.concat(root, base_path, href))
        .when(href.startswith("#"), F.concat(root, base_path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""), href))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, plain)), tail))
    )


def is_followable(href, skip_mail: bool = True) -> Column:
    """Links worth resolving: no script, no fragment, no mail address."""
    href = _col(href)
    skipped = href.startswith("javascript:") | href.startswith("#")
    if skip_mail:
        skipped = skipped | href.startswith("mailto:")
    return ~skipped


def is_listing_url(url) -> Column:
    return any_match(url, vocab.LISTING_URL_PATTERNS)


def is_media_url(url) -> Column:
    return any_match(url, vocab.MEDIA_URL_PATTERNS)


def without_query(url) -> Column:
    """Scheme, host and path only."""
    return F.concat(scheme(url), F.lit("://"), netloc(url), path(url))


def folder_url(url) -> Column:
    """Scheme, host and path, closed by a slash."""
    bare = without_query(url)
    return F.when(bare.endswith("/"), bare).otherwise(F.concat(bare, F.lit("/")))


def page_url(base, listing_path, page, style: str = "path", param: str = "page", start: int = 1) -> Column:
    """The URL of page ``page`` of a listing, in path or query style."""
    page = _col(page)
    first = resolve(listing_path, base)
    if style == "path":
        stem = F.regexp_replace(_col(listing_path), "/+$", "")
        numbered = resolve(F.concat(stem, F.lit("/page/"), page.cast("string"), F.lit("/")), base)
    else:
        joint = F.when(first.contains("?"), "&").otherwise("?")
        numbered = F.concat(first, joint, F.lit(param + "="), page.cast("string"))
    return F.when(page == start, first).otherwise(numbered)
