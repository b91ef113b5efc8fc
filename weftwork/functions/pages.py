"""Page columns: is it a page, is it blocked, what does it link to and say."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions.text import collapse, decode_entities
from weftwork.functions.urls import _col, any_match, is_followable, netloc, resolve

# --- corruption ------------------------------------------------------------


def _non_ascii(text: Column) -> Column:
    count = F.length(F.regexp_replace(text, r"[\x00-\x7F]+", ""))
    return F.when(F.octet_length(text) == F.length(text), 0).otherwise(count)


def _control(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\x00-\x08\x0B\x0C\x0E-\x1F]+", ""))


def text_corruption(html, challenge: bool = True) -> Column:
    """Why a decoded page is not usable; ``valid`` if it is.

    The whole page is measured, not a sample of its first characters.
    """
    html = _col(html)
    start = F.lower(F.regexp_replace(html, r"^\s+", ""))
    proper = start.startswith("<!doctype") | start.startswith("<html") | start.startswith("<?xml")
    body = F.regexp_extract(html, r"(?is)^\s*<html><head></head><body>(.*)$", 1)
    foreign = _non_ascii(body) + F.length(F.regexp_replace(body, r"[^\x00-\x1F]+", ""))
    wrapped = foreign > 0.3 * F.length(body)
    garbage = _control(html) + 0.5 * _non_ascii(html)
    # A page that opens with <html> is proper, so the wrapped form is tested before it.
    out = (
        F.when(F.coalesce(html, F.lit("")) == "", "empty")
        .when((body != "") & wrapped, "binary_wrapped")
        .when(~proper, "missing_doctype")
        .when(garbage > 0.15 * F.length(html), "high_garbage")
    )
    if challenge:
        out = out.when(start.contains("cloudflare") & start.contains("challenge"), "cloudflare_challenge")
    return out.otherwise("valid")


def byte_corruption(content) -> Column:
    """The same test on raw bytes: size, compression marks and encoding come first."""
    content = _col(content)
    size = F.octet_length(content)
    text = F.decode(content, "UTF-8")
    readable = F.is_valid_utf8(content.cast("string"))
    opens = F.lower(F.regexp_replace(text, r"^\s+", "")).startswith("<")
    head = F.hex(F.substring(content, 1, 4))
    return (
        F.when(F.coalesce(size, F.lit(0)) == 0, "empty")
        .when(size < 50, "too_small")
        .when(head.startswith("1F8B"), "gzip_compressed")
        .when(head == "28B52FFD", "zstd_compressed")
        .when(head.startswith("1B") & ~(readable & opens), "brotli_compressed")
        .when(~readable, "binary_data")
        .otherwise(text_corruption(F.when(readable, text)))
    )


# --- error and block pages -------------------------------------------------


def error_labels(html) -> Column:
    """One label per error pattern found, in pattern order; a label can occur twice."""
    html = _col(html)
    return F.array_compact(
        F.array(*[F.when(html.rlike("(?i)" + pattern), F.lit(label)) for pattern, label in vocab.ERROR_PATTERNS])
    )


def is_error_page(labels) -> Column:
    return F.size(_col(labels)) >= vocab.ERROR_PAGE_LABELS


def size_class(size) -> Column:
    size = _col(size)
    return (
        F.when(size == 0, "empty").when(size < vocab.TINY_PAGE_BYTES, "tiny")
        .when(size < vocab.SMALL_PAGE_BYTES, "small").otherwise("normal")
    )


def block_reason(status) -> Column:
    """Reason noted when a response is logged."""
    status = _col(status)
    return F.when(status == 403, "forbidden").when(status == 429, "rate_limit").when(status == 503, "service_unavailable")


def is_blocked(status, body, has_cf_header=None) -> Column:
    """Yes-or-no block test on status, headers and body."""
    status = _col(status)
    header = (has_cf_header if has_cf_header is not None else F.lit(False)) & (status >= 400)
    words = any_match(F.lower(_col(body)), vocab.BLOCK_PHRASES_SHORT, ignore_case=False)
    return F.coalesce(status.isin(403, 429, 503), F.lit(False)) | F.coalesce(header, F.lit(False)) | F.coalesce(words, F.lit(False))


def is_blocked_fetch(status, body) -> Column:
    """Block test of a plain fetch: status first, then the first ten phrases on good answers."""
    status = _col(status)
    words = any_match(F.lower(_col(body)), vocab.BLOCK_PHRASES, ignore_case=False)
    return status.isin(vocab.BLOCK_STATUS_CODES) | ((status < 400) & F.coalesce(words, F.lit(False)))


def cloudflare_headers(headers) -> Column:
    """Known header names present, in fixed order, whatever their case."""
    names = F.transform(F.map_keys(_col(headers)), F.lower)
    return F.filter(F.array(*map(F.lit, vocab.CLOUDFLARE_HEADERS)), lambda h: F.array_contains(names, h))


def block_report(html, status, headers, consecutive_blocks=None) -> Column:
    """Kind of block, what gave it away, and what to do about it.

    Precedence: status code, header, then page text in the order of the checks,
    then a very short error answer.
    """
    status = _col(status)
    lowered = F.lower(F.coalesce(_col(html), F.lit("")))
    size = F.length(lowered)
    cf = F.coalesce(cloudflare_headers(headers), F.array().cast("array<string>"))
    blocks = _col(consecutive_blocks) if consecutive_blocks is not None else F.lit(0)

    found = [(kind, reduce(lambda a, b: a & b, [lowered.contains(p) for p in phrases]), note)
             for kind, phrases, note in vocab.BLOCK_CHECKS]
    by_status = (
        F.when(status == 403, "http_403").when(status == 429, "rate_limit").when(status == 503, "service_unavailable")
        .when(status.isin(vocab.BLOCK_STATUS_CODES), "cloudflare_error")
    )
    by_header = F.when((F.size(cf) > 0) & (status >= 400), "cloudflare")
    by_text = reduce(lambda out, c: out.when(c[1], c[0]), found, F)
    short = (size > 0) & (size < 500) & (status >= 400)
    kind = F.coalesce(by_status, by_header, by_text, F.when(short, "short_response"))

    status_note = (
        F.when(status == 403, "HTTP 403 Forbidden").when(status == 429, "HTTP 429 Too Many Requests")
        .when(status == 503, "HTTP 503 Service Unavailable")
        .when(status.isin(vocab.BLOCK_STATUS_CODES), F.concat(F.lit("Cloudflare error "), status.cast("string")))
    )
    indicators = F.array_compact(F.concat(
        F.array(status_note),
        F.transform(cf, lambda h: F.concat(F.lit("Cloudflare header: "), h)),
        F.array(*[F.when(hit, F.lit(note)) for _, hit, note in found], F.when(short, F.lit("Very short response content"))),
    ))
    advice = reduce(lambda out, item: out.when(kind == item[0], item[1]), vocab.BLOCK_ADVICE.items(), F)
    return F.struct(
        kind.isNotNull().alias("is_blocked"),
        kind.alias("block_type"),
        indicators.alias("indicators"),
        F.when(kind.isNotNull(), advice.otherwise(vocab.BLOCK_ADVICE_DEFAULT)).alias("recommendation"),
        F.coalesce(kind.isin("captcha", "ddos_protection") | ((kind == "cloudflare") & (blocks >= 3)), F.lit(False)).alias("should_stop"),
        F.coalesce(~kind.isin("captcha", "ddos_protection"), F.lit(False)).alias("should_rotate"),
    )


def challenge_state(html) -> Column:
    """Interstitial or turnstile; turnstile wins where both are present."""
    html = _col(html)
    challenge = any_match(html, vocab.CHALLENGE_PATTERNS)
    turnstile = any_match(html, vocab.TURNSTILE_PATTERNS)
    return F.struct(
        challenge.alias("is_challenge"),
        turnstile.alias("is_turnstile"),
        F.when(turnstile, "turnstile").when(challenge, "interstitial").alias("challenge_type"),
    )


# --- pagination ------------------------------------------------------------


def _to_int(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("bigint")


def page_links(html, url) -> Column:
    """Numbered pagination links as (page, url)."""
    html = _col(html)
    hrefs = F.regexp_extract_all(html, F.lit(vocab.PAGE_LINK), F.lit(1))
    return F.transform(
        hrefs,
        lambda href: F.struct(
            F.regexp_extract(href, r"(?i)[?&]page=(\d+)", 1).try_cast("bigint").alias("page"),
            resolve(href, url).alias("url"),
        ),
    )


def pagination(html, url) -> Column:
    """Kind of pagination, page and item totals, next page, links and what was seen."""
    html = _col(html)
    page_of = r"(?i)page\s+(\d+)\s+of\s+(\d+)"
    this_page, last_page = (F.regexp_extract(html, page_of, i) for i in (1, 2))
    items = _to_int(F.regexp_extract(html, r"(?i)showing\s+[\d,]+[-\s]+[\d,]+\s+of\s+([\d,]+)", 1))
    next_href = F.coalesce(
        *[F.nullif(F.regexp_extract(html, "(?i)" + p, 1), F.lit("")) for p in vocab.NEXT_LINK_PATTERNS]
    )
    links = page_links(html, url)
    max_page = F.array_max(F.transform(links, lambda x: x["page"]))
    numeric = (last_page != "") | (F.size(links) > 0)
    scroll = reduce(lambda out, p: out.when(html.rlike("(?i)" + p), F.lit(p)), vocab.INFINITE_SCROLL_PATTERNS, F)
    button = any_match(html, vocab.LOAD_MORE_PATTERNS)
    return F.struct(
        F.when(scroll.isNotNull(), "infinite_scroll").when(numeric, "numeric").when(button, "load_more")
        .otherwise("unknown").alias("pagination_type"),
        F.greatest(_to_int(last_page), max_page).alias("total_pages"),
        items.alias("total_items"),
        F.when(next_href.isNotNull(), resolve(next_href, url)).alias("next_page_url"),
        links.alias("page_links"),
        F.array_compact(F.array(
            F.when(last_page != "", F.concat(F.lit("Found 'Page "), this_page, F.lit(" of "), last_page, F.lit("'"))),
            F.when(items.isNotNull(), F.concat(F.lit("Found total count: "), items.cast("string"), F.lit(" items"))),
            F.when(next_href.isNotNull(), F.lit("Found next page link")),
            F.when(scroll.isNotNull(), F.concat(F.lit("Found infinite scroll indicator: "), scroll)),
            F.when(button, F.lit("Found load more button")),
        )).alias("indicators"),
    )


def has_next_page(html) -> Column:
    return any_match(html, vocab.NEXT_PAGE_PATTERNS)


def total_pages(html) -> Column:
    """Highest number in the pagination block, else in any page link; 1 without either."""
    html = _col(html)
    block = F.regexp_extract(html, r"(?is)<div[^>]*class=[\"'][^\"']*pagination[^\"']*[\"'][^>]*>(.*?)</div>", 1)
    numbers = F.transform(
        F.regexp_extract_all(block, F.lit(r"(?is)<a[^>]*>\s*(\d+)\s*</a>"), F.lit(1)), lambda n: n.try_cast("bigint")
    )
    linked = F.transform(
        F.regexp_extract_all(html, F.lit(r"(?i)href=[\"'][^\"']*[?&]page=(\d+)"), F.lit(1)), lambda n: n.try_cast("bigint")
    )
    return F.coalesce(F.array_max(numbers), F.array_max(linked), F.lit(1).cast("bigint"))


# --- links -----------------------------------------------------------------


def hrefs(html) -> Column:
    return F.regexp_extract_all(_col(html), F.lit(r"(?i)href=[\"']([^\"']+)[\"']"), F.lit(1))


def internal_links(html, base, skip_mail: bool = True) -> Column:
    """Resolved links that stay on the page's host, in page order."""
    base = _col(base)
    kept = F.filter(hrefs(html), lambda h: is_followable(h, skip_mail))
    return F.filter(F.transform(kept, lambda h: resolve(h, base)), lambda u: netloc(u) == netloc(base))


def _attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*[\"']([^\"']*)[\"']", 1)


def strip_tags(fragment: Column) -> Column:
    return collapse(decode_entities(F.regexp_replace(fragment, r"(?s)<[^>]*>", " ")))


def links(html, base=None) -> Column:
    """Anchors as (href, text, title, is_internal)."""
    anchors = F.regexp_extract_all(_col(html), F.lit(r"(?is)<a\b[^>]*\bhref\s*=\s*[\"'][^\"']+[\"'][^>]*>.*?</a>"), F.lit(0))

    def row(anchor):
        opening = F.regexp_extract(anchor, r"(?is)^<a\b[^>]*>", 0)
        href = _attribute(opening, "href")
        if base is not None:
            href = resolve(href, base)
        return F.struct(
            href.alias("href"),
            strip_tags(anchor).alias("text"),
            _attribute(opening, "title").alias("title"),
            (netloc(href) == netloc(base) if base is not None else F.lit(None).cast("boolean")).alias("is_internal"),
        )

    return F.transform(anchors, row)


def links_in_family(html, base, patterns: list[str], keep_query: bool = True, skip: list[str] | None = None) -> Column:
    """Distinct item links of one family on the page's host; ``skip`` drops non-content paths."""
    base = _col(base)
    found = F.flatten(F.array(*[
        F.regexp_extract_all(_col(html), F.lit("(?i)" + p), F.lit(1)) for p in patterns
    ]))
    absolute = F.filter(F.transform(found, lambda h: resolve(h, base)), lambda u: netloc(u) == netloc(base))
    end = r"#.*$" if keep_query else r"[?#].*$"
    cleaned = F.transform(absolute, lambda u: F.regexp_replace(u, end, ""))
    if skip:
        cleaned = F.filter(cleaned, lambda u: reduce(lambda a, b: a & b, [~F.lower(u).contains(s) for s in skip]))
    return F.array_distinct(cleaned)


# --- head and content ------------------------------------------------------


def title(html) -> Column:
    return F.nullif(strip_tags(F.regexp_extract(_col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def heading(html) -> Column:
    """Text of the first ``h1``, empty without one."""
    return strip_tags(F.regexp_extract(_col(html), r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))


def _meta_tags(html: Column, key: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<meta\b[^>]*\b{key}\s*=[^>]*>"), F.lit(0))


def description(html) -> Column:
    tags = F.filter(_meta_tags(_col(html), "name"), lambda t: F.lower(_attribute(t, "name")) == "description")
    return F.coalesce(decode_entities(_attribute(F.get(tags, F.lit(0)), "content")), F.lit(""))


def canonical_link(html) -> Column:
    tags = F.regexp_extract_all(_col(html), F.lit(r"(?is)<link\b[^>]*>"), F.lit(0))
    canonical = F.filter(tags, lambda t: F.lower(_attribute(t, "rel")) == "canonical")
    return F.coalesce(_attribute(F.get(canonical, F.lit(0)), "href"), F.lit(""))


def open_graph(html) -> Column:
    """``og:`` properties as a map; the last of repeated properties wins."""
    tags = F.filter(_meta_tags(_col(html), "property"), lambda t: _attribute(t, "property").startswith("og:"))
    pairs = F.transform(tags, lambda t: F.struct(
        F.regexp_replace(_attribute(t, "property"), "^og:", "").alias("key"),
        decode_entities(_attribute(t, "content")).alias("value"),
    ))
    pairs = F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != ""))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    last = F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"])
    return F.map_from_arrays(keys, last)


def json_ld(html) -> Column:
    """The first JSON-LD block as text; null where it is missing or not JSON."""
    block = F.regexp_extract(
        _col(html), r"(?is)<script\b[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>", 1
    )
    block = F.trim(block)
    return F.when(F.try_parse_json(block).isNotNull(), block)


def gallery_images(html) -> Column:
    """Images of gallery blocks, then of image blocks; absolute addresses, each once."""
    tags = F.regexp_extract_all(_col(html), F.lit(r"(?is)<(?:/?(?:figure|div|ul)\b|img\b)[^>]*>"), F.lit(0))

    def sources(images):
        src = F.transform(images, lambda t: F.coalesce(
            F.nullif(F.regexp_extract(t, r"(?is)\ssrc\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit("")),
            _attribute(t, "data-src"),
        ))
        return F.filter(src, lambda s: s.startswith("http"))

    return F.array_distinct(F.concat(
        sources(_images_inside(tags, r"(?is)^<(?:figure|div|ul)\b[^>]*wp-block-gallery")),
        sources(_images_inside(tags, r"(?is)^<(?:figure|div)\b[^>]*wp-block-image")),
    ))


def _images_inside(tags: Column, opening: str) -> Column:
    """The ``img`` tags inside elements whose opening tag matches, however deep; an element without an end reaches to the last tag.

    One fold over the tags of a page. Only tags of the opened element's own name count for its depth.
    """
    name = lambda t: F.lower(F.regexp_extract(t, r"^</?(\w+)", 1))
    start = F.struct(F.lit("").alias("name"), F.lit(0).alias("depth"), F.array().cast("array<string>").alias("found"))

    def state(name_, depth, found):
        return F.struct(name_.alias("name"), depth.alias("depth"), found.alias("found"))

    def step(s, t):
        inside = s["depth"] > 0
        change = F.when(t.startswith("</"), -1).otherwise(1)
        return (
            F.when(~inside & t.rlike(opening), state(name(t), F.lit(1), s["found"]))
            .when(inside & (name(t) == "img"), state(s["name"], s["depth"], F.concat(s["found"], F.array(t))))
            .when(inside & (name(t) == s["name"]), state(s["name"], s["depth"] + change, s["found"]))
            .otherwise(s)
        )

    return F.aggregate(tags, start, step, lambda s: s["found"])


_CHUNK = 256


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def nested_elements(html: Column, tag: str, opening: str, outermost: bool = False) -> Column:
    """Elements named ``tag`` whose opening tag matches, whole, those inside others too; ``outermost``: only those inside no other match.

    An element without an end reaches to the end of the text; an end without a beginning counts for nothing. One pass with
    the stack of open matches: a tag that opens or closes none of them leaves the state as it is, and what is found is
    kept in chunks, so that the work grows with the page.
    """
    event = "struct<i:int,d:int>"
    span = "struct<i:int,e:int>"
    pieces = F.split(html, rf"(?i)(?=</?{tag}\b)")

    def events(ps):
        change = lambda p: F.when(p.rlike(rf"(?i)^<{tag}\b"), 1).when(p.rlike(rf"(?i)^</{tag}\b"), -1).otherwise(0)
        every = F.transform(ps, lambda p, i: F.struct(i.alias("i"), change(p).alias("c"), p.rlike(opening).alias("m")))
        return F.filter(every, lambda t: t["c"] != 0)

    start = F.struct(
        F.lit(0).alias("depth"), F.array().cast(f"array<{event}>").alias("open"), F.array().cast(f"array<{span}>").alias("new"), F.array().cast(f"array<array<{span}>>").alias("done"),
    )

    def state(depth, open_, new, done):
        return F.struct(depth.alias("depth"), open_.alias("open"), new.alias("new"), done.alias("done"))

    def step(s, t):
        depth = F.greatest(s["depth"] + t["c"], F.lit(0))
        top = F.try_element_at(s["open"], F.lit(-1))
        opens = (t["c"] == 1) & t["m"] & ((F.size(s["open"]) == 0) if outermost else F.lit(True))
        closes = F.coalesce((t["c"] == -1) & (top["d"] > depth), F.lit(False))
        found = F.array(F.struct(top["i"].alias("i"), t["i"].alias("e")))
        full = F.size(s["new"]) >= _CHUNK
        return (
            F.when(opens, state(depth, F.concat(s["open"], F.array(F.struct(t["i"].alias("i"), depth.alias("d")))), s["new"], s["done"]))
            .when(closes & full, state(depth, F.slice(s["open"], 1, F.size(s["open"]) - 1), found, F.concat(s["done"], F.array(s["new"]))))
            .when(closes, state(depth, F.slice(s["open"], 1, F.size(s["open"]) - 1), F.concat(s["new"], found), s["done"]))
            .otherwise(state(depth, s["open"], s["new"], s["done"]))
        )

    def spans(ps):
        endless = lambda s: F.transform(s["open"], lambda o: F.struct(o["i"].alias("i"), F.size(ps).alias("e")))
        return F.aggregate(events(ps), start, step, lambda s: F.array_sort(F.concat(F.flatten(s["done"]), s["new"], endless(s))))

    return _bound(pieces, lambda ps: F.transform(spans(ps), lambda s: F.array_join(F.transform(F.sequence(s["i"], s["e"] - 1), lambda k: F.get(ps, k)), "")))


def page_images(html) -> Column:
    """The social image first, then the gallery, each once."""
    social = F.element_at(open_graph(html), "image")
    gallery = gallery_images(html)
    return F.array_distinct(F.concat(F.when(social.isNotNull() & ~F.array_contains(gallery, social), F.array(social)).otherwise(F.array().cast("array<string>")), gallery))


def tables(html) -> Column:
    """Tables as arrays of (headers, rows of cell texts)."""
    found = F.regexp_extract_all(_col(html), F.lit(r"(?is)<table\b[^>]*>(.*?)</table>"), F.lit(1))

    def cells(row, tags):
        raw = F.regexp_extract_all(row, F.lit(rf"(?is)<(?:{tags})\b[^>]*>(.*?)</(?:{tags})>"), F.lit(1))
        return F.transform(raw, strip_tags)

    def one(table):
        rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
        body = F.filter(F.transform(F.slice(rows, 2, F.size(rows)), lambda r: cells(r, "td")), lambda r: F.size(r) > 0)
        return F.struct(
            F.coalesce(cells(F.get(rows, F.lit(0)), "th|td"), F.array().cast("array<string>")).alias("headers"),
            body.alias("rows"),
        )

    return F.transform(found, one)


def lot_attributes(html) -> Column:
    """Lot number, price and status from data attributes; null where missing."""
    return F.struct(*[
        F.nullif(F.regexp_extract(_col(html), pattern, 1), F.lit("")).alias(key)
        for key, pattern in vocab.LOT_ATTRIBUTES.items()
    ])


def body_stats(body) -> Column:
    """Size in bytes and whether the body is large enough to be stored compressed."""
    size = F.coalesce(F.octet_length(_col(body)), F.lit(0))
    return F.struct(size.alias("size"), (size >= vocab.BODY_COMPRESS_BYTES).alias("compressed"))
