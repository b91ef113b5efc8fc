"""Column functions on hand-picked values."""

import datetime
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from weftwork.functions import buckets, pages, records, text, urls
from weftwork.functions import pages as page_functions


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("given, expected", [
    ("HTTPS://Example.COM/Page#section", "https://example.com/Page"),
    ("https://www.example.com/a/b/", "https://example.com/a/b"),
    ("https://example.com", "https://example.com/"),
    ("https://example.com/p?utm_source=x&b=2&a=1&fbclid=9", "https://example.com/p?a=1&b=2"),
    ("https://example.com/p?b=2&a=1&b=1", "https://example.com/p?a=1&b=2&b=1"),
    ("https://example.com/p?q=a+b%20c&empty=", "https://example.com/p?empty=&q=a+b+c"),
    ("https://example.com/p;v=1?x=~*", "https://example.com/p?x=~%2A"),
    ("//cdn.example.com/x", "https://cdn.example.com/x"),
    ("", ""),
])
def test_canonical_url(spark, given, expected):
    assert one(spark, urls.canonical_url(F.lit(given))) == expected


def test_light_url_keeps_order_and_www(spark):
    given = "HTTP://WWW.Example.com/P/?z=1&utm_term=q&msclkid=4&a=2#f"
    assert one(spark, urls.light_url(F.lit(given))) == "http://www.example.com/P/?z=1&msclkid=4&a=2"


def test_build_id_golden(spark):
    url = "https://paramount-performance.com/showcase/bmw-m3-upgrades/"
    assert one(spark, urls.build_id(F.lit(url))) == 5490744721174123338
    assert one(spark, urls.build_id(F.lit(f"  {url} "))) == 5490744721174123338


@pytest.mark.parametrize("url, expected", [
    ("https://shop.example.co.uk/x", "example.co.uk"), ("https://a.b.example.com/x", "example.com"), ("https://example.com", "example.com"),
])
def test_registered_domain(spark, url, expected):
    assert one(spark, urls.registered_domain(F.lit(url))) == expected


@pytest.mark.parametrize("href, expected", [
    ("/a", "https://h.com/a"), ("b", "https://h.com/x/b"), ("../b", "https://h.com/b"), ("../../../b", "https://h.com/b"), ("./b/./c", "https://h.com/x/b/c"),
    ("//o.com/z", "https://o.com/z"), ("https://o.com/z", "https://o.com/z"), ("?q=1", "https://h.com/x/y?q=1"), ("", "https://h.com/x/y?p=1"),
])
def test_resolve(spark, href, expected):
    assert one(spark, urls.resolve(F.lit(href), F.lit("https://h.com/x/y?p=1"))) == expected


def test_showcase_item(spark):
    row = one(spark, urls.showcase_item(F.lit("https://f.com/showcase/my-car.1234/?x=1")))
    assert row["item_id"] == "1234" and row["url"] == "https://f.com/showcase/my-car.1234/"


def test_page_urls(spark):
    base, path = F.lit("https://h.com"), F.lit("/list/?a=1")
    assert one(spark, urls.page_url(base, path, F.lit(3), "query")) == "https://h.com/list/?a=1&page=3"
    assert one(spark, urls.page_url(base, F.lit("/list/"), F.lit(3))) == "https://h.com/list/page/3/"


def test_find_urls_keeps_the_last_character(spark):
    assert one(spark, text.find_urls(F.lit("see https://a.com/b and https://a.com/b."))) == ["https://a.com/b", "https://a.com/b."]


def test_redaction_and_headers(spark):
    assert one(spark, text.redact(F.lit("Authorization: Bearer abc"))) == "authorization: bearer [REDACTED]"
    headers = F.create_map(F.lit("X-Api-Key"), F.lit("1"), F.lit("Accept"), F.lit("2"))
    assert one(spark, text.redact_headers(headers)) == {"X-Api-Key": "[REDACTED]", "Accept": "2"}


@pytest.mark.parametrize("value, expected", [("N/A", True), ("12-3", True), ("ab", True), (None, True), ("Lorem ipsum", True), ("a lorem ipsum", False), ("Ford", False), ("Škoda", False)])
def test_garbage(spark, value, expected):
    assert one(spark, text.is_garbage(F.lit(value).cast("string"))) is expected


@pytest.mark.parametrize("name, expected", [("KW Coilovers", "coilovers"), ("HKS Turbo Kit", "turbo"), ("BC Racing BR Series Coilovers", "br coilovers")])
def test_normalize_name(spark, name, expected):
    assert one(spark, text.normalize_name(F.lit(name))) == expected


def test_verdicts(spark):
    assert one(spark, text.verdict(F.lit(" pass: ok")))["confidence"] == 0.9
    failed = one(spark, text.verdict(F.lit("FAIL: no button")))
    assert (failed["passed"], failed["reasoning"]) == (False, "no button")
    assert one(spark, text.verdict(F.lit("Yes, visible")))["passed"] is True


def test_visible_text(spark):
    html = "<html><head><title>t</title></head><body><script>x</script><p>a &amp; b</p><!-- c --><div>d</div></body></html>"
    assert one(spark, text.visible_text(F.lit(html))) == "a & b d"
    assert one(spark, text.visible_text(F.lit(html), preserve_structure=True)) == "a & b \n d".replace(" \n ", "\n")
    parsed = spark.createDataFrame([(html,)], "html string").select(text.visible_text_parsed()("html").alias("x")).first()[0]
    assert parsed == "a & b d"


@pytest.mark.parametrize("content, expected", [
    (b"", "empty"), (b"<p>", "too_small"), (bytes([0x1F, 0x8B]) + b"x" * 60, "gzip_compressed"), (bytes([0x28, 0xB5, 0x2F, 0xFD]) + b"x" * 60, "zstd_compressed"),
    (bytes([0x1B]) + b"x" * 60, "brotli_compressed"), (bytes([0xC3, 0x28]) + b"x" * 60, "binary_data"), (b"x" * 60, "missing_doctype"),
    (b"  <!DOCTYPE html>" + b"x" * 60, "valid"), ("<html>".encode() + "é".encode() * 60, "high_garbage"),
    ("<html><head></head><body>".encode() + "é".encode() * 60, "binary_wrapped"), (b"<html> Cloudflare challenge" + b" " * 60, "cloudflare_challenge"),
])
def test_byte_corruption(spark, content, expected):
    df = spark.createDataFrame([(bytearray(content),)], "c binary")
    assert df.select(pages.byte_corruption("c")).first()[0] == expected


def test_block_precedence(spark):
    def report(html, status, headers=None):
        cols = [x for k, v in (headers or {"a": "b"}).items() for x in (F.lit(k), F.lit(v))]
        return one(spark, pages.block_report(F.lit(html), F.lit(status), F.create_map(*cols), F.lit(4)))

    assert report("captcha", 403)["block_type"] == "http_403"
    assert report("captcha", 500, {"CF-Ray": "1"})["block_type"] == "cloudflare"
    found = report("cloudflare challenge captcha", 200)
    assert (found["block_type"], found["should_stop"]) == ("cloudflare", True)
    assert report("tiny", 404)["block_type"] == "short_response"
    assert report("fine", 200)["is_blocked"] is False


def test_tables_and_links(spark):
    html = "<table><tr><th>A</th></tr><tr><td>1</td></tr></table><a class='n' href='/x' title='T'>go <b>on</b></a>"
    table = one(spark, pages.tables(F.lit(html)))[0]
    assert table["headers"] == ["A"] and table["rows"] == [["1"]]
    link = one(spark, pages.links(F.lit(html), F.lit("https://h.com/")))[0]
    assert (link["href"], link["text"], link["title"], link["is_internal"]) == ("https://h.com/x", "go on", "T", True)


@pytest.mark.parametrize("n, expected", [(0, "Stock"), (1, "Stock"), (5, "Lightly Modified"), (15, "Moderately Modified"), (16, "Heavily Modified")])
def test_mod_level(spark, n, expected):
    assert one(spark, buckets.mod_level(F.lit(n))) == expected


@pytest.mark.parametrize("run, expected", [(0, 300), (1, 600), (2, 1200), (3, 1800), (60, 1800)])
def test_backoff(spark, run, expected):
    assert one(spark, buckets.backoff_seconds(F.lit(run))) == expected


def test_times(spark):
    assert one(spark, buckets.parse_time(F.lit("2024-01-01T10:00:00Z"))) == datetime.datetime(2024, 1, 1, 10)
    assert one(spark, buckets.parse_time(F.lit("junk"))) is None


def test_record_rules(spark):
    from weftwork import schemas

    good = {"build_id": 1, "source_type": "gallery", "build_type": "Track", "build_source": "s", "source_url": "https://a", "year": "2001", "make": "BMW", "model": "M3"}
    bad = {**good, "source_type": "showcase", "year": "01", "vin": "x", "extraction_confidence": 1.5, "modifications": [{"name": "a"}], "modification_level": "Heavily Modified"}
    df = spark.createDataFrame([good, bad], schemas.BUILD)
    rows = [r[0] for r in df.select(records.record_issues()).collect()]
    assert rows[0] == []
    assert [(i["field"], i["severity"]) for i in rows[1]] == [
        ("source_type", "error"), ("year", "error"), ("vin", "warning"), ("extraction_confidence", "error"), ("modification_level", "info"), ("modifications[0]", "error"),
    ]


def test_assertions(spark):
    doc = F.lit('{"urls": [1, 2, 3], "n": 5}')
    assert one(spark, records.assertion(doc, "count_eq", 3, "$.urls")) is True
    assert one(spark, records.assertion(doc, "count_gte", 6, "$.n")) is False
    assert one(spark, records.assertion(F.lit(None).cast("string"), "exists")) is False
    with pytest.raises(ValueError):
        records.assertion(doc, "nonsense")


def _plain_elements(html, tag, opening, outermost):
    """The same by looking for each element's end on its own."""
    pieces = [p for p in re.split(rf"(?i)(?=</?{tag}\b)", html)]
    depth, depths = 0, []
    for p in pieces:
        depth = max(0, depth + (1 if re.match(rf"(?i)<{tag}\b", p) else -1 if re.match(rf"(?i)</{tag}\b", p) else 0))
        depths.append(depth)
    spans = []
    for i, p in enumerate(pieces):
        if re.match(opening, p):
            spans.append((i, next((j for j in range(i + 1, len(pieces)) if depths[j] < depths[i]), len(pieces))))
    if outermost:
        spans = [s for s in spans if not any(o[0] < s[0] and o[1] > s[0] for o in spans)]
    return ["".join(pieces[a:b]) for a, b in spans]


@pytest.mark.parametrize("outermost", [False, True])
def test_nested_elements_against_plain_python(spark, outermost):
    rng = random.Random(3)
    bits = ["<div>", '<div class="x">', "</div>", "</div>", "<p>", "t", "<DIV class=\"x\" id=1>", "</Div>"]
    pages = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 40))) for _ in range(60)] + ['<div class="x">' * 600 + "</div>" * 300, ""]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    opening = '(?i)^<div class="x"'
    got = {r.i: r.e for r in df.select("i", page_functions.nested_elements(F.col("html"), "div", opening, outermost).alias("e")).collect()}
    assert got == {i: _plain_elements(h, "div", '(?i)<div class="x"', outermost) for i, h in enumerate(pages)}


def test_nested_elements_of_a_huge_page(spark):
    html = '<div class="x">a</div><div><b>' * 5_000 + "</div>" * 5_000
    df = spark.createDataFrame([(html,)], "html string")
    start = time.time()
    assert df.select(F.size(page_functions.nested_elements(F.col("html"), "div", '(?i)^<div class="x"'))).first()[0] == 5_000
    assert time.time() - start < 60
