"""Known answers: queues, batches, categories, extraction."""

import pytest
from pyspark.sql import functions as F

from weftwork.functions import pages as P
from weftwork.operators import aggregates, categories, extraction, filters, ordering, scan, similar, windows

SOURCES = [
    ("s1", "Site 1", "pending", 1, 10, 0, 0, 0, None, None), ("s2", "Site 2", "in_progress", 2, 20, 5, 0, 0, None, None),
    ("s3", "Site 3", "blocked", 3, 30, 0, 0, 30, None, None), ("s4", "Site 4", "completed", 4, 40, 40, 0, 0, 40, 40),
]


@pytest.fixture(scope="module")
def sources(spark):
    return spark.createDataFrame(SOURCES, "source string, name string, status string, priority int, urls_found bigint, html_scraped bigint, html_failed bigint, html_blocked bigint, builds bigint, mods bigint")


def test_source_summary(sources):
    row = aggregates.source_summary(sources).first()
    assert (row.total_sources, row.pending, row.in_progress, row.blocked, row.completed) == (4, 1, 1, 1, 1)
    assert (row.total_urls_found, row.total_html_scraped, row.total_builds, row.total_mods) == (100, 45, 40, 40)


def test_next_source(sources):
    assert ordering.next_source(sources).first().source == "s1"
    assert ordering.next_source(sources, ["completed"]).first().source == "s4"
    assert ordering.next_source(sources, ["skip"]).first() is None
    assert ordering.next_in_file_order(sources, "source").first().source == "s2"


@pytest.mark.parametrize("n, sizes", [(25, [10, 10, 5]), (5, [5]), (0, [])])
def test_batches(spark, n, sizes):
    out = windows.batches(spark.range(n), ["id"], 10).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in out] == sizes


def test_needs_work(sources):
    assert {r.source for r in sources.where(filters.needs_work()).collect()} == {"s1", "s2", "s3"}


# A small part of a component taxonomy and keyword dictionary, enough for the cases below.
COMPONENTS = {
    "Suspension": ["Control Arm"], "Transmission-Manual": ["Input Shaft Repair Sleeve", "Clutch Kit"], "Interior": ["Window Regulator"],
    "Brake & Wheel Hub": ["Brake Pad"], "Cooling System": ["Radiator"], "Engine": ["Camshaft"], "Fuel & Air": ["Air Filter"],
}
KEYWORDS = {
    "Forced Induction": ["turbo", "turbocharger", "intercooler", "hks turbo", "garrett turbo"],
    "Oil": ["motor oil", "engine oil", "motul", "300v"], "Wheel": ["wheels", "work wheels"], "Safety": ["racing harness", "sparco harness"],
    "Lighting": ["light bar", "rigid"], "Storage": ["roof rack", "prinsu rack"], "Recovery": ["winch", "warn winch"], "Armor/Protection": ["rock slider", "armor"],
    "Suspension": ["coilover", "coilovers", "springs", "shocks", "sway bar", "suspension"], "Fuel & Air": ["intake", "air filter", "cold air intake", "intake system"],
    "Brake & Wheel Hub": ["brake", "caliper", "big brake kit", "rotor"], "Engine": ["engine", "cam", "cams", "tomei"], "Exhaust & Emission": ["exhaust", "borla"],
    "Interior": ["seat", "recaro"], "Transmission-Manual": ["clutch", "clutch kit"], "Cooling System": ["radiator", "mishimoto radiator"],
    "Body & Lamp Assembly": ["bumper", "front bumper", "arb front"], "Electrical": ["harness"],
}
CASES = [
    ("Control Arm", "Suspension"), ("Input Shaft Repair Sleeve", "Transmission-Manual"), ("Window Regulator", "Interior"), ("Brake Pad", "Brake & Wheel Hub"),
    ("Radiator", "Cooling System"), ("KW Coilovers", "Suspension"), ("Bilstein Shocks", "Suspension"), ("Eibach Springs", "Suspension"), ("Brembo Calipers", "Brake & Wheel Hub"),
    ("Borla Exhaust", "Exhaust & Emission"), ("K&N Air Filter", "Fuel & Air"), ("HKS Turbo Kit", "Forced Induction"), ("Garrett GT3076R Turbo", "Forced Induction"),
    ("ACT Clutch Kit", "Transmission-Manual"), ("Mishimoto Radiator", "Cooling System"), ("Work Wheels", "Wheel"), ("Recaro Seats", "Interior"), ("Sparco Harness", "Safety"),
    ("Trust/GReddy Intercooler", "Forced Induction"), ("Tomei Cams", "Engine"), ("Cusco Sway Bar", "Suspension"), ("Tein Coilovers", "Suspension"),
    ("ARB Front Bumper", "Body & Lamp Assembly"), ("Icon Stage 7 Suspension", "Suspension"), ("Rigid Light Bar", "Lighting"), ("Warn Winch", "Recovery"),
    ("CBI Rock Sliders", "Armor/Protection"), ("Prinsu Roof Rack", "Storage"), ("BC Racing BR Series Coilovers", "Suspension"), ("Injen Cold Air Intake System", "Fuel & Air"),
    ("StopTech Big Brake Kit", "Brake & Wheel Hub"), ("Motul 300V Racing Oil", "Oil"),
]


def dictionary(spark, words, name):
    rows = [(w, c, i * 1000 + j) for i, (c, ws) in enumerate(words.items()) for j, w in enumerate(ws)]
    return spark.createDataFrame(rows, f"{name} string, category string, position bigint")


@pytest.fixture(scope="module")
def detected(spark):
    names = spark.createDataFrame([(n,) for n, _ in CASES] + [("",), ("qqq zzz",)], "name string")
    found = categories.detect(names, "name", dictionary(spark, COMPONENTS, "component"), dictionary(spark, KEYWORDS, "keyword"))
    return {r.name: (r.category, r.confidence) for r in found.collect()}


@pytest.mark.parametrize("name, expected", CASES)
def test_category_golden(detected, name, expected):
    assert detected[name][0] == expected


def test_category_edges(detected):
    assert detected["Control Arm"][1] == 1.0
    assert detected[""] == ("Other", 0.0)
    assert detected["qqq zzz"] == ("Other", 0.0)


def test_detect_batch_keeps_every_row(spark):
    names = spark.createDataFrame([("Brake Pad",)] * 3 + [("Radiator",), (None,)], "name string")
    out = categories.detect_batch(names, "name", dictionary(spark, COMPONENTS, "component"), dictionary(spark, KEYWORDS, "keyword"))
    assert out.count() == 5 and out.where("category is null").count() == 0


PAGE = """<!DOCTYPE html><html><head><meta property="og:title" content="BMW M3 | Shop"><meta name="description" content="Fast."></head><body><h1>M3</h1>
<ul class="wp-block-list"><li><a href="/a">Milltek cat back exhaust</a></li><li>KW coilovers</li><li>abc</li><li>Visit us</li></ul>
<div class="wc-block-grid__product-title">BMW M3 Exhaust valve</div><div class="wc-block-grid__product-title">Audi S3 intake pipe</div>
<h2 class="wp-block-heading">Carbon parts</h2><p>This package includes, Carbon wing, Carbon Hood, nothing.</p></body></html>"""


def test_extraction(spark):
    pages = spark.createDataFrame([("https://x.com/showcase/bmw-m3/", PAGE)], "url string, html string")
    vehicles = spark.createDataFrame([("bmw-m3", "BMW", "M3", "WAVE")], "slug string, make string, model string, package_name string")
    from weftwork.plans.jobs import extract

    builds, mods = extract(pages, vehicles, {"source_type": "showcase"})
    build = builds.first()
    assert (build.build_title, build.extraction_confidence, build.description, build.source_type) == ("BMW M3 WAVE", 0.95, "Fast.", "showcase")
    rows = {(r.mod_name, r.brand, r.category, r.confidence) for r in mods.collect()}
    default = "Paramount Performance"
    assert rows == {
        ("Milltek cat back exhaust", "Milltek", "Exhaust", 0.9), ("KW coilovers", "KW", "Suspension", 0.9), ("BMW M3 Exhaust valve", default, "Exhaust", 0.8),
        ("This package includes", default, "Other", 0.7), ("Carbon wing", default, "Exterior", 0.7), ("Carbon Hood", default, "Exterior", 0.7),
    }
    assert extraction.dedupe_mods(mods).count() == mods.count()


def test_component_similarity_is_gestalt():
    assert similar.gestalt_ratio("abcd", "bcde") == 0.75


def test_bounded_samples(spark):
    df = spark.createDataFrame([("a", str(i % 7)) for i in range(50)] + [("b", "x")], "k string, v string")
    rows = {r.k: (r["count"], r.samples) for r in scan.bounded_samples(df, ["k"], "v", 3).collect()}
    assert rows == {"a": (50, ["0", "1", "2"]), "b": (1, ["x"])}


def test_first_row_and_profile(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 2, "y"), (2, 9, "z")], "k int, o int, v string")
    assert {tuple(r) for r in scan.first_row(df, ["k"], ["o"]).collect()} == {(1, 2, "y"), (2, 9, "z")}
    profile = {r.column_name: r for r in aggregates.profile(df, exact=True).collect()}
    assert profile["o"].max == "9" and profile["v"].distinct_count == 3
    assert df.select(F.count("k")).first()[0] == 3


def test_nested_markup(spark):
    gallery = '<div class="wp-block-gallery"><div><img src="http://a/1.jpg"></div><div><div><img data-src="http://a/2.jpg"></div></div></div><div><img src="http://a/no.jpg"></div><figure class="wp-block-image"><figure><img src="http://a/3.jpg"></figure></figure>'
    items = '<ul class="wp-block-list"><li>Outer kit<ul><li>Inner one</li><li>Inner two</li></ul></li><li><a href="x">Next item</a></li></ul><ul><li>Not this</li></ul><ul class="x wp-block-list"><li>Last item<li>Never ended'
    df = spark.createDataFrame([(1, gallery, items), (2, None, None), (3, "", "</ul></li>")], "id int, g string, l string")
    out = {r.id: r for r in df.select("id", P.gallery_images("g").alias("images"), extraction.list_items("l").alias("items")).collect()}
    assert out[1].images == ["http://a/1.jpg", "http://a/2.jpg", "http://a/3.jpg"]
    assert out[1]["items"] == ["Outer kit Inner one Inner two", "Inner one", "Inner two", "Next item", "Last item Never ended", "Never ended"]
    assert out[2].images is None and out[2]["items"] is None
    assert out[3].images == [] and out[3]["items"] == []
