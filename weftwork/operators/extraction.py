"""Pages → builds → modifications."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions import pages as P
from weftwork.functions import text, urls
from weftwork.operators import categories
from weftwork.operators.windows import distinct_on


def text_builds(pages: DataFrame, keep: list[str] = ()) -> DataFrame:
    """A build record per page from its head, heading and images alone; ``keep`` carries page columns along."""
    og = P.open_graph("html")
    title = F.coalesce(F.element_at(og, "title"), P.heading("html"))
    return pages.select(
        urls.build_id("url").alias("build_id"), F.col("url").alias("source_url"),
        F.trim(F.substring_index(title, "|", 1)).alias("page_title"), P.description("html").alias("description"),
        P.page_images("html").alias("gallery_images"), F.col("slug") if "slug" in pages.columns else urls.showcase_slug("url").alias("slug"),
        *keep,
    )


def builds(pages: DataFrame, vehicles: DataFrame, constants: dict[str, str] | None = None, keep: list[str] = ()) -> DataFrame:
    """Build records; ``vehicles`` (slug, make, model, package_name) has one row per slug.

    ``constants`` are the fixed columns of a site, such as source type and brand.
    """
    joined = text_builds(pages, keep).join(vehicles, "slug", "left")
    blank = {c: F.coalesce(c, F.lit("")) for c in ("make", "model", "package_name")}
    known = (F.col("make") != "") & (F.col("model") != "")
    out = joined.withColumns(blank).withColumns({
        "build_title": F.when(known, F.concat_ws(" ", "make", "model", "package_name")).otherwise(F.col("page_title")),
        "extraction_confidence": F.when(known, 0.95).otherwise(0.7), "year": F.lit(""),
        **{name: F.lit(value) for name, value in (constants or {}).items()},
    })
    return out.drop("page_title")


def _blocks(html: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(html, F.lit("(?is)" + pattern), F.lit(group))


def _says(text_: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text_.contains(w) for w in words])


def list_items(html) -> Column:
    """Names in list blocks, items of lists inside items too: link text where an item has one."""
    lists = P.nested_elements(urls._col(html), "ul", r"(?is)^<ul\b[^>]*class=[\"'][^\"']*wp-block-list[^\"']*[\"'][^>]*>", outermost=True)
    items = F.flatten(F.transform(lists, lambda ul: P.nested_elements(ul, "li", r"(?is)^<li\b")))
    names = F.transform(items, lambda li: P.strip_tags(F.coalesce(
        F.nullif(F.regexp_extract(li, r"(?is)<a\b[^>]*>(.*?)</a>", 1), F.lit("")), li
    )))
    return F.filter(names, lambda n: (F.length(n) > 3) & ~_says(F.lower(n), vocab.LIST_ITEM_SKIP))


def product_titles(html) -> Column:
    """Product names that speak of performance parts."""
    found = _blocks(urls._col(html), r"<div\b[^>]*class=[\"'][^\"']*wc-block-grid__product-title[^\"']*[\"'][^>]*>(.*?)</div>")
    names = F.transform(found, P.strip_tags)
    return F.filter(names, lambda n: (F.length(n) > 5) & _says(F.lower(n), vocab.PRODUCT_TERMS))


def heading_items(html) -> Column:
    """Capitalised items of the paragraph behind a telling heading."""
    pairs = _blocks(
        urls._col(html),
        r"<h[23]\b[^>]*class=[\"'][^\"']*wp-block-heading[^\"']*[\"'][^>]*>.*?</h[23]>(?:(?!<h[23]\b).)*?<p\b[^>]*>.*?</p>", 0,
    )
    rows = F.transform(pairs, lambda p: F.struct(
        F.lower(P.strip_tags(F.regexp_extract(p, r"(?is)<h[23]\b[^>]*>(.*?)</h[23]>", 1))).alias("head"),
        P.strip_tags(F.regexp_extract(p, r"(?is)<p\b[^>]*>(.*?)</p>", 1)).alias("text"),
    ))
    telling = F.filter(rows, lambda r: ~_says(r["head"], vocab.HEADING_SKIP) & _says(r["head"], vocab.HEADING_TERMS)
                       & _says(F.lower(r["text"]), ["includes", "package"]))
    return F.flatten(F.transform(telling, lambda r: text.capitalised_items(r["text"])))


def mods(pages: DataFrame, default_brand: str = vocab.DEFAULT_BRAND) -> DataFrame:
    """Modification rows of pages with build_id, source_url, make, model, package_name and html.

    Three ways in, each with its own confidence; products of another make are dropped.
    """
    def tagged(names, confidence):
        return F.transform(names, lambda n: F.struct(n.alias("mod_name"), F.lit(confidence).alias("confidence")))

    make, model = F.lower(F.coalesce("make", F.lit(""))), F.lower(F.coalesce("model", F.lit("")))
    own = F.filter(product_titles("html"), lambda n: (make == "") | F.lower(n).contains(make) | F.lower(n).contains(model))
    every = F.concat(tagged(list_items("html"), 0.9), tagged(own, 0.8), tagged(heading_items("html"), 0.7))
    rows = pages.select("build_id", "source_url", "package_name", F.posexplode(every).alias("position", "m"))
    return rows.select(
        "build_id", "source_url", "m.mod_name", categories.brand("m.mod_name", default_brand).alias("brand"),
        categories.pattern_category("m.mod_name").alias("category"), F.lit(True).alias("is_tuner_package"),
        "package_name", "m.confidence", "position",
    )


def dedupe_mods(mods_: DataFrame) -> DataFrame:
    """The first mod of each name per build, names compared without case."""
    keyed = mods_.withColumn("_name", F.lower("mod_name"))
    return distinct_on(keyed, ["build_id", "_name"], ["position"]).drop("_name")
