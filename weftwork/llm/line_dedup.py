"""Line deduplication by distinct-site spread: lines that stand on many sites are boilerplate, long ones on fewer.

Each line hash gets a HyperLogLog sketch of the sites it stands on; Spark merges the sketches of all tasks. Estimates
clearly over or under the threshold decide; lines near it get an exact distinct count. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import document_key, same_document, small, stored

LG_K = 12
MARGIN = 0.08
BROADCAST_LINES = 1_000_000
LONG_WORDS = 50


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(line):
    return F.xxhash64(F.trim(line)), F.crc32(F.trim(line).cast("binary"))


def _marks(places: str):
    """True at the places (from 0) of a sorted array, false before and between them."""
    gap = lambda at, i: F.array_repeat(F.lit(False), at - F.coalesce(F.get(places, i - 1), F.lit(-1)) - 1)
    return F.flatten(F.transform(places, lambda at, i: F.concat(gap(at, i), F.array(F.lit(True)))))


def _needed(line, min_sites: int, long_sites: int | None):
    """The sites that a line must stand on."""
    if long_sites is None:
        return F.lit(min_sites)
    long = (F.length(line) > 2 * LONG_WORDS) & (F.size(F.split(F.trim(line), r"\s+")) > LONG_WORDS)
    return F.when(long, F.least(F.lit(long_sites), F.lit(min_sites))).otherwise(min_sites)


def boilerplate(docs: DataFrame, min_sites: int, long_sites: int | None = None) -> DataFrame:
    """h, c (hashes of a line) and ``first`` (key of the first document) of all lines on as many sites as they need, stored."""
    rows = docs.select(*document_key(), F.col("source").alias("site"), F.explode(_lines(F.col("text"))).alias("line")).where("trim(line) <> ''")
    h, c = _hash(F.col("line"))
    rows = rows.select("_id", "_text", "site", h.alias("h"), c.alias("c"), _needed(F.col("line"), min_sites, long_sites).alias("need"))
    spread = rows.groupBy("h", "c").agg(F.count("*").alias("times"), F.max("need").alias("need"), F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"), F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_text")).alias("first"))
    spread = stored(spread.where((F.col("times") >= F.col("need")) & (F.col("sites") >= F.col("need") * (1 - MARGIN) - 1)))
    sure = spread.where(F.col("sites") > F.col("need") * (1 + MARGIN) + 1)
    near = spread.join(sure, ["h", "c"], "left_anti")
    sites = rows.drop("need").join(small(stored(near.select("h", "c", "need")), BROADCAST_LINES), ["h", "c"]).select("h", "c", "need", "site").where("site IS NOT NULL").distinct()
    exact = sites.groupBy("h", "c", "need").agg(F.count("*").alias("exactly")).where(F.col("exactly") >= F.col("need"))
    return stored(sure.select("h", "c", "first").union(near.join(exact, ["h", "c"], "left_semi").select("h", "c", "first")))


def line_dedup(docs: DataFrame, min_sites: int = 10, long_sites: int | None = None) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and the counts n_lines and n_removed; all rows and columns stay.

    A line (compared without blanks at its ends) on at least ``min_sites`` distinct values of ``source`` is removed
    from every document but its first (the smallest doc_id, then the smaller hash of its text), so that nothing is lost
    from the corpus where whole documents are copied from site to site. With ``long_sites``, a line of over ``LONG_WORDS``
    words (between blanks) needs only so many sites, as no two authors write it by chance. Blank lines are never boilerplate; a null source
    is no site. A null text stays null, with 0 lines; an empty text has one line. Repeated rows of the first document
    all keep their lines. An empty table stays empty. Columns n_lines and n_removed of the input are replaced.
    """
    common = small(boilerplate(docs, min_sites, long_sites), BROADCAST_LINES)
    lines = docs.select(*document_key(), F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    h, c = _hash(F.col("line"))
    hits = lines.select("_id", "_text", "at", h.alias("h"), c.alias("c")).join(common, ["h", "c"])
    hits = hits.where(~(F.col("first._id").eqNullSafe(F.col("_id")) & (F.col("first._text") == F.col("_text"))))
    cut = hits.groupBy("_id", "_text").agg(F.array_sort(F.collect_set("at")).alias("_cut"))
    # Made below the join: inside the filter over lines it would be made anew for each of them.
    cut = cut.select("_id", "_text", F.size("_cut").alias("_removed"), _marks("_cut").alias("_marks"))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(*document_key(), F.struct(*[docs[c] for c in kept]).alias("_all"))
    out = rows.join(cut, same_document(rows, cut), "left")
    whole = F.col("_all.text")
    rest = F.array_join(F.filter(_lines(whole), lambda x, i: ~F.coalesce(F.get("_marks", i), F.lit(False))), "\n")
    text = F.when(whole.isNull() | F.col("_marks").isNull(), whole).otherwise(rest)
    counts = [F.when(whole.isNull(), 0).otherwise(F.size(_lines(whole))).cast("long").alias("n_lines"), F.coalesce("_removed", F.lit(0)).cast("long").alias("n_removed")]
    return out.select(*[text.alias("text") if c == "text" else F.col("_all")[c].alias(c) for c in kept], *counts)
