"""Naming the category and brand of a part.

Dictionaries are tables the caller brings: ``components`` (component, category,
position) and ``keywords`` (keyword, category, position). A later row for the
same word overwrites its category; the first row keeps the position.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork import vocab
from weftwork.functions.text import normalize_name
from weftwork.functions.urls import _col, any_match
from weftwork.operators import similar
from weftwork.operators.terms import find_terms
from weftwork.session import checkpointed


def pattern_category(name) -> Column:
    """Ordered pattern rules, first match wins, else ``Other``."""
    lowered = F.lower(_col(name))
    return reduce(lambda out, rule: out.when(any_match(lowered, rule[1], ignore_case=False), rule[0]), vocab.CATEGORY_PATTERNS, F).otherwise("Other")


def brand(name, default: str = vocab.DEFAULT_BRAND) -> Column:
    """The first known brand the name contains."""
    upper = F.upper(_col(name))
    return reduce(lambda out, b: out.when(upper.contains(b.upper()), b), vocab.KNOWN_BRANDS, F).otherwise(default)


def taxonomy(raw: DataFrame, column: str = "value") -> DataFrame:
    """``{category: [component]}`` as (component, category, position); one JSON document."""
    parsed = raw.select(F.from_json(column, "map<string,array<string>>").alias("m"))
    categories = parsed.select(F.posexplode(F.map_entries("m")).alias("c", "entry"))
    rows = categories.select("c", F.col("entry.key").alias("category"), F.posexplode("entry.value").alias("i", "component"))
    return rows.select("component", "category", (F.shiftleft(F.col("c").cast("bigint"), 32) + F.col("i")).alias("position"))


def members(components: DataFrame, category: str) -> DataFrame:
    return components.where(F.col("category") == category).orderBy("position").select("component")


def vocabulary(*tables: DataFrame) -> DataFrame:
    """All categories named in any of the tables, sorted."""
    return reduce(DataFrame.union, [t.select("category") for t in tables]).distinct().orderBy("category")


def _index(table: DataFrame, word: str) -> DataFrame:
    """One row per lower-cased word: last category, first position."""
    return table.groupBy(F.lower(word).alias(word)).agg(
        F.max_by("category", "position").alias("category"), F.min("position").alias("position")
    )


def keyword_matches(names: DataFrame, text: str, keywords: DataFrame, min_length: int = 5, whole_to: int = 8) -> DataFrame:
    """Dictionary words found in each distinct text: whole words, or inside words from 8 letters on."""
    distinct = names.select(text).where(F.col(text).isNotNull()).distinct()
    index = _index(keywords, "keyword").select("keyword", "category")
    found = find_terms(distinct, text, text, index, "keyword", min_length, whole_to)
    return found.withColumnRenamed("term", "keyword").join(index, "keyword")


def _keyword_score(text: str) -> Column:
    size = F.length("keyword")
    return F.least(size / F.length(text) + F.least(size / F.lit(10), F.lit(0.3)) + 0.3, F.lit(1.0))


def best_keyword(names: DataFrame, text: str, keywords: DataFrame, min_length: int = 5) -> DataFrame:
    """(text, category, keyword, score): longest share wins, then the earliest place."""
    matches = keyword_matches(names, text, keywords, min_length).withColumn("score", _keyword_score(text))
    rank = F.struct(-F.col("score"), F.col("start"), F.col("start") + F.length("keyword"))
    best = matches.groupBy(text).agg(F.min_by(F.struct("category", "keyword", "score"), rank).alias("best"))
    return best.select(text, "best.*")


def best_component(names: DataFrame, text: str, components: DataFrame, least: float = 0.5) -> DataFrame:
    """(text, component, category, score): the most similar component of each distinct text, from ``least`` on; the first of equals."""
    index = checkpointed(_index(components, "component"))
    found = similar.most_similar(names, text, index, "component", "position", least)
    return found.join(index.select("component", "category"), "component").select(text, "component", "category", "score")


def _words(text) -> Column:
    return F.array_distinct(F.filter(F.split(F.trim(F.lower(text)), r"\s+"), lambda w: w != ""))


def _word_pairs(words: str) -> Column:
    """All pairs of a sorted array of words."""
    last = F.size(words)
    firsts = F.when(last > 1, F.sequence(F.lit(1), last - 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(firsts, lambda i: F.transform(F.sequence(i + 1, last), lambda j: F.struct(F.get(words, i - 1).alias("a"), F.get(words, j - 1).alias("b")))))


def word_overlap(names: DataFrame, text: str, keywords: DataFrame) -> DataFrame:
    """(text, category, position, score): per category, how well its keywords fit the words of the text.

    A keyword inside the text scores its share of the length plus a half; else
    shared words of four or more letters score their share of the longer side.

    A word alone is never a key of keywords: what sharing one word scores depends on the two sizes only, so a text meets one
    row per word, category and size, which counts its keywords; those inside the text are taken off that count. Keywords
    that share more meet the text at the first two words they share.
    """
    distinct = names.select(text).where(F.length(text) > 0).distinct()
    listed = keywords.select(F.lower("keyword").alias("keyword"), "category", "position")
    phrases = checkpointed(find_terms(distinct, text, text, listed, "keyword").select(text, F.col("term").alias("keyword")).distinct())
    phrase_scores = phrases.join(listed, "keyword").withColumn(
        "score", F.least(F.length("keyword") / F.length(text) + 0.5, F.lit(1.0))
    )
    long = lambda words: F.array_sort(F.filter(words, lambda w: F.length(w) >= 4))
    keyed = listed.select("keyword", "category").distinct().withColumns({"_m": F.size(_words("keyword")), "_own": long(_words("keyword"))}).where(F.size("_own") > 0)
    sizes = keyed.withColumn("_word", F.explode("_own")).groupBy("_word", "category", "_m").agg(F.count(F.lit(1)).alias("_keywords"))
    texts = distinct.withColumns({"_n": F.size(_words(text)), "_its": long(_words(text))})

    inside = phrases.join(keyed, "keyword").withColumn("_word", F.explode("_own")).groupBy(text, "_word", "category", "_m").agg(F.count(F.lit(1)).alias("_inside"))
    one = texts.withColumn("_word", F.explode("_its")).join(sizes, "_word").join(inside, [text, "_word", "category", "_m"], "left")
    one = one.where(F.col("_keywords") > F.coalesce("_inside", F.lit(0))).withColumn("score", 1 / F.greatest("_n", "_m"))

    pair = F.explode(_word_pairs("_its")).alias("_pair")
    several = texts.select(text, "_n", "_its", pair).join(keyed.select("keyword", "category", "_m", "_own", F.explode(_word_pairs("_own")).alias("_pair")), "_pair")
    shared = F.array_intersect("_its", "_own")
    several = several.where((F.get(shared, F.lit(0)) == F.col("_pair.a")) & (F.get(shared, F.lit(1)) == F.col("_pair.b")))
    several = several.join(phrases, [text, "keyword"], "left_anti").withColumn("score", F.size(shared) / F.greatest("_n", "_m"))

    columns = [text, "category", "score"]
    every = phrase_scores.select(*columns).unionByName(one.select(*columns)).unionByName(several.select(*columns))
    per_category = every.groupBy(text, "category").agg(F.max("score").alias("score"))
    order = keywords.groupBy("category").agg(F.min("position").alias("position"))
    return per_category.join(order, "category").select(text, "category", "position", "score")


def detect(names: DataFrame, name: str, components: DataFrame, keywords: DataFrame) -> DataFrame:
    """(name, category, confidence) for each distinct name.

    Exact component, cleaned component, keyword (from 0.5), similar component
    (from 0.8), shared words, then the thresholds 0.4 / 0.5 / 0.25, else Other.
    Each step sees only the names the steps before it left open.
    """
    # Every later step starts from the distinct names; they are stored so that the table is read once.
    base = checkpointed(names.select(name).distinct().withColumns({"_raw": F.lower(name), "_clean": normalize_name(F.coalesce(name, F.lit("")))}))
    index = _index(components, "component").select("component", F.col("category"))

    def by(column, out):
        return index.select(F.col("component").alias(column), F.col("category").alias(out))

    exact = base.join(by("_raw", "_exact"), "_raw", "left").join(by("_clean", "_cleaned"), "_clean", "left")
    blank = F.coalesce(F.trim(name), F.lit("")) == ""
    settled = (
        F.when(blank, F.struct(F.lit("Other").alias("category"), F.lit(0.0).alias("confidence")))
        .when(F.col("_exact").isNotNull(), F.struct(F.col("_exact").alias("category"), F.lit(1.0).alias("confidence")))
        .when(F.col("_cleaned").isNotNull(), F.struct(F.col("_cleaned").alias("category"), F.lit(0.95).alias("confidence")))
    )
    exact = exact.withColumn("_settled", settled)
    open_ = exact.where("_settled is null").select(name, "_raw", "_clean")

    texts = open_.select(F.col("_raw").alias("text")).union(open_.select(F.col("_clean").alias("text"))).where("text <> ''").distinct()
    keyed = best_keyword(texts, "text", keywords)

    def pick(column, prefix):
        return keyed.select(F.col("text").alias(column), F.col("category").alias(f"{prefix}_cat"), F.col("score").alias(f"{prefix}_score"))

    scored = open_.join(pick("_raw", "_r"), "_raw", "left").join(pick("_clean", "_c"), "_clean", "left")
    better = F.coalesce(F.col("_c_score"), F.lit(0.0)) > F.coalesce(F.col("_r_score"), F.lit(0.0))
    scored = scored.select(
        name, "_raw", "_clean", F.when(better, F.col("_c_cat")).otherwise(F.col("_r_cat")).alias("_key_cat"),
        F.greatest(F.coalesce("_r_score", F.lit(0.0)), F.coalesce("_c_score", F.lit(0.0))).alias("_key"),
    )
    scored = checkpointed(scored)
    weak = scored.where("_key < 0.5")
    fuzzy = best_component(weak.where("_clean <> ''"), "_clean", components).select("_clean", F.col("category").alias("_comp_cat"), F.col("score").alias("_comp"))
    unsure = weak.where("_key < 0.4")
    overlap_texts = unsure.select(F.col("_raw").alias("text")).union(unsure.select(F.col("_clean").alias("text"))).distinct()
    overlaps = word_overlap(overlap_texts, "text", keywords)
    # Categories in dictionary order, the cleaned text before the raw one; the first best score wins.
    tried = unsure.select(name, F.explode(F.array(
        F.struct(F.col("_clean").alias("text"), F.lit(0).alias("turn")), F.struct(F.col("_raw").alias("text"), F.lit(1).alias("turn")),
    )).alias("t")).select(name, "t.*").join(overlaps, "text")
    best_overlap = tried.groupBy(name).agg(
        F.min_by(F.struct("category", "score"), F.struct(-F.col("score"), F.col("position"), F.col("turn"))).alias("_o")
    ).select(name, F.col("_o.category").alias("_over_cat"), F.col("_o.score").alias("_over"))

    joined = scored.join(fuzzy, "_clean", "left").join(best_overlap, name, "left").fillna(0.0, ["_comp", "_over"])
    c = F.col
    by_words = c("_over") > c("_key")
    key_cat = F.when(by_words, c("_over_cat")).otherwise(c("_key_cat"))
    key_score = F.greatest("_key", "_over")

    def result(category, confidence):
        return F.struct(category.alias("category"), confidence.alias("confidence"))

    decided = joined.select(name, (
        F.when(c("_key") >= 0.5, result(c("_key_cat"), c("_key")))
        .when(c("_comp") >= 0.8, result(c("_comp_cat"), c("_comp")))
        .when(key_score >= 0.4, result(key_cat, key_score))
        .when(c("_comp") >= 0.5, result(c("_comp_cat"), c("_comp")))
        .when(key_score >= 0.25, result(key_cat, key_score))
        .otherwise(result(F.lit("Other"), F.lit(0.0)))
    ).alias("_settled"))
    return exact.where("_settled is not null").select(name, "_settled").unionByName(decided).select(name, "_settled.*")


def detect_batch(df: DataFrame, name: str, components: DataFrame, keywords: DataFrame) -> DataFrame:
    """Adds category and confidence to every row; distinct names are looked up once."""
    found = detect(df, name, components, keywords)
    left, right = df.alias("l"), found.alias("r")
    return left.join(right, F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")), "left").select("l.*", "r.category", "r.confidence")


