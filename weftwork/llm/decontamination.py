"""Benchmark decontamination: a positional inverted index of the corpus, searched for phrases and near phrases.

``build_index`` stores one posting (document, position, term) for each occurrence of a query term, partition by partition
as the documents are read, without a shuffle. A phrase is looked up by its two rarest terms: both lists, each shifted by
the term's offset in the phrase, are intersected; what is left is compared with the words of the document.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import document_key, same_document, small, stored, word_array

BROADCAST_TERMS = 1_000_000
BROADCAST_ROWS = 200_000


def phrases(items: DataFrame, size: int = 10) -> DataFrame:
    """Distinct windows of ``size`` words of ``items`` (item_id, text), stored: phrase, words, item_ids.

    An item of fewer words is one window; one without words has none.
    """
    words = items.select("item_id", word_array(F.col("text")).alias("w")).withColumn("n", F.size("w")).where("n > 0")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.col("n") - size + 1, F.lit(1))))
    cut = words.select("item_id", "w", starts.alias("at")).select("item_id", F.slice("w", F.col("at"), size).alias("words"))
    return stored(cut.groupBy("words").agg(F.collect_set("item_id").alias("item_ids")).withColumn("phrase", F.monotonically_increasing_id()))


def vocabulary(sought: DataFrame) -> DataFrame:
    """The terms of the phrases, numbered and stored: word, term."""
    return stored(sought.select(F.explode("words").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id()))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings _id, _text, position (from 0), term of all ``terms`` in all ``docs``, stored."""
    words = docs.select(*document_key(), F.posexplode(word_array(F.col("text"))).alias("position", "word"))
    return stored(words.join(small(terms, BROADCAST_TERMS), "word").select("_id", "_text", "position", "term"))


def _rarest(sought: DataFrame, terms: DataFrame, index: DataFrame, count: int) -> DataFrame:
    """phrase, term, offset, last of the ``count`` places of each phrase whose terms are rarest in the corpus, and how many there are.

    ``last``: whether it is the later one of two. What is known of a term is bounded by the query's vocabulary, so it is
    broadcast where that is small and no term of very many phrases is one task's work.
    """
    often = small(stored(index.groupBy("term").agg(F.count("*").alias("often")).join(terms, "term")), BROADCAST_TERMS)
    places = sought.select("phrase", F.size("words").alias("n"), F.posexplode("words").alias("offset", "word")).join(often, "word")
    ranked = places.groupBy("phrase").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("often", "offset", "term"))).alias("p")).where(F.size("p") == F.col("n"))
    best = F.array_sort(F.transform(F.slice("p", 1, count), lambda x: F.struct(x["offset"].alias("offset"), x["term"].alias("term"))))
    chosen = ranked.select("phrase", F.least(F.lit(count), "n").alias("needed"), F.posexplode(best).alias("place", "b"))
    return chosen.select("phrase", "b.term", "b.offset", "needed", ((F.col("place") == 1) & (F.col("needed") == 2)).alias("last"))


def _begins(words: Column, start: Column, phrase: Column, slack: int) -> Column:
    """Whether the words from ``start`` on hold those of ``phrase`` in order, the first at once, with up to ``slack`` words between them."""
    near = F.slice(words, start + 1, F.size(phrase) + slack)
    told = F.aggregate(near, F.lit(0), lambda n, w: F.when(F.get(phrase, n) == w, n + 1).otherwise(n))
    return (F.get(words, start) == F.get(phrase, F.lit(0))) & (told == F.size(phrase))


def matches(docs: DataFrame, sought: DataFrame, slack: int = 0) -> DataFrame:
    """For each document with a match (_id, _text): ``hits``, an array of (start, n, phrase) of all places where a phrase stands, and ``near``.

    ``near`` holds the phrases that stand in the document, exactly or with up to ``slack`` other words between their own.
    Null, empty and wordless texts match nothing; a phrase with a word that is in no document neither. Repeated rows are one.
    """
    terms = vocabulary(sought)
    index = build_index(docs, terms)
    places = small(stored(_rarest(sought, terms, index, 2)), BROADCAST_TERMS)
    shifted = index.join(places, "term").select("_id", "_text", (F.col("position") - F.col("offset")).alias("at"), "phrase", "needed", "offset", "last")
    # Other words before the later of the two terms move it on, and its shifted place with it.
    moved = F.when(F.col("last"), F.sequence(F.lit(0), F.lit(slack))).otherwise(F.array(F.lit(0)))
    shifted = shifted.select("_id", "_text", "phrase", "needed", "offset", "at", F.explode(moved).alias("moved")).withColumn("start", F.col("at") - F.col("moved")).where("start >= 0")
    both = shifted.groupBy("_id", "_text", "start", "phrase").agg(F.first("needed").alias("needed"), F.count_distinct("offset").alias("found"))
    meant = both.where("found = needed").join(sought.select("phrase", "words"), "phrase")
    asked = stored(meant.groupBy("_id", "_text").agg(F.collect_list(F.struct("start", "phrase", "words")).alias("asked")))
    few = small(asked, BROADCAST_ROWS, F.size("asked"))
    keyed = docs.select(*document_key(), F.col("text").alias("_words"))
    words = keyed.join(few, same_document(keyed, few)).select(few["_id"], few["_text"], "asked", word_array(F.col("_words")).alias("w"))
    true = F.filter("asked", lambda a: F.slice(F.col("w"), a["start"] + 1, F.size(a["words"])) == a["words"])
    hits = F.transform(true, lambda a: F.struct(a["start"].alias("start"), F.size(a["words"]).alias("n"), a["phrase"].alias("phrase")))
    # Other words before the earlier term move the beginning back by as many.
    starts = lambda a: F.sequence(F.greatest(a["start"] - slack, F.lit(0)), a["start"])
    near = F.filter("asked", lambda a: F.exists(starts(a), lambda s: _begins(F.col("w"), s, a["words"], slack)))
    found = words.select("_id", "_text", hits.alias("hits"), F.array_distinct(F.transform(near, lambda a: a["phrase"])).alias("near"))
    return stored(found.where((F.size("hits") > 0) | (F.size("near") > 0)).dropDuplicates(["_id", "_text"]))


def exact_matches(docs: DataFrame, sought: DataFrame) -> DataFrame:
    """``matches`` without slack: _id, _text, hits of the documents that hold a phrase."""
    return matches(docs, sought).select("_id", "_text", "hits")


def near_matches(docs: DataFrame, sought: DataFrame, slack: int = 2) -> DataFrame:
    """Proximity: _id, _text, phrase where all words of a phrase stand in its order with up to ``slack`` other words between them."""
    return matches(docs, sought, slack).select("_id", "_text", F.explode("near").alias("phrase"))


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, slack: int = 0) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, any others): doc_id, n_words, n_hit, n_items, items, contaminated, n_near, _id, _text.

    ``items`` (item_id, text) are searched by windows of ``size`` words; a document word inside any occurrence is hit.
    ``items`` of the result holds the item_ids with an occurring window, sorted as strings; ``n_near`` counts the items with
    a window that occurs exactly or with up to ``slack`` other words between its own, which are not hit. Null, empty and wordless
    texts have no words and no hits; wordless items and null item_ids match nothing. Repeated rows get equal results;
    equal item_ids count once. Empty tables give no rows or no hits. Other columns are ignored, whatever their names.
    """
    sought = phrases(items, size)
    hits = matches(docs, sought, slack)
    spans = F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1)))
    covered = hits.select("_id", "_text", F.size(F.array_distinct(spans)).alias("n_hit"))
    named = hits.select("_id", "_text", F.explode("hits.phrase").alias("phrase")).distinct().join(sought.select("phrase", F.explode("item_ids").alias("item")), "phrase")
    named = named.groupBy("_id", "_text").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    items_of = sought.select("phrase", F.explode("item_ids").alias("item"))
    close = hits.select("_id", "_text", F.explode("near").alias("phrase")).join(items_of, "phrase").groupBy("_id", "_text").agg(F.count_distinct("item").alias("n_near"))
    found = covered.join(named, same_document(covered, named), "left").select(covered["_id"], covered["_text"], "n_hit", "items")
    found = found.join(close, same_document(found, close), "left").select(found["_id"], found["_text"], "n_hit", "items", "n_near")
    rows = docs.select("doc_id", F.size(word_array(F.col("text"))).cast("long").alias("n_words"), *document_key())
    out = rows.join(found, same_document(rows, found), "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit").cast("long"), F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"), (n_hit > 0).alias("contaminated"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), rows["_id"], rows["_text"])
