"""Similar names without comparing every pair: an index of shared letters by length band.

The similarity of two strings counts matched characters twice over both lengths, so it never exceeds what their letters
allow: twice the letters they share, each as often as in both. Two strings that can reach a threshold have lengths within a
factor of each other and share a letter among the rarest of each (letters are counted: the second e is another letter than
the first). The index joins on length band and such letters, and a pair is made at its first shared letter alone. Pairs
whose bound stays below the threshold are never made; the others are counted and dealt out evenly before they are scored.
"""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from weftwork.session import checkpointed

PAIRS_PER_TASK = 20_000
_TINY = 1e-9


def gestalt_ratio(a: str, b: str) -> float:
    """Similarity of two strings: twice the matched characters over both lengths."""
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def _ratios(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else gestalt_ratio(x, y) for x, y in zip(left, right)], dtype="float64")


def similarity(a: Column, b: Column) -> Column:
    """``gestalt_ratio`` of two columns, lower-cased; null in, null out."""
    return _ratios(F.lower(a), F.lower(b))


def letters(text: Column) -> Column:
    """The characters of a text, each numbered among its equals: "noon" has n0, n1, o0, o1."""
    sorted_ = F.array_sort(F.split(text, ""))
    return F.transform(sorted_, lambda c, i: F.concat(c, (i - F.array_position(sorted_, c).cast("int") + 1).cast("string")))


def _band(size: Column, ratio: float) -> Column:
    return F.floor(F.ln(size) / math.log(ratio) + _TINY)


def _indexed(strings: DataFrame, column: str, order: DataFrame, least: float) -> DataFrame:
    """Each string with its letters, rare ones first, their number, and how many of them can hold its first shared one."""
    own = strings.withColumn("_letters", letters(F.col(column))).withColumn("_size", F.size("_letters"))
    rows = own.select(*strings.columns, "_size", F.explode("_letters").alias("_letter")).join(order, "_letter", "left")
    sorted_ = F.array_sort(F.collect_list(F.struct(F.coalesce("_often", F.lit(0)).alias("often"), "_letter")))
    out = rows.groupBy(*strings.columns, "_size").agg(F.transform(sorted_, lambda x: x["_letter"]).alias("_letters"))
    needed = F.ceil(F.col("_size") * (least / (2 - least)) - _TINY)
    return out.withColumn("_head", (F.col("_size") - needed + 1).cast("int"))


def candidates(names: DataFrame, text: str, terms: DataFrame, term: str, least: float) -> DataFrame:
    """The pairs of distinct ``text`` and ``term`` (with the other columns of both) whose letters allow a similarity of ``least``."""
    ratio = (2 - least) / least
    often = terms.select(F.explode(letters(F.col(term))).alias("_letter")).groupBy("_letter").agg(F.count(F.lit(1)).alias("_often"))
    often = checkpointed(often)  # as many rows as the alphabet has letters, times the longest run of one
    left = _indexed(names.where(F.length(text) > 0), text, often, least)
    right = _indexed(terms.where(F.length(term) > 0), term, often, least)
    keys = lambda side, df: df.withColumnsRenamed({c: f"{side}_{c}" for c in ("_size", "_letters", "_head")})
    left, right = keys("l", left), keys("r", right)
    left = left.withColumn("_band", F.explode(F.sequence(_band(F.col("l__size"), ratio) - 1, _band(F.col("l__size"), ratio) + 1)))
    left = left.withColumn("_letter", F.explode(F.slice("l__letters", F.lit(1), F.col("l__head"))))
    right = right.withColumn("_band", _band(F.col("r__size"), ratio)).withColumn("_letter", F.explode(F.slice("r__letters", F.lit(1), F.col("r__head"))))
    shared = F.array_intersect("l__letters", "r__letters")
    reach = 2 * F.size(shared) >= (F.col("l__size") + F.col("r__size")) * least - _TINY
    met = left.join(right, ["_band", "_letter"]).where((F.get(shared, F.lit(0)) == F.col("_letter")) & reach)
    return met.select(*names.columns, *terms.columns)


def scored(pairs: DataFrame, text: str, term: str) -> DataFrame:
    """Stored ``pairs`` with ``score``, dealt out by their number."""
    tasks = -(-pairs.count() // PAIRS_PER_TASK)
    even = pairs.repartition(max(1, tasks), text, term)
    # Marked so that no filter on the result runs the function twice.
    return even.withColumn("score", _ratios.asNondeterministic()(text, term))


def most_similar(names: DataFrame, text: str, terms: DataFrame, term: str, position: str, least: float = 0.5, first: float = 0.8) -> DataFrame:
    """(text, term, position, score) for each distinct text that some term is similar to by ``least``: the best, then the first.

    Texts that find a term by ``first`` look no further: any other pair has a bound below that. Only the rest is tried with
    the lower threshold.
    """
    # Stored, so that what follows starts from the distinct texts, however many rows there are.
    open_ = checkpointed(names.select(text).where(F.col(text).isNotNull()).distinct())
    found = None
    for threshold in sorted({max(first, least), least}, reverse=True):
        pairs = checkpointed(candidates(open_, text, terms.select(term, position), term, threshold))
        best = F.min_by(F.struct(term, position, "score"), F.struct(-F.col("score"), F.col(position)))
        hits = checkpointed(scored(pairs, text, term).where(F.col("score") >= threshold).groupBy(text).agg(best.alias("_b")).select(text, "_b.*"))
        open_ = open_.join(hits.select(text), text, "left_anti")
        found = hits if found is None else found.unionByName(hits)
    return found
