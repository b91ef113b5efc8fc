"""A training corpus from raw documents, stage by stage; each stage is written as Parquet and read again.

ORACLE_SQL is None: language proportions, MinHash groups and piece paths are beyond SQL. tests/llm/test_brute_force.py
holds every stage against a brute-force version instead.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.llm import decontamination, language_id, line_dedup, near_dedup, sentencepiece_codec
from weftwork.llm.common import held_out, same_document, shared_path, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # what words are made of, see common.word_array


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no language: null, or without any letter. ``lang`` becomes the language found.

    Where there is no text to learn a language from, it stays as it is.
    """
    model = language_id.train(docs.where(~held_out()).select("text", "lang"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    found = language_id.predict(docs, model).where("lang_pred <> 'und'")
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that stand on ten sites or more, or four if they have over 50 words, out of all texts but the first.

    A document that this leaves without any word goes: each of its lines stands in a first document, which keeps it. So
    of a large group of copies one stays. Documents that lose no line all stay, also null and wordless ones.
    """
    out = line_dedup.line_dedup(docs, min_sites=10, long_sites=4)
    out = out.where((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (0.8 or more on five-word shingles), the one of smallest doc_id."""
    return near_dedup.one_of_each(docs.select(*COLUMNS), percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten words in a row of a benchmark item, or all of a shorter item."""
    found = decontamination.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10)
    leaked = stored(found.where("contaminated").select("_id", "_text").distinct())
    keyed = docs.select(*COLUMNS).withColumns({"_id": F.col("doc_id"), "_text": F.xxhash64("text")})
    return keyed.join(leaked, same_document(keyed, leaked), "left_anti").select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the piece ids of the text, their number, and whether they decode to the text."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_codec.encode(docs.select("doc_id", "text", "lang", "source"), path, verify=True)
    return coded.select("doc_id", "lang", "source", "ids", "n_tokens", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = shared_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
