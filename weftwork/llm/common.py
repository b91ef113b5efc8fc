"""What the operators of this package share: stored tables, document keys, words, the learning split, checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def shared_path(spark: SparkSession) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``).

    Only a single-machine session may leave that setting out; it then uses /tmp/checkpoints.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith(("local[", "local,")) and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "/tmp/checkpoints"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts the lineage and survives lost executors."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def widened(df: DataFrame, fields: str) -> StructType:
    """The schema of ``df`` with more fields, given as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(fields).fields])


def small(df: DataFrame, rows: int, weight: Column | None = None) -> DataFrame:
    """Marks a stored table for broadcast if it has at most ``rows`` rows; a larger one is joined by shuffling.

    ``weight``: what a row counts, where rows hold arrays.
    """
    if weight is None:
        return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
    return F.broadcast(df) if (df.agg(F.sum(weight)).first()[0] or 0) <= rows else df


def hot_keys(rows: DataFrame, key: str, split: int, broadcast_rows: int) -> DataFrame:
    """The keys of more than ``split`` rows and into how many parts their rows are dealt, for ``dealt``. Stored."""
    often = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > split)
    return small(stored(often.select(key, F.ceil(F.col("_n") / split).cast("long").alias("_parts"))), broadcast_rows)


def dealt(rows: DataFrame, key: str, by: str, table: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` joined with ``table`` on ``key``; the rows of a hot key are dealt out by ``by``, and those of the table repeated."""
    count = F.coalesce("_parts", F.lit(1).cast("long"))
    left = rows.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(by), count)).drop("_parts")
    right = table.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))).drop("_parts")
    return left.join(right, [key, "_part"]).drop("_part")


def document_key(text: str = "text", doc_id: str = "doc_id") -> list[Column]:
    """Two columns by which rows meet again: equal keys mean the same id and the same text, so repeated rows share them."""
    return [F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_text")]


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_text"] == right["_text"])


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the ids that learning never sees; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone. ``lower`` does the same, and faster, where a text is all ASCII."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def word_array(text: Column) -> Column:
    """Words of letters, digits and everything beyond ASCII, lower-cased A-Z; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def parts(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices whose ``column`` holds about ``size`` bytes (or list items); a longer row stands alone."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        lengths = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
        group = np.cumsum(np.asarray(pc.fill_null(lengths, 0)).astype(np.int64)) // size
        starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            if b > a or not batch.num_rows:
                yield batch.slice(a, b - a)
        del batch, values
        pa.default_memory_pool().release_unused()


def blank_words(text: str | None) -> list[bytes]:
    """Words between ASCII blanks (space, tab to carriage return), lower-cased A-Z, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER_BYTES).split() if text else []


def hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sequence_hash(parts: list[np.ndarray]) -> np.ndarray:
    """One well-mixed 64-bit hash for each row of a sequence of hash columns; order and length matter."""
    total = np.full(parts[0].shape, len(parts), np.uint64)
    for part in parts:
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + part)
    return total


def shingle_set(words: list[bytes], size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; a shorter text is one run, no words give an empty set."""
    h = hashes(words)
    if not len(h):
        return h
    size = min(size, len(h))
    return np.unique(sequence_hash([h[i : len(h) - size + 1 + i] for i in range(size)]))
