"""Homomorphic multiset fingerprints: a text is the sum of the vectors of its paragraphs.

A paragraph (a non-empty line) is hashed to a vector of 16 lanes of 32 bits, which tell whether two texts have the same
paragraphs, and LEVELS x SLOTS lanes of 16 bits that its shingles fall into, which tell how much two texts share: at
level 0 each shingle, at each further level half as many; 32 levels thin out any text that a row can hold. Shingles are runs
of SHINGLE characters of a paragraph that has a border of SHINGLE - 1 on either side, so a paragraph of n characters has
n + SHINGLE - 1 of them, whether or not its writing has blanks or full stops. Vectors are added lane by lane modulo 2^32
and 2^16. So the order of paragraphs does not matter, and a paragraph is inserted or deleted by adding or subtracting its
vector.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import mixed

DENSE, LEVELS, SLOTS = 16, 32, 32
SHINGLE = 8
CHUNK = 1 << 20
_FULL = SLOTS * 15 // 16
_BORDER = "\n" * (SHINGLE - 1)
_M, _AGAIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _lanes(lines: list[str]) -> np.ndarray:
    """The lanes of likeness, worked through about ``CHUNK`` shingles at a time, longer paragraphs in pieces of so many.

    A shingle that a paragraph repeats counts as another one each time, so that what it has more often is not lost.
    """
    points = np.frombuffer((_BORDER + _BORDER.join(lines) + _BORDER).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter(map(len, lines), np.int64, len(lines)) + SHINGLE - 1
    turn = np.zeros(len(sizes), np.uint64)
    if sizes.max() > CHUNK:
        turn = np.array([i // CHUNK for n in sizes.tolist() for i in range(0, n, CHUNK)], np.uint64)
        sizes = np.array([min(CHUNK, n - i) for n in sizes.tolist() for i in range(0, n, CHUNK)])
    ends, total, start, at = np.cumsum(sizes), np.zeros(LEVELS * SLOTS, np.uint64), 0, 0
    while at < len(sizes):
        after = max(at + 1, int(np.searchsorted(ends, start + CHUNK, "right")))
        n = int(ends[after - 1]) - start
        part = points[start : start + n + SHINGLE - 1].astype(np.uint64)
        h = part[:n].copy()
        for i in range(1, SHINGLE):
            h *= _M
            h += part[i : n + i]
        h = mixed(h)
        key = h ^ np.repeat(mixed(np.arange(at + 1, after + 1, dtype=np.uint64)), sizes[at:after])
        ranked = np.sort(key)
        twice = ranked[1:][ranked[1:] == ranked[:-1]]
        if len(twice):
            found = np.searchsorted(twice, key)
            rows = np.flatnonzero(twice[np.minimum(found, len(twice) - 1)] == key)
            rows = rows[np.argsort(key[rows])]
            place, own = np.arange(len(rows)), key[rows]
            first = np.maximum.accumulate(np.where(np.r_[True, own[1:] != own[:-1]], place, 0))
            again = (place - first).astype(np.uint64) | np.repeat(turn[at:after], sizes[at:after])[rows] << np.uint64(32)
            h[rows] = np.where(place != first, mixed(h[rows] + again * _AGAIN), h[rows])
        deep = (h >> np.uint64(8)) & np.uint64(0x7FFFFFFF) | np.uint64(0x80000000)
        level = np.frexp((deep & -deep).astype(np.float64))[1] - 1
        lane = level * SLOTS + (h & np.uint64(SLOTS - 1)).astype(np.int64)
        total += np.bincount(lane, (h >> np.uint64(48) | np.uint64(1)).astype(np.float64), LEVELS * SLOTS).astype(np.uint64)
        start, at = start + n, after
    return np.cumsum(total.reshape(LEVELS, SLOTS)[::-1], axis=0)[::-1].astype(np.uint16)


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The two groups of lanes of a text; null and empty texts and those of empty lines are the zero vector."""
    lines = [x for x in text.split("\n") if x] if text else []
    if not lines:
        return np.zeros(DENSE, np.uint32), np.zeros((LEVELS, SLOTS), np.uint16)
    digests = b"".join([hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=4 * DENSE).digest() for x in lines])
    dense = np.frombuffer(digests, "<u4").reshape(-1, DENSE).sum(axis=0, dtype=np.uint32)
    return dense, _lanes(lines)


def insert(print_: tuple, paragraph: str) -> tuple:
    dense, lanes = vector(paragraph)
    return print_[0] + dense, print_[1] + lanes


def delete(print_: tuple, paragraph: str) -> tuple:
    dense, lanes = vector(paragraph)
    return print_[0] - dense, print_[1] - lanes


def as_text(print_: tuple) -> str:
    """Hexadecimal; levels from the first on that nothing reaches are left out."""
    levels = np.flatnonzero(print_[1].any(axis=1))
    return print_[0].astype("<u4").tobytes().hex() + print_[1][: levels[-1] + 1 if len(levels) else 0].astype("<u2").tobytes().hex()


def from_text(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = bytes.fromhex(text)
    lanes, given = np.zeros((LEVELS, SLOTS), np.uint16), np.frombuffer(data, "<u2", offset=4 * DENSE).reshape(-1, SLOTS)
    lanes[: len(given)] = given
    return np.frombuffer(data, "<u4", DENSE), lanes


def likeness(a: tuple, b: tuple) -> float:
    """1 for equal fingerprints; else about the number of shared shingles by that of all, 0 if no lane in use is equal.

    Of lanes that u shingles fall into, exp(-u / SLOTS) stay empty; likewise, with as many shingles as one text alone has,
    do lanes that differ in nothing. Levels with a few empty lanes are taken together; if none has them, the deepest in use.
    """
    if (a[0] == b[0]).all() and (a[1] == b[1]).all():
        return 1.0
    used, differ = ((a[1] != 0) | (b[1] != 0)).sum(axis=1), (a[1] != b[1]).sum(axis=1)
    fit = np.flatnonzero((used <= _FULL) & (used > 0))
    if not len(fit):
        fit = np.flatnonzero(used)[-1:]
    if not len(fit):
        return 0.0
    every, alone = (-np.log1p(-np.minimum(x[fit], SLOTS - 0.5) / SLOTS).sum() for x in (used, differ))
    return float(1 - alone / every)


def _buckets(docs: DataFrame) -> DataFrame:
    """Rows with ``bucket``, a number that falls with the doc_id: ranges of about equal size, four for each shuffle partition; null ids come last."""
    spark = docs.sparkSession
    count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = sorted(set(docs.select(F.col("doc_id").cast("double").alias("x")).approxQuantile("x", [i / count for i in range(1, count)], 0.25 / count))) if count > 1 else []
    bounds = np.array(edges)

    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        values = ids.to_numpy("float64", na_value=np.nan)
        return pd.Series(np.where(np.isnan(values), len(bounds) + 1, len(bounds) - np.searchsorted(bounds, values)))

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), place(F.col("doc_id").cast("double")).alias("bucket"))


def _with_next(docs: DataFrame) -> DataFrame:
    """Buckets of rows in descending order; at the end of each, once more, the first row of the next (``head``)."""
    rows = _buckets(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("down")))
    tops = rows.groupBy("bucket").agg(first.alias("top")).select("bucket", "top.none", "top.down").orderBy("bucket").collect()
    numbers = [r.bucket for r in tops]
    if not numbers:
        return rows.withColumn("head", F.lit(0))
    before = docs.sparkSession.createDataFrame([(b, numbers[i - 1], r.none, r.down) for i, (b, r) in enumerate(zip(numbers, tops))], "bucket long, target long, none boolean, down long")
    top = rows.join(F.broadcast(before), "bucket").where(F.when(F.col("none"), F.col("doc_id").isNull()).otherwise(-F.col("doc_id") == F.col("down")))
    heads = top.groupBy("target").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "doc_id")).alias("t"))
    return rows.withColumn("head", F.lit(0)).union(heads.select("t.doc_id", "t.text", F.col("target").alias("bucket"), F.lit(1)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """For each row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by as many first ones (or all) of the next
    document's in descending doc_id; the first follows the last. Null doc_ids come last; equal ids are ordered by a hash of
    their text, then the text. A null text counts as empty, an only row as its own next. Repeated rows stay. An empty
    table gives no rows. Only doc_id and text are read. The driver gets a few numbers for each range of ids (four for each shuffle partition).
    """
    order = ["bucket", "head", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"]
    rows = _with_next(docs).repartition("bucket").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, head in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "text", "head"))):
                own = vector(text)
                if held:
                    before, said, theirs = held
                    half = len(said) // 2
                    edited = said[: len(said) - half] + text[:half]
                    changed = vector(edited)
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((before, len(said), digest, as_text(theirs), as_text(changed), likeness(theirs, changed), likeness(theirs, own)))
                held = None if head else (doc_id, text, own)
            columns = list(zip(*out)) if out else [()] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
