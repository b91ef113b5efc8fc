"""N-gram Jaccard join with several global token orders: candidates must share prefix tokens under each of them.

In any order of all tokens, two sets that are similar enough share their first common token at places that their sizes
bound, so only the first part of each set, its prefix, need be looked at. Each order here counts the tokens of the corpus in
a table of fixed size and takes the rare ones first; the tables hash differently, so what one takes for rare by mistake
another one does not. Pairs that meet in the first order's prefixes are tested against the others, then on whole sets.

Texts with equal sets are one node. Nodes that share a token are compared with one of them first, which links most of a
group of near copies; after that only nodes of different components meet, and per token the members of its largest
component meet none of each other. So no group is paired in full, and every link between components is tested.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.llm.common import blank_words, dealt, hot_keys, mixed, parts, same_document, shingle_set, small, stored
from weftwork.llm.near_dedup import components

ORDERS = 3
COUNTERS = 1 << 20  # of each order
SLICE = 1 << 12  # counters that are sent together
TEXT_BYTES = 4_000_000
BROADCAST_ROWS = 500_000
SPLIT = 256  # pairs of a node that one task compares


def _ordered(shingles: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The counter of each shingle in an order, and its hash there."""
    h = mixed(shingles + np.uint64((order + 1) * 0x9E3779B97F4A7C15 % 2**64))
    return (h >> np.uint64(32)).astype(np.int64) % COUNTERS, h


def _packed(counts: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """at, n: the number of each slice of the counters, and its counts, packed."""
    for at, n in counts:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([zlib.compress(n.astype("<i8").tobytes(), 1)], pa.binary())], ["at", "n"])


def _unpacked(n: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(n), "<i8")


def _counter(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((ORDERS, COUNTERS), np.int64)
        for batch in parts(batches, "text", TEXT_BYTES):
            found = np.concatenate([shingle_set(blank_words(t), size) for t in batch.column("text").to_pylist()] or [np.zeros(0, np.uint64)])
            for o in range(ORDERS):
                counts[o] += np.bincount(_ordered(found, o)[0], minlength=COUNTERS)
        yield from _packed((at, n) for at, n in enumerate(counts.reshape(-1, SLICE)) if n.any())

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, n in zip(batch.column("at").to_pylist(), batch.column("n").to_pylist()):
            counts[at] = counts.get(at, 0) + _unpacked(n)
    yield from _packed(iter(counts.items()))


def token_counts(docs: DataFrame, size: int) -> np.ndarray:
    """How many texts hold the shingles of each counter of each order, up to 2^32 - 1; all texts count."""
    counted = docs.select("text").mapInArrow(_counter(size), "at long, n binary")
    rows = counted.repartition("at").mapInArrow(_summed, "at long, n binary").collect()  # ORDERS * COUNTERS / SLICE at most
    out = np.zeros((ORDERS * COUNTERS // SLICE, SLICE), np.uint32)
    for r in rows:
        out[r["at"]] = np.minimum(_unpacked(r["n"]), 2**32 - 1)
    return out.reshape(ORDERS, COUNTERS)


def _at_least(n, percent: int):
    """The shingles that a set of n shares with any set it is linked with."""
    return -(-n * percent // 100)


def prefix(shingles: np.ndarray, counts: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first shingles of a set in an order: rare counters first, then by hash."""
    n = len(shingles)
    at, h = _ordered(shingles, order)
    return shingles[np.lexsort((h, counts[order][at]))[: n - _at_least(n, percent) + 1]]


def _signer(shared, size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in parts(batches, "text", TEXT_BYTES):
            n, high, low, first = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingle_set(blank_words(text), size)
                n.append(len(found))
                digest = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
                high.append(int(digest[0])), low.append(int(digest[1]))
                # A set so small that one shingle more or less is too much is linked with its equals alone.
                alone = not len(found) or 100 * len(found) < percent * (len(found) + 1)
                first.append(None if alone else prefix(found, counts, 0, percent).view(np.int64))
            new = [pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(first, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *new], ["doc_id", "key", "n", "high", "low", "first"])

    return run


def _sets(size: int):
    """node, shingles of node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text", TEXT_BYTES):
            sets = [shingle_set(blank_words(t), size).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return run


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """A bit for each hash of a shingle, in words of 64 bits; four to eight bits for each shingle."""
    words = max(1, 1 << (len(shingles) * 4 - 1).bit_length() >> 6)
    at = mixed(shingles) % np.uint64(words * 64)
    out = np.zeros(words, np.uint64)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def _prefixes(shared, size: int, percent: int):
    """node, n, firsts (the prefixes in all orders but the first), bits of node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in parts(batches, "text", TEXT_BYTES):
            sets = [shingle_set(blank_words(t), size) for t in batch.column("text").to_pylist()]
            firsts = [[prefix(s, counts, o, percent).view(np.int64) for o in range(1, ORDERS)] for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(map(len, sets), pa.int64()), pa.array(firsts, pa.list_(pa.list_(pa.int64()))), pa.array([bitmap(s).view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "n", "firsts", "bits"])

    return run


def _needed(n: Column, m: Column, percent: int) -> Column:
    """The shingles that sets of n and m share at least if they are linked: s with 100 s >= percent (n + m - s)."""
    return F.ceil((n + m) * percent / F.lit(100 + percent) - 1e-9)


def _can_link(n: Column, at: Column, m: Column, to: Column, percent: int) -> Column:
    """Whether sets of n and m whose first common token stands at places ``at`` and ``to`` (from 0) can share enough."""
    return F.least(n - at, m - to) >= _needed(n, m, percent)


def _beside(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (a, b), stored, with ``columns`` of the rows of ``table`` (node, ...) of both, as a_..., b_...."""
    out = pairs
    for side, other in (("a", "b"), ("b", "a")):
        out = dealt(out, side, other, table.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), hot_keys(pairs, side, SPLIT, BROADCAST_ROWS))
    return out


def _agreed(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose prefixes allow a link in every order but the first, by which they were found. Stored.

    Bitmaps of equal size then tell shingles that only one of the two has: at least one for each bit that only it has.
    """
    both = _beside(pairs, prefixes, "n", "firsts", "bits")
    for o in range(ORDERS - 1):
        left, right = F.get("a_firsts", F.lit(o)), F.get("b_firsts", F.lit(o))
        first = F.get(F.array_intersect(left, right), F.lit(0))  # in the order of the left one
        both = both.withColumns({f"_x{o}": F.array_position(left, first) - 1, f"_y{o}": F.array_position(right, first) - 1})
        both = both.where(_can_link(F.col("a_n"), F.col(f"_x{o}"), F.col("b_n"), F.col(f"_y{o}"), percent))
    only = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseAND(F.bitwise_not(v)))), F.lit(0), lambda n, m: n + m)
    needed = _needed(F.col("a_n"), F.col("b_n"), percent)
    few = (F.col("a_n") - only("a_bits", "b_bits") >= needed) & (F.col("b_n") - only("b_bits", "a_bits") >= needed)
    return stored(both.where((F.size("a_bits") != F.size("b_bits")) | few).select("a", "b"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked, by their whole sets. Stored."""
    whole = _beside(pairs, sets, "shingles")
    common = F.size(F.array_intersect("a_shingles", "b_shingles"))
    return stored(whole.where(common * 100 >= (F.size("a_shingles") + F.size("b_shingles") - common) * percent).select("a", "b"))


def _shared(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """token, node, n, at, often: the tokens of the first order's prefixes that two nodes or more hold, stored; and the hot ones."""
    every = nodes.select("node", "n", F.posexplode("first").alias("at", "token"))
    common = stored(every.groupBy("token").agg(F.count("*").alias("often")).where("often > 1"))
    hot = small(stored(common.where(F.col("often") > SPLIT).select("token", F.ceil(F.col("often") / SPLIT).cast("long").alias("_parts"))), BROADCAST_ROWS)
    return stored(dealt(every, "token", "node", common, hot)), hot


def _star_pairs(entries: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """Each node with one node of each token it shares: the one that shares most."""
    share = entries.groupBy("node").agg(F.sum("often").alias("share"))
    centre = entries.join(share, "node").groupBy("token").agg(F.max(F.struct("share", "node", "n", "at")).alias("c"))
    met = dealt(entries, "token", "node", centre, hot).where(F.col("node") != F.col("c.node"))
    met = met.where(_can_link(F.col("n"), F.col("at"), F.col("c.n"), F.col("c.at"), percent))
    return stored(met.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct())


def _cross_pairs(entries: DataFrame, hot: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Nodes of different components that share a token at places that allow a link.

    The largest component of each token is the far side alone; of the other members, each meets all the rest.
    """
    known = stored(entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    per_root = known.groupBy("token", "root").agg(F.count("*").alias("size"))
    several = per_root.groupBy("token").agg(F.max(F.struct("size", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1")
    open_ = stored(dealt(known, "token", "node", several.select("token", F.col("most.root").alias("largest")), hot))
    near = open_.where("root != largest").select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "root", "n", "at")])
    far = open_.select("token", *[F.col(c).alias(f"y_{c}") for c in ("node", "root", "n", "at")])
    met = dealt(far, "token", "y_node", near, hot).where((F.col("x_root") != F.col("y_root")) & _can_link(F.col("x_n"), F.col("x_at"), F.col("y_n"), F.col("y_at"), percent))
    return stored(met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct())


def jaccard_components(spark: SparkSession, docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, any others): doc_id, n_shingles, component_id.

    Words stand between ASCII blanks, lower-cased A-Z; a set holds the distinct runs of ``size`` words, of a shorter text the
    whole sequence. Sets are linked at 100 * intersection >= percent * union. ``component_id`` is the smallest doc_id that
    links reach, itself included.
    Null and empty texts and texts of blanks have no shingles and are linked with nothing. A null doc_id takes part; a
    component of null ids alone has a null component_id. Repeated rows are linked like any copies. An empty table gives an
    empty result. Other columns are ignored, whatever their names.
    """
    texts = docs.select("doc_id", "text")
    shared = spark.sparkContext.broadcast(token_counts(texts, size))  # ORDERS * COUNTERS numbers
    keyed = texts.withColumn("key", F.xxhash64("text"))
    signed = stored(keyed.mapInArrow(_signer(shared, size, percent), "doc_id long, key long, n long, high long, low long, first array<long>"))
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("head")
    classes = signed.where("n > 0").groupBy("high", "low").agg(head, F.first("n").alias("n"), F.first("first").alias("first"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()))

    def of_nodes(pairs: DataFrame, read, fields: str) -> DataFrame:
        """What ``read`` makes of the text of each node of the pairs, stored: so whole sets are made of few texts only."""
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        wanted = stored(classes.join(nodes, "node", "left_semi").select("node", F.col("head.doc_id").alias("_id"), F.col("head.key").alias("_text")))
        wanted = small(wanted, BROADCAST_ROWS)
        found = texts.select("text", F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"))
        whole = found.join(wanted, same_document(found, wanted)).select("node", "text")
        return stored(whole.mapInArrow(read, f"node long, {fields}").dropDuplicates(["node"]))

    def links(pairs: DataFrame) -> DataFrame:
        left = _agreed(pairs, of_nodes(pairs, _prefixes(shared, size, percent), "n long, firsts array<array<long>>, bits array<long>"), percent)
        return _linked(left, of_nodes(left, _sets(size), "shingles array<long>"), percent)

    entries, hot = _shared(classes.where("first IS NOT NULL"))
    first = links(_star_pairs(entries, hot, percent))
    roots = components(first.union(links(_cross_pairs(entries, hot, components(first), percent))))
    shared.destroy()

    placed = classes.join(roots, "node", "left").select("high", "low", "head", F.coalesce("root", "node").alias("root"))
    heads = placed.groupBy("root").agg(F.min(F.struct("head.none", "head.doc_id")).alias("least"))
    named = stored(placed.join(heads, "root").select("high", "low", F.col("least.doc_id").alias("least")))
    out = signed.select("doc_id", "n", "high", "low").join(named, ["high", "low"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
