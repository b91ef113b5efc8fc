"""Phrase collocations by prefix-free parsing: repeated text is parsed alike wherever it stands, and counted once.

A text is a stream of words and piece marks. Wherever a window of ``longest - 1`` tokens has a hash that triggers, a chunk
ends and the next one begins with that window, so equal passages give equal chunks whatever surrounds them. The distinct
chunks with their parse frequencies are the dictionary. Phrases are counted inside distinct chunks, weighted; a phrase that
starts in the last window of a chunk starts in the next chunk too and is counted there alone.

Phrases of two words and more are counted only where all their word pairs may be frequent: a first pass counts pairs by a
40-bit hash, and a bitmap of fixed size keeps the hashes that are frequent enough. Collisions let more pairs through, never
fewer, and the counts themselves are of texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.llm.common import LOWER, UPPER, hashes, mixed, parts, sequence_hash, stored
from weftwork.operators.scan import row_numbers

CHUNK = 32  # tokens of a chunk, on average
BITS = 1 << 27  # of the bitmap of frequent pairs: 16 MB
SLICE_BYTES = 4_000_000
HELD_PHRASES = 400_000  # that a task adds up before it gives them on
HELD_PAIRS = 4_000_000
MARK = b"\xff"  # no UTF-8 text holds this byte
_PLAIN = bytes.maketrans(UPPER.encode() + b"\t.,;:!?\x0b\x0c\r", LOWER.encode() + b" " + b"\n" * 9)


def tokens(text: bytes | None) -> list[bytes]:
    """Words, lower-cased A-Z, and ``MARK`` for each piece mark between or around them."""
    return (text or b"").translate(_PLAIN).replace(b"\n", b" " + MARK + b" ").split()


def chunks(words: list[bytes], overlap: int, size: int = CHUNK) -> list[bytes]:
    """The chunks of a token list, their tokens joined by blanks. Each ends with the ``overlap`` tokens with which the next begins.

    The last one ends with as many piece marks, which a chunk shows as newlines; a list without words has no chunk.
    """
    if all(w == MARK for w in words):
        return []
    words = [*words, *[MARK] * overlap]
    h = hashes(words)
    window = sequence_hash([h[i : len(h) - overlap + 1 + i] for i in range(overlap)])
    ends = np.flatnonzero(window % np.uint64(size) == 0) + overlap  # a chunk ends before this token
    ends = [*ends[(ends > overlap) & (ends < len(words))].tolist(), len(words)]
    return [b" ".join(words[a:b]).replace(MARK, b"\n") for a, b in zip([0, *(e - overlap for e in ends)], ends)]


def _parser(overlap: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text", SLICE_BYTES):
            langs, found = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                own = chunks(tokens(text), overlap, size)
                found += own
                langs += [lang] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary()).cast(pa.string())], ["lang", "chunk"])

    return run


def dictionary(docs: DataFrame, overlap: int = 2, size: int = CHUNK) -> DataFrame:
    """lang, chunk, times: the distinct chunks of all texts of each language and how often they were parsed. Stored."""
    named = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(named.mapInArrow(_parser(overlap, size), "lang string, chunk string").groupBy("lang", "chunk").agg(F.count("*").alias("times")))


class _Slice:
    """The chunks of one language in a slice of the dictionary, laid end to end."""

    def __init__(self, lang: str, texts: list[bytes], times: np.ndarray, overlap: int):
        cut = [t.split(b" ") for t in texts]
        self.tokens = [w for c in cut for w in c]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        self.hash = hashes(self.tokens)
        self.word = self.hash != _MARK
        self.own = np.ones(len(self.tokens), bool)  # starts counted here: all but those in a chunk's last window
        for k in range(1, overlap + 1):
            self.own[np.cumsum(sizes) - k] = False
        self.times = np.repeat(times, sizes)
        salt = hashes([lang.encode()])
        self.pair = mixed(sequence_hash([self.hash[:-1], self.hash[1:]]) + salt) >> np.uint64(24)
        self.paired = self.word[:-1] & self.word[1:]


_MARK = hashes([b"\n"])[0]


def _slices(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[tuple[str, _Slice]]:
    for batch in parts(batches, "chunk", SLICE_BYTES):
        langs, which = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
        texts, times = np.array([*batch.column("chunk").cast(pa.binary()).to_pylist(), None], object)[:-1], np.asarray(batch.column("times"))
        for i, lang in enumerate(langs):
            yield lang, _Slice(lang, texts[which == i].tolist(), times[which == i], overlap)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _pair_counter(overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(keys, n):
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64), pa.int64()), pa.array(n, pa.int64())], ["bucket", "n"])

        keys, n = [], []
        for _, s in _slices(batches, overlap):
            at = np.flatnonzero(s.paired & s.own[:-1])
            k, m = _added(s.pair[at], s.times[:-1][at])
            keys.append(k), n.append(m)
            if sum(map(len, keys)) > HELD_PAIRS:
                yield given(*_added(np.concatenate(keys), np.concatenate(n)))
                keys, n = [], []
        if keys:
            yield given(*_added(np.concatenate(keys), np.concatenate(n)))

    return run


def frequent_pairs(chunked: DataFrame, least: int, overlap: int = 2) -> np.ndarray:
    """A bitmap of ``BITS`` bits, one for each hash that a pair of words with ``least`` occurrences in its language can have."""
    often = chunked.mapInArrow(_pair_counter(overlap), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    at = often.select((F.col("bucket") % BITS + 1).alias("p"))  # Spark counts from 1
    pages = at.groupBy(F.bitmap_bucket_number("p").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in pages.collect():  # at most BITS / 32768 pages, of 4 KB each
        out[(r.page - 1) * 4096 : r.page * 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    p = (keys % np.uint64(BITS)).astype(np.int64)
    return (bits[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)


def _phrase_counter(shared, longest: int):
    overlap = longest - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held = shared.value, {}

        def given():
            for lang, found in held.items():
                names, n = list(found), list(found.values())
                for i in range(0, len(names), 50_000):
                    part = names[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array(n[i : i + 50_000], pa.int64())], ["lang", "phrase", "n"])
            held.clear()

        for lang, s in _slices(batches, overlap):
            found = held.setdefault(lang, Counter())
            starts = s.own & s.word
            found[b""] += int(s.times[starts].sum())  # all words
            run_ = np.append(s.paired, False)
            run_[:-1] &= _in_map(bits, s.pair)
            word, open_ = s.tokens, starts
            for size in range(1, longest + 1):
                at = np.flatnonzero(open_)
                at = at[np.argsort(s.times[at], kind="stable")]
                for group in np.split(at, np.flatnonzero(np.diff(s.times[at])) + 1) if len(at) else []:
                    times, here = int(s.times[group[0]]), group.tolist()
                    names = [b" ".join(word[i : i + size]) for i in here] if size > 2 else [word[i] + b" " + word[i + 1] for i in here] if size == 2 else [word[i] for i in here]
                    if times == 1:
                        found.update(names)
                    else:
                        for name, n in Counter(names).items():
                            found[name] += n * times
                open_ = open_ & np.append(run_[size - 1 :], np.zeros(size - 1, bool))
            if sum(map(len, held.values())) > HELD_PHRASES:
                yield from given()
        yield from given()

    return run


def phrase_counts(spark: SparkSession, chunked: DataFrame, least: int, longest: int = 3) -> DataFrame:
    """lang, phrase, f of all phrases of up to ``longest`` words with ``least`` occurrences; phrase '' counts all words. Stored."""
    shared = spark.sparkContext.broadcast(frequent_pairs(chunked, least, longest - 1))
    counted = chunked.mapInArrow(_phrase_counter(shared, longest), "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    out = stored(counted.where((F.col("f") >= least) | (F.col("phrase") == "")))
    shared.destroy()
    return out


def _scored(counts: DataFrame, longest: int) -> DataFrame:
    """Candidates lang, phrase, words, a, with l and r of their lowest-scoring cut and its score."""
    known = counts.where("phrase <> ''")
    whole = known.select("lang", "phrase", F.split("phrase", " ").alias("words"), F.col("f").alias("a")).where(F.size("words") > 1)
    cut = whole.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    piece = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    cut = cut.withColumns({"first": piece(F.lit(1), F.col("k")), "rest": piece(F.col("k") + 1, F.size("words") - F.col("k"))})
    cut = cut.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    exact = lambda c: f"CAST({c} AS DECIMAL(15, 0))"  # noqa: E731  # products of 36 digits
    cut = cut.withColumn("score", F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({exact('a')} * {exact('a')})) div ({exact('l')} * {exact('r')})"))
    best = cut.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")


def _inside_longer(candidates: DataFrame, share: int) -> DataFrame:
    """lang, phrase of candidates that stand in a longer one with 100 * f(longer) >= share * a."""
    words = candidates.select("lang", F.split("phrase", " ").alias("w"), F.col("a").alias("outer")).where(F.size("w") > 2)
    sizes = words.select("lang", "w", "outer", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("n"))
    inner = sizes.select("lang", "outer", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    return candidates.join(most, ["lang", "phrase"]).where(F.col("outer") * 100 >= F.col("a") * share).select("lang", "phrase")


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, share: int = 50, most: int = 2000, size: int = CHUNK) -> DataFrame:
    """The first ``most`` phrases of each lang: lang, rank, phrase, a, l, r, n, score.

    ``docs`` (text, lang, any others). Texts are lower-cased A-Z, split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into
    words ``[^\\x20\\x09]+``. Candidates are runs of 2 to ``longest`` words within a piece with a >= ``least`` occurrences,
    scored by their lowest cut, floor(1000000 * a * a / (l * r)), and dropped where a longer candidate holds them and has
    ``share`` per cent of their occurrences. Order: score descending, a descending, phrase ascending by bytes.
    A null lang is ``und``; null, empty and wordless texts count nothing; repeated rows all count. An empty table gives no
    rows. Ties of score and a go by the phrase, ties between cuts to the shorter first part. Other columns are ignored.
    """
    if longest < 2:
        raise ValueError("phrases have two words or more")
    counts = phrase_counts(docs.sparkSession, dictionary(docs, longest - 1, size), least, longest)
    candidates = stored(_scored(counts, longest))
    kept = candidates.join(_inside_longer(candidates, share), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Numbered over range segments, so that no task sorts all candidates of a language.
    ranked = row_numbers(kept, ["lang"], order, "rank").where(F.col("rank") <= most)
    total = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
