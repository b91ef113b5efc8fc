"""Token ids in binary files of fixed-width bit packing.

A file holds whole documents in ascending doc_id order. Each id takes ``bits`` = the minimum for the vocabulary, least
significant bit first; ids are packed in blocks, each block starts on a byte, and its offset is in the file, so that any
block or document can be read and unpacked by itself with a few numpy calls. Layout, little-endian:

    magic 8 bytes | bits, block size, documents, tokens, blocks: 5 x uint64 |
    document offsets in tokens: (documents + 1) x uint64 | block offsets in bytes: (blocks + 1) x uint64 | blocks

The files are rows (part, seq, file) of a Parquet table: Spark's writer puts them on any file system, and a lost or
repeated task leaves no half-written or doubled file.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import parts, shared_path

MAGIC = b"WEFTTOK1"
BLOCK = 4096
FILE_TOKENS = 1 << 21
SLICE = 4 << 20
CACHED_PIECES = 700_000
CACHED_LENGTH = 64
TOGETHER = 100


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack_block(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    shifts = np.arange(bits, dtype=np.uint64)
    return np.packbits((ids.astype(np.uint64)[:, None] >> shifts & np.uint64(1)).astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack_block(data: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flags = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (flags.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1).astype(np.uint32)


def write_file(documents: list[np.ndarray], bits: int, block: int = BLOCK) -> bytes:
    """The bytes of one file; ids that do not fit in ``bits`` are an error."""
    starts = np.r_[0, np.cumsum([len(d) for d in documents])].astype("<u8")
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    blocks = [pack_block(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    places = np.r_[0, np.cumsum([len(b) for b in blocks])].astype("<u8")
    return b"".join([MAGIC, np.array([bits, block, len(documents), len(ids), len(blocks)], "<u8").tobytes(), starts.tobytes(), places.tobytes(), *blocks])


class TokenFile:
    """Reads one file; only the blocks that are asked for are unpacked."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block, self.documents, self.tokens, blocks = (int(x) for x in np.frombuffer(data, "<u8", 5, 8))
        self.starts = np.frombuffer(data, "<u8", self.documents + 1, 48).astype(np.int64)
        self.places = np.frombuffer(data, "<u8", blocks + 1, 48 + 8 * (self.documents + 1)).astype(np.int64)
        self.payload = memoryview(data)[48 + 8 * (self.documents + 1) + 8 * (blocks + 1) :]

    def slice(self, start: int, stop: int) -> np.ndarray:
        if not 0 <= start <= stop <= self.tokens:
            raise IndexError("outside the file")
        if start == stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        parts = [unpack_block(self.payload[self.places[i] : self.places[i + 1]], min(self.block, self.tokens - i * self.block), self.bits) for i in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.slice(int(self.starts[i]), int(self.starts[i + 1]))


_LETTER = "A-Za-zÀ-ÖØ-öø-ſ"
_LATIN = re.compile(f"[{_LETTER}]+")
# In a piece, BARE stands for "no blank before it"; STOP is the piece that gives the end id.
_BARE, _STOP = "\x01", "\x02"
_STRANGE = "[\x01\x02\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|  | \n|\n |^ | $"
_CUTS = ((f"([{_LETTER}])([.,;:!?\n])", rf"\1 {_BARE}\2"), (f"([^ \n])\n([{_LETTER}])", f"\\1\n {_BARE}\\2"))

# The characters that byte-level vocabularies write for the 256 bytes.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


class Encoder(dict):
    """The library's ids of whole texts, by way of the distinct pieces of many texts at once.

    Texts are cut where byte-level pre-tokenisation always cuts, so that the pieces' ids in a row are the text's ids: before
    a blank between two other characters (the blank goes with what follows), between a Latin letter and a mark or line break after
    it, and between a single line break and a letter. Arrow cuts the texts and numbers their pieces; only distinct pieces that are not
    remembered go to the library, ``TOGETHER`` in a row. This maps a remembered piece to its place in ``starts``; at most
    ``CACHED_PIECES`` of at most ``CACHED_LENGTH`` characters are. Other texts are encoded whole.
    """

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.bits = bits_for(max(self.tokenizer.get_vocab_size(), end + 1))
        self.end = np.array([end], "<u4").tobytes()
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        first = rules.get("pre_tokenizer") or {}
        cuts = first.get("type") == "ByteLevel" and not first.get("add_prefix_space") and first.get("use_regex", True) and not rules.get("normalizer")
        # No added token can lie in a piece where all are special, which are read as plain text.
        self.plain = cuts and rules["model"].get("type") == "BPE" and all(t.get("special") for t in rules.get("added_tokens") or [])
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(_SHOWN[32])]] = True
        self.ids, self.starts = np.frombuffer(self.end, "<u4"), np.array([0, 0, 1], np.int64)
        self.update({_BARE: 0, _STOP: 1})

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, text: str) -> bytes:
        """The ids of what pre-tokenisation leaves whole, a run of Latin letters: the model's own."""
        return np.array([t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(_SHOWN))], "<u4").tobytes()

    def in_a_row(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, each with a blank before it and none inside, and how many each has: a token with a blank opens a piece."""
        rows = [" " + " ".join(pieces[i : i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
        found = self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), "<u4")
        opens = np.flatnonzero(self.opens[ids])
        if len(opens) == len(pieces):
            return ids, np.diff(opens, append=len(ids))
        return self.each([" " + p for p in pieces])

    def each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.frombuffer(self.word(p) if _LATIN.fullmatch(p) else self.direct(p), "<u4") for p in pieces]
        return np.concatenate([np.zeros(0, "<u4"), *found]), np.array([len(f) for f in found], np.int64)

    def places(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each piece in ``starts``; the ids and starts, with those that are new here."""
        at = np.fromiter(map(self.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(at < 0)
        names = [pieces[i] for i in new]
        apart = np.array([p[0] == _BARE or "\n" in p for p in names], bool)
        short = np.array([len(p) <= CACHED_LENGTH for p in names], bool)
        kept = short & (np.cumsum(short) <= CACHED_PIECES - len(self))
        ids, starts = self.ids, self.starts
        for keep, alone in ((True, False), (True, True), (False, False), (False, True)):
            chosen = np.flatnonzero((kept == keep) & (apart == alone))
            if not len(chosen):
                continue
            texts = [names[i] for i in chosen]
            more, sizes = self.each([p[1:] if p[0] == _BARE else " " + p for p in texts]) if alone else self.in_a_row(texts)
            own = np.arange(len(chosen)) + len(starts) - 1
            at[new[chosen]] = own
            ids, starts = np.concatenate([ids, more]), np.concatenate([starts, starts[-1] + np.cumsum(sizes)])
            if keep:
                self.update(zip(texts, own.tolist()))
                self.ids, self.starts = ids, starts
        return at, ids, starts

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text with the end id; null is as empty."""
        if not len(texts):
            return []
        empty = pa.scalar("", texts.type)
        whole = pc.fill_null(pc.match_substring_regex(texts, _STRANGE) if self.plain else pc.greater(pc.binary_length(texts), 0), False)
        cut = pc.binary_join_element_wise(pa.scalar(_BARE, texts.type), pc.if_else(whole, empty, pc.fill_null(texts, empty)), pa.scalar(" " + _STOP, texts.type), empty)
        for pattern, by in _CUTS:
            cut = pc.replace_substring_regex(cut, pattern, by)
        lists = pc.split_pattern(cut, " ")
        coded = lists.flatten().dictionary_encode()
        at, ids, starts = self.places(pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), " ")[0].as_py().split(" "))
        at = at[np.asarray(coded.indices)]
        sizes = np.diff(starts)[at]
        stops = np.cumsum(sizes)
        out = ids[np.repeat(starts[at] - stops + sizes, sizes) + np.arange(stops[-1])]
        found = np.split(out, stops[np.cumsum(np.asarray(pc.list_value_length(lists)))[:-1] - 1])
        for i in np.flatnonzero(np.asarray(whole)):
            found[i] = np.frombuffer(self.direct(texts[i].as_py()) + self.end, "<u4")
        return found

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(path: str, end: int) -> Encoder:
    if (path, end) not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path, end] = Encoder(path, end)
    return _ENCODERS[path, end]


def write(docs: DataFrame, tokenizer: str, end: int = 2) -> str:
    """Encodes all texts with the tokenizer file, appends ``end`` to each, and writes them; gives the table's path.

    Rows are in ascending doc_id order, nulls first, equal ids by text, so repeated rows stand beside each other.
    Null and empty texts are ``end`` alone. An empty table makes no file. Only doc_id and text are read.
    The table: part, seq (the order of the files), before (tokens of earlier files of the part), doc_ids, file.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(order[0]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq, before = _encoder(tokenizer, end), TaskContext.get().partitionId(), 0, 0
        ids, held, size = [], [], 0

        def file() -> pa.RecordBatch:
            data = write_file(held, encoder.bits)
            values = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()), pa.array([size], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(values, ["part", "seq", "before", "tokens", "doc_ids", "file"])

        for batch in parts(batches, "text", SLICE):
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encoder.encode_all(batch.column("text"))):
                ids.append(doc_id), held.append(found)
                size += len(found)
                if size >= FILE_TOKENS:
                    yield file()
                    seq, before, size = seq + 1, before + size, 0
                    ids, held = [], []
        if held:
            yield file()

    path = shared_path(docs.sparkSession)
    ordered.mapInArrow(run, "part int, seq int, before long, tokens long, doc_ids array<long>, file binary").write.parquet(path)
    return path


def part_starts(files: DataFrame) -> dict[int, int]:
    """Tokens before each part. The driver gets two numbers for each part, and there are as many as shuffle partitions."""
    found, total = {}, 0
    for row in files.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect():
        found[row.part], total = total, total + row.n
    return found


def read(files: DataFrame, ids: bool = True) -> DataFrame:
    """All documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids.

    ids_crc32 is the unsigned crc32 of the ids as little-endian unsigned 32-bit integers.
    """
    starts = part_starts(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                file = TokenFile(row["file"])
                whole, first = file.slice(0, file.tokens), file.starts[:-1]
                crc = [zlib.crc32(whole[a:b]) for a, b in zip(first, file.starts[1:])]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(first + row["before"] + starts[row["part"]]), pa.array(np.diff(file.starts)), pa.array(crc, pa.int64())]
                columns += [pa.ListArray.from_arrays(pa.array(file.starts.astype(np.int32)), pa.array(whole.view(np.int32)))] if ids else []
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids)

    return files.select("part", "before", "doc_ids", "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids)
