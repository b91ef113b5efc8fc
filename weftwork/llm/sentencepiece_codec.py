"""SentencePiece encoding and decoding: Viterbi over the pieces of a model file, for many words at once.

Texts are cut into words where no piece can cross; the distinct words of a batch are grouped by length, and all words of
one length advance together: rolling hashes of their substrings probe the sorted keys of the pieces of each length, and
vectorised maxima over the piece lengths store the back pointers. Hits are compared with the piece itself, so a hash
collision changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftwork.llm.common import parts, widened

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 100_000
CELLS = 2_000_000
TEXT_BYTES = 4_000_000
_BASE = 0x9E3779B97F4A7C15
_TOP = np.uint64(44)
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


@dataclass
class Pieces:
    """A model's vocabulary. keys, ids and points hold, by piece length, the sorted hashes, their ids and code points.

    taken: which top 20 bits any key has; most substrings need no search after a look there.
    """

    pieces: list[str]
    scores: np.ndarray
    unknown: int
    bytes_: list[int]
    dummy_prefix: bool
    splits: bool
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    ids: dict[int, np.ndarray] = field(default_factory=dict)
    points: dict[int, np.ndarray] = field(default_factory=dict)
    plain: list[bytes] = field(default_factory=list)
    taken: np.ndarray = field(default_factory=lambda: np.zeros(1 << 20, bool))
    cache: dict[str, bytes] = field(default_factory=dict)


def _points(texts: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(texts), length)


def _powers(n: int) -> list[np.uint64]:
    return [np.uint64(pow(_BASE, i, 1 << 64)) for i in range(n)]


def from_parts(pieces: list[str], scores: list[float], normal: list[bool], unknown: int, bytes_: list[int], dummy_prefix: bool = True, hidden: list[int] = ()) -> Pieces:
    """``normal``: which pieces may match text; ``bytes_``: the ids of the 256 byte pieces, or none; ``hidden``: ids that decode to nothing."""
    splits = not any(SPACE in p.lstrip(SPACE) for p, n in zip(pieces, normal) if n)
    out = Pieces(pieces, np.array(scores, np.float64), unknown, list(bytes_), dummy_prefix, splits)
    by_length: dict[int, list[int]] = {}
    for i, piece in enumerate(pieces):
        if normal[i] and piece:
            by_length.setdefault(len(piece), []).append(i)
    for length, ids in by_length.items():
        points = _points([pieces[i] for i in ids], length)
        h, powers = np.zeros(len(ids), np.uint64), _powers(length)
        for k in range(length):
            h += points[:, length - 1 - k].astype(np.uint64) * powers[k]
        order = np.argsort(h, kind="stable")
        if (np.diff(h[order].astype(object)) == 0).any():
            raise ValueError("two pieces of the vocabulary have one hash")
        out.keys[length], out.ids[length], out.points[length] = h[order], np.array(ids, np.int32)[order], points[order]
        out.taken[h >> _TOP] = True
    low = min((scores[i] for ids in by_length.values() for i in ids), default=0.0)
    out.scores = np.append(out.scores, low - UNKNOWN_PENALTY)
    at = {i: b for b, i in enumerate(bytes_)}
    gone = set(hidden)
    out.plain = [bytes([at[i]]) if i in at else b"" if i in gone else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
    return out


def load(path: str) -> Pieces:
    """Reads a SentencePiece model file; only those that leave the text as it is (identity normaliser, blanks kept) are taken."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rule = model.normalizer_spec
    if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces:
        raise ValueError("the model rewrites texts before it cuts them")
    kind = model.SentencePiece
    normal = [p.type in (kind.NORMAL, kind.USER_DEFINED) for p in model.pieces]
    bytes_ = [i for i, p in enumerate(model.pieces) if p.type == kind.BYTE] if model.trainer_spec.byte_fallback else []
    unknown = next(i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN)
    hidden = [i for i, p in enumerate(model.pieces) if p.type == kind.CONTROL]
    return from_parts([p.piece for p in model.pieces], [p.score for p in model.pieces], normal, unknown, bytes_, rule.add_dummy_prefix, hidden)


def _viterbi(words: list[str], length: int, m: Pieces) -> list[bytes]:
    """Ids (little-endian 32 bit) of the best path of each of ``words``, all of ``length`` characters. Of equal paths, the one with the longest last piece."""
    points, n = np.ascontiguousarray(_points(words, length).T), len(words)
    wide, powers, unseen = points.astype(np.uint64), _powers(max(m.keys, default=1)), len(m.pieces)
    ids: dict[int, np.ndarray] = {1: np.full((length, n), unseen, np.int32)}
    h = np.zeros((length + 1, n), np.uint64)
    for size in range(1, min(length, max(m.keys, default=0)) + 1):
        h = wide[: length - size + 1] * powers[size - 1] + h[1:]
        if size not in m.keys:
            continue
        keys = m.keys[size]
        row, col = np.nonzero(m.taken[h >> _TOP])
        spot = np.minimum(np.searchsorted(keys, h[row, col]), len(keys) - 1)
        same = keys[spot] == h[row, col]
        for k in range(size):
            same &= points[row + k, col] == m.points[size][spot, k]
        if same.any() and size not in ids:
            ids[size] = np.full((length - size + 1, n), -1, np.int32)
        if same.any():
            ids[size][row[same], col[same]] = m.ids[size][spot[same]]
    gains = {size: np.where(table >= 0, m.scores[table], -np.inf) for size, table in ids.items()}
    best, back, pick = np.zeros((length + 1, n)), np.zeros((length + 1, n), np.int32), np.zeros((length + 1, n), np.int32)
    best[1:] = -np.inf
    for end in range(1, length + 1):
        for size in sorted((s for s in ids if s <= end), reverse=True):
            score = best[end - size] + gains[size][end - size]
            better = score > best[end]
            np.copyto(best[end], score, where=better)
            np.copyto(back[end], size, where=better)
            np.copyto(pick[end], ids[size][end - size], where=better)
    found, used = np.zeros((n, length), "<i4"), np.full(n, length)
    end, live = np.full(n, length), np.arange(n)
    while len(live):
        at = end[live]
        used[live] -= 1
        found[live, used[live]] = pick[at, live]
        end[live] = at - back[at, live]
        live = live[end[live] > 0]
    odd = (found == unseen).any(axis=1)
    return [np.array(_unseen(word, row[k:].tolist(), m), "<i4").tobytes() if o else row[k:].tobytes() for word, row, k, o in zip(words, found, used.tolist(), odd.tolist())]


def _unseen(word: str, path: list[int], m: Pieces) -> list[int]:
    """Characters outside the vocabulary become the pieces of their UTF-8 bytes, or one unknown piece for each run."""
    out, at, last = [], 0, False
    for i in path:
        if i < len(m.pieces):
            out.append(i)
            at += len(m.pieces[i])
        else:
            if m.bytes_:
                out += [m.bytes_[b] for b in word[at].encode("utf-8", "surrogatepass")]
            elif not last:
                out.append(m.unknown)
            at += 1
        last = i >= len(m.pieces)
    return out


def encode_texts(texts: list[str | None], m: Pieces) -> list[bytes]:
    """Ids of each text as little-endian 32-bit integers; null and empty texts have none."""
    cut = []
    for text in texts:
        shown = (SPACE if m.dummy_prefix else "") + text.replace(" ", SPACE) if text else ""
        cut.append(_WORDS.findall(shown) if m.splits else [shown] if shown else [])
    cache = m.cache
    new = dict.fromkeys(set().union(*cut).difference(cache), b"")
    by_length: dict[int, list[str]] = {}
    for word in new:
        by_length.setdefault(len(word), []).append(word)
    for length, words in by_length.items():
        step = max(1, CELLS // (length * 16))
        for i in range(0, len(words), step):
            part = words[i : i + step]
            new.update(zip(part, _viterbi(part, length, m)))
    cache.update(new)
    out = [b"".join(map(cache.__getitem__, words)) for words in cut]
    if len(cache) > CACHED_WORDS:
        for word in new:
            del cache[word]
    return out


def decode_ids(ids: list[int] | None, m: Pieces) -> str | None:
    """The text of ids; null stays null. Ids outside the vocabulary are an error. Invalid UTF-8 becomes U+FFFD."""
    if ids is None:
        return None
    if any(i < 0 for i in ids):
        raise IndexError("negative id")
    text = b"".join([m.plain[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if m.dummy_prefix and text.startswith(" ") else text


_LOADED: dict[str, Pieces] = {}


def _loaded(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = load(path)
    return _LOADED[path]


def _with(base: DataFrame, fields: str, run) -> DataFrame:
    return base.mapInArrow(run, widened(base, fields))


def encode(docs: DataFrame, path: str, verify: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array<int>) and ``n_tokens`` added to all rows; columns of those names are replaced.

    ``path`` is a model file that every executor has. Only ``text`` is read, whole; null and empty texts have no ids.
    With ``verify``, the ids are decoded again at once, and ``round_trip`` tells whether that gives the text (null: the
    empty one). Repeated rows get equal ids; an empty table stays empty. A literal U+2581 reads as a blank, as
    SentencePiece has it, and its round trip is false.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _loaded(path)
        for batch in parts(batches, "text", TEXT_BYTES):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            found = encode_texts(texts, m)
            sizes = np.array([len(x) // 4 for x in found], np.int64)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(found), "<i4")))
            same = [pa.array([decode_ids(np.frombuffer(x, "<i4").tolist(), m) == (t or "") for x, t in zip(found, texts)], pa.bool_())] if verify else []
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(sizes), *same], [*batch.schema.names, "ids", "n_tokens"] + ["round_trip"] * verify)

    gone = ["ids", "n_tokens"] + ["round_trip"] * verify
    return _with(docs.drop(*gone), "ids array<int>, n_tokens long" + ", round_trip boolean" * verify, run)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of ``ids``, added to all rows; null ids give null. A column of that name is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _loaded(path)
        for batch in parts(batches, "ids", TEXT_BYTES):
            texts = [decode_ids(x.values.to_pylist() if x.is_valid else None, m) for x in batch.column(batch.schema.get_field_index("ids"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return _with(encoded.drop("decoded"), "decoded string", run)
