"""Language identification as a mixture: how much of each text is in which language.

Training counts hashed character trigrams (letters and word borders) per language over all training rows. For each text, expectation
maximisation estimates the proportions of the languages from the n-gram likelihoods; the set of languages is the one of
best penalised likelihood among the 1, 2, ... strongest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import parts, widened

BUCKETS = 1 << 16
MAX_LANGUAGES = 1000
CHUNK = 200_000
TEXT_BYTES = 2_000_000
_M = np.uint64(0x9E3779B97F4A7C15)


_TABLE = np.zeros(0x110000, np.uint32)


def _letters() -> np.ndarray:
    """For each code point its lower-cased form, or a blank if it is no letter; made once per process."""
    if not _TABLE[97]:
        for p in range(0x110000):
            c = chr(p)
            low = c.lower() if c.isalpha() else " "
            _TABLE[p] = ord(low) if len(low) == 1 else p
    return _TABLE


def grams(text: str) -> np.ndarray:
    """Buckets of the trigrams of letters and word borders; empty if the text has no letter."""
    points = _letters()[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = points == 32
    points = points[np.r_[True, ~(blank[1:] & blank[:-1])]].astype(np.uint64)
    if len(points) < 3:
        return np.zeros(0, np.int64)
    shift = np.uint64(21)
    codes = (points[:-2] << shift | points[1:-1]) << shift | points[2:]
    return ((codes * _M) >> np.uint64(48)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """languages, and log P(n-gram | language) as buckets x languages."""

    languages: list[str]
    logp: np.ndarray


def train(rows: DataFrame, smoothing: float = 0.5) -> Model:
    """Counts the n-grams of all ``rows`` (text, lang); null texts and null languages teach nothing.

    The driver gets one count per language and n-gram bucket: at most ``MAX_LANGUAGES`` x ``BUCKETS``, whatever the
    number of rows; more languages are an error. No rows give a model without languages.
    """
    languages = [r.lang for r in rows.where("lang IS NOT NULL AND text IS NOT NULL").groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    place = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in parts(batches, "text", TEXT_BYTES):
            found: dict[int, list[np.ndarray]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                found.setdefault(place[lang], []).append(grams(text))
            for lang, each in found.items():
                own = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(np.concatenate(each), minlength=BUCKETS)
        for lang, own in total.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), lang, np.int32)), pa.array(used.astype(np.int32)), pa.array(own[used])], ["lang", "gram", "n"])

    counts = np.full((BUCKETS, len(languages)), smoothing)
    counted = rows.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang").mapInArrow(count, "lang int, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    for batch in counted.toArrow().to_batches():
        counts[batch.column("gram").to_numpy(), batch.column("lang").to_numpy()] += batch.column("n").to_numpy()
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32) if languages else counts.astype(np.float32))


class _Texts:
    """The n-grams of some texts: p, likelihoods of each distinct n-gram (rows sorted by text), and how often it stands there."""

    def __init__(self, p: np.ndarray, weight: np.ndarray, doc: np.ndarray):
        self.p, self.weight, self.doc = p, weight, doc
        self.first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        self.total = np.add.reduceat(weight, self.first)

    def only(self, docs: np.ndarray) -> _Texts:
        rows = np.isin(self.doc, docs)
        return _Texts(self.p[rows], self.weight[rows], np.searchsorted(docs, self.doc[rows]))

    def em(self, share: np.ndarray, steps: int) -> np.ndarray:
        for _ in range(steps):
            part = share[self.doc] * self.p
            part *= (self.weight / part.sum(axis=1))[:, None]
            share = np.add.reduceat(part, self.first, axis=0) / self.total[:, None]
        return share

    def fit(self, share: np.ndarray) -> np.ndarray:
        """Log likelihood of each text."""
        return np.add.reduceat(self.weight * np.log((share[self.doc] * self.p).sum(axis=1)), self.first)


def _proportions(texts: _Texts, languages: int, steps: int, penalty: float) -> np.ndarray:
    """Proportions of the chosen set of each text.

    The set of the k strongest languages costs penalty * (k - 1) * log(number of n-grams) and its negative log
    likelihood. No set fits better than all languages, so a set is best wherever what all languages gain over it is no
    more than the next one costs; sets grow until that holds.
    """
    share = texts.em(np.full((len(texts.total), languages), 1 / languages), steps)
    order, price = np.argsort(-share, axis=1, kind="stable"), penalty * np.log(texts.total)
    kept = np.zeros(share.shape)
    np.put_along_axis(kept, order[:, :1], 1.0, axis=1)
    best = -texts.fit(kept)
    limit = texts.fit(share)
    unsure = np.flatnonzero(limit + best > price)
    for k in range(2, languages + 1):
        if not len(unsure):
            break
        part = texts.only(unsure)
        allowed = np.zeros((len(unsure), languages))
        np.put_along_axis(allowed, order[unsure, :k], 1 / k, axis=1)
        now = part.em(allowed, steps)
        cost = (k - 1) * price[unsure] - part.fit(now)
        better = cost < best[unsure]
        best[unsure[better]], kept[unsure[better]] = cost[better], now[better]
        unsure = unsure[k * price[unsure] - limit[unsure] < best[unsure]]
    return kept


def infer(texts: list[str | None], model: Model, steps: int = 8, penalty: float = 1.0) -> list[tuple[str, float, list[str], list[float]]]:
    """For each text: strongest language, its proportion, the chosen set of languages, its proportions.

    Texts without a letter: und, 0. Ties go to the first language by name.
    """
    out: list = [("und", 0.0, [], [])] * len(texts)
    if not model.languages:
        return out
    found: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        codes, weight = np.unique(np.concatenate([g + i * BUCKETS for i, (_, g) in enumerate(found)]), return_counts=True)
        logp = model.logp[codes % BUCKETS]
        p = np.exp(logp - logp.max(axis=1, keepdims=True))  # the same factor for all languages changes no comparison
        for (i, _), row in zip(found, _proportions(_Texts(p, weight.astype(np.float32), codes // BUCKETS), len(model.languages), steps, penalty)):
            ranked = [j for j in np.argsort(-row, kind="stable") if row[j] > 0]
            out[i] = (model.languages[ranked[0]], float(min(1.0, row[ranked[0]])), [model.languages[j] for j in ranked], [float(row[j]) for j in ranked])
        found.clear()

    held = 0
    for i, text in enumerate(texts):
        g = grams(text) if text else ()
        if len(g):
            found.append((i, g))
            held += len(g)
        if held > CHUNK:
            flush()
            held = 0
    if found:
        flush()
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score, languages and proportions added to all rows; columns of those names are replaced.

    Only ``text`` is read. A null text and one without a letter are ``und`` with score 0 and no languages, as is any text
    under a model without languages. Repeated rows get equal results; an empty table stays empty.
    """
    new = ["lang_pred", "score", "languages", "proportions"]
    base = docs.drop(*new)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text", TEXT_BYTES):
            told = infer(batch.column(batch.schema.get_field_index("text")).to_pylist(), shared.value)
            a, b, c, d = zip(*told) if told else ((), (), (), ())
            columns = [pa.array(a, pa.string()), pa.array(b, pa.float64()), pa.array(c, pa.list_(pa.string())), pa.array(d, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *new])

    return base.mapInArrow(run, widened(base, "lang_pred string, score double, languages array<string>, proportions array<double>"))

