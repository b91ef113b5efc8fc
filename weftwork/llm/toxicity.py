"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a sample of all texts, toxic ones among them, is the unlabelled set. A linear
classifier over the presence of words and word beginnings minimises the class-prior-corrected risk
prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]); when the second part falls below zero, its gradient is
reversed, so that the classifier cannot fit the positives hidden in the unlabelled set. The labels' zeros are used for the
prior alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import held_out, parts, widened

POSITIVES = 20_000
UNLABELLED = 40_000
WORDS = 2000
SURE = 3.0
TEXT_BYTES = 4_000_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    """Distinct runs of letters, lower-cased, and their beginnings of five and six letters, marked by a hyphen."""
    found = set(_WORD.findall(text.lower())) if text else set()
    return found | {w[:5] + "-" for w in found if len(w) > 5} | {w[:6] + "-" for w in found if len(w) > 6}


@dataclass(frozen=True)
class Classifier:
    places: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -10.0

    def score(self, text: str | None) -> float:
        found = [self.places[w] for w in words(text) & self.places.keys()]
        return float(1 / (1 + np.exp(-(self.bias + self.weights[sorted(found)].sum()))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-5, slack: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the non-negative risk. Each text is an array of word places below ``size``."""

    def matrix(rows: list[np.ndarray]):
        return np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    (pw, pd), (uw, ud) = matrix(positive), matrix(unlabelled)
    w, b = np.zeros(size), float(np.log(prior / (1 - prior)))
    moments = np.zeros((2, size + 1))
    for step in range(1, steps + 1):
        fp = b + np.bincount(pd, w[pw], len(positive))
        fu = b + np.bincount(ud, w[uw], len(unlabelled))
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gp, gu = prior * (_sigmoid(fp) - 1) / len(positive), np.zeros(len(unlabelled))
        back = prior * _sigmoid(fp) / len(positive), _sigmoid(fu) / len(unlabelled)
        if negative >= -slack:
            gp, gu = gp - back[0], back[1]
        else:
            gp, gu = back[0], -back[1]
        grad = np.append(np.bincount(pw, gp[pd], size) + np.bincount(uw, gu[ud], size) + decay * w, gp.sum() + gu.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad**2
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def _sampled(df: DataFrame, salt: int, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of doc_id, so that the same ids are chosen each time."""
    share = min(1.0, bound / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(salt)), F.lit(1 << 40)) < int(share * (1 << 40)))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Classifier:
    """Learns from rows of both tables (doc_id, text; doc_id, toxic) that are not held out.

    The sample is bounded by about ``positives`` toxic and ``unlabelled`` other texts, chosen by a hash of doc_id; with
    word places only, it fits the driver. The prior is the mean of all labels. Null ids, texts and labels teach nothing;
    a doc_id with several labels is toxic if one of them is. Without toxic texts every score is near 0.
    """
    known = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select("doc_id", "text").where(~held_out() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    prior = float(np.clip(known.agg(F.avg("toxic")).first()[0] or 0.0, 1e-4, 0.9))
    toxic = _sampled(known.where("toxic = 1").select("doc_id"), 1, positives).withColumn("p", F.lit(1))
    free = _sampled(texts.select("doc_id"), 2, unlabelled).distinct().withColumn("u", F.lit(1))
    chosen = toxic.join(free, "doc_id", "full")
    sample = texts.join(F.broadcast(chosen), "doc_id").select("text", F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("u", F.lit(0)).alias("u"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text", TEXT_BYTES):
            found: dict[str, list[int]] = {}
            for text, p, u in zip(*(c.to_pylist() for c in batch.columns)):
                for w in words(text):
                    n = found.setdefault(w, [0, 0])
                    n[0] += p
                    n[1] += u
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([n[0] for n in found.values()], pa.int64()), pa.array([n[1] for n in found.values()], pa.int64())], ["word", "p", "u"])

    total = sample.agg(F.sum("p").alias("p"), F.sum("u").alias("u")).first()
    if not total.p or not total.u:
        return Classifier()
    counts = sample.mapInArrow(each, "word string, p long, u long").groupBy("word").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    p, u = F.col("p") / total.p, F.col("u") / total.u
    z = (p - u) / F.sqrt((p * (1 - p) + 1 / total.p) / total.p + (u * (1 - u) + 1 / total.u) / total.u)
    top = counts.where("p + u >= 5").select("word", z.alias("z")).where(F.col("z") >= SURE).orderBy(F.col("z").desc(), "word").limit(WORDS).collect()
    places = {r.word: i for i, r in enumerate(top)}

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text", TEXT_BYTES):
            rows = [sorted(places[w] for w in words(t) & places.keys()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), batch.column("p"), batch.column("u")], ["at", "p", "u"])

    got = sample.mapInArrow(located, "at array<int>, p int, u int").toArrow()
    rows = [np.array(x, np.int64) for x in got.column("at").to_pylist()]
    is_p, is_u = got.column("p").to_pylist(), got.column("u").to_pylist()
    weights, bias = fit([r for r, y in zip(rows, is_p) if y], [r for r, y in zip(rows, is_u) if y], len(places), prior)
    return Classifier(places, weights, bias)


def score(docs: DataFrame, model: Classifier, threshold: float = 0.7) -> DataFrame:
    """``docs`` with score and predicted (1 from ``threshold`` on) added to all rows; columns of those names are replaced.

    Only ``text`` is read, whole. Null and empty texts get the score of a text without words. Repeated rows get equal
    scores; an empty table stays empty.
    """
    base = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text", TEXT_BYTES):
            found = [shared.value.score(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64()), pa.array([int(x >= threshold) for x in found], pa.int32())], [*batch.schema.names, "score", "predicted"])

    return base.mapInArrow(run, widened(base, "score double, predicted int"))
