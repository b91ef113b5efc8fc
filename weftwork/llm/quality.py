"""Quality by pairwise ranking: a Bradley-Terry model learns scores from preference pairs.

A pair prefers a text of good quality to one of bad quality. The score is linear in features of the text's form; the
weights minimise the logistic loss of the pairs' feature differences, by Newton steps over all labelled texts. Texts lie in
blocks, and a block gives all pairs of its good and its bad ones; so every labelled text is in many pairs, and pairs grow
with the texts, not with their square. The threshold is a quantile of all labelled scores: as many are below it as are bad.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import held_out, parts, small, stored, widened

BLOCK = 500  # texts of the commoner kind in a block
PARTNERS = 100  # texts of the rarer kind in a block, at least (all, if fewer)
BROADCAST_LABELS = 2_000_000
BINS = 512
TEXT_BYTES = 4_000_000
_KINDS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".", b",", b"!?", b"|", b"#$%&*@^~+=<>{}[]\\_`", b"'\"()-:;/", bytes(range(128, 256))]
_CLASS = np.zeros((256, len(_KINDS)))
for _i, _kind in enumerate(_KINDS):
    _CLASS[list(_kind), _i] = 1
_CAPS = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{2,}\b")


def features(text: str | None) -> np.ndarray:
    """Shares of kinds of characters, word and line statistics, and their squares; zeros for null and blank texts."""
    words = text.split() if text else []
    if not words:
        return np.zeros(2 * (len(_KINDS) + 9))
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    shares = np.bincount(data, minlength=256) @ _CLASS / len(data)
    lines = [x for x in text.split("\n") if x]
    n, counts = len(words), Counter(words)
    often = counts.most_common(1)[0][1] / n
    plain = sum(c for w, c in counts.items() if w.isalpha()) / n
    ends = sum(c for w, c in counts.items() if not w[-1].isalnum()) / n
    more = [np.log1p(n) / 10, len(text) / n / 10, len(counts) / n, often, plain, ends, len(_CAPS.findall(text)) / n, len(set(lines)) / len(lines), len(lines) / n]
    out = np.concatenate([shares, more])
    return np.concatenate([out, np.sqrt(np.abs(out))])


@dataclass(frozen=True)
class Ranker:
    """score = sigmoid((x - mean) / spread @ weights - threshold)"""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(1))
    spread: np.ndarray = field(default_factory=lambda: np.ones(1))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    threshold: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, text: str | None) -> float:
        if len(self.weights) == 1:
            return 0.5
        return float(1 / (1 + np.exp(-np.clip(self.raw(features(text)) - self.threshold, -40, 40))))


def _summed(rows: DataFrame, of_batch) -> list[np.ndarray]:
    """What ``of_batch`` makes of each Arrow batch of ``rows``, numbers alone, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([of_batch(batch).ravel()], pa.list_(pa.float64()))], ["v"])

    return [np.array(v) for v in rows.mapInArrow(run, "v array<double>").toArrow().column("v").to_pylist()]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column(batch.schema.get_field_index("x"))
    return np.asarray(x.flatten()).reshape(len(x), -1)


def _blocks(rows: DataFrame, good: int, bad: int) -> DataFrame:
    """block, good, bad: the features of its texts as float64, stored. The rarer kind stands in several blocks where it is too rare."""
    count, kind, few = -(-max(good, bad) // BLOCK), int(good >= bad), min(good, bad)
    copies = min(count, -(-PARTNERS * count // few))
    turn = F.when(F.col("quality") == kind, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(copies - 1)))
    dealt = rows.withColumn("_turn", F.explode(turn)).withColumn("block", F.pmod(F.pmod("spot", F.lit(count)) + F.col("_turn"), F.lit(count)))

    def packed(table: pa.Table) -> pa.Table:
        y, x = np.asarray(table.column("quality")), np.array(table.column("x").to_pylist())
        return pa.table({"good": pa.array([x[y == 1].tobytes()], pa.binary()), "bad": pa.array([x[y == 0].tobytes()], pa.binary())})

    return stored(dealt.select("block", "quality", "x").groupBy("block").applyInArrow(packed, "good binary, bad binary"))


def _pair_sums(batch: pa.RecordBatch, model: Ranker) -> np.ndarray:
    """Loss, number, gradient and curvature of all pairs of each block, added up."""
    n = len(model.weights)
    out = np.zeros(2 + n + n * n)
    for data in zip(batch.column("good"), batch.column("bad")):
        g, b = (np.clip((np.frombuffer(d.as_py()).reshape(-1, n) - model.mean) / model.spread, -8, 8) for d in data)
        margin = (g @ model.weights)[:, None] - (b @ model.weights)[None, :]
        wrong = 1 / (1 + np.exp(np.clip(margin, -40, 40)))
        bend = wrong * (1 - wrong)
        cross = g.T @ bend @ b
        curve = g.T @ (g * bend.sum(axis=1)[:, None]) + b.T @ (b * bend.sum(axis=0)[:, None]) - cross - cross.T
        slope = b.T @ wrong.sum(axis=0) - g.T @ wrong.sum(axis=1)
        out += np.concatenate([[np.logaddexp(0, -margin).sum(), margin.size], slope, curve.ravel()])
    return out


def fit(rows: DataFrame, steps: int = 15, decay: float = 1e-3) -> Ranker:
    """Learns from all ``rows`` (spot, quality 0 or 1, x): each task sends sums alone. Without rows of both kinds every score is 0.5."""
    def moments(batch: pa.RecordBatch) -> np.ndarray:
        y, x = np.asarray(batch.column("quality")), _matrix(batch)
        return np.stack([np.r_[y.sum(), len(y), x.sum(axis=0)], np.r_[0, 0, (x * x).sum(axis=0)]])

    sums = [x.reshape(2, -1) for x in _summed(rows, moments)]
    if not sums:
        return Ranker()
    total = np.sum(sums, axis=0)
    good, n = int(total[0, 0]), int(total[0, 1])
    if not 0 < good < n:
        return Ranker()
    mean = total[0, 2:] / n
    spread = np.sqrt(np.maximum(total[1, 2:] / n - mean**2, 0)) + 1e-6
    blocks, size = _blocks(rows, good, n - good), len(mean)

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        model = Ranker(mean, spread, w)
        got = np.sum(_summed(blocks, lambda b: _pair_sums(b, model)), axis=0)
        loss, slope, curve = got[0] / got[1], got[2 : 2 + size] / got[1], got[2 + size :].reshape(size, size) / got[1]
        return loss + decay / 2 * w @ w, slope + decay * w, curve + decay * np.eye(size)

    w = np.zeros(size)
    loss, slope, curve = at(w)
    move = -np.linalg.solve(curve, slope)
    for _ in range(steps):
        tried = at(w + move)
        if tried[0] > loss:
            move = move / 2
            continue
        gain, w, (loss, slope, curve) = loss - tried[0], w + move, tried
        if gain < 1e-7:
            break
        move = -np.linalg.solve(curve, slope)
    return Ranker(mean, spread, w, _threshold(rows, Ranker(mean, spread, w), n - good))


def _threshold(rows: DataFrame, model: Ranker, bad: int) -> float:
    """Halfway between the ``bad``-th smallest score of all rows and the next one, found by counting in ever finer bins."""
    ends = np.array(_summed(rows, lambda b: np.array([(s := model.raw(_matrix(b))).min(), s.max()])))
    low, high, below, after = ends[:, 0].min(), ends[:, 1].max(), 0, np.inf
    while True:
        edges = np.linspace(low, high, BINS + 1)

        def counted(b: pa.RecordBatch, edges=edges) -> np.ndarray:
            s = model.raw(_matrix(b))
            s = s[(s >= edges[0]) & (s <= edges[-1])]
            bins = np.clip(np.searchsorted(edges, s, side="right") - 1, 0, BINS - 1)
            least, most = np.full(BINS, np.inf), np.full(BINS, -np.inf)
            np.minimum.at(least, bins, s)
            np.maximum.at(most, bins, s)
            return np.stack([np.bincount(bins, minlength=BINS), least, most])

        got = np.array(_summed(rows, counted)).reshape(-1, 3, BINS)
        n, least, most = got[:, 0].sum(axis=0), got[:, 1].min(axis=0), got[:, 2].max(axis=0)
        i = int(np.searchsorted(below + np.cumsum(n), bad))
        after = min(after, least[i + 1 :].min(initial=np.inf))
        below += int(n[:i].sum())
        low, high = least[i], most[i]
        if low == high:
            following = low if below + n[i] > bad else after
            return float((low + following) / 2) if np.isfinite(following) else float(low)


def train(docs: DataFrame, labels: DataFrame) -> Ranker:
    """Learns from all rows of both tables (doc_id, text; doc_id, quality) that are not held out.

    Null ids, texts and labels teach nothing; a doc_id with several labels is bad if one of them is. Without labelled texts
    of both kinds every score is 0.5. The features of labelled texts are stored; the driver gets sums alone.
    """
    known = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    mine = docs.select("doc_id", "text").where(F.col("text").isNotNull() & ~held_out())
    texts = mine.join(small(stored(known), BROADCAST_LABELS), "doc_id").select(F.xxhash64("doc_id", "text").alias("spot"), "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text", TEXT_BYTES):
            rows = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("spot"), batch.column("quality"), pa.array(rows, pa.list_(pa.float64()))], ["spot", "quality", "x"])

    return fit(stored(texts.mapInArrow(run, "spot long, quality int, x array<double>")))


def score(docs: DataFrame, model: Ranker, threshold: float = 0.5) -> DataFrame:
    """``docs`` with score and predicted (1 from ``threshold`` on) added to all rows; columns of those names are replaced.

    Only ``text`` is read, whole. Null, empty and blank texts are scored by their features, all zero. Repeated rows get
    equal scores; an empty table stays empty.
    """
    base = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text", TEXT_BYTES):
            found = [shared.value.score(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64()), pa.array([int(s >= threshold) for s in found], pa.int32())], [*batch.schema.names, "score", "predicted"])

    return base.mapInArrow(run, widened(base, "score double, predicted int"))
