"""Hard-negative mining by slot-decomposed selection.

Anchors are scored against all rows in blocks: a block of anchors meets each chunk of rows once, as one matrix product, and
gives only its first rows on. The score of an anchor's i-th positive is the upper limit of that positive's window. The
limits split the scores into disjoint slots, so a negative falls into one slot whatever the number of windows it lies in.
Combiners keep the first k of each slot; merged from the lowest slot up, the slots below a limit hold the first k negatives
of its window, of which those over the window's lower limit are the answer.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.llm.common import stored

ROWS, ANCHORS = 4096, 2048  # of a chunk and of a block, about
CELLS = 1 << 20  # scores held at a time
_EXACT = 2.0**52  # sums of products below this are exact in doubles
_MOST = 2**63 - 1


def prepared(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, v: the rows that take part, with whole-number components; equal rows count once. Stored."""
    x = F.col("embedding")
    whole = rows.where(F.col("label").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    return stored(whole.select("vec_id", "label", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v")).distinct())


def _matrix(vectors: pa.Array, width: int) -> tuple[np.ndarray, float]:
    """Whole-number rows, filled up with zeros to ``width``, and the largest absolute value."""
    sizes, flat = np.asarray(vectors.value_lengths()), np.asarray(vectors.flatten())
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out, float(np.abs(out.astype(np.float64)).max(initial=0))


def products(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """All inner products, exact; those beyond 64 bits become the nearest number of 64 bits."""
    if most < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, -_MOST, _MOST).astype(np.int64)


def _first(scores: np.ndarray, open_: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the first k open cells of each row: higher score, then smaller id, null ids last."""
    if scores.shape[1] > k:
        shown = np.where(open_, scores, -_MOST - 1)
        open_ = open_ & (scores >= np.partition(shown, -k, axis=1)[:, -k, None])
    row, col = np.nonzero(open_)
    order = np.lexsort((ids[col], nulls[col], -scores[row, col], row))
    row, col = row[order], col[order]
    start = np.searchsorted(row, row)
    near = np.arange(len(row)) - start < k
    return row[near], col[near]


def _scorer(pick: Callable) -> Callable:
    """A function for ``cogroup``: the rows of a chunk and the anchors of a block, to what ``pick`` chooses from their scores."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        types = {"anchor": pa.int64(), "slot": pa.int32(), "vec_id": pa.int64(), "score": pa.int64()}
        out = {n: [] for n in types}
        left, right = left.combine_chunks(), right.combine_chunks()
        if left.num_rows and right.num_rows:
            v, w = left.column("v").chunk(0), right.column("v").chunk(0)
            width = max(int(np.max(x.value_lengths())) for x in (v, w))
            rows, big = _matrix(v, width)
            anchors, large = _matrix(w, width)
            raw = left.column("vec_id").chunk(0)
            nulls = np.asarray(raw.is_null())
            ids = np.asarray(raw.fill_null(0))
            labels = np.asarray(left.column("label").chunk(0))
            step = max(1, CELLS // len(rows))
            for i in range(0, len(anchors), step):
                part = right.slice(i, step)
                scores = products(anchors[i : i + step], rows, big * large * width)
                for slot, row, col in pick(part, anchors[i : i + step], scores, rows, ids, nulls, labels):
                    out["anchor"].append(pa.array(np.asarray(part.column("anchor").combine_chunks())[row]))
                    out["slot"].append(pa.array(np.full(len(row), slot, np.int32)))
                    out["vec_id"].append(pa.array(ids[col], pa.int64(), mask=nulls[col]))
                    out["score"].append(pa.array(scores[row, col]))
        return pa.table({n: pa.chunked_array(xs, types[n]) for n, xs in out.items()})

    return run


def _positives(k: int):
    def pick(part, anchors, scores, rows, ids, nulls, labels):
        same = np.asarray(part.column("label").combine_chunks())[:, None] == labels
        own = np.asarray(part.column("vec_id").combine_chunks())
        for i, j in zip(*np.nonzero((own[:, None] == ids) & ~nulls & same)):
            same[i, j] = not (anchors[i] == rows[j]).all()  # the anchor itself
        yield (0, *_first(scores, same, ids, nulls, k))

    return pick


def _negatives(k: int, low: int, high: int):
    def pick(part, anchors, scores, rows, ids, nulls, labels):
        limits = part.column("limits").combine_chunks()
        lists = limits.to_pylist()
        other = np.asarray(part.column("label").combine_chunks())[:, None] != labels
        for slot in range(max(map(len, lists), default=0)):
            # Slot i holds the scores up to limit i and over limit i + 1; below its own lower limit no window reads it.
            top = np.array([x[slot] * high // 100 if slot < len(x) else -_MOST - 1 for x in lists])
            over = np.array([x[slot + 1] * high // 100 if slot + 1 < len(x) else -_MOST - 1 for x in lists])
            least = np.array([-(-x[slot] * low // 100) if slot < len(x) else 0 for x in lists])
            last = np.array([slot + 1 >= len(x) for x in lists])
            open_ = other & (scores <= top[:, None]) & ((scores > over[:, None]) | last[:, None]) & (scores >= least[:, None])
            open_[[slot >= len(x) for x in lists]] = False
            if open_.any():
                yield (slot, *_first(scores, open_, ids, nulls, k))

    return pick


def _blocks(rows: DataFrame, n: int, size: int) -> Column:
    return F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(1, -(-n // size))))


def _met(rows: DataFrame, anchors: DataFrame, pick: Callable, k: int) -> DataFrame:
    """anchor, slot, vec_id, score: the first k of each slot over all rows."""
    n_rows, n_anchors = rows.count(), anchors.count()
    n_chunks, n_blocks = max(1, -(-n_rows // ROWS)), max(1, -(-n_anchors // ANCHORS))
    left = rows.withColumns({"chunk": _blocks(rows, n_rows, ROWS), "block": F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>"))})
    right = anchors.withColumns({"block": _blocks(anchors, n_anchors, ANCHORS), "chunk": F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)).cast("array<bigint>"))})
    met = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(_scorer(pick), "anchor long, slot int, vec_id long, score long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return met.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k).drop("_at")


def _of_slot(i: int) -> Callable[[Column], Column]:
    return lambda e: e["slot"] == i


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` (vec_id, label, embedding, any others). A component x counts as floor(256 * x). Anchors are the rows whose vec_id
    is divisible by ``every``; their positives are the first other rows of their label, and for each positive the first
    rows of another label follow with low * positive <= 100 * negative <= high * positive in scores. Higher inner products
    come first, then smaller ids.
    Rows with a null label, a null vector, or a null or non-finite component take no part. A null vec_id is no anchor, and
    comes after all ids among ties. Rows equal in id, label and vector count once; rows that share an id but differ are
    rows of their own. Missing components of a shorter vector count as 0. Scores beyond 64 bits count as the nearest
    number of 64 bits. Anchors without a positive or a negative give no row; an empty table gives none. Other columns are
    ignored.
    """
    every_row = prepared(rows.select("vec_id", "label", "embedding"))
    anchors = stored(every_row.where(F.col("vec_id") % every == 0).withColumn("anchor", F.monotonically_increasing_id()))
    found = stored(_met(every_row, anchors, _positives(positives), positives))
    first = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("vec_id").isNull().alias("none"), "vec_id", "score")))
    chosen = stored(anchors.join(found.groupBy("anchor").agg(first.alias("positives")), "anchor").withColumn("limits", F.col("positives.score")))
    # A slot of a positive whose lower limit is over its upper one (score below 0) stays empty.
    slots = _met(every_row, chosen.select("anchor", "vec_id", "label", "v", "limits"), _negatives(negatives, low, high), negatives)
    held = slots.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("minus"), F.col("vec_id").isNull().alias("none"), "vec_id", "score"))).alias("held"))
    table = chosen.select("anchor", F.col("vec_id").alias("anchor_id"), "positives").join(held, "anchor")
    merged = F.array().cast(table.schema["held"].dataType)
    windows = []
    for i in reversed(range(positives)):  # from the lowest slot up: what lies under limit i, the first of it
        name = f"_under{i}"
        table = table.withColumn(name, F.slice(F.concat(F.filter("held", _of_slot(i)), merged), 1, negatives))
        merged = F.col(name)
        windows.append(F.when(F.size("positives") > i, F.struct(F.get("positives", F.lit(i)).alias("p"), F.col(name).alias("under"))))
    flat = table.select("anchor_id", F.explode(F.filter(F.array(*windows), lambda w: w.isNotNull())).alias("w"))
    wide = lambda c: c.cast("decimal(38,0)")
    inside = F.filter("w.under", lambda e: (wide(F.col("w.p.score")) * low <= wide(e["score"]) * 100) & (wide(e["score"]) * 100 <= wide(F.col("w.p.score")) * high))
    out = flat.select("anchor_id", "w.p", F.posexplode(inside).alias("at", "e"))
    return out.select("anchor_id", F.col("p.vec_id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("e.score").alias("negative_score"))
