"""Ordered logic over groups of any size.

A plain window sorts each group inside one task, which fails where one source
holds a third of all rows. Rows are therefore always cut into range segments by
(keys, order). A window runs inside each segment; what a segment does to a value
that enters it is summed up in one row per segment and key, and these summaries
compose: sums add up, extremes meet, counts since a reset start anew where a
segment holds a reset, and the last row is the next segment's previous row. So
any number of ordered columns costs one range shuffle and one stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.session import checkpointed

# Up to this ``n`` Spark limits groups before the shuffle (its own setting).
_GROUP_LIMIT = 1000
_SEGMENT = "_segment"
_END = 2**31 - 1
_RUNNING = {"sum": F.sum, "max": F.max, "min": F.min}
_COUNTS = ("since", "since_before")


def order_columns(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def scans(
    df: DataFrame, keys: Sequence[str], order: Sequence, columns: dict[str, tuple], segments: int | None = None, entry: DataFrame | None = None,
) -> DataFrame:
    """Adds ordered columns, all from one pass over range segments.

    ``("sum"|"max"|"min", column)``: running aggregate, the row included.
    ``("since", hit, reset)``: hits since the last reset, the row included; a row that resets counts 0.
    ``("since_before", hit, reset)``: the same as it was before the row.
    ``("previous", column)``: the previous row's value, null on a group's first row.

    ``order`` must be total within a group (end it with a unique column).
    ``segments``: how many; as many as shuffle partitions if not given.
    ``entry``: what groups bring with them (the state that ``scans_and_state`` gave for earlier rows): keys and one column per name.
    """
    rows, sums = _segments(df, list(keys), order_columns(order), columns, segments, entry)
    return _composed(df, rows, sums, list(keys), columns, entry is None)


def scans_and_state(df: DataFrame, keys: Sequence[str], order: Sequence, columns: dict[str, tuple], entry: DataFrame | None = None, segments: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``scans``, and for each key what it leaves to rows that come later, to be given as their ``entry``."""
    keys = list(keys)
    rows, sums = _segments(df, keys, order_columns(order), columns, segments, entry)
    ends = sums.select(*keys).distinct().select(F.lit(_END).alias(_SEGMENT), *keys)
    blank = [F.lit(None).cast(sums.schema[c].dataType).alias(c) for c in sums.columns if c not in (_SEGMENT, *keys)]
    state = _carried(sums.unionByName(ends.select("*", *blank)), keys, columns).where(F.col(_SEGMENT) == _END)
    return _composed(df, rows, sums, keys, columns, entry is None), state.select(*keys, *[F.col(f"_carry_{n}").alias(n) for n in columns])


def _segments(df: DataFrame, keys: list[str], order: list[Column], columns: dict[str, tuple], segments: int | None, entry: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The rows with what each column is within its segment, stored, and the summary of each segment and key."""
    parts = segments or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = {}
    for n, (op, *what) in columns.items():
        given[f"_in_{n}"] = what[0].cast("bigint") if op in _COUNTS else what[0] if isinstance(what[0], Column) else F.col(what[0])
        if op in _COUNTS:
            given[f"_reset_{n}"] = F.coalesce(what[1], F.lit(False))
    ranged = df.withColumns(given).repartitionByRange(parts, *keys, *order).withColumn(_SEGMENT, F.spark_partition_id())

    ordered = Window.partitionBy(_SEGMENT, *keys).orderBy(*order)
    inside, before = ordered.rowsBetween(Window.unboundedPreceding, 0), ordered.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_at", F.row_number().over(ordered))
    local = local.withColumns({f"_here_{n}": _RUNNING[op](f"_in_{n}").over(inside) for n, (op, *_) in columns.items() if op in _RUNNING} | {
        f"_here_{n}": F.lag(f"_in_{n}").over(ordered) for n, (op, *_) in columns.items() if op == "previous"
    } | {f"_hits_{n}": F.sum(F.coalesce(f"_in_{n}", F.lit(0))).over(inside) for n, (op, *_) in columns.items() if op in _COUNTS})
    bases = {}
    for n, (op, *_) in columns.items():
        if op in _COUNTS:
            at_reset = F.when(F.col(f"_reset_{n}"), F.col(f"_hits_{n}"))
            bases[f"_base_{n}"] = F.max(at_reset).over(inside)
            if op == "since_before":
                bases[f"_early_{n}"] = F.max(at_reset).over(before)
    # Stored once: the segment of a row must not change between its two uses, and both read the windows above.
    rows = checkpointed(local.withColumns(bases) if bases else local)

    def end(n, op):
        if op == "previous":
            return [F.col(f"_in_{n}").alias(n)]
        if op in _RUNNING:
            return [F.col(f"_here_{n}").alias(n)]
        return [(F.col(f"_hits_{n}") - F.coalesce(f"_base_{n}", F.lit(0))).alias(n), F.col(f"_base_{n}").isNotNull().alias(f"_anew_{n}")]

    last = F.struct(F.lit(0).alias("_none"), *[c for n, (op, *_) in columns.items() for c in end(n, op)])
    sums = rows.groupBy(_SEGMENT, *keys).agg(F.max_by(last, "_at").alias("_last")).select(_SEGMENT, *keys, "_last.*").drop("_none")
    if entry is not None:
        brought = entry.select(F.lit(-1).alias(_SEGMENT), *keys, *columns, *[F.lit(True).alias(f"_anew_{n}") for n, (op, *_) in columns.items() if op in _COUNTS])
        sums = sums.unionByName(brought)
    return rows, sums


def _composed(df: DataFrame, rows: DataFrame, sums: DataFrame, keys: list[str], columns: dict[str, tuple], few: bool) -> DataFrame:
    """The rows with the carry of earlier segments; ``few``: without an entry, at most one carry per segment."""
    carry = _carried(sums, keys, columns)
    back = [carry[k].alias(f"_k{i}") for i, k in enumerate(keys)]
    carry_in = carry.where("_earlier > 0").select(F.col(_SEGMENT).alias("_to"), *back, *[F.col(f"_carry_{n}") for n in columns])
    match = [rows[_SEGMENT] == carry_in["_to"]] + [rows[k].eqNullSafe(carry_in[f"_k{i}"]) for i, k in enumerate(keys)]
    joined = rows.join(F.broadcast(carry_in) if few else carry_in, match, "left")

    def whole(n, op):
        before_ = F.col(f"_carry_{n}")
        if op in _COUNTS:
            late = op == "since"
            base = F.col(f"_base_{n}" if late else f"_early_{n}")
            hits = F.col(f"_hits_{n}") if late else F.col(f"_hits_{n}") - F.coalesce(f"_in_{n}", F.lit(0))
            return hits - F.coalesce(base, F.lit(0)) + F.when(base.isNotNull(), 0).otherwise(F.coalesce(before_, F.lit(0)))
        mine = F.col(f"_here_{n}")
        if op == "previous":
            return F.when(F.col("_at") == 1, before_).otherwise(mine)
        if op == "sum":
            return F.when(mine.isNull() & before_.isNull(), None).otherwise(F.coalesce(mine, F.lit(0)) + F.coalesce(before_, F.lit(0)))
        return (F.greatest if op == "max" else F.least)(mine, before_)

    kept = [rows[c] for c in df.columns if c not in columns]
    return joined.select(*kept, *[whole(n, op).alias(n) for n, (op, *_) in columns.items()])


def _carried(sums: DataFrame, keys: list[str], columns: dict[str, tuple]) -> DataFrame:
    """The summaries with what all earlier segments of a key bring into each: ``_carry_<name>``, and how many there are."""
    by = Window.partitionBy(*keys).orderBy(_SEGMENT)
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    counts = [n for n, (op, *_) in columns.items() if op in _COUNTS]
    out = sums.withColumn("_earlier", F.count(F.lit(1)).over(earlier))
    if counts:
        out = out.withColumns({f"_all_{n}": F.sum(n).over(upto) for n in counts})
    values = {}
    for n, (op, *_) in columns.items():
        if op in _COUNTS:
            base = F.max(F.when(F.col(f"_anew_{n}"), F.col(f"_all_{n}") - F.col(n))).over(earlier)
            values[f"_carry_{n}"] = F.sum(n).over(earlier) - F.coalesce(base, F.lit(0))
        elif op == "previous":
            values[f"_carry_{n}"] = F.lag(n).over(by)
        else:
            values[f"_carry_{n}"] = _RUNNING[op](n).over(earlier)
    return out.withColumns(values)


def running(df: DataFrame, keys: Sequence[str], order: Sequence, exprs: dict[str, tuple[str, Column]], segments: int | None = None) -> DataFrame:
    """Adds running aggregates, current row included: ``{name: ("sum"|"max"|"min", column)}``; see ``scans``."""
    return scans(df, keys, order, exprs, segments)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "row_number", **kw) -> DataFrame:
    """1-based position in the group (or in the whole table for no keys)."""
    return running(df, keys, order, {name: ("sum", F.lit(1).cast("bigint"))}, **kw)


def previous(df: DataFrame, keys: Sequence[str], order: Sequence, columns: dict[str, str], segments: int | None = None) -> DataFrame:
    """Adds the previous row's values: ``{new name: column}``, null on the first row of a group."""
    return scans(df, keys, order, {new: ("previous", old) for new, old in columns.items()}, segments)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence, n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows per group.

    Up to ``_GROUP_LIMIT`` rows Spark limits each group before the shuffle
    (``WindowGroupLimit``), so a hot group sends at most ``n`` rows per task.
    """
    if n > _GROUP_LIMIT:
        return row_numbers(df, keys, order, name).where(F.col(name) <= n)
    w = Window.partitionBy(*keys).orderBy(*order_columns(order))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per group by ascending ``order`` columns, as a combinable aggregate."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"), F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")) \
        if rest else df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    if rest:
        return best.select("_row.*")
    return best.select(*keys, "_first.*").select(*df.columns)


def bounded_samples(df: DataFrame, keys: Sequence[str], value: str, n: int, name: str = "samples") -> DataFrame:
    """Count per group with its ``n`` smallest distinct values, limited before they are collected."""
    per_value = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    counts = per_value.groupBy(*keys).agg(F.sum("_n").alias("count"))
    few = first_rows(per_value.where(F.col(value).isNotNull()), keys, [value], n)
    lists = few.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(name))
    lists = lists.select(*[F.col(k).alias(f"_s_{k}") for k in keys], name)
    match = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    return counts.join(lists, match, "left").select(*keys, "count", F.coalesce(name, F.array()).alias(name))
