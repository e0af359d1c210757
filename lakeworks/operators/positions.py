"""Exact positions over a whole frame: order statistics by refined histograms, ranks by ranges and offsets.

Nothing here sorts all rows in one task, and what comes to the driver is bounded: a block of bins for each wanted
position, or one row for each range.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor, inf, isinf, isnan, log2, nan

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.runtime import materialise

BINS = 1024


def _bin(x: Column, a: float, b: float) -> Column:
    """The bin of a value between a and b: by sign where that differs, by magnitude where the interval spans several powers
    of two, else by equal widths. So whatever the values are, some eight rounds tell all doubles apart."""
    if a == b:
        return F.lit(0)
    if a <= 0 <= b:
        return F.signum(x) + 1
    low, high = sorted((abs(a), abs(b)))
    if high / 4 > low:
        share = (F.log2(F.abs(x)) - log2(low)) / (log2(high) - log2(low))
    else:
        share = (F.abs(x) - F.lit(low)) / F.lit(high - low)
    place = F.greatest(F.lit(0), F.least(F.floor(share * BINS), F.lit(BINS - 1)))
    return place if a > 0 else BINS - 1 - place


def values_at(counts: DataFrame, positions: Sequence[int]) -> dict[int, float]:
    """The values at these places (from 0 on) of the sorted rows that `counts` (`_x` double, `_n`) stands for.

    Each round counts the rows in the bins of every interval that holds a wanted place, all in one aggregate, and
    keeps the bin of each place with its least and greatest value as the next interval, until those are the same.
    """
    x, out = F.col("_x"), {}
    odd = F.isnan("_x") | (F.abs("_x") == inf)
    ends = counts.agg(F.min(F.when(~odd, x)), F.max(F.when(~odd, x))).first()
    # (least, greatest, rows before) of the intervals, and the places still open in each
    open_: dict[tuple[float, float, int], list[int]] = {(ends[0] or 0.0, ends[1] or 0.0, 0): list(dict.fromkeys(positions))}
    begun = False
    while open_:
        spans = list(open_)
        where = [F.lit(True)] if not begun else [(x >= F.lit(a)) & (x <= F.lit(b)) for a, b, _ in spans]
        part = [_bin(x, a, b) for a, b, _ in spans]
        inside, bins = F.lit(-1), F.lit(0)
        for i, (test, b) in enumerate(zip(where, part, strict=True)):
            inside, bins = F.when(test, i).otherwise(inside), F.when(test, b.cast("int")).otherwise(bins)
        bins = F.when(F.isnan("_x"), BINS + 1).when(x == inf, BINS).when(x == -inf, -1).otherwise(bins)
        rows = (
            counts.select("_x", "_n", inside.alias("span"), bins.alias("bin")).where("span >= 0").groupBy("span", "bin")
            .agg(F.sum("_n").alias("n"), F.min("_x").alias("least"), F.max("_x").alias("greatest")).collect()
        )
        following: dict[tuple[float, float, int], list[int]] = {}
        for i, (span, wanted) in enumerate(open_.items()):
            at = span[2]
            for r in sorted((r for r in rows if r.span == i), key=lambda r: r.bin):
                for place in (p for p in wanted if at <= p < at + r.n):
                    if r.least == r.greatest or isnan(r.least) or isnan(r.greatest):
                        out[place] = r.greatest
                    else:
                        following.setdefault((r.least, r.greatest, at), []).append(place)
                at += r.n
        open_, begun = following, True
    return out


def overall_percentiles(df: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    """One row with the exact percentiles `p25`, ... of a column's values, interpolated between neighbours; null without any.

    The rows are read once, to count equal values."""
    values = df.where(F.col(column).isNotNull()).select((F.col(column).cast("double") + 0.0).alias("_x"))
    counts = materialise(values.groupBy("_x").agg(F.count("*").alias("_n")), "value-counts")
    size = counts.agg(F.sum("_n")).first()[0] or 0
    places = {share: float(share) * (size - 1) for share in shares}
    found = values_at(counts, [f(p) for p in places.values() for f in (floor, ceil)]) if size else {}

    def between(place: float) -> float | None:
        if not size:
            return None
        a, b = found[floor(place)], found[ceil(place)]
        if a == b or isinf(a) and place == floor(place):
            return a
        return nan if isnan(a) or isnan(b) else a + (place - floor(place)) * (b - a)

    names = [f"p{round(share * 100)}" for share in shares]
    return df.sparkSession.createDataFrame([tuple(map(between, places.values()))], ", ".join(f"{n} double" for n in names))


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value is another one than that before it; the first is not looked at. Nulls are equal, and so are NaNs."""
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    unlike = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    unlike = unlike | (a.is_valid().to_numpy(zero_copy_only=False) != b.is_valid().to_numpy(zero_copy_only=False))
    if pa.types.is_floating(column.type):
        unlike &= ~pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False).to_numpy(zero_copy_only=False)
    return unlike


def _local(batches, at: int):
    """A sorted range's rows with their place, the place at which their value begins, and how many values there are up to
    it; all from 1 on."""
    rows, start, values, last = 0, 1, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(at)
        joined = pa.concat_arrays([last, column]) if last is not None else column
        new = _changes(joined) if last is not None else np.concatenate(([True], _changes(joined)))
        place = np.arange(rows + 1, rows + 1 + batch.num_rows)
        begins = np.maximum.accumulate(np.where(new, place, start))
        upto = values + np.cumsum(new)
        rows, start, values, last = int(place[-1]), int(begins[-1]), int(upto[-1]), column.slice(batch.num_rows - 1)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(place), pa.array(begins), pa.array(upto)], [*batch.schema.names, "_place", "_begin", "_value"]
        )


def ranked_overall(df: DataFrame, by: Sequence) -> DataFrame:
    """`row_number` over all order columns, `rank` and `dense_rank` over the first, and `group_rows`, the number of all rows.

    Rows are dealt to ranges of the order, with a hash and their place in the input behind it, so a value with very
    many rows, even identical ones, fills several ranges. Ranges are numbered in themselves; one row for each
    range tells what comes before it."""
    columns, first = df.columns, df.columns.index(by[0].name)
    # the row's hash and number part what the order does not tell apart
    marked = df.withColumns({"_hash": F.xxhash64(*(F.col(f"`{c}`") for c in columns)), "_turn": F.monotonically_increasing_id()})
    order = [*(b.order for b in by), F.col("_hash"), F.col("_turn")]
    in_order = marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash", "_turn")
    plain = in_order.toDF(*(f"c{i}" for i in range(len(columns))))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    local = plain.mapInArrow(lambda b: _local(b, first), f"{kinds}, _place long, _begin long, _value long")
    placed = materialise(local.withColumn("_part", F.spark_partition_id()), "ranks")
    parts = placed.groupBy("_part").agg(
        F.count("*").alias("n"), F.max("_value").alias("values"), F.max("_begin").alias("begin"),
        F.min_by(F.struct(f"c{first}"), "_place").alias("head"), F.max_by(F.struct(f"c{first}"), "_place").alias("tail"),
    )
    goes_on = F.expr("coalesce(head <=> lag(tail) over (order by _part), false)")
    offsets, before, dense, run = [], 0, 0, 0
    for part, n, values, begin, same in sorted(tuple(r) for r in parts.select("_part", "n", "values", "begin", goes_on).collect()):
        head = run if same else before + 1  # where the range's first value begins among all rows
        dense -= same
        offsets.append((part, before, dense, head))
        run = head if values == 1 else before + begin
        before, dense = before + n, dense + values
    table = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part int, _before long, _dense long, _head long"))
    rank = F.when(F.col("_value") == 1, F.col("_head")).otherwise(F.col("_before") + F.col("_begin"))
    return placed.join(table, "_part").select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)),
        (F.col("_before") + F.col("_place")).alias("row_number"), rank.alias("rank"),
        (F.col("_dense") + F.col("_value")).alias("dense_rank"), F.lit(before).cast("long").alias("group_rows"),
    )
