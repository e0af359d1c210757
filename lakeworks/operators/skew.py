"""Exact windows and joins for keys of any size.

A plain `Window.partitionBy(key)` puts all rows of a key into one task. Here a key with too many
rows for that (see `Cut`) is *hot*: its rows are cut into slices that follow the window
order, each slice is worked on by itself, and what a slice needs from the others (counts, sums,
neighbouring rows) comes from a summary with one row per slice. All other keys keep a single
slice, so the whole frame is still shuffled once, by (key, slice).

Sizes: there is at most one hot key for every `hot_rows` rows, and the number of slices of each is
bounded by `parts`. Hot keys come from a sketch of frequent keys (`frequent`): one pass that shuffles
sketches only, or none where the cut brings the table's profile along. They are kept as a small written
table, so every branch of the plan, and every retry, sees the same cuts. Where no key is hot the
plain window or join is used.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.operators.frequent import MOST_ITEMS, Profile, key_hash, profile
from lakeworks.operators.positions import ranked_overall
from lakeworks.runtime import materialise

SAMPLE_PER_POINT = 1000  # rows looked at per cut point
TIE_FACTOR = 8  # ranges of the second order column per repeated cut of the first


@dataclass(frozen=True)
class Cut:
    """When a key is hot: it holds more than `hot_rows` rows, which is what one task sorts with ease.
    Its rows are cut to about 1/parts of all rows or `hot_rows` each, whichever is less. With
    `hot_rows` 0 it is hot above 1/parts of all rows. `known` is the table's profile, if there is one: then
    the keys it was made for cost no pass. A sketch may miss a key of up to half a part's share of the rows, which
    is no more than any task has; results never depend on which keys are hot."""

    parts: int
    hot_rows: int = 4_000_000
    known: Profile | None = None

    @property
    def items(self) -> int:
        """Items of a sketch that misses no key with half a part's share of the rows."""
        return min(MOST_ITEMS, 12 * self.parts)

    @staticmethod
    def default(df: DataFrame) -> Cut:
        """As many parts as shuffle partitions, and 1024 at least."""
        return Cut(max(1024, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


class By:
    """One column of a window order. Nulls come first ascending and last descending."""

    def __init__(self, name: str, desc: bool = False):
        self.name, self.desc = name, desc

    @property
    def order(self) -> Column:
        column = F.col(self.name)
        return column.desc_nulls_last() if self.desc else column.asc_nulls_first()

    def position(self, schema: T.StructType) -> Column | None:
        """A number that rises with the order, or None for a type without one."""
        column, kind = F.col(self.name), schema[self.name].dataType
        if isinstance(kind, T.DateType):
            column = F.unix_date(column)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.unix_micros(column.cast("timestamp"))
        elif isinstance(kind, T.BooleanType):
            column = column.cast("int")
        elif not isinstance(kind, T.NumericType):
            return None
        column = column.cast("double")
        return -column if self.desc else column


def same_keys(left: str, right: str, names: Sequence[str]) -> Column:
    """Null-safe equality of the named columns of two aliased frames."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.`{n}`").eqNullSafe(F.col(f"{right}.`{n}`")) for n in names],
    )


def hot_hashes(df: DataFrame, keys: Sequence[str], cut: Cut) -> DataFrame | None:
    """Hash of each hot key (`_hash`), its `_rows`, never too few, and the `_share` of parts it would fill, as a written
    table; None if no key is hot. A key that shares a hot one's hash is taken for hot too, which does no harm.
    """
    found = cut.known.of(keys) if cut.known else None
    if found is None:
        found = profile(df, [keys], cut.items).of(keys)
    least = F.lit(cut.hot_rows) if cut.hot_rows else F.col("rows") / cut.parts
    share = F.ceil(F.col("count") * cut.parts / F.col("rows"))
    if cut.hot_rows:
        share = F.greatest(share, F.ceil(F.col("count") / cut.hot_rows))
    hot = found.where(F.col("count") > least).select(
        F.col("key").alias("_hash"), F.col("count").alias("_rows"), F.least(share, F.lit(2**31 - 1)).cast("int").alias("_share")
    )
    return None if hot.isEmpty() else hot


def hot_keys(df: DataFrame, keys: Sequence[str], cut: Cut) -> DataFrame | None:
    """The hot keys themselves with their exact `_rows` and their `_share`, as a written table; None if none is.
    Only rows of hot keys are counted."""
    hot = hot_hashes(df, keys, cut)
    if hot is None:
        return None
    heavy = df.select(*keys, key_hash(keys).alias("_hash")).join(F.broadcast(hot.drop("_rows")), "_hash")
    return materialise(heavy.groupBy(*keys).agg(F.count("*").alias("_rows"), F.max("_share").alias("_share")), "hot-keys")


# ------------------------------------------------------------------ cutting hot keys


def _quantiles(column: Column, points: int) -> Column:
    shares = ",".join(str(i / (points + 1)) for i in range(1, points + 1))
    return F.percentile_approx(column, F.split(F.lit(shares), ",").cast("array<double>"), 4 * points)


def _thin(edges: Column, share: Column, points: int) -> Column:
    """Keep about `share` of the points, evenly spaced."""
    step = F.greatest(F.lit(1), F.floor(F.lit(points) / share).cast("int"))
    return F.filter(edges, lambda _, i: (i + 1) % step == 0)


def _search(df: DataFrame, found: Mapping[str, tuple[str, str, bool]], points: int) -> DataFrame:
    """Binary searches in arrays of edges: {result: (edges, value, count edges equal to it)}.

    Each step is a projection on the one before, so the searches stay in generated code; a
    lambda over the array would copy it for every row.
    """
    df = df.withColumns({name: F.lit(0) for name in found})
    for bit in reversed(range(ceil(log2(points + 1)))):
        steps = {}
        for name, (edges, value, equal) in found.items():
            edge = F.get(edges, F.col(name) + (2**bit - 1))
            passed = edge <= F.col(value) if equal else edge < F.col(value)
            steps[name] = F.col(name) + F.when(passed, 2**bit).otherwise(0)
        df = df.withColumns(steps)
    return df


def _cuts(df: DataFrame, keys: Sequence[str], cut: Cut, points: int) -> DataFrame | None:
    """Cut points of the hot keys over columns `_v` and `_t`, written once; None if none is hot.

    The points are approximate quantiles: they only balance the slices, no result depends on them.
    """
    if keys:
        hot = hot_hashes(df, keys, cut)
        if hot is None:
            return None
        size = hot.agg(F.sum("_rows")).first()[0]
        heavy = df.withColumn("_hash", key_hash(keys)).join(F.broadcast(hot.drop("_rows")), "_hash").drop("_hash")
    else:
        size = df.count()
        if not size:
            return None
        heavy = df.withColumn("_share", F.lit(cut.parts))
    # cuts only have to be roughly even: some rows per point of each key's share will do; the sample
    # balances slices, and no row or result depends on it
    fraction = SAMPLE_PER_POINT * cut.parts / size
    if fraction < 1:
        heavy = heavy.sample(fraction, seed=17)
    cuts = heavy.groupBy(*keys).agg(
        F.max("_share").alias("_share"),
        _quantiles(F.col("_v"), points).alias("_ve"),
        _quantiles(F.col("_t"), points).alias("_te"),
    )
    nothing = F.array().cast("array<double>")
    thin = {c: F.coalesce(_thin(F.col(c), F.col("_share"), points), nothing) for c in ("_ve", "_te")}
    return materialise(cuts.withColumns(thin).drop("_share"), "cuts")


class Sliced:
    """A frame whose hot keys carry slices `_code`, `_sub` that rise with the order.

    `_code` is odd where the slice holds a single value of the first order column, so equal
    values never straddle two codes. A value repeated far beyond its share is cut further, into
    `_sub` ranges of the second order column. Cold keys have `_code` = `_sub` = 0.
    """

    def __init__(
        self, df: DataFrame, keys: Sequence[str], by: Sequence[By], cut: Cut | None = None
    ):
        self.keys, self.by, self.columns = list(keys), list(by), df.columns
        cut = cut or Cut.default(df)
        points = 2 ** ceil(log2(cut.parts)) - 1
        first = by[0].position(df.schema)
        if first is None:
            raise TypeError(f"order column {by[0].name} must be a number, date or timestamp")
        second = by[1].position(df.schema) if len(by) > 1 else None
        second = F.lit(None).cast("double") if second is None else second
        cuts = _cuts(
            df.select(*keys, first.alias("_v"), second.alias("_t")), self.keys, cut, points
        )
        self.hot = cuts is not None
        if not self.hot:
            self.frame = df
            return
        placed = df.withColumns({"_v": first, "_t": second}).alias("d")
        if keys:
            placed = placed.join(F.broadcast(cuts).alias("c"), same_keys("d", "c", self.keys), "left")
            placed = placed.select("d.*", "c._ve", "c._te")
        else:
            row = cuts.select(F.struct("_ve", "_te")).scalar()
            placed = placed.withColumn("_row", row).select("d.*", "_row.*")
        hot, empty = F.col("_ve").isNotNull(), F.col("_v").isNull()
        searches = {"_lo": ("_ve", "_v", False), "_hi": ("_ve", "_v", True), "_tn": ("_te", "_t", False)}
        placed = _search(placed.withColumn("_hot", hot), searches, points)
        repeats = F.col("_hi") - F.col("_lo")
        whole = F.size("_te") + 1
        placed = placed.withColumns(
            {
                "_code": F.when(~hot, 0)
                .when(empty, 2 * points + 3 if by[0].desc else -1)
                .otherwise(2 * F.col("_lo") + (repeats > 0).cast("int")),
                "_ranges": F.when(hot & empty, whole)
                .when(repeats > 1, F.least(whole, TIE_FACTOR * repeats))
                .otherwise(1),
            }
        )
        last = len(by) > 1 and by[1].desc
        sub = (
            F.when(F.col("_ranges") == 1, 0)
            .when(F.col("_t").isNull(), F.col("_ranges") if last else F.lit(-1))
            .otherwise(F.floor(F.col("_tn") * F.col("_ranges") / whole).cast("int"))
        )
        self.frame = placed.withColumn("_sub", sub).drop(
            "_v", "_t", "_ve", "_te", "_lo", "_hi", "_tn", "_ranges"
        )

    @property
    def slice_keys(self) -> list[str]:
        return self.keys + (["_code", "_sub"] if self.hot else [])

    def window(self, depth: int | None = None):
        """Window over one slice, ordered by the first `depth` order columns."""
        return Window.partitionBy(*self.slice_keys).orderBy(*[b.order for b in self.by[:depth]])

    def summary(self, *aggs: Column) -> DataFrame:
        """One row per slice of the hot keys."""
        return self.frame.where("_hot").groupBy(*self.slice_keys).agg(*aggs)

    def over_key(self):
        """Window over the slices of a key, in order (a bounded number of rows)."""
        return Window.partitionBy(*self.keys).orderBy("_code", "_sub")

    def attach(self, local: DataFrame, summary: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        """Left join of the rows with a bounded summary on the slice (and `extra` columns)."""
        on = [*self.slice_keys, *extra]
        added = [c for c in summary.columns if c not in on]
        joined = local.alias("l").join(
            F.broadcast(summary).alias("s"), same_keys("l", "s", on), "left"
        )
        return joined.select("l.*", *[F.col(f"s.`{c}`") for c in added])


# ------------------------------------------------------------------ window operators


def ranked(
    df: DataFrame, keys: Sequence[str], by: Sequence[By], cut: Cut | None = None
) -> DataFrame:
    """Add `row_number` (over all order columns), `rank` and `dense_rank` (over the first order
    column, ties share a rank) and `group_rows`, the number of rows of the key. Without keys: of all rows."""
    if not keys:
        return ranked_overall(df, by)
    s = Sliced(df, keys, by, cut)
    local = s.frame.withColumns(
        {
            "row_number": F.row_number().over(s.window()).cast("long"),
            "rank": F.rank().over(s.window(1)).cast("long"),
            "dense_rank": F.dense_rank().over(s.window(1)).cast("long"),
        }
    )
    here = F.count("*").over(Window.partitionBy(*s.slice_keys))
    if not s.hot:
        return local.withColumn("group_rows", here)
    slices = s.summary(
        F.count("*").alias("_n"),
        (F.count_distinct(by[0].name) + F.max(F.col(by[0].name).isNull().cast("int"))).alias("_d"),
    )
    key = s.over_key()
    codes = Window.partitionBy(*keys).orderBy("_code").rangeBetween(Window.unboundedPreceding, -1)
    first_sub = F.row_number().over(Window.partitionBy(*keys, "_code").orderBy("_sub")) == 1
    slices = slices.withColumn("_d", F.when(first_sub, F.col("_d")).otherwise(0)).withColumns(
        {
            "_rows_before": F.sum("_n").over(key.rowsBetween(Window.unboundedPreceding, -1)),
            "_codes_before": F.sum("_n").over(codes),
            "_values_before": F.sum("_d").over(codes),
            "_rows_of_key": F.sum("_n").over(Window.partitionBy(*keys)),
        }
    ).drop("_n", "_d")
    out = s.attach(local.withColumn("group_rows", here), slices)
    return out.select(
        *s.columns,
        (F.col("row_number") + F.coalesce("_rows_before", F.lit(0))).alias("row_number"),
        (F.col("rank") + F.coalesce("_codes_before", F.lit(0))).alias("rank"),
        (F.col("dense_rank") + F.coalesce("_values_before", F.lit(0))).alias("dense_rank"),
        F.coalesce("_rows_of_key", "group_rows").alias("group_rows"),
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[By],
    sums: Mapping[str, Column],
    cut: Cut | None = None,
) -> DataFrame:
    """Add running sums from the first row of the key to the current one.

    Pass whole numbers or decimals: those add up alike in any order.
    """
    s = Sliced(df, keys, by, cut)
    frame = s.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = s.frame.withColumns({n: F.sum(c).over(frame) for n, c in sums.items()})
    if not s.hot:
        return local
    before = s.over_key().rowsBetween(Window.unboundedPreceding, -1)
    slices = s.summary(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
    slices = slices.select(
        *s.slice_keys, *[F.sum(f"_sum_{n}").over(before).alias(f"_before_{n}") for n in sums]
    )
    out = s.attach(local, slices)
    return out.select(
        *s.columns,
        *[
            F.when(F.col(f"_before_{n}").isNull(), F.col(n))
            .otherwise(F.coalesce(n, F.lit(0)) + F.col(f"_before_{n}"))
            .cast(local.schema[n].dataType)
            .alias(n)
            for n in sums
        ],
    )


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[By],
    back: Mapping[str, Callable] | None = None,
    ahead: Mapping[str, Callable] | None = None,
    reach: int = 1,
    cut: Cut | None = None,
) -> DataFrame:
    """Add columns that look at most `reach` rows back or ahead within a key.

    Each value of `back` and `ahead` is a function from a window to a column, such as
    `lambda w: F.lag("x", 1).over(w)` or `lambda w: F.sum("x").over(w.rowsBetween(-2, 0))`.
    """
    back, ahead = back or {}, ahead or {}
    s = Sliced(df, keys, by, cut)
    w = s.window()
    made = {n: f(w) for n, f in {**back, **ahead}.items()}
    if not s.hot:
        return s.frame.withColumns(made)
    marks = {
        "_i": F.row_number().over(w),
        "_tail": F.lead(F.lit(1), reach).over(w).isNull(),
    }
    local = s.frame.withColumns({**made, **marks})
    # rows at the ends of slices: the only ones whose neighbours may lie in another slice
    ends = s.frame.where("_hot").withColumns(marks).where((F.col("_i") <= reach) | F.col("_tail"))
    whole = Window.partitionBy(*keys).orderBy(*[b.order for b in by])
    ends = ends.select(
        *s.slice_keys, "_i", *[f(whole).alias(f"_end_{n}") for n, f in {**back, **ahead}.items()],
        F.lit(True).alias("_end"),
    )
    out = s.attach(local, ends, extra=["_i"])
    head, tail = F.col("_end") & (F.col("_i") <= reach), F.col("_end") & F.col("_tail")
    return out.select(
        *s.columns,
        *[F.when(head, F.col(f"_end_{n}")).otherwise(F.col(n)).alias(n) for n in back],
        *[F.when(tail, F.col(f"_end_{n}")).otherwise(F.col(n)).alias(n) for n in ahead],
    )


# ------------------------------------------------------------------ joins


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    cut: Cut | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join for a left side with hot keys and a right side with few rows per key.

    Rows of a hot key get one of as many salts as the key fills parts; the right rows of that
    key are repeated once per salt. Everything else joins under salt 0. The salt depends on the
    row and on its input partition, both stable when a lost task runs again, so even identical
    rows spread out. For inner, left, left_semi and left_anti. With `null_safe` a null key is a key
    like any other and matches a null key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join cannot repeat the right side of a {how} join")
    if null_safe:
        # structs are never null, and two that hold null are equal
        boxed = {f"_key_{i}": F.struct(F.col(k).alias("k")) for i, k in enumerate(keys)}
        right = right.withColumns(boxed).drop(*keys)
        return skew_join(left.withColumns(boxed), right, list(boxed), how, cut).drop(*boxed)
    cut = cut or Cut.default(left)
    row = F.xxhash64(*left.columns, F.spark_partition_id())
    # null keys never match; spread over salts they do not pile up in one task
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = F.when(some_null, F.pmod(row, F.lit(cut.parts)) + 1)
    keyed = left.select(*keys) if cut.known else left.select(*keys).dropna()
    if not _hash_alike(left, right, keys):
        hot, on = hot_keys(keyed.dropna(), keys, cut), list(keys)
    else:
        hot, on = hot_hashes(keyed, keys, cut), ["_hash"]
    if hot is None:
        if how in ("inner", "left_semi") or not any(left.schema[k].nullable for k in keys):
            return left.join(right, list(keys), how)
        big = left.withColumn("_salt", spread.otherwise(0).cast("int"))
        # always 0, but not seen to be: a literal would be taken out of the join's keys
        none = right.withColumn("_salt", F.pmod(key_hash(keys), F.lit(1)).cast("int"))
        return big.join(none, [*keys, "_salt"], how).drop("_salt")
    hot = F.broadcast(hot.drop("_rows"))
    salt = spread.when(F.col("_share").isNotNull(), F.pmod(row, F.col("_share")) + 1).otherwise(0)
    if on == ["_hash"]:
        left, right = (side.withColumn("_hash", key_hash(keys)) for side in (left, right))
    big = left.join(hot, on, "left").withColumn("_salt", salt.cast("int")).drop("_share")
    copies = F.when(F.col("_share").isNotNull(), F.sequence(F.lit(1), F.col("_share")))
    small = right.join(hot, on, "left")
    small = small.withColumn("_salt", F.explode(F.coalesce(copies, F.array(F.lit(0))))).drop("_share")
    if on == ["_hash"]:
        big, small = big.drop("_hash"), small.drop("_hash")
    return big.join(small, [*keys, "_salt"], how).drop("_salt")


def _hash_alike(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys of both sides have equal hashes: they are of the same type, and compared byte by byte."""
    kinds = [(left.schema[k].dataType.simpleString(), right.schema[k].dataType.simpleString()) for k in keys]
    return all(a == b and "collate" not in a for a, b in kinds)


def with_group_totals(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], cut: Cut | None = None
) -> DataFrame:
    """Aggregates of the key on each of its rows: aggregate, then join back."""
    totals = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return skew_join(df, totals, keys, "left", cut, null_safe=True)
