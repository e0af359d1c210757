"""Frequent keys from mergeable sketches.

A sketch of frequent items (`approx_top_k_accumulate`) is kept for each group of input parts, for several sets of key
columns at once, in one pass that shuffles nothing but sketches. Sketches of several parts, days or tables merge. A
merged sketch over N rows gives every key that has more than `bound(N)` rows, and no count below the true one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.runtime import materialise

#: Input parts share so many first sketches, so none merges more than a small share of all.
GROUPS = 256
MOST_ITEMS = 1_000_000


def key_hash(keys: Sequence[str | Column]) -> Column:
    """A number for a key; a key that is null in part has one too."""
    return F.xxhash64(*keys)


def bound(rows: int, items: int) -> float:
    """A key with more rows than this is in a sketch of `items` over `rows` rows: twice the most that a count may be off,
    which is 3.5 times the rows over the places of the sketch's table."""
    return 7 * rows / 2 ** ceil(log2(ceil(items / 0.75)))


def sketches(df: DataFrame, sets: Sequence[Sequence[str]], items: int, by: Sequence[str] = ()) -> DataFrame:
    """One row for each group of input parts and value of `by`: `_rows` and a sketch `_sketch_i` for each set of keys."""
    hashed = df.select(
        *by, (F.spark_partition_id() % GROUPS).alias("_group"), *(key_hash(s).alias(f"_key_{i}") for i, s in enumerate(sets))
    )
    counted = [F.expr(f"approx_top_k_accumulate(_key_{i}, {items})").alias(f"_sketch_{i}") for i in range(len(sets))]
    return hashed.groupBy(*by, "_group").agg(F.count("*").alias("_rows"), *counted)


def merged(some: DataFrame, items: int) -> DataFrame:
    """One row (set, rows, key, count) for each frequent key of all the sketches together."""
    n = sum(c.startswith("_sketch_") for c in some.columns)
    tops = [
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(_sketch_{i}, {items}), {items})").alias(f"_top_{i}") for i in range(n)
    ]
    # grouped, for a part without a sketch has nothing to combine
    row = some.groupBy((F.col("_group") >= 0).alias("_all")).agg(F.sum("_rows").alias("rows"), *tops)
    each = F.array(*(F.struct(F.lit(i).alias("set"), F.col(f"_top_{i}").alias("top")) for i in range(n)))
    return row.select("rows", F.explode(each).alias("e")).select(
        F.col("e.set").alias("set"), "rows", F.explode("e.top").alias("t")
    ).select("set", "rows", F.col("t.item").alias("key"), F.col("t.count").alias("count"))


@dataclass(frozen=True)
class Profile:
    """Frequent keys of one table for several sets of columns, written once: operators share it instead of counting."""

    sets: tuple[tuple[str, ...], ...]
    found: DataFrame
    items: int

    def of(self, keys: Sequence[str]) -> DataFrame | None:
        """(rows, key, count) of the frequent keys, or None if this set was not looked at."""
        if tuple(keys) not in self.sets:
            return None
        return self.found.where(F.col("set") == self.sets.index(tuple(keys))).drop("set")


def profile(df: DataFrame, sets: Sequence[Sequence[str]], items: int) -> Profile:
    """One pass over the table for all sets of key columns."""
    found = materialise(merged(sketches(df, sets, items), items), "frequent-keys")
    return Profile(tuple(map(tuple, sets)), found, items)
