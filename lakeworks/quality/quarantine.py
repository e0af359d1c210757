"""Marking rows with the rules they break, and splitting them from the valid ones."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.operators.joins import flag_known
from lakeworks.operators.skew import By, Cut, hot_hashes, ranked
from lakeworks.quality.checks import holds
from lakeworks.runtime import materialise

REASONS = "_reasons"


def repeated(
    df: DataFrame, keys: Sequence[str], order: str, flag: str, cut: Cut | None = None
) -> DataFrame:
    """Add a boolean: is this row a repetition of its key. The first row in the order is not.

    Rows without a key are never repetitions. `order` should tell apart rows that differ. Where
    a key has too many rows for one task, rows first get a number that is written down with them,
    so that even a heap of identical copies can be cut.
    """
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    cut = cut or Cut.default(df)
    # rows without a key are spread: they are not compared
    spread = F.when(keyed, 0).otherwise(F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(cut.parts)) + 1)
    if hot_hashes(df.select(*keys).dropna(), keys, cut) is None:
        w = Window.partitionBy(*keys, "_spread").orderBy(order, F.xxhash64(*df.columns))
        marked = df.withColumn("_spread", spread).withColumn(flag, keyed & (F.row_number().over(w) > 1))
        return marked.drop("_spread")
    numbered = materialise(df.withColumns({"_number": F.monotonically_increasing_id(), "_spread": spread}), "numbered")
    out = ranked(numbered, [*keys, "_spread"], [By(order), By("_number")], cut)
    return out.withColumn(flag, keyed & (F.col("row_number") > 1)).select(*df.columns, flag)


def mark(
    df: DataFrame,
    rules: Mapping[str, str | Column],
    null_ok: Iterable[str] = (),
    refs: Mapping[str, tuple[DataFrame, str, str]] | None = None,
    unique: tuple[Sequence[str], str, str] | None = None,
    cut: Cut | None = None,
) -> DataFrame:
    """Add `_reasons`, the array of names of all rules a row breaks (never null).

    `rules`: name -> what a good row fulfils. `refs`: foreign key -> (reference, its key, name);
    a missing key is no orphan. `unique`: (keys, order, name) marks repetitions.
    """
    columns, allowed = df.columns, set(null_ok)
    reasons = [F.when(~holds(rule, name in allowed), F.lit(name)) for name, rule in rules.items()]
    for i, (fk, (ref, pk, name)) in enumerate((refs or {}).items()):
        df = flag_known(df, ref, fk, pk, f"_known_{i}")
        reasons.append(F.when(F.col(fk).isNotNull() & ~F.col(f"_known_{i}"), F.lit(name)))
    if unique:
        keys, order, name = unique
        df = repeated(df, keys, order, "_repeated", cut)
        reasons.append(F.when(F.col("_repeated"), F.lit(name)))
    return df.select(*columns, F.array_compact(F.array(*reasons)).alias(REASONS))


def severity(critical: Iterable[str]) -> Column:
    """Critical when one of the named reasons is among the row's, else a warning."""
    named = F.array(*[F.lit(c) for c in critical])
    return F.when(F.arrays_overlap(REASONS, named), "critical").otherwise("warning")


def split(
    marked: DataFrame, critical: Iterable[str] = (), at: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine). The condition is never null, so every row lands on one side."""
    good = F.size(REASONS) == 0
    when = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    bad = marked.where(~good).withColumns({"_quarantine_ts": when, "_severity": severity(critical)})
    return marked.where(good).drop(REASONS), bad


def first_reason() -> Column:
    """The first broken rule, in the order the rules were given."""
    return F.get(REASONS, 0)


def reasons_text(separator: str = ", ") -> Column:
    return F.concat_ws(separator, REASONS)


def conservation(marked: DataFrame) -> DataFrame:
    """One row: rows in, valid, quarantined, whether they add up, and the rate."""
    bad = F.size(REASONS) > 0
    return marked.agg(
        F.count("*").alias("rows"),
        F.count_if(~bad).alias("valid"),
        F.count_if(bad).alias("quarantined"),
    ).select(
        "*",
        (F.col("valid") + F.col("quarantined") == F.col("rows")).alias("conserved"),
        F.coalesce(F.try_divide(F.col("quarantined").cast("double"), "rows"), F.lit(0.0)).alias("rate"),
    )


def breakdown(marked: DataFrame, *by: str) -> DataFrame:
    """Rows per reason (and other columns). A row counts once for each of its reasons."""
    return marked.select(F.explode(REASONS).alias("reason"), *by).groupBy("reason", *by).agg(F.count("*").alias("rows"))


def rejection_by(marked: DataFrame, *by: str) -> DataFrame:
    bad = F.size(REASONS) > 0
    return marked.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count_if(bad).alias("quarantined"),
        F.try_divide(F.count_if(bad) * 100.0, F.count("*")).cast("double").alias("percent"),
    )


def per_reason(quarantine: DataFrame, date: Column) -> DataFrame:
    """A view with a row per reason, for a table laid out by reason and date. The row-level table
    keeps each row once."""
    exploded = quarantine.withColumn("reason", F.explode(REASONS)).withColumn("date", date)
    return exploded.drop(REASONS)


def backlog(quarantine: DataFrame, as_of: str, limit: int) -> DataFrame:
    """One row: rows waiting, limit passed, oldest, days without action."""
    oldest = F.min(F.col("_quarantine_ts").cast("date"))
    return quarantine.agg(F.count("*").alias("rows"), oldest.alias("oldest")).select(
        "rows",
        (F.col("rows") > limit).alias("over_limit"),
        "oldest",
        F.datediff(F.lit(as_of).cast("date"), "oldest").cast("long").alias("days_waiting"),
    )


def priorities(quarantine: DataFrame, as_of: str) -> DataFrame:
    """Per reason: rows, first and last day, days waiting; biggest heap first."""
    day = F.col("_quarantine_ts").cast("date")
    per = quarantine.select(F.explode(REASONS).alias("reason"), day.alias("_day"))
    return per.groupBy("reason").agg(
        F.count("*").alias("rows"),
        F.min("_day").alias("first_day"),
        F.max("_day").alias("last_day"),
        F.datediff(F.lit(as_of).cast("date"), F.min("_day")).cast("long").alias("days_waiting"),
    ).orderBy(F.desc("rows"), "reason")
