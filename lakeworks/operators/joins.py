"""Joins of facts with dimensions, and reports on their health."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.operators.skew import skew_join
from lakeworks.runtime import total

def small_side(df: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """Hint a broadcast where the plan's own size statistics stay within the bound; beyond it the choice
    is left to Spark. No job is run: the statistics are an upper bound from file sizes and columns."""
    if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= max_bytes:
        return F.broadcast(df)
    return df


def by_totals(fact: DataFrame, key: str, amount: str | None = None) -> DataFrame:
    """Rows (and value) per foreign key, nulls as their own key: what the reports below join
    instead of the facts, so a key of any size is one row."""
    aggs = [F.count("*").alias("rows")]
    if amount:
        aggs.append(F.sum(F.col(amount).cast("decimal(18,2)")).alias("value"))
    return fact.groupBy(key).agg(*aggs)


def integrity(fact: DataFrame, ref: DataFrame, fk: str, pk: str, amount: str | None = None) -> DataFrame:
    """Totals per foreign key with `known`: is the key in the reference. Null keys are kept
    with known = null: they refer to nothing and are neither valid nor orphan."""
    keys = ref.where(F.col(pk).isNotNull()).select(F.col(pk).alias("_pk")).distinct()
    sums = by_totals(fact, fk, amount)
    joined = sums.join(keys, sums[fk] == keys["_pk"], "left")
    known = F.when(F.col(fk).isNotNull(), F.col("_pk").isNotNull())
    return joined.withColumn("known", known).drop("_pk")


def integrity_report(fact: DataFrame, ref: DataFrame, fk: str, pk: str) -> DataFrame:
    """One row: rows with a key, valid, orphans, percent, score, distinct orphan keys, passed."""
    t = integrity(fact, ref, fk, pk)
    counted = t.agg(
        F.coalesce(F.sum(F.when(F.col(fk).isNotNull(), F.col("rows"))), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("rows"))), F.lit(0)).alias("valid_references"),
        F.count_if(~F.col("known")).alias("orphan_distinct_keys"),
        F.coalesce(F.sum(F.when(F.col(fk).isNull(), F.col("rows"))), F.lit(0)).alias("null_keys"),
    )
    orphans = F.col("total_records") - F.col("valid_references")
    score = F.coalesce(F.try_divide(F.col("valid_references"), F.col("total_records")), F.lit(1.0))
    return counted.select(
        F.lit(fk).alias("source_col"),
        "total_records",
        "valid_references",
        orphans.alias("orphan_records"),
        F.coalesce(F.try_divide(orphans * 100.0, "total_records"), F.lit(0.0)).alias("orphan_pct"),
        score.alias("integrity_score"),
        "orphan_distinct_keys",
        "null_keys",
        (orphans == 0).alias("passed"),
    )


def join_health(fact: DataFrame, dim: DataFrame, key: str, amount: str) -> DataFrame:
    """What a left join of facts with a dimension would do, before it is run.

    One row: fact rows, rows after the join, matched rows, orphan rows and value, null keys,
    dimension keys that occur more than once, and whether the row count is kept.
    """
    dim_keys = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_copies"))
    t = by_totals(fact, key, amount).join(dim_keys, key, "left")
    rows, copies = F.col("rows"), F.col("_copies")
    from_facts = t.agg(
        F.sum(rows).alias("fact_rows"),
        F.sum(rows * F.coalesce(copies, F.lit(1))).alias("joined_rows"),
        F.sum(F.when(copies.isNotNull(), rows).otherwise(0)).alias("matched_rows"),
        F.sum(F.when(copies.isNull() & F.col(key).isNotNull(), rows).otherwise(0)).alias("orphan_rows"),
        F.sum(F.when(copies.isNull() & F.col(key).isNotNull(), F.col("value")).otherwise(0))
        .cast("double").alias("orphan_value"),
        F.sum(F.when(F.col(key).isNull(), rows).otherwise(0)).alias("null_key_rows"),
    )
    repeated = dim_keys.agg(F.count_if(F.col("_copies") > 1)).scalar()
    return from_facts.withColumn("repeated_dim_keys", repeated).withColumn(
        "rows_kept", F.col("fact_rows") == F.col("joined_rows")
    )


def orphans(fact: DataFrame, ref: DataFrame, fk: str, pk: str) -> DataFrame:
    """Fact rows whose key is set but unknown."""
    # both sides come straight from their shuffles, so adaptive execution splits a hot key
    keys = ref.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull())
    return fact.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def flag_known(fact: DataFrame, ref: DataFrame, fk: str, pk: str, flag: str) -> DataFrame:
    """Add a boolean: is the key known. Null keys are not."""
    keys = ref.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull()).distinct()
    out = skew_join(fact, keys.withColumn(flag, F.lit(True)), [fk], "left")
    return out.withColumn(flag, F.coalesce(flag, F.lit(False))).select(*fact.columns, flag)


def repair(fact: DataFrame, refs: Mapping[str, tuple[DataFrame, str, object]]) -> DataFrame:
    """Replace unknown and missing keys: {fk: (reference, pk, value for unknown)}."""
    out = fact
    for fk, (ref, pk, unknown) in refs.items():
        out = flag_known(out, ref, fk, pk, "_known").withColumn(
            fk, F.when(F.col("_known"), F.col(fk)).otherwise(F.lit(unknown))
        ).drop("_known")
    return out


def with_unknown_member(dim: DataFrame, **values) -> DataFrame:
    """The dimension with one more row for unknown keys; columns not named are null."""
    wanted = T.StructType([T.StructField(f.name, f.dataType, True) for f in dim.schema])
    row = dim.sparkSession.createDataFrame([tuple(values.get(f.name) for f in wanted)], wanted)
    return dim.unionByName(row)


def lost_value(fact: DataFrame, ref: DataFrame, fk: str, pk: str, amount: str) -> DataFrame:
    """Value an inner join would lose, of the facts with a key."""
    t = integrity(fact, ref, fk, pk, amount).where(F.col(fk).isNotNull())
    return t.agg(
        F.sum("value").cast("double").alias("value_total"),
        F.sum(F.when(F.col("known"), F.col("value")).otherwise(0)).cast("double").alias("value_joined"),
        F.sum(F.when(~F.col("known"), F.col("value")).otherwise(0)).cast("double").alias("value_lost"),
    ).withColumn("percent_lost", F.try_divide(F.col("value_lost") * 100, F.col("value_total")))


def enrich(fact: DataFrame, dim: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left join with a dimension, default texts for facts without a match."""
    return fact.join(dim, list(keys), "left").fillna(dict(defaults))


def revenue_by(df: DataFrame, keys: Sequence[str], amount: str = "total_amount") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("orders"), total(amount).alias("revenue"))


def for_each_value(df: DataFrame, values: DataFrame, most: int = 10_000) -> DataFrame:
    """Each row of a frame once per different value of a one-column value list, null being one.

    The list becomes an array that every task gets, as a broadcast would be, so there is no join. A list of more than
    `most` values is refused.
    """
    name, once = values.columns[0], values.distinct()
    if once.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} values for each row")
    boxes = F.explode(once.agg(F.array_agg(F.struct(F.col(name).alias("value")))).scalar())
    return df.withColumn(name, boxes).withColumn(name, F.col(f"`{name}`.value"))
