"""Exact positions against plain windows and DuckDB's exact quantiles."""

import math
import random

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeworks.operators import positions
from lakeworks.operators.aggregates import percentiles
from lakeworks.operators.skew import By, ranked
from tests.test_skew import same

SHARES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def values(kind):
    rng = random.Random(kind)
    return {
        "even": [rng.random() for _ in range(2000)],
        "tied": [7.0] * 700 + [float(rng.randint(0, 20)) for _ in range(1300)],
        "steep": [math.exp(rng.uniform(-300, 300)) * rng.choice([-1, 1]) for _ in range(2000)],
        "close": [1e15 + i / 8 for i in range(3000)],
        "wide": [1.7e308, -1.7e308, 5e-324, -5e-324, 0.0, 1.0],
        "ends": [math.inf] * 3 + [-math.inf] * 3 + [float(i) for i in range(10)],
        "one": [3.5],
    }[kind]


@pytest.mark.parametrize("kind", ["even", "tied", "steep", "close", "wide", "ends", "one"])
@pytest.mark.parametrize("bins", [16, 1024])
def test_order_statistics(spark, monkeypatch, kind, bins):
    monkeypatch.setattr(positions, "BINS", bins if kind != "steep" else 1024)
    xs = values(kind)
    counts = spark.createDataFrame([(x,) for x in xs], "_x double").groupBy("_x").agg(F.count("*").alias("_n"))
    wanted = sorted({0, len(xs) - 1, len(xs) // 2, len(xs) // 3})
    found = positions.values_at(counts, wanted)
    assert [found[p] for p in wanted] == [sorted(xs)[p] for p in wanted]


@pytest.mark.parametrize("kind", ["even", "tied", "steep"])
def test_percentiles(spark, kind):
    xs = values(kind)
    df = spark.createDataFrame([(x,) for x in [*xs, None, None]], "x double").repartition(5)
    want = duckdb.connect().execute(f"SELECT {', '.join(f'quantile_cont(x, {s})' for s in SHARES)} FROM (SELECT unnest({xs}) AS x)").fetchone()
    assert list(percentiles(df, "x", SHARES).first()) == pytest.approx(want, rel=1e-12)


def test_no_values(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert tuple(percentiles(empty, "x", [0.5]).first()) == (None,)
    some = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert percentiles(some, "x", [0.0]).first()[0] == 1.0 and math.isnan(percentiles(some, "x", [1.0]).first()[0])


def test_facts_are_read_once(spark, path):
    """Counting the values is the only step over the facts."""
    where = path("facts")
    spark.range(1000).select(F.col("id").cast("double").alias("x")).write.parquet(where)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(where).mapInArrow(counted, "x double")
    assert percentiles(df, "x", [0.25, 0.5]).first()["p50"] == 499.5
    assert seen.value == 1000


@pytest.mark.parametrize("kind", ["k int", "k double", "k string", "k date"])
@pytest.mark.parametrize("desc", [False, True])
def test_ranks_without_keys(spark, kind, desc):
    rng = random.Random(5)
    raw = [rng.choice([None, 3, 3, 3, *range(9)]) for _ in range(900)]
    column = {"int": "k", "double": "if(k = 8, double('nan'), k)", "string": "concat('v', k)", "date": "date_add(date'2024-01-01', k)"}[kind[2:]]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(raw)], "k int, id int").selectExpr(f"{column} as k", "id", "'x' as `a.b`")
    by = [By("k", desc), By("id")]
    first, whole = Window.orderBy(by[0].order), Window.orderBy(*[b.order for b in by])
    plain = df.withColumns(
        {
            "row_number": F.row_number().over(whole).cast("long"), "rank": F.rank().over(first).cast("long"),
            "dense_rank": F.dense_rank().over(first).cast("long"), "group_rows": F.lit(900).cast("long"),
        }
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")  # values go on over many ranges
    try:
        found = ranked(df.repartition(7), [], by)
        assert found.select(F.col("`a.b`")).distinct().count() == 1
        same(plain.withColumnRenamed("a.b", "ab"), found.withColumnRenamed("a.b", "ab"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_identical_rows_fill_several_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50).alias("k"))
        found = ranked(df, [], [By("k")])
        assert sorted(r[0] for r in found.select("row_number").collect()) == list(range(1, 4001))
        sizes = [r[0] for r in found.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(sizes) < 1500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranked(df.limit(0), [], [By("k")]).count() == 0
