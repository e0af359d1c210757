"""The sliced windows and salted joins against plain ones, on frames with hot keys, ties and nulls."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeworks.operators.skew import By, Cut, Sliced, hot_keys, neighbours, ranked, running, skew_join
from lakeworks.operators.windows import quartiles, top_overall, top_per_group

SCHEMA = "k long, d date, id long, amt decimal(18,2)"
ORDERS = {
    "date": [By("d"), By("id")],
    "date desc": [By("d", True), By("id", True)],
    "amount desc": [By("amt", True), By("id")],
}


def same(a, b):
    columns = sorted(a.columns)
    assert a.count() == b.count()
    assert a.select(*columns).exceptAll(b.select(*columns)).isEmpty()


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows on one key, half of those on one day; null keys, days and amounts."""
    i = F.col("id")
    df = spark.range(6000).select(
        F.when(i % 3 == 0, 1).when(i % 7 == 0, None).otherwise(i % 97).cast("long").alias("k"),
        F.when(i % 6 == 0, F.lit("1999-01-01").cast("date"))
        .when(i % 29 == 0, None)
        .otherwise(F.date_add(F.lit("1998-01-01").cast("date"), ((i * 7919) % 900).cast("int")))
        .alias("d"),
        i.alias("id"),
        F.when(i % 31 != 0, ((i * 104729) % 5000).cast("decimal(18,2)")).alias("amt"),
    )
    return df.cache()


@pytest.mark.parametrize("keys", [["k"], []], ids=["by key", "whole frame"])
@pytest.mark.parametrize(
    ("order", "parts"), [("date", 8), ("date", 512), ("date desc", 64), ("amount desc", 64)]
)
def test_windows(rows, keys, order, parts):
    by, cut = ORDERS[order], Cut(parts, 0)
    w = Window.partitionBy(*keys).orderBy(*[b.order for b in by])
    first = Window.partitionBy(*keys).orderBy(by[0].order)
    same(
        rows.withColumns(
            {
                "row_number": F.row_number().over(w).cast("long"),
                "rank": F.rank().over(first).cast("long"),
                "dense_rank": F.dense_rank().over(first).cast("long"),
                "group_rows": F.count("*").over(Window.partitionBy(*keys)),
            }
        ),
        ranked(rows, keys, by, cut),
    )
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    same(
        rows.withColumns({"s": F.sum("amt").over(upto), "n": F.count("*").over(upto)}),
        running(rows, keys, by, {"s": F.col("amt"), "n": F.lit(1).cast("long")}, cut),
    )
    back = {
        "one": lambda w: F.lag("amt", 1).over(w),
        "three": lambda w: F.sum("amt").over(w.rowsBetween(-2, 0)),
    }
    ahead = {"next": lambda w: F.lead("id", 2).over(w)}
    same(
        rows.withColumns({n: f(w) for n, f in {**back, **ahead}.items()}),
        neighbours(rows, keys, by, back, ahead, reach=2, cut=cut),
    )


def test_slices_are_small(rows):
    """The hot key holds a third of all rows; none of its slices comes near that."""
    s = Sliced(rows, ["k"], ORDERS["date"], Cut(256, 0))
    biggest = s.frame.where("k = 1").groupBy("_code", "_sub").count().agg(F.max("count")).first()[0]
    assert biggest <= 2000 / 32


def test_ntile_and_percent_rank(rows):
    by = [By("amt"), By("id")]
    some = rows.where("amt IS NOT NULL")
    w = Window.orderBy("amt", "id")
    plain = some.withColumns(
        {
            "tile": F.ntile(4).over(w).cast("long"),
            "percent_rank": F.percent_rank().over(Window.orderBy("amt")),
        }
    )
    same(plain, quartiles(some, by, cut=Cut(64, 0)))


def test_few_rows_for_many_tiles(spark):
    df = spark.createDataFrame([(i,) for i in range(3)], "id long").withColumn("amt", F.col("id"))
    tiles = [r["tile"] for r in quartiles(df, [By("amt"), By("id")], tiles=5).orderBy("id").collect()]
    assert tiles == [1, 2, 3]


def test_hot_keys_are_few(rows):
    hot = hot_keys(rows, ["k"], Cut(16, 0))
    assert {r["k"] for r in hot.collect()} == {1, None}
    assert hot_keys(rows, ["k"], Cut(16)) is None  # so few rows are never hot


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join(spark, rows, how):
    right = spark.range(0, 60).select(F.col("id").alias("k"), F.lit("x").alias("tag"))
    right = right.unionByName(right.where("k % 10 = 1"))
    copies = rows.unionByName(rows.where("k = 1"))
    plain = copies.join(right, ["k"], how)
    salted = skew_join(copies, right, ["k"], how, Cut(16, 0))
    same(plain, salted)


def test_skew_join_refuses_other_kinds(rows):
    with pytest.raises(ValueError, match="right"):
        skew_join(rows, rows, ["k"], "right")


def test_top_values_keep_ties(rows):
    w = Window.partitionBy("k").orderBy(F.desc("amt"))
    some = rows.where("amt IS NOT NULL AND k IS NOT NULL")
    plain = some.withColumn("place", F.dense_rank().over(w).cast("long")).where("place <= 3")
    same(plain, top_per_group(some, ["k"], "amt", 3))
    everywhere = Window.orderBy(F.desc("amt"))
    plain = some.withColumn("place", F.dense_rank().over(everywhere).cast("long")).where("place <= 5")
    same(plain, top_overall(some, "amt", 5))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), keys=st.integers(1, 4), days=st.integers(1, 30), parts=st.sampled_from([2, 16, 64]))
def test_any_frame(spark, seed, keys, days, parts):
    rnd = random.Random(seed)
    import datetime

    data = [
        (
            rnd.choice([None, *range(keys)]),
            rnd.choice([None, datetime.date(2020, 1, 1) + datetime.timedelta(rnd.randrange(days))]),
            i,
        )
        for i in range(200)
    ]
    df = spark.createDataFrame(data, "k long, d date, id long")
    by = [By("d", bool(seed % 2)), By("id", bool(seed % 3))]
    w = Window.partitionBy("k").orderBy(*[b.order for b in by])
    plain = df.withColumn("row_number", F.row_number().over(w).cast("long"))
    same(plain, ranked(df, ["k"], by, Cut(parts, 0)).drop("rank", "dense_rank", "group_rows"))
