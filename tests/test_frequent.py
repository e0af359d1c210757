"""Frequent keys from sketches: none missed beyond the bound, no count too low, one pass for a table."""

import random

import pytest
from pyspark.sql import functions as F

from lakeworks.operators import frequent
from lakeworks.operators.frequent import bound, key_hash, merged, profile, sketches
from lakeworks.operators.joins import for_each_value
from lakeworks.operators.skew import By, Cut, hot_hashes, ranked, running, skew_join
from lakeworks.quality.quarantine import repeated
from tests.test_skew import same


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a third without, the rest on many keys."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(100 + F.col("id"))
    frame = spark.range(0, 30_000, 1, 12).select("id", key.alias("k"), (F.col("id") % 5).alias("g"), (F.col("id") % 11).alias("v"))
    return frame.withColumn("day", (F.col("id") % 4).cast("int"))


def exact(df, keys):
    return {r["h"]: r["n"] for r in df.groupBy(key_hash(keys).alias("h")).agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("items", [10, 100, 100_000])
def test_counts_and_bound(facts, items):
    sets = [["k"], ["g"], ["k", "g"]]
    found = merged(sketches(facts, sets, items), items).collect()
    for i, keys in enumerate(sets):
        true, mine = exact(facts, keys), {r.key: r["count"] for r in found if r.set == i}
        assert all(r.rows == 30_000 for r in found if r.set == i)
        assert all(true[h] <= n <= true[h] + bound(30_000, items) / 2 for h, n in mine.items())
        assert {h for h, n in true.items() if n > bound(30_000, items)} <= mine.keys()
    if items == 100_000:
        assert {r.key: r["count"] for r in found if r.set == 0} == exact(facts, ["k"])  # nothing was thrown out


def test_days_merge(facts):
    by_day = sketches(facts, [["k"]], 1000, ["day"])
    for days in ([0], [1, 3], [0, 1, 2, 3]):
        some = facts.where(F.col("day").isin(days))
        found = {r.key: r["count"] for r in merged(by_day.where(F.col("day").isin(days)), 1000).collect()}
        true, rows = exact(some, ["k"]), 7500 * len(days)
        assert {h for h, n in true.items() if n > bound(rows, 1000)} <= found.keys()
        assert all(found[h] >= true[h] for h in found)


def test_a_profile_saves_the_pass(facts, monkeypatch):
    cut = Cut(16, 0)
    known = Cut(16, 0, profile(facts, [["k"], ["g"]], cut.items))
    want = {k: sorted(map(str, hot_hashes(facts, [k], cut).collect())) for k in ("k", "g")}
    monkeypatch.setattr(frequent, "sketches", None)
    assert {k: sorted(map(str, hot_hashes(facts, [k], known).collect())) for k in ("k", "g")} == want
    by = [By("v"), By("id")]
    plain = ranked(facts, ["k"], by, known)
    assert plain.count() == 30_000
    with pytest.raises(TypeError):
        hot_hashes(facts, ["v"], known)  # no profile of these, so a pass


def test_results_do_not_depend_on_the_profile(facts):
    by, cut = [By("v"), By("id")], Cut(16, 0)
    other = Cut(16, 0, profile(facts.where("id < 1000"), [["k"], ["g"]], 100))  # of another table
    for keys in (["k"], ["g"]):
        same(running(facts, keys, by, {"s": F.col("v")}, cut), running(facts, keys, by, {"s": F.col("v")}, other))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("kind", ["long", "int", "decimal(20,2)"])
def test_join_with_null_and_hot_keys(spark, facts, how, kind):
    """Hot or not, null keys or not, and whatever the type of the other side's key."""
    right = spark.range(0, 400).select(F.when(F.col("id") == 50, None).otherwise(F.col("id")).cast(kind).alias("k"), F.lit("x").alias("tag"))
    plain = facts.join(right, "k", how)
    for cut in (Cut(16, 0), Cut(16), Cut(16, 0, profile(facts, [["k"]], 200))):
        same(plain, skew_join(facts, right, ["k"], how, cut))


def _largest_share(df):
    """The largest task's share of the rows that come out."""
    rows = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    return max(rows) / sum(rows)


def test_null_keys_are_spread(spark, facts):
    right = spark.range(0, 400).select(F.col("id").alias("k"), F.lit("x").alias("tag"))
    only = facts.where("k is null or k > 200")  # half of the rows have no key, and no key is hot
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        assert _largest_share(only.join(right, "k", "left")) > 0.4
        assert _largest_share(skew_join(only, right, ["k"], "left", Cut(64))) < 0.25
        assert _largest_share(repeated(only, ["k"], "id", "again", Cut(64))) < 0.25
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_with_a_third_of_the_keys_null(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, None, 1, 1, *range(2, 40)]), i) for i in range(600)]
    df, seen, want = spark.createDataFrame(rows, "k long, id long"), set(), {}
    for k, i in rows:
        want[i] = k is not None and k in seen
        seen.add(k)
    for cut in (Cut(16), Cut(16, 0)):
        assert {r.id: r.again for r in repeated(df, ["k"], "id", "again", cut).collect()} == want


def test_each_value_and_null(spark):
    df = spark.range(3)
    values = spark.createDataFrame([("x",), (None,), ("x",)], "tag string")
    assert sorted(map(str, map(tuple, for_each_value(df, values).collect()))) == sorted(str((i, t)) for i in range(3) for t in ("x", None))
    with pytest.raises(ValueError):
        for_each_value(df, spark.range(20), most=10)
