"""File-level rewrites: untouched files keep their names, and a broken rewrite is brought to its end."""

import pytest
from pyspark.sql import functions as F

from lakeworks.sinks import rewrite, tables
from lakeworks.sinks.files import children


def names(spark, path):
    return {f"{d}/{f}" for d in children(spark, path) if "=" in d for f in children(spark, f"{path}/{d}") if f.endswith(".parquet")}


def rows(spark, path):
    return sorted(map(str, spark.read.parquet(path).select("id", "day", "k").collect()))


@pytest.fixture
def table(spark, path):
    """Two partitions, each with one large file and several small ones."""
    where = path("files")
    df = spark.range(3000).select("id", (F.col("id") % 300).cast("int").alias("day"), (F.col("id") % 2).cast("string").alias("k"))
    df.where("id < 2900").repartition(1).write.partitionBy("k").parquet(where)
    for i in range(4):
        df.where(f"id >= {2900 + 25 * i} and id < {2925 + 25 * i}").repartition(1).write.mode("append").partitionBy("k").parquet(where)
    return where


def test_packing():
    groups = rewrite.packed({"a": 7, "b": 5, "c": 4, "d": 3, "e": 1, "huge": 30}, 10)
    assert groups == [["huge"], ["a", "d"], ["b", "c", "e"]]
    assert rewrite.packed({}, 10) == []


def test_only_small_files_are_put_together(spark, table):
    before, content = names(spark, table), rows(spark, table)
    large = {f for f in before if any(s.file.endswith(f) and s.rows > 100 for s in rewrite.file_stats(spark, table).collect())}
    assert len(before) == 10 and len(large) == 2
    assert rewrite.compact_small(spark, table, target=1 << 20, small=0.005) == 8
    after = names(spark, table)
    assert large < after and len(after) == 4 and rows(spark, table) == content
    assert rewrite.compact_small(spark, table, target=1 << 20, small=0.005) == 0  # one small file a folder stays


def test_archive_touches_only_files_with_expired_rows(spark, path):
    live, archive = path("live"), path("archive")
    for k, day in (("a", "2024-01-01"), ("a", "2024-03-01"), ("b", "2024-03-01")):
        spark.range(50).selectExpr("id", f"date'{day}' as day", f"'{k}' as k").repartition(1).write.mode("append").partitionBy("k").parquet(live)
    mixed = spark.createDataFrame([(900, "2024-01-02"), (901, "2024-03-02")], "id long, day string").selectExpr("id", "date(day) day", "'b' k")
    mixed.repartition(1).write.mode("append").partitionBy("k").parquet(live)
    before = names(spark, live)
    assert tables.archive_expired(spark, live, archive, "day", "2024-03-05", 30) == (101, 51)
    after = names(spark, live)
    assert len(before & after) == 2 and len(after) == 3  # a whole file gone, one written anew without its expired row
    assert {r.id for r in spark.read.parquet(live).where("id >= 900").collect()} == {901}
    assert spark.read.parquet(archive).count() == 51
    assert tables.archive_expired(spark, live, archive, "day", "2024-03-05", 30) == (101, 0) and names(spark, live) == after
    assert tables.archive_expired(spark, live, archive, "day", "2025-03-05", 30) == (0, 101)
    assert names(spark, live) == set()


@pytest.mark.parametrize("died", ["before", "at once", "half", "late"])
def test_a_broken_rewrite_ends_later(spark, table, monkeypatch, died):
    """Whenever the run dies: nothing has changed, or the next call brings it to its end."""
    content, finish = rows(spark, table), rewrite.finish
    if died == "before":
        monkeypatch.setattr(rewrite, "_begin", lambda *a: (_ for _ in ()).throw(OSError("died")))
    calls = []
    monkeypatch.setattr(rewrite, "finish", lambda *a: calls.append(1) or (len(calls) > 1 and (_ for _ in ()).throw(OSError("died"))))
    with pytest.raises(OSError):
        rewrite.compact_small(spark, table, target=1 << 20, small=0.005)
    monkeypatch.undo()
    assert rows(spark, table) == content  # a journal alone changes nothing for readers
    if died in ("half", "late"):
        import json
        import os

        journal = next(n for n in children(spark, table) if n.startswith(rewrite.JOURNAL))
        steps = json.loads(open(f"{table}/{journal}").read())
        for source, target in steps["add"][: 1 if died == "half" else None]:
            os.rename(source.removeprefix("file:"), target.removeprefix("file:"))
        if died == "late":
            os.remove(steps["remove"][0].removeprefix("file:"))
    assert finish(spark, table) == (died != "before")
    assert rows(spark, table) == content
    assert len(names(spark, table)) == (10 if died == "before" else 4)
