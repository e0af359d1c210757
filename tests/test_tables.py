"""Writers, readers and the arriving files."""

import pytest
from pyspark.sql import functions as F

from lakeworks.operators.joins import for_each_value
from lakeworks.operators.transform import align, compare_schemas, hash_sample, one_per_key
from lakeworks.plans import daily, metrics
from lakeworks.plans.feeds import land_days, product_rows, sale_rows
from lakeworks.plans.sales import orders_fact
from lakeworks.runtime import shared_folder
from lakeworks.schemas import schema
from lakeworks.sinks import tables
from lakeworks.sinks.files import exists, partition_columns, swap_in
from lakeworks.sources import files

DAYS = [("2024-01-14", 1, 10.0), ("2024-01-14", 2, 20.0), ("2024-01-15", 3, 30.0), ("2024-01-15", 4, 40.0),
        ("2024-01-15", 5, 50.0)]


@pytest.fixture
def days(spark):
    return spark.createDataFrame(DAYS, "data_ref string, id long, amount double")


def content(spark, path):
    return sorted((str(r["data_ref"]), r["id"], r["amount"]) for r in spark.read.parquet(path).collect())


def test_rewriting_one_day_leaves_the_other(spark, days, path):
    p = path()
    assert tables.write(days, p, ["data_ref"]) == 5
    tables.write(days.where("data_ref = '2024-01-15'").withColumn("amount", F.lit(1.0)), p, ["data_ref"])
    assert content(spark, p) == [("2024-01-14", 1, 10.0), ("2024-01-14", 2, 20.0), ("2024-01-15", 3, 1.0),
                                 ("2024-01-15", 4, 1.0), ("2024-01-15", 5, 1.0)]
    tables.write(days.where("id = 5"), p, ["data_ref"], dynamic=False)
    assert content(spark, p) == [("2024-01-15", 5, 50.0)]


def test_a_day_that_became_empty_goes(spark, days, path):
    p = path()
    tables.write(days, p, ["data_ref"])
    assert tables.write_refs(days.where("id = 1"), p, "data_ref", ["2024-01-14", "2024-01-15"]) == 1
    assert content(spark, p) == [("2024-01-14", 1, 10.0)]


def test_stray_rows_end_the_write_and_delete_nothing(spark, days, path):
    p = path()
    tables.write(days, p, ["data_ref"])
    for stray in (days, days.withColumn("data_ref", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="none of those to write"):
            tables.write_refs(stray, p, "data_ref", ["2024-01-14"])
    assert len(content(spark, p)) == 5


def test_refs_with_leading_zeros_and_none(spark, path):
    p = path()
    df = spark.createDataFrame([("01", 1), ("02", 2), ("12", 3), (None, 4)], "m string, id long")
    tables.write_refs(df, p, "m", ["01", "02", "12", None])
    again = files.read_refs(spark, p, "m", ["01", "12"])
    assert sorted((r.m, r.id) for r in again.collect()) == [("01", 1), ("12", 3)]
    assert tables.write_refs(again, path(), "m", ["01", "12"]) == 2
    assert tables.write_refs(df.where("id = 1"), p, "m", ["01", None]) == 1
    assert sorted(r.id for r in spark.read.parquet(p).collect()) == [1, 2, 3]


def test_columns_that_came_later_are_read(spark, path):
    p = path()
    spark.createDataFrame([("01", 1)], "k string, id long").write.partitionBy("k").parquet(p)
    spark.createDataFrame([("02", 2, "x")], "k string, id long, x string").write.mode("append").partitionBy("k").parquet(p)
    rows = files.read_refs(spark, p, "k", ["01", "02"]).collect()
    assert sorted((r.k, r.id, r.x) for r in rows) == [("01", 1, None), ("02", 2, "x")]


def test_upsert_with_rows_without_a_partition(spark, path):
    p = path()
    df = spark.createDataFrame([(None, 1, 1), ("01", 2, 1), ("02", 3, 1)], "m string, id long, version int")
    tables.write(df, p, ["m"])
    changes = spark.createDataFrame([("01", 1, 2), (None, 2, 2), (None, 9, 2)], "m string, id long, version int")
    tables.upsert(changes, p, ["id"], ["version"], "m")
    assert sorted((r.id, r.m, r.version) for r in tables.read_text_keys(spark, p, ["m"]).collect()) == [
        (1, "01", 2), (2, None, 2), (3, "02", 1), (9, None, 2)
    ]


def test_archive_adds_and_keeps_the_layout(spark, path):
    live, archive = path("live"), path("archive")
    df = spark.createDataFrame([("a", "2024-01-01", i) for i in range(100)] + [("b", "2024-03-01", 200)], "reason string, day string, id long")
    tables.write(df.selectExpr("reason", "date(day) AS day", "id"), live, ["reason", "day"])
    assert tables.archive_expired(spark, live, archive, "day", "2024-03-02", 30) == (1, 100)
    late = spark.createDataFrame([("a", "2024-01-02", i) for i in (300, 301, 302)], "reason string, day string, id long")
    tables.append(late.selectExpr("reason", "date(day) AS day", "id"), live, ["reason", "day"])
    assert tables.archive_expired(spark, live, archive, "day", "2024-03-02", 30) == (1, 3)
    assert tables.archive_expired(spark, live, archive, "day", "2024-03-02", 30) == (1, 0)
    assert spark.read.parquet(archive).count() == 103 and partition_columns(spark, live) == ["reason", "day"]
    assert partition_columns(spark, archive) == ["_archived_on", "_batch", "reason", "day"]
    tables.compact(spark, live)
    assert partition_columns(spark, live) == ["reason", "day"]


def test_whole_error_messages_are_kept(spark, path):
    log = metrics.RunLog(spark, path("log"), "job", "day")

    def fails():
        raise ValueError("x" * 3000)

    with pytest.raises(ValueError):
        log.stage("bronze", fails)
    assert metrics.errors(metrics.read_log(spark, log.path)).first()["message"] == "x" * 3000


def test_values_without_a_bound(spark):
    grid = for_each_value(spark.range(2).withColumnRenamed("id", "a"), spark.range(3000).withColumnRenamed("id", "b"))
    assert grid.count() == 6000


def test_guard_staging_and_round_trip(spark, days, path):
    p = path()
    tables.guarded_overwrite(days, p)
    with pytest.raises(tables.EmptyWriteError):
        tables.guarded_overwrite(days.where("id > 99"), p)
    assert tables.staged_overwrite(spark.read.parquet(p).where("id > 1"), p) == 4
    assert tables.round_trip(days.where("id > 1"), spark.read.parquet(p)).first()["same"]
    assert not tables.round_trip(days, spark.read.parquet(p)).first()["same"]


def test_swap_without_a_staged_table_touches_nothing(spark, days, path):
    p = path()
    tables.write(days, p)
    with pytest.raises(OSError, match="nothing at"):
        swap_in(spark, path("missing"), p)
    assert spark.read.parquet(p).count() == 5


def test_upsert_moves_rows_between_partitions(spark, days, path):
    p = path()
    tables.write(days.withColumn("version", F.lit(1)), p, ["data_ref"])
    changes = spark.createDataFrame(
        [("2024-01-15", 1, 11.0, 2), ("2024-01-15", 2, 21.0, 2), ("2024-01-16", 9, 90.0, 2)],
        "data_ref string, id long, amount double, version int",
    )
    tables.upsert(changes, p, ["id"], ["version"], "data_ref")
    assert content(spark, p) == [("2024-01-15", 1, 11.0), ("2024-01-15", 2, 21.0), ("2024-01-15", 3, 30.0),
                                 ("2024-01-15", 4, 40.0), ("2024-01-15", 5, 50.0), ("2024-01-16", 9, 90.0)]
    assert not exists(spark, f"{p}/data_ref=2024-01-14")


def test_modes(spark, days, path):
    p = path()
    assert tables.write(days, p, mode="errorifexists") == 5
    assert tables.write(days, p, mode="ignore") == 0
    assert tables.append(days, p) == 5 and spark.read.parquet(p).count() == 10


def test_align_makes_misfits_null(spark):
    df = spark.createDataFrame([("1", "x"), ("zwei", "y")], "a string, b string")
    rows = align(df, schema(a="int", c="date")).collect()
    assert [tuple(r) for r in rows] == [(1, None), (None, None)]


def test_survivor_is_decided_by_the_order(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, "d")], "k int, at int, v string")
    last = {r["k"]: r["v"] for r in one_per_key(df, ["k"], ["at"]).collect()}
    first = {r["k"]: r["v"] for r in one_per_key(df, ["k"], ["at"], keep="first").collect()}
    assert last == {1: "b", 2: "d"} and first == {1: "a", 2: "d"}


def test_hash_sample_is_the_same_every_time(spark):
    a, b = (hash_sample(spark.range(10_000), ["id"], 10) for _ in range(2))
    assert a.exceptAll(b).isEmpty() and 800 < a.count() < 1200


def test_compare_schemas(spark):
    out = compare_schemas(spark, schema(a="int", b="string"), schema(b="long", c="date"))
    assert {r["column"]: r["state"] for r in out.collect()} == {"a": "only left", "b": "other type", "c": "only right"}


def test_corrupt_rows_do_not_depend_on_the_columns_used(spark, path):
    p = path()
    spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":"no","b":"y"}',), ("{broken",)], "value string").write.text(p)
    valid, corrupt = files.read_with_corrupt(spark, p, schema(a="int", b="string"))
    assert valid.count() == 1 and valid.select("b").count() == 1
    assert valid.select("b").first()["b"] == "x" and corrupt.select("_corrupt_record").count() == 2


def test_missing_package_is_named(spark, path):
    with pytest.raises(ImportError, match="delta"):
        files.read_external(spark, "delta", path())


def test_failed_day_is_logged_and_leaves_no_table(spark, sf_dir, path):
    lake = daily.Lake(path("lake"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        daily.run(spark, path("incoming"), lake, ["2024-01-15"], product_rows(spark, sf_dir))
    log = metrics.errors(metrics.read_log(spark, lake.metrics)).collect()
    assert [(r["stage"], r["data_ref"]) for r in log] == [("bronze", "2024-01-15")]
    assert not exists(spark, lake.gold)


def test_two_runs_of_a_day_give_the_same_files_content(spark, sf_dir, path):
    base = path("daily")
    rows = sale_rows(spark, sf_dir, orders_fact(spark, sf_dir).withColumn("data_ref", F.year("order_date").cast("string")))
    refs = land_days(rows, f"{base}/incoming")
    lake, named = daily.Lake(f"{base}/lake"), product_rows(spark, sf_dir)

    def prints():
        return [tables.fingerprint(spark.read.parquet(p)).first() for p in (lake.bronze, lake.silver, lake.gold)]

    daily.run(spark, f"{base}/incoming", lake, refs, named, ingested_at="2024-01-15 06:00:00")
    before = [(r["rows"], r["hash"]) for r in prints()[1:]]
    daily.run(spark, f"{base}/incoming", lake, refs[1:3], named, ingested_at="2024-01-15 06:00:00")
    assert [(r["rows"], r["hash"]) for r in prints()[1:]] == before


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_one_ref_is_told_by_the_number_of_rows(spark, path, monkeypatch):
    """A single partition's write feeds no set with every row; without rows the partition goes."""
    asked, p, observed = [], path(), tables.write_observed
    monkeypatch.setattr(tables, "write_observed", lambda df, at, keys, met, **o: asked.append(met) or observed(df, at, keys, met, **o))
    df = spark.createDataFrame([(1, "01"), (2, None)], "id long, m string")
    tables.write_refs(df, p, "m", ["01", None])
    for ref, left in (("01", {2}), (None, set())):
        some = df.where("m = '01'" if ref else "m is null")
        assert tables.write_refs(some, p, "m", [ref]) == 1 and tables.write_refs(some.limit(0), p, "m", [ref]) == 0
        assert {r.id for r in spark.read.schema("id long, m string").parquet(p).collect()} == left
    assert [bool(met) for met in asked] == [True, False, False, False, False]


def test_refs_met_are_told_by_new_files(spark, path, monkeypatch):
    """No set is fed by every row; a partition without rows goes, the others and those not named stay."""
    asked, p, observed = [], path(), tables.write_observed
    monkeypatch.setattr(tables, "write_observed", lambda df, at, keys, met, **o: asked.append(met) or observed(df, at, keys, met, **o))
    df = spark.createDataFrame([(1, "01"), (2, "02"), (3, None), (4, "04")], "id long, m string")
    assert tables.write_refs(df, p, "m", ["01", "02", None, "04", "05"]) == 4
    assert tables.write_refs(df.where("id = 2"), p, "m", ["01", "02", None, "05"]) == 1
    assert {r.id for r in spark.read.schema("id long, m string").parquet(p).collect()} == {2, 4}
    assert all(set(met) <= {"_without"} for met in asked)
