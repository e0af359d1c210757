"""Sinks (W). Each query writes the tables, works on what was written and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeworks.operators.aggregates import partition_advice
from lakeworks.operators.transform import union_all
from lakeworks.plans.sales import orders_fact, sales
from lakeworks.queries.aggregates import REVENUE
from lakeworks.queries.registry import query
from lakeworks.runtime import fresh_path, total
from lakeworks.sinks import tables
from lakeworks.sinks.files import children
from lakeworks.sinks.rewrite import compact_small, file_stats
from lakeworks.sources.files import read_parquet


def simple(spark, d):
    return orders_fact(spark, d).select("order_id", "customer_id", "order_date", "total_amount", "status")


def by(df, *keys):
    return df.groupBy(*keys).agg(F.count("*").alias("orders"), total("total_amount").alias("revenue"))


def with_year(df):
    return df.withColumn("year", F.year("order_date"))


def yearly(df):
    return by(df.withColumn("year", F.col("year").cast("long")), "year")


BY_STATUS = f"SELECT status, COUNT(*) AS orders, {REVENUE} AS revenue FROM o GROUP BY 1"
BY_YEAR = f"SELECT CAST(year(order_date) AS BIGINT) AS year, COUNT(*) AS orders, {REVENUE} AS revenue FROM o GROUP BY 1"


@query("w01_overwrite", BY_STATUS)
def _(spark, d):
    """The second write replaces the first."""
    path, fact = fresh_path(spark, "table"), simple(spark, d)
    tables.write(fact.where("status = 'P'"), path)
    tables.write(fact, path)
    return by(spark.read.parquet(path), "status")


@query(
    "w02_append",
    f"""SELECT partner_source AS _source, COUNT(*) AS orders, {REVENUE} AS revenue FROM o GROUP BY 1""",
)
def _(spark, d):
    path, fact = fresh_path(spark, "bronze"), orders_fact(spark, d)
    for partner in ("partner_a", "partner_b", "partner_c"):
        rows = fact.where(F.col("partner_source") == partner).withColumnRenamed("partner_source", "_source")
        tables.append(rows, path, ["_source"])
    return by(spark.read.parquet(path), "_source")


@query(
    "w03_partitioned_write",
    f"""SELECT shipping_state, CAST(year(order_date) AS BIGINT) AS year, COUNT(*) AS orders, {REVENUE} AS revenue
        FROM s GROUP BY 1, 2""",
)
def _(spark, d):
    path = fresh_path(spark, "silver")
    rows = with_year(sales(spark, d)).select("order_id", "total_amount", "shipping_state", "year")
    tables.write(rows, path, ["shipping_state", "year"])
    back = spark.read.parquet(path).withColumn("year", F.col("year").cast("long"))
    return by(back, "shipping_state", "year")


# the years from 1998 on are written again with doubled amounts
REDONE = f"""WITH x AS (SELECT year(order_date) AS year, CASE WHEN year(order_date) >= 1998 THEN 2 ELSE 1 END
    * CAST(total_amount AS DECIMAL(18,2)) AS total_amount FROM o {{0}})
  SELECT CAST(year AS BIGINT) AS year, COUNT(*) AS orders, {REVENUE} AS revenue FROM x GROUP BY 1"""


def redo(spark, d, dynamic):
    path, rows = fresh_path(spark, "layer"), with_year(simple(spark, d))
    tables.write(rows, path, ["year"])
    again = rows.where("year >= 1998").withColumn("total_amount", F.col("total_amount") * 2)
    tables.write(again, path, ["year"], dynamic=dynamic)
    return yearly(spark.read.parquet(path))


@query("w04_dynamic_overwrite", REDONE.format(""))
def _(spark, d):
    return redo(spark, d, dynamic=True)


@query("w04_static_overwrite", REDONE.format("WHERE year(order_date) >= 1998"))
def _(spark, d):
    return redo(spark, d, dynamic=False)


@query(
    "w05_repeatable_layer_write",
    f"""SELECT strftime(order_date, '%Y-%m') AS data_ref, COUNT(*) AS orders, {REVENUE} AS revenue FROM o
        WHERE NOT (strftime(order_date, '%Y-%m') = '1999-05') GROUP BY 1""",
)
def _(spark, d):
    """All months are written twice; one has become empty by the second time and disappears."""
    path = fresh_path(spark, "layer")
    rows = simple(spark, d).withColumn("data_ref", F.date_format("order_date", "yyyy-MM"))
    refs = [r[0] for r in rows.select("data_ref").distinct().collect()]
    tables.write_refs(rows, path, "data_ref", refs)
    tables.write_refs(rows.where("data_ref <> '1999-05'"), path, "data_ref", refs)
    return by(spark.read.parquet(path), "data_ref")


@query("w06_backfill", REDONE.format(""))
def _(spark, d):
    """Three past years are run again in one job; the others keep their files."""
    path, rows = fresh_path(spark, "layer"), with_year(simple(spark, d))
    tables.write(rows, path, ["year"])
    late = rows.withColumn("total_amount", F.when(F.col("year") >= 1998, F.col("total_amount") * 2).otherwise(0))
    tables.write_refs(late.where("year >= 1998"), path, "year", ["1998", "1999", "2000", "2001"])
    return yearly(spark.read.parquet(path))


@query(
    "w07_compaction",
    "SELECT COUNT(*) AS orders, TRUE AS fewer_files, TRUE AS same FROM orders",
)
def _(spark, d):
    path, rows = fresh_path(spark, "table"), simple(spark, d)
    tables.write(rows.repartition(24), path)
    before = tables.layout(spark, path).first()["files"]
    tables.compact(spark, path, files=2)
    after = tables.layout(spark, path)
    same = tables.round_trip(rows, spark.read.parquet(path)).select("same").scalar()
    return after.select(F.col("rows").alias("orders"), (F.col("files") < before).alias("fewer_files"), same.alias("same"))


@query("w08_rows_per_file", "SELECT COUNT(*) AS orders, TRUE AS capped FROM orders")
def _(spark, d):
    path = fresh_path(spark, "table")
    tables.write(simple(spark, d), path, rows_per_file=2000)
    return tables.layout(spark, path).select(
        F.col("rows").alias("orders"), (F.col("rows_in_biggest_file") <= 2000).alias("capped")
    )


@query(
    "w09_append_with_new_column",
    """SELECT order_id, total_amount, CASE WHEN order_id % 2 = 1 THEN payment_method END AS payment_method FROM o""",
)
def _(spark, d):
    path, fact = fresh_path(spark, "table"), orders_fact(spark, d)
    tables.append_evolving(fact.where("order_id % 2 = 0").select("order_id", "total_amount"), path)
    late = fact.where("order_id % 2 = 1").select(
        F.col("order_id").cast("string"), "payment_method", F.col("total_amount").cast("string")
    )
    tables.append_evolving(late, path)
    return read_parquet(spark, path, merge=True)


@query("w10_empty_frame_refused", BY_STATUS)
def _(spark, d):
    path, fact = fresh_path(spark, "table"), simple(spark, d)
    tables.guarded_overwrite(fact, path)
    try:
        tables.guarded_overwrite(fact.where("total_amount < 0"), path)
    except tables.EmptyWriteError:
        return by(spark.read.parquet(path), "status")
    raise AssertionError("an empty frame replaced the table")


@query("w11_staged_overwrite", f"{BY_STATUS} HAVING status <> 'P'")
def _(spark, d):
    """A table rewritten from its own rows: staged, counted, swapped in."""
    path = fresh_path(spark, "table")
    tables.write(simple(spark, d), path)
    tables.staged_overwrite(spark.read.parquet(path).where("status <> 'P'"), path)
    return by(spark.read.parquet(path), "status")


@query("w12_round_trip", "SELECT COUNT(*) AS rows_before, COUNT(*) AS rows_after, TRUE AS same FROM orders")
def _(spark, d):
    path, fact = fresh_path(spark, "table"), simple(spark, d)
    tables.write(fact, path)
    return tables.round_trip(fact, spark.read.parquet(path))


@query(
    "w13_codecs",
    "SELECT codec, COUNT(*) AS orders, TRUE AS named FROM orders, (VALUES ('snappy'), ('gzip'), ('zstd'), ('lz4')) t(codec) GROUP BY 1",
)
def _(spark, d):
    out = []
    for codec, mark in (("snappy", "snappy"), ("gzip", "gz"), ("zstd", "zstd"), ("lz4", "lz4")):
        path = fresh_path(spark, "table")
        tables.write(simple(spark, d), path, codec=codec)
        rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"))
        out.append(
            rows.agg(F.count("*").alias("orders"), F.every(F.col("file").contains(f".{mark}")).alias("named")).select(
                F.lit(codec).alias("codec"), "orders", "named"
            )
        )
    return union_all(out)


@query(
    "w14_partition_advice",
    """WITH d AS (SELECT order_date, COUNT(*) AS n FROM o GROUP BY 1), g AS (
         SELECT 'day' AS grain, strftime(order_date, '%Y-%m-%d') AS label, n FROM d UNION ALL
         SELECT 'month', strftime(order_date, '%Y-%m'), n FROM d UNION ALL SELECT 'year', strftime(order_date, '%Y'), n FROM d),
       parts AS (SELECT grain, label, SUM(n) AS n FROM g GROUP BY 1, 2)
       SELECT grain, COUNT(*) AS partitions, CAST(SUM(n) AS DOUBLE) / COUNT(*) AS mean_rows,
         CAST(MIN(n) AS BIGINT) AS min_rows, CAST(MAX(n) AS BIGINT) AS max_rows,
         CASE WHEN SUM(n) / COUNT(*) < 1000 THEN 'coarser' WHEN SUM(n) / COUNT(*) <= 100000 THEN 'fits daily data'
           WHEN SUM(n) / COUNT(*) <= 1000000 THEN 'fits monthly data' ELSE 'finer' END AS advice FROM parts GROUP BY 1""",
)
def _(spark, d):
    return partition_advice(orders_fact(spark, d), "order_date")


@query(
    "w15_file_layout",
    "SELECT CAST(year(order_date) AS BIGINT) AS year, COUNT(*) AS rows, TRUE AS has_files FROM o GROUP BY 1",
)
def _(spark, d):
    path = fresh_path(spark, "layer")
    tables.write(with_year(simple(spark, d)), path, ["year"])
    out = tables.layout(spark, path, ["year"])
    return out.select(
        F.col("year").cast("long").alias("year"), "rows", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files")
    )


@query(
    "w07_compact_small_files",
    f"SELECT 14 AS files_before, 7 AS files_after, 6 AS untouched, COUNT(*) AS orders, {REVENUE} AS revenue FROM o",
)
def _(spark, d):
    """Eight small files beside six large ones become one; the large ones stay as they are."""
    path, rows = fresh_path(spark, "files"), simple(spark, d)
    rows.where("order_id % 50 <> 0").repartition(6).write.parquet(path)
    rows.where("order_id % 50 = 0").repartition(8).write.mode("append").parquet(path)

    def names():
        return {n for n in children(spark, path) if n.endswith(".parquet")}

    before = names()
    largest = file_stats(spark, path).agg(F.max("bytes")).first()[0]
    compact_small(spark, path, target=largest * 2, small=0.25)
    after = names()
    back = spark.read.parquet(path).agg(F.count("*").alias("orders"), total("total_amount").alias("revenue"))
    return back.select(
        F.lit(len(before)).alias("files_before"), F.lit(len(after)).alias("files_after"), F.lit(len(before & after)).alias("untouched"),
        "orders", "revenue",
    )


@query(
    "w16_archive_expired",
    """SELECT part, COUNT(*) AS orders, strftime(MAX(order_date), '%Y-%m-%d') AS newest FROM (SELECT *,
       CASE WHEN datediff('day', order_date, DATE '2001-08-01') > 365 THEN 'archive' ELSE 'live' END AS part FROM o) GROUP BY 1""",
)
def _(spark, d):
    """Run three times on one day: late rows are added to the archive, then nothing more is found."""
    live, archive = fresh_path(spark, "live"), fresh_path(spark, "archive")
    tables.write(simple(spark, d).where("order_id % 7 <> 0"), live)
    tables.archive_expired(spark, live, archive, "order_date", "2001-08-01", 365)
    tables.append(simple(spark, d).where("order_id % 7 = 0"), live)
    for _run in range(2):
        tables.archive_expired(spark, live, archive, "order_date", "2001-08-01", 365)
    parts = [
        spark.read.parquet(path).select(F.lit(name).alias("part"), "order_date")
        for name, path in (("live", live), ("archive", archive))
    ]
    return union_all(parts).groupBy("part").agg(
        F.count("*").alias("orders"), F.date_format(F.max("order_date"), "yyyy-MM-dd").alias("newest")
    )


@query("w17_repartition", "SELECT COUNT(*) AS orders, TRUE AS apart, 4 AS by_count, 6 AS by_key, 2 AS joined_up FROM orders")
def _(spark, d):
    """Rows of a key meet in one partition; the number of partitions is as asked for."""
    fact = simple(spark, d)
    keyed = fact.repartition(6, "customer_id").withColumn("_part", F.spark_partition_id())
    spread = keyed.groupBy("customer_id").agg(F.count_distinct("_part").alias("n")).agg(F.max("n") == 1).scalar()

    def parts(df):
        return df.withColumn("_p", F.spark_partition_id()).agg(F.count_distinct("_p").cast("int")).scalar()

    return fact.agg(F.count("*").alias("orders")).select(
        "orders", spread.alias("apart"), parts(fact.repartition(4)).alias("by_count"),
        parts(fact.repartition(6, "customer_id")).alias("by_key"),
        parts(fact.repartition(6, "customer_id").coalesce(2)).alias("joined_up"),
    )


@query("w18_modes_ignore_and_error", f"{BY_STATUS} HAVING status = 'P'")
def _(spark, d):
    """Both leave an existing table alone; `errorifexists` says so."""
    path, fact = fresh_path(spark, "table"), simple(spark, d)
    tables.write(fact.where("status = 'P'"), path, mode="errorifexists")
    tables.write(fact, path, mode="ignore")
    try:
        tables.write(fact, path, mode="errorifexists")
    except Exception as error:
        if "PATH_ALREADY_EXISTS" in str(error):
            return by(spark.read.parquet(path), "status")
        raise
    raise AssertionError("the table was written again")


@query(
    "w19_upsert",
    f"""WITH x AS (SELECT order_id, CASE WHEN order_id % 40 = 1 THEN DATE '2001-01-15' ELSE order_date END AS order_date,
          CAST(total_amount AS DECIMAL(18,2)) * CASE WHEN order_id % 40 = 1 OR order_id % 40 = 2 THEN 2 ELSE 1 END AS total_amount FROM o)
        SELECT CAST(year(order_date) AS BIGINT) AS year, COUNT(*) AS orders, {REVENUE} AS revenue FROM x GROUP BY 1""",
)
def _(spark, d):
    """Some orders are new, some change their amount, some also move to another year."""
    path = fresh_path(spark, "table")
    rows = with_year(simple(spark, d)).withColumn("version", F.lit(1))
    tables.write(rows.where("order_id % 40 <> 2"), path, ["year"])
    moved = F.when(F.col("order_id") % 40 == 1, F.lit("2001-01-15").cast("date")).otherwise(F.col("order_date"))
    changes = with_year(
        rows.where("order_id % 40 IN (1, 2)").withColumns(
            {"order_date": moved, "total_amount": F.col("total_amount") * 2, "version": F.lit(2)}
        )
    )
    tables.upsert(changes, path, ["order_id"], ["version"], "year")
    return yearly(spark.read.parquet(path))
