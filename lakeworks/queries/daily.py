"""Daily batch, medallion lake, run metrics and arriving files (L). Reference periods are quarters."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from lakeworks.operators.joins import enrich, revenue_by
from lakeworks.operators.transform import union_all
from lakeworks.plans import daily, medallion, metrics
from lakeworks.plans.feeds import land_days, land_legacy, land_pages, land_parquet, product_rows, sale_rows
from lakeworks.plans.reports import kept, three_reports, three_reports_below_joins
from lakeworks.plans.sales import AS_OF, customers, lines_fact, orders_fact, products, sales
from lakeworks.quality.defects import DIRTY_SQL, inject
from lakeworks.queries.aggregates import REVENUE, TICKET
from lakeworks.queries.registry import query
from lakeworks.runtime import fresh_path, total
from lakeworks.sinks import tables
from lakeworks.sinks.files import file_system
from lakeworks.streaming.arrivals import process_new_files

AT = "2001-08-01 06:00:00"
REF = "strftime(o.order_date, '%Y') || '-Q' || quarter(o.order_date)"

# the landed rows and what Silver keeps of them
LANDED = f"""WITH {DIRTY_SQL}, d AS (SELECT x.*, {REF} AS data_ref FROM x JOIN o USING (order_id)),
  good AS (SELECT * FROM d WHERE customer_id IS NOT NULL AND total_amount >= 0),
  sil AS (SELECT DISTINCT * FROM good),
  gol AS (SELECT data_ref, shipping_state, category, {REVENUE} AS revenue, COUNT(*) AS orders, {TICKET} AS avg_ticket
    FROM sil JOIN c USING (customer_id) LEFT JOIN (SELECT product_id + 1 AS product_no, category FROM p)
      ON product_no = order_id % 5000 + 1 GROUP BY 1, 2, 3)"""


def quarter(column: str):
    return F.concat(F.year(column).cast("string"), F.lit("-Q"), F.quarter(column).cast("string"))


def arrivals(spark, d, period=quarter):
    """Dirty sales with the period they arrive in (that of the date before it was spoilt)."""
    fact = orders_fact(spark, d).withColumn("data_ref", period("order_date"))
    rows = inject(fact, "order_id", "customer_id", "total_amount", "status", "order_date")
    return sale_rows(spark, d, rows.drop("expected_amount"))


def landed(spark, d, period=quarter):
    """(incoming folder, lake, periods)."""
    base = fresh_path(spark, "daily")
    refs = land_days(arrivals(spark, d, period), f"{base}/incoming")
    return f"{base}/incoming", daily.Lake(f"{base}/lake"), refs


@query("l01_bronze_stage", LANDED + " SELECT data_ref AS _data_ref, 'daily_sales_v1' AS _source, COUNT(*) AS rows FROM d GROUP BY 1")
def _(spark, d):
    incoming, lake, refs = landed(spark, d)
    daily.bronze(spark, incoming, lake, refs, AT)
    return spark.read.parquet(lake.bronze).groupBy("_data_ref", "_source").agg(F.count("*").alias("rows"))


@query(
    "l02_silver_stage",
    LANDED + f""" SELECT data_ref, COUNT(*) AS rows, {REVENUE} AS revenue,
      (SELECT COUNT(*) FROM d WHERE d.data_ref = sil.data_ref AND (customer_id IS NULL OR total_amount < 0)) AS rejected
      FROM sil GROUP BY 1""",
)
def _(spark, d):
    incoming, lake, refs = landed(spark, d)
    daily.bronze(spark, incoming, lake, refs, AT)
    daily.silver(spark, lake, refs, ingested_at=AT)
    bad = spark.read.parquet(lake.quarantine).groupBy("data_ref").agg(F.count("*").alias("rejected"))
    good = spark.read.parquet(lake.silver).groupBy("data_ref").agg(
        F.count("*").alias("rows"), total("total_amount").alias("revenue")
    )
    return good.join(bad, "data_ref", "left").fillna({"rejected": 0})


@query("l03_gold_stage", LANDED + " SELECT * FROM gol")
def _(spark, d):
    incoming, lake, refs = landed(spark, d)
    daily.bronze(spark, incoming, lake, refs, AT)
    daily.silver(spark, lake, refs, ingested_at=AT)
    daily.gold(spark, lake, refs, product_rows(spark, d))
    return spark.read.parquet(lake.gold)


COUNTS = LANDED + """ SELECT 'bronze' AS stage, COUNT(*) AS records_count, CAST(0 AS BIGINT) AS records_rejected FROM d
    UNION ALL SELECT 'silver', COUNT(*), (SELECT COUNT(*) FROM d WHERE customer_id IS NULL OR total_amount < 0) FROM sil
    UNION ALL SELECT 'gold', COUNT(*), 0 FROM gol UNION ALL SELECT 'checks', COUNT(*), 0 FROM gol"""


@query("l04_whole_run", COUNTS)
def _(spark, d):
    """All stages for all periods in one run; the result is what its metrics say."""
    incoming, lake, refs = landed(spark, d)
    daily.run(spark, incoming, lake, refs, product_rows(spark, d), ingested_at=AT)
    return metrics.read_log(spark, lake.metrics).select("stage", "records_count", "records_rejected")


@query("l04_run_again_and_backfill", LANDED + " SELECT * FROM gol")
def _(spark, d):
    """The whole run, the same again, then three past periods alone: Gold stays the same."""
    incoming, lake, refs = landed(spark, d)
    named = product_rows(spark, d)
    daily.run(spark, incoming, lake, refs, named, ingested_at=AT)
    daily.run(spark, incoming, lake, refs, named, ingested_at=AT)
    daily.run(spark, incoming, lake, refs[2:5], named, ingested_at=AT)
    return spark.read.parquet(lake.gold)


def feeds(spark, d):
    base, rows = fresh_path(spark, "medallion"), arrivals(spark, d).drop("data_ref")
    folders = {f"partner_{x}": f"{base}/in/{x}" for x in "abc"}
    land_legacy(rows.where("partner_source = 'partner_a'"), folders["partner_a"])
    land_pages(rows.where("partner_source = 'partner_b'"), folders["partner_b"])
    land_parquet(rows.where("partner_source = 'partner_c'"), folders["partner_c"])
    return folders, daily.Lake(f"{base}/lake")


MEDALLION = f"""WITH {DIRTY_SQL}, good AS (SELECT DISTINCT * FROM x WHERE total_amount > 0 AND order_date <= DATE '{AS_OF}'),
  sil AS (SELECT good.*, CASE WHEN customer_id IS NOT NULL THEN 'CUST_' || lpad(CAST(customer_id AS VARCHAR), 5, '0') END AS customer,
    shipping_state FROM good LEFT JOIN c USING (customer_id))"""


@query(
    "l05_medallion_counts",
    MEDALLION + f""" SELECT 'bronze' AS layer, COUNT(*) AS rows FROM x UNION ALL SELECT 'silver', COUNT(*) FROM sil
      UNION ALL SELECT 'quarantine', COUNT(*) FROM x WHERE NOT (total_amount > 0 AND order_date <= DATE '{AS_OF}')""",
)
def _(spark, d):
    folders, lake = feeds(spark, d)
    medallion.run(spark, folders, lake, AS_OF, AT)
    layers = {
        "bronze": medallion.unified(spark, lake),
        "silver": spark.read.parquet(lake.silver),
        "quarantine": spark.read.parquet(lake.quarantine),
    }
    return union_all(
        [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("layer"), "rows") for n, df in layers.items()]
    )


@query(
    "l05_gold_by_state_and_partner",
    MEDALLION + f""" SELECT shipping_state, partner_source AS _source, {REVENUE} AS revenue, COUNT(*) AS orders, {TICKET} AS avg_ticket
      FROM sil GROUP BY 1, 2""",
)
def _(spark, d):
    folders, lake = feeds(spark, d)
    medallion.run(spark, folders, lake, AS_OF, AT)
    return spark.read.parquet(f"{lake.gold}/by_state_and_partner")


@query(
    "l05_gold_customer_360",
    MEDALLION + f""" SELECT customer AS customer_id, {REVENUE} AS lifetime_value, COUNT(*) AS total_orders,
      strftime(MIN(order_date), '%Y-%m-%d') AS first_purchase, strftime(MAX(order_date), '%Y-%m-%d') AS last_purchase,
      COUNT(DISTINCT partner_source) AS num_channels FROM sil GROUP BY 1""",
)
def _(spark, d):
    folders, lake = feeds(spark, d)
    medallion.run(spark, folders, lake, AS_OF, AT)
    out = spark.read.parquet(f"{lake.gold}/customer_360")
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_purchase", "last_purchase")})


@query(
    "l06_new_silver_column_leaves_gold",
    MEDALLION + f""" SELECT strftime(order_date, '%Y-%m') AS month, partner_source AS _source, {REVENUE} AS revenue,
      COUNT(*) AS orders, {TICKET} AS avg_ticket FROM sil GROUP BY 1, 2""",
)
def _(spark, d):
    """Silver gains a column; Gold is made again and is the same."""
    folders, lake = feeds(spark, d)
    medallion.bronze(spark, folders, lake, AT)
    medallion.silver(spark, lake, AS_OF, AT)
    wider = spark.read.parquet(lake.silver).withColumn("coupon", F.lit("NONE"))
    tables.staged_overwrite(wider, lake.silver, ["shipping_state"])
    medallion.gold(spark, lake)
    return spark.read.parquet(f"{lake.gold}/monthly_by_partner")


@query(
    "l07_partition_job_by_state",
    f"""SELECT {REF} AS dt, shipping_state, {REVENUE} AS revenue, COUNT(*) AS orders FROM s o GROUP BY 1, 2""",
)
def _(spark, d):
    source, target = fresh_path(spark, "dt"), fresh_path(spark, "dt-gold")
    rows = sales(spark, d).withColumn("dt", quarter("order_date"))
    tables.write(rows, source, ["dt"])
    refs = [r[0] for r in rows.select("dt").distinct().collect()]
    daily.by_state(spark, source, target, refs)
    daily.by_state(spark, source, target, refs[:3])
    return spark.read.parquet(target)


@query(
    "l08_losses_per_stage",
    LANDED + """, n AS (SELECT (SELECT COUNT(*) FROM d) AS bronze, (SELECT COUNT(*) FROM sil) AS silver, (SELECT COUNT(*) FROM gol) AS gold)
      SELECT (SELECT MIN(data_ref) || '..' || MAX(data_ref) FROM d) AS data_ref, bronze, silver, gold,
        (bronze - silver) * 100.0::DOUBLE / bronze AS silver_lost_percent FROM n""",
)
def _(spark, d):
    incoming, lake, refs = landed(spark, d)
    daily.run(spark, incoming, lake, refs, product_rows(spark, d), ingested_at=AT)
    return metrics.losses(metrics.read_log(spark, lake.metrics))


@query("l09_stage_metrics", f"SELECT stage, records_count, records_rejected, TRUE AS timed, 'INFO' AS level FROM ({COUNTS})")
def _(spark, d):
    incoming, lake, refs = landed(spark, d)
    daily.run(spark, incoming, lake, refs, product_rows(spark, d), ingested_at=AT)
    log = metrics.read_log(spark, lake.metrics)
    timed = (F.col("duration_seconds") > 0).alias("timed")
    return log.select("stage", "records_count", "records_rejected", timed, "level")


@query(
    "l10_questions_to_the_run_log",
    LANDED.replace(REF, "strftime(o.order_date, '%Y')") + """, r AS (SELECT data_ref, COUNT(*) FILTER (customer_id IS NULL OR total_amount < 0) AS rejected FROM d GROUP BY 1)
      SELECT 'errors' AS question, '1990' AS data_ref, CAST(1 AS BIGINT) AS answer FROM r HAVING COUNT(*) > 0
      UNION ALL SELECT 'slow', 'all', 0
      UNION ALL SELECT 'rejected', data_ref, rejected FROM r""",
)
def _(spark, d):
    """Runs year by year (and one year without a file), then asks the log."""
    incoming, lake, refs = landed(spark, d, lambda c: F.year(c).cast("string"))
    named = product_rows(spark, d)
    for ref in refs:
        daily.run(spark, incoming, lake, [ref], named, ingested_at=AT)
    try:
        daily.run(spark, incoming, lake, ["1990"], named, ingested_at=AT)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    log = metrics.read_log(spark, lake.metrics)
    slow = metrics.slow_stages(log, 3600).agg(F.count("*").alias("answer"))
    return union_all(
        [
            metrics.errors(log).groupBy("data_ref").agg(F.count("*").alias("answer")).withColumn("question", F.lit("errors")),
            slow.withColumns({"question": F.lit("slow"), "data_ref": F.lit("all")}),
            metrics.rejected_per_run(log).withColumnRenamed("rejected", "answer").withColumn("question", F.lit("rejected")),
        ]
    ).select("question", "data_ref", "answer")


def schema_of(spark, d):
    return sale_rows(spark, d).schema


@query("l11_files_as_they_arrive", LANDED + " SELECT * FROM gol")
def _(spark, d):
    """A file stream over the landed periods: half of them first, the rest later."""
    incoming, lake, refs = landed(spark, d)
    base = fresh_path(spark, "stream")
    fs, Path = file_system(spark, base)
    fs.mkdirs(Path(f"{base}/in"))
    half = len(refs) // 2
    for part in (refs[:half], refs[half:]):
        for ref in part:
            fs.rename(Path(f"{incoming}/{ref}"), Path(f"{base}/in/{ref}"))
        process_new_files(
            spark, f"{base}/in", lake, f"{base}/checkpoint", schema_of(spark, d), product_rows(spark, d),
            files_per_batch=20, ingested_at=AT,
        )
    return spark.read.parquet(lake.gold)


@query("l12_late_and_repeated_files", LANDED + " SELECT * FROM gol")
def _(spark, d):
    """Every period comes in two files, the second one late; then nothing new comes, and at last the
    checkpoint is lost and every file is taken once more. The tables stay the same."""
    base = fresh_path(spark, "stream")
    lake, rows = daily.Lake(f"{base}/lake"), arrivals(spark, d)
    named = product_rows(spark, d)

    def take(checkpoint):
        process_new_files(
            spark, f"{base}/in", lake, f"{base}/{checkpoint}", schema_of(spark, d), named, files_per_batch=60, ingested_at=AT
        )

    for half in (0, 1):
        part = rows.where(F.col("order_id").cast("long") % 2 == half)
        part.hint("rebalance", "data_ref").write.mode("append").partitionBy("data_ref").parquet(f"{base}/in")
        take("first")
    take("first")
    take("second")
    return spark.read.parquet(lake.gold)


THREE = f"""WITH names AS (SELECT DISTINCT CAST(ceil(product_id / 500) AS BIGINT) AS n FROM p),
  base AS (SELECT l.total_amount, customer_id, shipping_state, customer_name,
      CASE WHEN n IS NOT NULL THEN 'Category ' || n ELSE 'Sem Categoria' END AS category_name
    FROM l LEFT JOIN c USING (customer_id) LEFT JOIN names ON n = CAST(ceil(product_id / 500) AS BIGINT)),
  t AS (SELECT customer_id, customer_name, {REVENUE} AS spent FROM base GROUP BY 1, 2),
  r AS (SELECT *, DENSE_RANK() OVER (ORDER BY spent DESC) AS place FROM t)
  SELECT 'state' AS report, shipping_state AS name, {REVENUE} AS value, COUNT(*) AS number FROM base GROUP BY 2
  UNION ALL SELECT 'category', category_name, {REVENUE}, COUNT(*) FROM base GROUP BY 2
  UNION ALL SELECT 'customer', customer_name, spent, place FROM r WHERE place <= 100"""


def category_number():
    """The category itself: its two-digit text key (`category_key`) names several from the hundredth on."""
    return F.ceil(F.col("product_id") / 500)


def category_names(spark, d):
    names = products(spark, d).select(category_number().alias("category_id")).distinct()
    return names.select("category_id", F.concat(F.lit("Category "), "category_id").alias("category_name"))


def base_of(spark, d):
    names = category_names(spark, d)
    fact = lines_fact(spark, d).withColumn("category_id", category_number())
    fact = fact.join(customers(spark, d), "customer_id", "left")
    fact = enrich(fact, names, ["category_id"], {"category_name": "Sem Categoria"})
    return fact.select("total_amount", "customer_id", "customer_name", "shipping_state", "category_name")


def stacked(reports):
    return union_all(
        [
            reports["states"].select(F.lit("state").alias("report"), F.col("shipping_state").alias("name"),
                                     F.col("revenue").alias("value"), F.col("orders").alias("number")),
            reports["categories"].select(F.lit("category").alias("report"), F.col("category_name").alias("name"),
                                         F.col("revenue").alias("value"), F.col("orders").alias("number")),
            reports["customers"].select(F.lit("customer").alias("report"), F.col("customer_name").alias("name"),
                                        F.col("spent").alias("value"), F.col("place").alias("number")),
        ]
    )


@query("l13_three_reports_one_base", THREE)
def _(spark, d):
    """The joined base is computed once and kept for three reports."""
    path = fresh_path(spark, "reports")
    with kept(base_of(spark, d)) as base:
        stacked(three_reports(base)).write.parquet(path)
    return spark.read.parquet(path)


@query("l13_three_reports_below_joins", THREE)
def _(spark, d):
    """The sums made below the joins, nothing kept in memory."""
    path = fresh_path(spark, "reports")
    fact = lines_fact(spark, d).withColumn("category_id", category_number())
    reports = three_reports_below_joins(fact, customers(spark, d), category_names(spark, d), "Sem Categoria")
    stacked(reports).write.parquet(path)
    return spark.read.parquet(path)


@query("l13_three_reports_recomputed", THREE)
def _(spark, d):
    """The same without keeping the base, for comparison."""
    path = fresh_path(spark, "reports")
    stacked(three_reports(base_of(spark, d))).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "l14_storage_levels",
    f"""SELECT level, shipping_state, COUNT(*) AS orders, {REVENUE} AS revenue FROM s,
        (VALUES ('disk'), ('memory'), ('memory and disk')) t(level) GROUP BY 1, 2""",
)
def _(spark, d):
    levels = {
        "memory": StorageLevel.MEMORY_ONLY, "disk": StorageLevel.DISK_ONLY, "memory and disk": StorageLevel.MEMORY_AND_DISK,
    }
    path = fresh_path(spark, "levels")
    for name, level in levels.items():
        with kept(sales(spark, d), level) as base:
            revenue_by(base, ["shipping_state"]).withColumn("level", F.lit(name)).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query(
    "l15_partner_volumes",
    """SELECT COALESCE(partner_source, 'total') AS _source, COUNT(*) AS rows FROM o GROUP BY ROLLUP (partner_source)""",
)
def _(spark, d):
    per = orders_fact(spark, d).groupBy(F.col("partner_source").alias("_source")).agg(F.count("*").alias("rows"))
    everything = per.agg(F.sum("rows").alias("rows")).select(F.lit("total").alias("_source"), "rows")
    return per.unionByName(everything)
