"""Sources (S). Each query writes the tables in the foreign form first and then reads that form."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeworks.plans.feeds import land_legacy, land_pages, land_parquet, sale_rows
from lakeworks.plans.sales import orders_fact, table
from lakeworks.queries.aggregates import REVENUE
from lakeworks.queries.registry import query
from lakeworks.runtime import fresh_path, total
from lakeworks.schemas import LEGACY, PAGE, schema
from lakeworks.sources import files, partners
from lakeworks.sources.quoted_csv import read_quoted_csv

BY_STATUS = f"SELECT status, COUNT(*) AS orders, {REVENUE} AS revenue FROM o GROUP BY 1"


def by(df, *keys):
    return df.groupBy(*keys).agg(F.count("*").alias("orders"), total("total_amount").alias("revenue"))


def simple(spark, d):
    return orders_fact(spark, d).select("order_id", "customer_id", "order_date", "total_amount", "status")


SIMPLE = schema(order_id="long", customer_id="long", order_date="date", total_amount="double", status="string")


@query("s01_csv_inferred", BY_STATUS)
def _(spark, d):
    path = fresh_path(spark, "csv")
    simple(spark, d).write.option("header", True).csv(path)
    return by(files.read_csv(spark, path, samplingRatio=1.0), "status")


@query("s02_csv_with_schema", BY_STATUS)
def _(spark, d):
    path = fresh_path(spark, "csv")
    simple(spark, d).write.option("header", True).csv(path)
    return by(files.read_csv(spark, path, SIMPLE), "status")


@query(
    "s03_legacy_csv",
    f"""SELECT 'São ' || shipping_state AS city, COUNT(*) AS orders, {REVENUE} AS revenue,
        COUNT(*) FILTER (order_id % 10 = 0) AS no_method FROM s GROUP BY 1""",
)
def _(spark, d):
    """Semicolons, ISO-8859-1 letters, N/A for missing, read back through a glob."""
    path = fresh_path(spark, "legacy")
    land_legacy(sale_rows(spark, d), path)
    feed = files.read_legacy_csv(spark, f"{path}/*.csv", LEGACY)
    return feed.groupBy(F.col("cidade_entrega").alias("city")).agg(
        F.count("*").alias("orders"),
        total(F.col("valor_total").cast("double")).alias("revenue"),
        F.count_if(F.col("forma_pagamento").isNull()).alias("no_method"),
    )


@query(
    "s04_csv_options",
    """SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date,
       'said "' || status || '"' || chr(10) || 'twice' AS note FROM o""",
)
def _(spark, d):
    """Own date format, quoted quotes and line breaks inside a field."""
    path = fresh_path(spark, "csv")
    note = F.concat(F.lit('said "'), "status", F.lit('"\ntwice'))
    options = {"dateFormat": "dd/MM/yyyy", "quote": '"', "escape": '"'}
    rows = simple(spark, d).select("order_id", "order_date", note.alias("note"))
    rows.write.options(header=True, quoteAll=True, **options).csv(path)
    target = schema(order_id="long", order_date="date", note="string")
    back = files.read_csv(spark, path, target, multiLine=True, mode="FAILFAST", **options)
    return back.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


@query(
    "s05_json_pages",
    f"SELECT CAST(order_id // 1000 + 1 AS BIGINT) AS page, COUNT(*) AS orders, {REVENUE} AS revenue FROM o GROUP BY 1",
)
def _(spark, d):
    """One JSON document per page; the sales inside are unfolded."""
    path = fresh_path(spark, "pages")
    land_pages(sale_rows(spark, d), path)
    return by(partners.unfold(files.read_json_documents(spark, path, PAGE)), "page")


@query("s06_json_lines_inferred", BY_STATUS)
def _(spark, d):
    path = fresh_path(spark, "json")
    simple(spark, d).write.json(path)
    return by(files.read_json_lines(spark, path), "status")


@query("s07_json_with_schema", BY_STATUS)
def _(spark, d):
    path = fresh_path(spark, "json")
    simple(spark, d).write.json(path)
    return by(files.read_json_lines(spark, path, SIMPLE), "status")


SPLIT = f"""SELECT CASE WHEN order_id % 50 = 7 THEN 'corrupt' ELSE 'valid' END AS part, COUNT(*) AS rows,
    CAST(SUM(CASE WHEN order_id % 50 = 7 THEN 0 ELSE CAST(total_amount AS DECIMAL(18,2)) END) AS DOUBLE) AS revenue
    FROM o GROUP BY 1"""


def split_counts(valid, corrupt):
    a = valid.agg(F.count("*").alias("rows"), total("total_amount").alias("revenue"))
    b = corrupt.agg(F.count("*").alias("rows"), F.lit(0.0).alias("revenue"))
    return a.select(F.lit("valid").alias("part"), "*").unionByName(b.select(F.lit("corrupt").alias("part"), "*"))


@query("s08_corrupt_json_lines", SPLIT)
def _(spark, d):
    """Every fiftieth line is cut off; it is kept as text, apart from the valid rows."""
    path = fresh_path(spark, "json")
    line = F.to_json(F.struct("order_id", "status", "total_amount"))
    cut = F.when(F.col("order_id") % 50 == 7, F.substring(line, 1, 20)).otherwise(line)
    simple(spark, d).select(cut.alias("value")).write.text(path)
    target = schema(order_id="long", status="string", total_amount="double")
    return split_counts(*files.read_with_corrupt(spark, path, target))


@query("s08_corrupt_csv_rows", SPLIT)
def _(spark, d):
    """Every fiftieth amount is no number."""
    path = fresh_path(spark, "csv")
    amount = F.when(F.col("order_id") % 50 == 7, "12,3x").otherwise(F.col("total_amount").cast("decimal(18,2)").cast("string"))
    rows = simple(spark, d).select("order_id", "status", amount.alias("total_amount"))
    rows.write.option("header", True).csv(path)
    target = schema(order_id="long", status="string", total_amount="double")
    return split_counts(*files.read_with_corrupt(spark, path, target, form="csv"))


@query(
    "s08_corrupt_csv_values",
    """SELECT CASE WHEN order_id % 50 = 7 THEN 'corrupt' ELSE 'valid' END AS part, COUNT(*) AS rows,
       COUNT(*) FILTER (order_id % 50 <> 7 AND order_id % 3 = 0) AS with_break,
       COUNT(*) FILTER (order_id % 50 <> 7) AS with_accent FROM o GROUP BY 1""",
)
def _(spark, d):
    """Quoted line breaks, accents in ISO-8859-1 and a quoted heading; every fiftieth amount is no number."""
    path = fresh_path(spark, "csv")
    amount = F.when(F.col("order_id") % 50 == 7, "12,3x").otherwise(F.col("total_amount").cast("string"))
    city = F.when(F.col("order_id") % 3 == 0, "S\u00e3o\nPaulo").otherwise("S\u00e3o Paulo")
    rows = simple(spark, d).select("order_id", city.alias("city"), amount.alias("total_amount"))
    rows.write.options(header=True, quoteAll=True, encoding="ISO-8859-1").csv(path)
    target = schema(order_id="long", city="string", total_amount="double")
    valid, corrupt = files.read_with_corrupt(spark, path, target, form="csv", encoding="ISO-8859-1")
    good = valid.agg(
        F.lit("valid").alias("part"), F.count("*").alias("rows"), F.count_if(F.col("city").contains("\n")).alias("with_break"),
        F.count_if(F.col("city").startswith("S\u00e3o")).alias("with_accent"),
    )
    nothing = F.lit(0).cast("long")
    return good.unionByName(
        corrupt.agg(F.lit("corrupt").alias("part"), F.count("*").alias("rows"), nothing.alias("with_break"), nothing.alias("with_accent"))
    )


@query(
    "s08_quoted_breaks_in_ranges",
    """SELECT status, COUNT(*) AS orders, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       COUNT(*) FILTER (order_id % 3 = 0) AS with_break, SUM(CASE WHEN order_id % 3 = 0 THEN 33 ELSE 17 END)::BIGINT AS letters,
       MIN(order_id) AS first_order, MAX(order_id) AS last_order FROM o GROUP BY 1""",
)
def _(spark, d):
    """One large ISO-8859-1 file, a third of whose rows have quotes and line breaks inside a value, in ranges."""
    path = fresh_path(spark, "csv")
    note = F.when(F.col("order_id") % 3 == 0, 'S\u00e3o Paulo,\n"centro"\n\npara entrega').otherwise("entrega em S\u00e3o P.")
    rows = simple(spark, d).select("order_id", "status", "total_amount", note.alias("note"))
    options = {"encoding": "ISO-8859-1", "escape": '"'}
    rows.coalesce(1).write.options(header=True, quoteAll=True, **options).csv(path)
    target = schema(order_id="long", status="string", total_amount="double", note="string")
    return read_quoted_csv(spark, path, target, mode="FAILFAST", **options).groupBy("status").agg(
        F.count("*").alias("orders"), total("total_amount").alias("revenue"), F.count_if(F.col("note").contains("\n")).alias("with_break"),
        F.sum(F.length("note")).alias("letters"), F.min("order_id").alias("first_order"), F.max("order_id").alias("last_order"),
    )


@query("s09_json_options", "SELECT order_id, status, strftime(order_date, '%Y-%m-%d') AS order_date FROM o")
def _(spark, d):
    """Names without quotes, values in single quotes, dates day first."""
    path = fresh_path(spark, "json")
    line = F.format_string(
        "{order_id: %s, status: '%s', order_date: '%s'}", "order_id", "status", F.date_format("order_date", "dd/MM/yyyy")
    )
    simple(spark, d).select(line.alias("value")).write.text(path)
    target = schema(order_id="long", status="string", order_date="date")
    back = files.read_json_lines(
        spark, path, target, allowUnquotedFieldNames=True, allowSingleQuotes=True, dateFormat="dd/MM/yyyy"
    )
    return back.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


@query(
    "s10_parquet_scan",
    "SELECT l_linestatus, COUNT(*) AS lines, MAX(l_shipdate) = MAX(l_shipdate) AS dated FROM lineitem GROUP BY 1",
)
def _(spark, d):
    lineitem = files.read_parquet(spark, f"{d}/lineitem.parquet")
    return lineitem.groupBy("l_linestatus").agg(
        F.count("*").alias("lines"), F.max("l_shipdate").isNotNull().alias("dated")
    )


@query(
    "s11_parquet_merged_schemas",
    """SELECT order_id, CASE WHEN order_id % 2 = 0 THEN status END AS status,
       CASE WHEN order_id % 2 = 1 THEN payment_method END AS payment_method FROM o""",
)
def _(spark, d):
    path = fresh_path(spark, "merged")
    fact = orders_fact(spark, d)
    fact.where("order_id % 2 = 0").select("order_id", "status").write.parquet(f"{path}/part=0")
    fact.where("order_id % 2 = 1").select("order_id", "payment_method").write.parquet(f"{path}/part=1")
    return files.read_parquet(spark, path, merge=True).drop("part")


@query(
    "s12_file_selection",
    """SELECT how, COUNT(*) AS rows FROM o, (VALUES ('recursive'), ('glob'), ('base path'), ('modified')) t(how)
       WHERE how IN ('recursive', 'modified') OR (how = 'glob' AND order_id % 3 = 0)
         OR (how = 'base path' AND order_id % 3 = 1) GROUP BY 1""",
)
def _(spark, d):
    """Nested folders, a name pattern, one branch under its base path, a time limit."""
    path = fresh_path(spark, "tree")
    fact = simple(spark, d).withColumn("third", (F.col("order_id") % 3).cast("int"))
    for third in range(3):
        fact.where(F.col("third") == third).drop("third").write.parquet(f"{path}/feeds/third={third}")
    base = f"{path}/feeds"
    reads = {
        "recursive": files.read_parquet(spark, path, recursiveFileLookup=True),
        "glob": files.read_parquet(spark, f"{base}/third=0", pathGlobFilter="*.parquet"),
        "base path": files.read_parquet(spark, f"{base}/third=1", basePath=base).where("third = 1"),
        "modified": files.read_parquet(
            spark, base, modifiedAfter="2020-01-01T00:00:00", modifiedBefore="2200-01-01T00:00:00"
        ),
    }
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(how).alias("how"), "rows") for how, df in reads.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


YEARLY = "SELECT CAST(year(order_date) AS BIGINT) AS year, COUNT(*) AS orders, {0} AS revenue FROM o {1} GROUP BY 1"


def yearly(spark, d, form="parquet"):
    path = fresh_path(spark, "yearly")
    fact = simple(spark, d).withColumn("year", F.year("order_date").cast("long"))
    fact.hint("rebalance", "year").write.partitionBy("year").option("header", True).format(form).save(path)
    return path


@query("s13_hive_partitions_all", YEARLY.format(REVENUE, ""))
def _(spark, d):
    back = files.read_partitions(spark, yearly(spark, d))
    return by(back.withColumn("year", F.col("year").cast("long")), "year")


@query("s13_hive_partition_one", YEARLY.format(REVENUE, "WHERE year(order_date) = 1998"))
def _(spark, d):
    back = files.read_partitions(spark, yearly(spark, d), "year = 1998")
    return by(back.withColumn("year", F.col("year").cast("long")), "year")


@query("s13_hive_partitions_csv", YEARLY.format(REVENUE, ""))
def _(spark, d):
    back = files.read_partitions(spark, yearly(spark, d, "csv"), form="csv", header=True, inferSchema=True)
    return by(back.withColumn("year", F.col("year").cast("long")), "year")


@query(
    "s14_days_by_literal_path",
    f"SELECT CAST(year(order_date) AS VARCHAR) AS data_ref, COUNT(*) AS orders, {REVENUE} AS revenue FROM o GROUP BY 1",
)
def _(spark, d):
    """One folder per reference period, named by value only; each is read by its literal path."""
    incoming = fresh_path(spark, "incoming")
    fact = simple(spark, d)
    span = fact.agg(F.year(F.min("order_date")), F.year(F.max("order_date"))).first()
    out = None
    for year in range(span[0], span[1] + 1):
        fact.where(F.year("order_date") == year).write.parquet(f"{incoming}/{year}/vendas.parquet")
        one = files.read_day(spark, incoming, str(year))
        out = one if out is None else out.unionByName(one)
    return by(out, "data_ref")


@query(
    "s15_rows_from_a_list",
    """SELECT label, COUNT(*) AS orders FROM o JOIN (VALUES ('O', 'open'), ('F', 'finished'), ('P', 'pending')) t(status, label)
       USING (status) GROUP BY 1""",
)
def _(spark, d):
    labels = spark.createDataFrame(
        [("O", "open"), ("F", "finished"), ("P", "pending")], schema(status="string", label="string")
    )
    # the size of rows from a list is not known to the planner, which would sort all orders by three statuses
    return orders_fact(spark, d).join(F.broadcast(labels), "status").groupBy("label").agg(F.count("*").alias("orders"))


@query(
    "s16_calendar_from_a_range",
    f"""WITH g AS (SELECT order_date, {REVENUE} AS revenue FROM o GROUP BY 1)
        SELECT strftime(day, '%Y-%m-%d') AS day, COALESCE(revenue, 0) AS revenue FROM
          (SELECT CAST(UNNEST(generate_series((SELECT MIN(order_date) FROM o), (SELECT MAX(order_date) FROM o), INTERVAL 1 DAY)) AS DATE) AS day)
          LEFT JOIN g ON order_date = day""",
)
def _(spark, d):
    """A day without orders still has a row: the calendar comes from a number range."""
    fact = orders_fact(spark, d)
    daily = fact.groupBy("order_date").agg(total("total_amount").alias("revenue"))
    first, last = daily.agg(F.min("order_date"), F.max("order_date")).first()
    days = spark.range((last - first).days + 1)
    calendar = days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("order_date"))
    out = calendar.join(daily, "order_date", "left").fillna({"revenue": 0.0})
    return out.select(F.date_format("order_date", "yyyy-MM-dd").alias("day"), "revenue")


@query(
    "s17_lineage_columns",
    """SELECT 'partner_c' AS _source, COUNT(*) AS rows, TRUE AS from_file, '2024-01-15 06:00:00' AS ingested FROM o""",
)
def _(spark, d):
    path = fresh_path(spark, "partner-c")
    land_parquet(sale_rows(spark, d), path)
    feed = partners.parquet_feed(spark, path, ingested_at="2024-01-15 06:00:00")
    return feed.groupBy("_source").agg(
        F.count("*").alias("rows"),
        F.every(F.col("_file_origin").contains("partner-c")).alias("from_file"),
        F.date_format(F.max("_ingestion_ts"), "yyyy-MM-dd HH:mm:ss").alias("ingested"),
    )


@query("s18_orc", BY_STATUS)
def _(spark, d):
    path = fresh_path(spark, "orc")
    simple(spark, d).write.orc(path)
    return by(files.read_orc(spark, path), "status")


@query(
    "s03_s05_s10_three_formats_one_schema",
    f"""SELECT partner_source AS _source, COUNT(*) AS rows, {REVENUE} AS revenue,
        COUNT(*) FILTER (order_id % 10 <> 0) AS with_method, strftime(MIN(order_date), '%Y-%m-%d') AS first_date FROM o GROUP BY 1""",
)
def _(spark, d):
    base, rows = fresh_path(spark, "feeds"), sale_rows(spark, d)
    land_legacy(rows.where("partner_source = 'partner_a'"), f"{base}/a")
    land_pages(rows.where("partner_source = 'partner_b'"), f"{base}/b")
    land_parquet(rows.where("partner_source = 'partner_c'"), f"{base}/c")
    every = partners.unified(
        partners.legacy_feed(spark, f"{base}/a"),
        partners.paged_feed(spark, f"{base}/b"),
        partners.parquet_feed(spark, f"{base}/c"),
    )
    return every.groupBy("_source").agg(
        F.count("*").alias("rows"),
        total("total_amount").alias("revenue"),
        F.count("payment_method").alias("with_method"),
        F.date_format(F.min("order_date"), "yyyy-MM-dd").alias("first_date"),
    )


