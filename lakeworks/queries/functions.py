"""Scalar functions (F) and Python functions (D)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.functions import columns as fn
from lakeworks.functions import udfs
from lakeworks.operators import windows as win
from lakeworks.plans.sales import AS_OF, customers, lines, orders_fact, products, table
from lakeworks.queries.registry import query
from lakeworks.queries.windows import SEGMENT
from lakeworks.runtime import fresh_path

# ------------------------------------------------------------------ scalar functions


@query(
    "f01_category_key_from_product",
    """SELECT product_id, 'CAT_' || lpad(CAST(CAST(ceil(product_id / 500) AS BIGINT) AS VARCHAR), 2, '0') AS category_id FROM p""",
)
def _(spark, d):
    named = products(spark, d).select("product_id", F.format_string("PROD_%04d", "product_id").alias("code"))
    return named.select("product_id", fn.category_key("code").alias("category_id"))


@query(
    "f02_join_texts_without_nulls",
    """SELECT order_id, concat_ws('|', CASE WHEN status = 'P' THEN 'open' END, CASE WHEN total_amount > 300000 THEN 'big' END,
       CASE WHEN payment_method = '1-URGENT' THEN 'urgent' END) AS marks FROM o""",
)
def _(spark, d):
    marks = F.concat_ws(
        "|",
        F.when(F.col("status") == "P", "open"),
        F.when(F.col("total_amount") > 300000, "big"),
        F.when(F.col("payment_method") == "1-URGENT", "urgent"),
    )
    return orders_fact(spark, d).select("order_id", marks.alias("marks"))


@query(
    "f03_text_functions",
    """SELECT c_custkey, upper(trim('  ' || c_name || ' ')) AS name, substring(c_name, 1, 4) AS prefix,
       CAST(length(c_name) AS BIGINT) AS letters, lower(c_mktsegment) AS segment FROM customer""",
)
def _(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        F.upper(F.trim(F.concat(F.lit("  "), "c_name", F.lit(" ")))).alias("name"),
        F.substring("c_name", 1, 4).alias("prefix"),
        F.length("c_name").cast("long").alias("letters"),
        F.lower("c_mktsegment").alias("segment"),
    )


@query(
    "f04_split_and_explode",
    "SELECT word, COUNT(*) AS parts FROM (SELECT UNNEST(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1",
)
def _(spark, d):
    words = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("parts"))


@query(
    "f05_dates_from_text",
    """SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date, strftime(order_date, '%Y-%m-%d') || ' 06:30:00' AS at FROM o
       WHERE order_id % 10 <> 9 UNION ALL SELECT order_id, NULL, NULL FROM o WHERE order_id % 10 = 9""",
)
def _(spark, d):
    """Dates in two formats and some that are none; what fits no format is null."""
    number = F.col("order_id") % 10
    text = (
        F.when(number == 9, "not a date")
        .when(number < 5, F.date_format("order_date", "dd/MM/yyyy"))
        .otherwise(F.date_format("order_date", "yyyy-MM-dd"))
    )
    rows = orders_fact(spark, d).select("order_id", text.alias("text"))
    day = fn.parse_date("text", ["dd/MM/yyyy", "yyyy-MM-dd"])
    at = F.try_to_timestamp(F.concat(day.cast("string"), F.lit(" 06:30:00")), F.lit("yyyy-MM-dd HH:mm:ss"))
    return rows.select(
        "order_id", day.cast("string").alias("order_date"), F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at")
    )


@query(
    "f06_date_parts",
    """SELECT CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month,
       CAST(dayofweek(order_date) + 1 AS BIGINT) AS weekday, strftime(order_date, '%Y-%m') AS label, COUNT(*) AS orders
       FROM o GROUP BY ALL""",
)
def _(spark, d):
    parts = [
        F.year("order_date").cast("long").alias("year"),
        F.month("order_date").cast("long").alias("month"),
        F.dayofweek("order_date").cast("long").alias("weekday"),
        F.date_format("order_date", "yyyy-MM").alias("label"),
    ]
    return orders_fact(spark, d).groupBy(*parts).agg(F.count("*").alias("orders"))


@query(
    "f07_date_arithmetic",
    f"""SELECT order_id, CAST(datediff('day', order_date, DATE '{AS_OF}') AS BIGINT) AS age,
        strftime(order_date + INTERVAL 30 DAY, '%Y-%m-%d') AS due, strftime(order_date - INTERVAL 7 DAY, '%Y-%m-%d') AS week_before FROM o""",
)
def _(spark, d):
    today = F.lit(AS_OF).cast("date")
    return orders_fact(spark, d).select(
        "order_id",
        F.datediff(today, "order_date").cast("long").alias("age"),
        F.date_add("order_date", 30).cast("string").alias("due"),
        F.date_sub("order_date", 7).cast("string").alias("week_before"),
    )


@query(
    "f08_time_zone",
    """SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS local_time FROM events""",
)
def _(spark, d):
    local = F.from_utc_timestamp(F.col("ts").cast("timestamp"), "America/Sao_Paulo")
    return table(spark, d, "events").select(
        "event_id", F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_time")
    )


@query(
    "f09_rounding_and_arithmetic",
    """SELECT order_id, CAST(ROUND(CAST(total_amount AS DECIMAL(18,6)), 1) AS DOUBLE) AS rounded, CAST(ceil(total_amount) AS BIGINT) AS up,
       CAST(floor(total_amount) AS BIGINT) AS down, order_id % 7 AS rest, total_amount / 2 + 1 AS half FROM o""",
)
def _(spark, d):
    amount = F.col("total_amount")
    return orders_fact(spark, d).select(
        "order_id",
        fn.exact_round(amount, 1).alias("rounded"),
        F.ceil(amount).alias("up"),
        F.floor(amount).alias("down"),
        (F.col("order_id") % 7).alias("rest"),
        (amount / 2 + 1).alias("half"),
    )


@query(
    "f10_null_and_nan_functions",
    """SELECT order_id, COALESCE(CASE WHEN order_id % 5 = 0 THEN NULL ELSE status END, '?') AS status,
       order_id % 5 = 0 AS missing, CASE WHEN order_id % 3 = 0 THEN 'third' ELSE 'other' END AS kind, order_id % 11 = 0 AS not_a_number FROM o""",
)
def _(spark, d):
    missing = F.when(F.col("order_id") % 5 != 0, F.col("status"))
    number = F.when(F.col("order_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("total_amount"))
    return orders_fact(spark, d).select(
        "order_id",
        F.coalesce(missing, F.lit("?")).alias("status"),
        F.isnull(missing).alias("missing"),
        F.expr("IF(order_id % 3 = 0, 'third', 'other')").alias("kind"),
        F.isnan(number).alias("not_a_number"),
    )


@query(
    "f11_arrays_and_structs",
    """SELECT status, count(*) AS methods, MAX(n) AS most FROM (SELECT status, payment_method, COUNT(*) AS n FROM o GROUP BY 1, 2) GROUP BY 1""",
)
def _(spark, d):
    """Small arrays of structs (one entry per payment method) built, measured and unfolded."""
    counts = orders_fact(spark, d).groupBy("status", "payment_method").agg(F.count("*").alias("n"))
    nested = counts.groupBy("status").agg(F.collect_list(F.struct("payment_method", "n")).alias("items"))
    sized = nested.withColumn("methods", F.size("items").cast("long"))
    each = sized.select("status", "methods", F.explode("items").alias("item"))
    return each.groupBy("status", "methods").agg(F.max("item.n").alias("most"))


@query(
    "f12_json_functions",
    """SELECT event_id, json_extract_string(props, '$.k') AS by_path, CAST(json_extract_string(props, '$.k') AS BIGINT) AS parsed,
       '{"id":' || event_id || ',"k":' || json_extract_string(props, '$.k') || '}' AS text,
       event_type IN ('click', 'view') AS listed FROM events""",
)
def _(spark, d):
    parsed = F.from_json("props", T.StructType([T.StructField("k", T.LongType())]))
    listed = F.array_contains(F.array(F.lit("click"), F.lit("view")), F.col("event_type"))
    return table(spark, d, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("by_path"),
        parsed["k"].alias("parsed"),
        F.to_json(F.struct(F.col("event_id").alias("id"), parsed["k"].alias("k"))).alias("text"),
        listed.alias("listed"),
    )


@query(
    "f13_repeatable_keys",
    "SELECT COUNT(*) AS rows, COUNT(DISTINCT order_id) AS keys, TRUE AS same_again, 16 AS buckets FROM o",
)
def _(spark, d):
    """Row keys and buckets from the row's own values, in place of uuid() and rand()."""
    fact = orders_fact(spark, d).select(
        F.sha2(F.concat_ws("|", "order_id", "order_date"), 256).alias("key"),
        fn.bucket_of(["order_id"], 16).alias("bucket"),
    )
    path = fresh_path(spark, "keys")
    fact.write.parquet(path)
    again = fact.exceptAll(spark.read.parquet(path)).agg(F.count("*") == 0).scalar()
    return fact.agg(
        F.count("*").alias("rows"), F.count_distinct("key").alias("keys"), F.count_distinct("bucket").cast("int").alias("buckets")
    ).withColumn("same_again", again)


@query(
    "f14_rules_in_spark_sql",
    f"""SELECT CAST(datediff('day', MAX(order_date), DATE '{AS_OF}') AS BIGINT) AS age, MAX(length(payment_method)) AS longest,
       COUNT(COALESCE(NULLIF(status, 'P'), NULL)) AS not_open, CASE WHEN COUNT(*) > 10 THEN 'many' ELSE 'few' END AS size FROM o""",
)
def _(spark, d):
    """What other dialects call DATEDIFF, LEN, ISNULL and IIF, in Spark SQL."""
    return orders_fact(spark, d).selectExpr(
        f"CAST(datediff(DATE '{AS_OF}', max(order_date)) AS BIGINT) AS age",
        "CAST(max(length(payment_method)) AS BIGINT) AS longest",
        "count(coalesce(nullif(status, 'P'), NULL)) AS not_open",
        "if(count(*) > 10, 'many', 'few') AS size",
    )


# ------------------------------------------------------------------ Python functions

BANDS = """SELECT CASE WHEN amount IS NULL THEN 'Indefinido' WHEN amount < 50000 THEN 'Baixo' WHEN amount < 200000 THEN 'Medio'
    WHEN amount < 500000 THEN 'Alto' ELSE 'Premium' END AS band, COUNT(*) AS orders
    FROM (SELECT CASE WHEN order_id % 10 <> 0 THEN total_amount END AS amount FROM o) GROUP BY 1"""


def amounts(spark, d):
    some = F.when(F.col("order_id") % 10 != 0, F.col("total_amount"))
    return orders_fact(spark, d).select("order_id", some.alias("amount"))


def counted(df):
    return df.groupBy("band").agg(F.count("*").alias("orders"))


@query("d01_python_function", BANDS)
def _(spark, d):
    return counted(amounts(spark, d).withColumn("band", udfs.ticket_band_udf(1000)("amount")))


@query("d02_native_form", BANDS)
def _(spark, d):
    return counted(amounts(spark, d).withColumn("band", fn.ticket_band("amount", 1000)))


@query("d02_forms_agree", "SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS different FROM o")
def _(spark, d):
    both = amounts(spark, d).withColumns(
        {"python": udfs.ticket_band_udf(1000)("amount"), "native": fn.ticket_band("amount", 1000)}
    )
    return udfs.count_differences(both, "python", "native")


@query("d03_pandas_function", BANDS)
def _(spark, d):
    return counted(amounts(spark, d).withColumn("band", udfs.ticket_band_pandas(1000)("amount")))


@query("d04_function_of_three_columns", f"SELECT customer_id, segment FROM ({SEGMENT})")
def _(spark, d):
    per = win.segments(orders_fact(spark, d), AS_OF, scale=1000)
    made = udfs.segment_udf(1000)("lifetime_value", "total_orders", "days")
    return per.select("customer_id", made.alias("segment"))


LOOKUP = {"O": "open", "F": "finished"}
LABELS = "SELECT order_id, CASE status WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' ELSE 'other' END AS label FROM o"


@query("d05_lookup_by_broadcast_variable", LABELS)
def _(spark, d):
    find = udfs.lookup_udf(spark, LOOKUP, "other")
    return orders_fact(spark, d).select("order_id", find("status").alias("label"))


@query("d05_lookup_as_map", LABELS)
def _(spark, d):
    label = udfs.lookup_native(F.col("status"), LOOKUP, "other")
    return orders_fact(spark, d).select("order_id", label.alias("label"))


@query("d06_case_over_a_view", BANDS)
def _(spark, d):
    return spark.sql(
        """SELECT CASE WHEN amount IS NULL THEN 'Indefinido' WHEN amount < 50000 THEN 'Baixo'
             WHEN amount < 200000 THEN 'Medio' WHEN amount < 500000 THEN 'Alto' ELSE 'Premium' END AS band,
           count(*) AS orders FROM {rows} GROUP BY 1""",
        rows=amounts(spark, d),
    )


@query(
    "d06_temp_view",
    "SELECT segment, COUNT(*) AS lines FROM li JOIN o USING (order_id) JOIN c USING (customer_id) GROUP BY 1",
)
def _(spark, d):
    lines(spark, d).createOrReplaceTempView("lakeworks_lines")
    orders_fact(spark, d).createOrReplaceTempView("lakeworks_orders")
    customers(spark, d).createOrReplaceTempView("lakeworks_customers")
    return spark.sql(
        """SELECT segment, count(*) AS lines FROM lakeworks_lines JOIN lakeworks_orders USING (order_id)
           JOIN lakeworks_customers USING (customer_id) GROUP BY segment"""
    )
