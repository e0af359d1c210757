"""Projections, filters and column operators (P), unions (U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeworks.operators import transform as tf
from lakeworks.plans.sales import customers, lines, orders_fact, products, sales, table
from lakeworks.queries.registry import query
from lakeworks.runtime import money, total
from lakeworks.schemas import LEGACY_NAMES, schema


def day(column: str):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


@query(
    "p01_project_expressions",
    "SELECT o_orderkey AS order_id, o_totalprice * 2 AS twice, upper(o_orderstatus) AS status FROM orders",
)
def _(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        (F.col("o_totalprice") * 2).alias("twice"),
        F.upper("o_orderstatus").alias("status"),
    )


@query(
    "p02_filter_and_or_not",
    """SELECT order_id, total_amount, status FROM o
       WHERE (total_amount > 400000 OR status = 'P') AND NOT payment_method = '5-LOW'""",
)
def _(spark, d):
    wanted = ((F.col("total_amount") > 400000) | (F.col("status") == "P")) & ~(
        F.col("payment_method") == "5-LOW"
    )
    return orders_fact(spark, d).filter(wanted).select("order_id", "total_amount", "status")


@query(
    "p03_filter_sql_text",
    "SELECT order_id, shipping_state, total_amount FROM s WHERE shipping_state = 'NATION_3' AND total_amount > 100000",
)
def _(spark, d):
    fact = sales(spark, d).where("shipping_state = 'NATION_3' AND total_amount > 100000")
    return fact.select("order_id", "shipping_state", "total_amount")


@query(
    "p04_membership_range_null_tests",
    """SELECT payment_method, COUNT(*) AS orders, COUNT(*) FILTER (segment IS NULL) AS no_segment,
       COUNT(*) FILTER (isnan(balance)) AS nan_balance FROM s
       WHERE status IN ('O', 'F') AND order_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
         AND total_amount IS NOT NULL GROUP BY 1""",
)
def _(spark, d):
    fact = sales(spark, d).filter(
        F.col("status").isin("O", "F")
        & F.col("order_date").between("1996-01-01", "1996-12-31")
        & F.col("total_amount").isNotNull()
    )
    return fact.groupBy("payment_method").agg(
        F.count("*").alias("orders"),
        F.count_if(F.col("segment").isNull()).alias("no_segment"),
        F.count_if(F.isnan("balance")).alias("nan_balance"),
    )


@query(
    "p05_add_and_replace_columns",
    """SELECT order_id, line_no, product_id, upper(return_flag) AS return_flag, total_amount,
       total_amount - quantity AS net FROM li""",
)
def _(spark, d):
    out = lines(spark, d).withColumns(
        {"net": F.col("total_amount") - F.col("quantity"), "return_flag": F.upper("return_flag")}
    )
    return out.select("order_id", "line_no", "product_id", "return_flag", "total_amount", "net")


@query(
    "p06_rename_from_mapping",
    """SELECT order_id, customer_id, total_amount, status FROM o""",
)
def _(spark, d):
    """Legacy names and back, through the partner's mapping."""
    legacy = orders_fact(spark, d).select(
        F.col("order_id").alias("cod_pedido"), F.col("customer_id").alias("cod_cliente"),
        F.col("total_amount").alias("valor_total"), F.col("status").alias("situacao"),
    )
    return legacy.withColumnsRenamed(LEGACY_NAMES)


@query("p07_rename_by_position", "SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation")
def _(spark, d):
    return table(spark, d, "nation").toDF("key", "name", "region")


@query("p08_drop_columns", "SELECT s_suppkey, s_name FROM supplier")
def _(spark, d):
    return table(spark, d, "supplier").drop("s_acctbal", "s_nationkey")


@query(
    "p09_literal_alias_cast",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_text, 'lake' AS origin,
       CAST(o_orderstatus = 'P' AS INTEGER) AS pending, TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number,
       CAST(floor(o_totalprice) AS BIGINT) AS whole FROM orders""",
)
def _(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_text"),
        F.lit("lake").alias("origin"),
        (F.col("o_orderstatus") == "P").cast("int").alias("pending"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
        F.floor("o_totalprice").alias("whole"),
    )


@query(
    "p10_conditional_bands",
    """SELECT CASE WHEN total_amount < 100000 THEN 'small' WHEN total_amount < 300000 THEN 'medium'
       ELSE 'large' END AS size, COUNT(*) AS orders FROM o GROUP BY 1""",
)
def _(spark, d):
    size = (
        F.when(F.col("total_amount") < 100000, "small")
        .when(F.col("total_amount") < 300000, "medium")
        .otherwise("large")
    )
    return orders_fact(spark, d).groupBy(size.alias("size")).agg(F.count("*").alias("orders"))


@query(
    "p11_null_defaults",
    """SELECT COALESCE(segment, 'Sem Segmento') AS segment, COALESCE(customer_name, '-') AS customer_name,
       COUNT(*) AS orders FROM o LEFT JOIN (SELECT * FROM c WHERE customer_id % 25 <> 4) USING (customer_id)
       GROUP BY 1, 2""",
)
def _(spark, d):
    known = customers(spark, d).where("customer_id % 25 <> 4")
    fact = orders_fact(spark, d).join(known, "customer_id", "left")
    fact = fact.withColumn("segment", F.coalesce("segment", F.lit("Sem Segmento")))
    return fact.fillna({"customer_name": "-"}).groupBy("segment", "customer_name").agg(
        F.count("*").alias("orders")
    )


@query(
    "p12_align_to_schema",
    """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS BIGINT) AS customer_id,
       TRY_CAST(payment_method AS INTEGER) AS payment_method, CAST(NULL AS VARCHAR) AS shipping_city,
       total_amount FROM o""",
)
def _(spark, d):
    target = schema(
        order_id="string", customer_id="long", payment_method="int", shipping_city="string", total_amount="double"
    )
    return tf.align(orders_fact(spark, d), target)


@query("p13_keep_present_columns", "SELECT order_id, total_amount FROM o")
def _(spark, d):
    return tf.keep_present(orders_fact(spark, d), ["order_id", "shipping_city", "total_amount", "coupon"])


@query("p14_distinct_rows", "SELECT DISTINCT customer_id, payment_method FROM o")
def _(spark, d):
    return orders_fact(spark, d).select("customer_id", "payment_method").distinct()


@query("p14_count_copies", "SELECT customer_id, status, COUNT(*) AS copies FROM o GROUP BY ALL")
def _(spark, d):
    return tf.count_copies(orders_fact(spark, d).select("customer_id", "status"))


@query(
    "p15_drop_duplicates",
    "SELECT COUNT(DISTINCT order_id) AS kept, COUNT(DISTINCT order_id) AS keys, COUNT(*) AS rows FROM li",
)
def _(spark, d):
    """The survivor is any row of the key, so only counts are compared."""
    li = lines(spark, d)
    kept = li.dropDuplicates(["order_id"]).agg(F.count("*").alias("kept"), F.count_distinct("order_id").alias("keys"))
    return kept.withColumn("rows", li.agg(F.count("*")).scalar())


@query(
    "p16_latest_per_key",
    """SELECT customer_id, order_id, strftime(order_date, '%Y-%m-%d') AS order_date, total_amount FROM o
       QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) = 1""",
)
def _(spark, d):
    fact = orders_fact(spark, d).select("customer_id", "order_id", "order_date", "total_amount")
    return tf.one_per_key(fact, ["customer_id"], ["order_date", "order_id"]).withColumn(
        "order_date", day("order_date")
    )


@query(
    "p16_first_per_key",
    """SELECT order_id, line_no, MIN(product_id) AS product_id, MIN(quantity) AS quantity,
       MIN(total_amount) AS total_amount FROM (SELECT * FROM li QUALIFY ROW_NUMBER() OVER (
         PARTITION BY order_id, line_no ORDER BY product_id, quantity, total_amount) = 1) GROUP BY 1, 2""",
)
def _(spark, d):
    """Repeated (order, line) pairs of the line table, first by product, quantity and amount."""
    li = lines(spark, d).select("order_id", "line_no", "product_id", "quantity", "total_amount")
    return tf.one_per_key(
        li, ["order_id", "line_no"], ["product_id", "quantity", "total_amount"], keep="first"
    )


@query("p17_sample_share", "SELECT TRUE AS near_one_percent, COUNT(*) AS rows FROM lineitem")
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    sampled = li.sample(0.01, seed=42).agg(F.count("*")).scalar()
    return li.agg(F.count("*").alias("rows")).select(
        "rows", (F.abs(sampled / F.col("rows") - 0.01) < 0.005).alias("near_one_percent")
    )


@query("p17_hash_sample", "SELECT 0 AS split_customers, TRUE AS near_share WHERE EXISTS (FROM orders)")
def _(spark, d):
    """A sample by customer holds all orders of the customers it holds."""
    fact = orders_fact(spark, d).select("customer_id", "order_id")
    picked = tf.hash_sample(fact, ["customer_id"], 10)
    all_of = fact.groupBy("customer_id").agg(F.count("*").alias("n"))
    in_sample = picked.groupBy("customer_id").agg(F.count("*").alias("m"))
    joined = all_of.join(in_sample, "customer_id", "left")
    share = F.count("m") / F.count("*")
    return joined.agg(
        F.count_if(F.col("m").isNotNull() & (F.col("m") != F.col("n"))).cast("int").alias("split_customers"),
        share.between(0.05, 0.15).alias("near_share"),
    )


@query(
    "p18_schema_as_rows",
    """SELECT column_name AS "column", CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
         WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE 'string' END AS type, (SELECT COUNT(*) FROM orders) AS rows
       FROM (DESCRIBE orders)""",
)
def _(spark, d):
    orders = table(spark, d, "orders")
    out = tf.schema_frame(spark, orders.schema).select("column", "type")
    return out.withColumn("rows", orders.agg(F.count("*")).scalar())


@query(
    "p19_compare_sources",
    """SELECT 'customer' AS source, 'acctbal' AS "column", 'double' AS type, COUNT(*) AS rows, COUNT(*) FILTER (c_acctbal IS NULL) AS nulls FROM customer
       UNION ALL SELECT 'customer', 'nationkey', 'int', COUNT(*), COUNT(*) FILTER (c_nationkey IS NULL) FROM customer
       UNION ALL SELECT 'supplier', 'acctbal', 'double', COUNT(*), COUNT(*) FILTER (s_acctbal IS NULL) FROM supplier
       UNION ALL SELECT 'supplier', 'nationkey', 'int', COUNT(*), COUNT(*) FILTER (s_nationkey IS NULL) FROM supplier""",
)
def _(spark, d):
    frames = {}
    for name, prefix in (("customer", "c_"), ("supplier", "s_")):
        df = table(spark, d, name).select(f"{prefix}acctbal", f"{prefix}nationkey")
        frames[name] = df.toDF(*[c.removeprefix(prefix) for c in df.columns])
    return tf.null_comparison(frames)


@query(
    "p20_bounded_head",
    "SELECT event_id, event_type, user_id FROM events ORDER BY event_id LIMIT 7",
)
def _(spark, d):
    """`head` of a sorted frame: tasks keep seven rows each, seven reach the driver."""
    events = table(spark, d, "events").select("event_id", "event_type", "user_id")
    rows = events.orderBy("event_id").head(7)
    return spark.createDataFrame(rows, events.schema)


@query(
    "p21_plan_inspection",
    """SELECT TRUE AS pushed, TRUE AS pruned, (SELECT COUNT(*) FROM lineitem
       WHERE l_quantity > 30) AS rows""",
)
def _(spark, d):
    """The filter reaches the scan, and the scan reads only the columns used."""
    big = table(spark, d, "lineitem").where("l_quantity > 30").groupBy("l_returnflag").agg(
        F.sum("l_tax").alias("tax"), F.count("*").alias("rows")
    )
    text = tf.plan_text(big)
    read = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    return big.agg(F.sum("rows").alias("rows")).select(
        F.lit("GreaterThan(l_quantity,30.0)" in text).alias("pushed"),
        F.lit(all("l_extendedprice" not in line for line in read)).alias("pruned"),
        "rows",
    )


@query(
    "u01_union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def _(spark, d):
    a = table(spark, d, "customer").selectExpr("c_custkey id", "c_name name", "c_mktsegment segment", "c_acctbal balance")
    b = table(spark, d, "supplier").selectExpr("s_acctbal balance", "s_suppkey id", "s_name name")
    return tf.union_all([a, b])


@query(
    "u02_union_by_position",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def _(spark, d):
    a = table(spark, d, "customer").selectExpr("c_custkey id", "c_name name")
    return a.union(table(spark, d, "supplier").select("s_suppkey", "s_name"))


@query(
    "u03_normalise_then_union",
    """SELECT partner_source AS _source, CAST(order_id AS VARCHAR) AS order_id, total_amount,
       strftime(order_date, '%Y-%m-%d') AS order_date FROM o WHERE total_amount > 0""",
)
def _(spark, d):
    """Three partners with their own names and types, brought to one schema."""
    fact = orders_fact(spark, d)
    target = schema(order_id="string", total_amount="double", order_date="date", _source="string")

    def of(partner):
        return fact.where(F.col("partner_source") == partner)

    a = of("partner_a").select(
        F.col("order_id").cast("string").alias("cod_pedido"),
        F.col("total_amount").cast("string").alias("valor_total"),
        F.date_format("order_date", "dd/MM/yyyy").alias("data_pedido"),
    )
    b = of("partner_b").select("order_id", "total_amount", F.col("order_date").cast("string"))
    c = of("partner_c").select("order_id", money("total_amount").alias("total_amount"), "order_date")
    parsed = F.try_to_timestamp("order_date", F.lit("dd/MM/yyyy")).cast("date")
    frames = [
        tf.normalise(a, LEGACY_NAMES, target, order_date=parsed, _source=F.lit("partner_a")),
        tf.normalise(b, {}, target, _source=F.lit("partner_b")),
        tf.normalise(c, {}, target, _source=F.lit("partner_c")),
    ]
    valid = tf.union_all(frames).where("order_id IS NOT NULL AND total_amount > 0 AND order_date IS NOT NULL")
    return valid.withColumn("order_date", day("order_date"))


@query(
    "u03_partner_volumes",
    """SELECT partner_source, COUNT(*) AS orders, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM o JOIN (SELECT DISTINCT order_id FROM li JOIN p USING (product_id)) USING (order_id) GROUP BY 1""",
)
def _(spark, d):
    bought = lines(spark, d).join(products(spark, d), "product_id", "left_semi").select("order_id")
    return orders_fact(spark, d).join(bought, "order_id", "left_semi").groupBy("partner_source").agg(
        F.count("*").alias("orders"), total("total_amount").alias("revenue")
    )
