"""Aggregations (A), sorting and limits (O)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeworks.functions.columns import exact_round, quantity_band, ticket_band
from lakeworks.operators import aggregates as agg
from lakeworks.operators.skew import By, Cut
from lakeworks.plans.sales import lines, lines_fact, orders_fact, products, sales, table
from lakeworks.queries.registry import query
from lakeworks.runtime import mean, total

# SQL for an exact sum and mean of prices
SUM = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"
MEAN = SUM + " / COUNT({0})"
REVENUE, TICKET = SUM.format("total_amount"), MEAN.format("total_amount")


def day(column: str):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


@query(
    "a01_revenue_by_state",
    f"SELECT shipping_state, {REVENUE} AS revenue, COUNT(*) AS orders, {TICKET} AS avg_ticket FROM s GROUP BY 1",
)
def _(spark, d):
    return agg.revenue_report(sales(spark, d), ["shipping_state"]).orderBy(F.desc("revenue"))


@query(
    "a02_revenue_by_state_and_status",
    f"""SELECT shipping_state, status, {REVENUE} AS revenue, COUNT(*) AS orders, {TICKET} AS avg_ticket
        FROM s GROUP BY 1, 2""",
)
def _(spark, d):
    return agg.revenue_report(sales(spark, d), ["shipping_state", "status"])


@query(
    "a03_global_panel",
    f"""SELECT COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS customers, {REVENUE} AS revenue,
        {TICKET} AS avg_ticket, MIN(total_amount) AS min_ticket, MAX(total_amount) AS max_ticket FROM o""",
)
def _(spark, d):
    return agg.panel(orders_fact(spark, d), "total_amount", "customer_id")


@query(
    "a04_distinct_customers_by_method",
    "SELECT payment_method, COUNT(DISTINCT customer_id) AS customers FROM o GROUP BY 1",
)
def _(spark, d):
    return orders_fact(spark, d).groupBy("payment_method").agg(
        F.count_distinct("customer_id").alias("customers")
    )


@query(
    "a05_approximate_distinct_within_bound",
    "SELECT COUNT(DISTINCT l_partkey) AS exact, TRUE AS within_bound FROM lineitem",
)
def _(spark, d):
    """The sketch at 1 % standard error must lie within three errors of the exact count."""
    parts = table(spark, d, "lineitem").select("l_partkey")
    # apart: beside an exact distinct count Spark would keep and shuffle a sketch for every different value
    sketch = parts.agg(F.approx_count_distinct("l_partkey", rsd=0.01)).scalar()
    both = parts.agg(F.count_distinct("l_partkey").alias("exact")).withColumn("sketch", sketch)
    off = F.abs(F.col("sketch") - F.col("exact")) / F.col("exact")
    return both.select("exact", (off <= 0.03).alias("within_bound"))


@query(
    "a06_dictionary_aggregate",
    f"""SELECT payment_method, {SUM.format('total_amount')} AS total_amount,
        COUNT(customer_id) AS customer_ids, MAX(order_id) AS order_id FROM o GROUP BY 1""",
)
def _(spark, d):
    fact = orders_fact(spark, d).withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)"))
    out = fact.groupBy("payment_method").agg(
        {"total_amount": "sum", "customer_id": "count", "order_id": "max"}
    )
    return out.select(
        "payment_method",
        F.col("sum(total_amount)").cast("double").alias("total_amount"),
        F.col("count(customer_id)").alias("customer_ids"),
        F.col("max(order_id)").alias("order_id"),
    )


@query(
    "a07_conditional_counts",
    """SELECT COUNT(*) FILTER (status IS NULL) AS status_nulls, COUNT(*) FILTER (total_amount > 300000) AS big,
       CAST(SUM(CAST(status = 'P' AS INT)) AS BIGINT) AS pending, COUNT(*) FILTER (payment_method IS NULL)
       AS payment_method_nulls FROM o""",
)
def _(spark, d):
    return orders_fact(spark, d).agg(
        F.count(F.when(F.col("status").isNull(), 1)).alias("status_nulls"),
        F.count_if(F.col("payment_method").isNull()).alias("payment_method_nulls"),
        F.count_if(F.col("total_amount") > 300000).alias("big"),
        F.sum((F.col("status") == "P").cast("int")).alias("pending"),
    )


@query(
    "a08_ratio_of_sums",
    f"SELECT return_flag, {REVENUE} / SUM(quantity) AS revenue_per_unit FROM li GROUP BY 1",
)
def _(spark, d):
    ratio = F.try_divide(total("total_amount"), F.sum("quantity"))
    return lines(spark, d).groupBy("return_flag").agg(ratio.alias("revenue_per_unit"))


@query(
    "a09_having_big_tickets",
    f"""SELECT product_id, {TICKET} AS avg_ticket, COUNT(*) AS sold FROM li GROUP BY 1
        HAVING {TICKET} > 40000 AND COUNT(*) >= 5""",
)
def _(spark, d):
    per_product = lines(spark, d).groupBy("product_id").agg(
        mean("total_amount").alias("avg_ticket"), F.count("*").alias("sold")
    )
    return per_product.filter((F.col("avg_ticket") > 40000) & (F.col("sold") >= 5))


@query(
    "a10_two_level_loyalty",
    """SELECT COUNT(*) AS customers, CAST(SUM(n) AS DOUBLE) / COUNT(*) AS mean_orders,
       CAST(COUNT(*) FILTER (n >= 3) AS DOUBLE) * 100 / COUNT(*) AS percent_loyal
       FROM (SELECT customer_id, COUNT(*) AS n FROM o GROUP BY 1)""",
)
def _(spark, d):
    per_customer = orders_fact(spark, d).groupBy("customer_id").agg(F.count("*").alias("n"))
    return per_customer.agg(
        F.count("*").alias("customers"),
        (F.sum("n").cast("double") / F.count("*")).alias("mean_orders"),
        (F.count_if(F.col("n") >= 3).cast("double") * 100 / F.count("*")).alias("percent_loyal"),
    )


@query(
    "a11_percent_of_state",
    f"""WITH g AS (SELECT shipping_state, payment_method, {REVENUE} AS revenue, COUNT(*) AS orders,
          SUM(CAST(total_amount AS DECIMAL(18,2))) AS v FROM s GROUP BY 1, 2)
        SELECT shipping_state, payment_method, orders, revenue,
          revenue / CAST(SUM(v) OVER (PARTITION BY shipping_state) AS DOUBLE) * 100 AS percent FROM g""",
)
def _(spark, d):
    return agg.share_in_group(sales(spark, d), ["shipping_state"], ["payment_method"], "total_amount")


@query(
    "a11_percent_with_missing_states",
    f"""WITH x AS (SELECT nullif(shipping_state, 'BRAZIL') AS shipping_state, payment_method, total_amount FROM s),
          g AS (SELECT shipping_state, payment_method, {REVENUE} AS revenue, COUNT(*) AS orders,
            SUM(CAST(total_amount AS DECIMAL(18,2))) AS v FROM x GROUP BY 1, 2)
        SELECT shipping_state, payment_method, orders, revenue,
          revenue / CAST(SUM(v) OVER (PARTITION BY shipping_state) AS DOUBLE) * 100 AS percent FROM g""",
)
def _(spark, d):
    rows = sales(spark, d).withColumn("shipping_state", F.nullif("shipping_state", F.lit("BRAZIL")))
    return agg.share_in_group(rows, ["shipping_state"], ["payment_method"], "total_amount")


MODE = """SELECT shipping_state, payment_method AS top_method, n AS top_method_count FROM (
    SELECT shipping_state, payment_method, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY shipping_state
      ORDER BY COUNT(*) DESC, payment_method) AS place FROM s GROUP BY 1, 2) WHERE place = 1"""


@query("a12_mode_per_state", MODE)
def _(spark, d):
    return agg.mode_of(sales(spark, d), ["shipping_state"], "payment_method", "top_method")


DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT({c}) AS count, MIN({c}) AS min, MAX({c}) AS max,
        ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_SAMP({c}), 4) AS stddev FROM li"""
    for c in ("quantity", "total_amount")
)


@query("a13_describe", DESCRIBE)
def _(spark, d):
    out = agg.describe(lines(spark, d), ["quantity", "total_amount"])
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


SHARES = [0.25, 0.5, 0.75, 0.9]
QUANTILES = ", ".join(
    f"CAST(ROUND(CAST(quantile_cont(total_amount, {p}) AS DECIMAL(18,6)), 3) AS DOUBLE) AS p{round(p * 100)}"
    for p in SHARES
)


def rounded_shares(df):
    return df.withColumns({f"p{round(p * 100)}": exact_round(f"p{round(p * 100)}", 3) for p in SHARES})


@query("a14_percentiles_overall", f"SELECT {QUANTILES} FROM o")
def _(spark, d):
    return rounded_shares(agg.percentiles(orders_fact(spark, d), "total_amount", SHARES))


@query("a14_percentiles_by_state", f"SELECT shipping_state, {QUANTILES} FROM s GROUP BY 1")
def _(spark, d):
    return rounded_shares(agg.percentiles(sales(spark, d), "total_amount", SHARES, ["shipping_state"]))


@query("a14_percentiles_by_state_sliced", f"SELECT shipping_state, {QUANTILES} FROM s GROUP BY 1")
def _(spark, d):
    """The same with every state treated as a hot key."""
    cut = Cut(parts=64, hot_rows=0)
    return rounded_shares(
        agg.percentiles(sales(spark, d), "total_amount", SHARES, ["shipping_state"], cut)
    )


@query(
    "a14_summary_near_exact",
    """SELECT s AS statistic, TRUE AS near FROM
       (VALUES ('count'), ('max'), ('min'), ('25%'), ('50%'), ('75%')) t(s) WHERE EXISTS (FROM orders)""",
)
def _(spark, d):
    """`summary` (approximate quartiles) against exact ones, one row per statistic."""
    fact = orders_fact(spark, d)
    made = fact.select("total_amount").summary("count", "min", "25%", "50%", "75%", "max")
    exact = agg.percentiles(fact, "total_amount", [0.0, 0.25, 0.5, 0.75, 1.0])
    pairs = F.create_map(
        F.lit("min"), "p0", F.lit("25%"), "p25", F.lit("50%"), "p50", F.lit("75%"), "p75", F.lit("max"), "p100",
        F.lit("count"), F.lit(fact.count()).cast("double"),
    )
    values = exact.select(F.explode(pairs).alias("statistic", "exact"))
    near = F.abs(F.col("total_amount").cast("double") - F.col("exact")) <= 0.02 * F.col("exact")
    return made.withColumnRenamed("summary", "statistic").join(values, "statistic").select(
        "statistic", near.alias("near")
    )


@query(
    "a15_price_by_quantity_band",
    """SELECT CASE WHEN quantity < 2 THEN '1 unidade' WHEN quantity < 4 THEN '2-3 unidades'
         WHEN quantity < 6 THEN '4-5 unidades' ELSE '6+ unidades' END AS quantity_band,
       COUNT(*) AS sold, CAST(SUM(ROUND(CAST(unit_price AS DECIMAL(18,6)), 2)) AS DOUBLE) / COUNT(*) AS avg_price,
       CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_amount
       FROM li GROUP BY 1""",
)
def _(spark, d):
    banded = lines(spark, d).withColumn("quantity_band", quantity_band("quantity"))
    out = banded.groupBy("quantity_band").agg(
        F.count("*").alias("sold"),
        mean(exact_round("unit_price")).alias("avg_price"),
        mean("total_amount").alias("avg_amount"),
        F.min("quantity").alias("_first"),
    )
    return out.orderBy("_first").drop("_first")


@query(
    "a15_revenue_by_ticket_band",
    f"""SELECT CASE WHEN total_amount < 50000 THEN 'Baixo' WHEN total_amount < 200000 THEN 'Medio'
         WHEN total_amount < 500000 THEN 'Alto' ELSE 'Premium' END AS band,
       {REVENUE} AS revenue, COUNT(*) AS orders, {TICKET} AS avg_ticket FROM o GROUP BY 1""",
)
def _(spark, d):
    banded = orders_fact(spark, d).withColumn("band", ticket_band("total_amount", scale=1000))
    return agg.revenue_report(banded, ["band"]).orderBy(F.desc("revenue"))


@query(
    "a16_monthly_revenue",
    f"""SELECT CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month,
        {REVENUE} AS revenue, COUNT(*) AS orders, {TICKET} AS avg_ticket FROM o GROUP BY 1, 2""",
)
def _(spark, d):
    dated = orders_fact(spark, d).withColumns(
        {"year": F.year("order_date").cast("long"), "month": F.month("order_date").cast("long")}
    )
    return agg.revenue_report(dated, ["year", "month"]).orderBy("year", "month")


@query(
    "a16_monthly_revenue_by_partner",
    f"""SELECT strftime(order_date, '%Y-%m') AS month, partner_source, {REVENUE} AS revenue,
        COUNT(*) AS orders, {TICKET} AS avg_ticket FROM o GROUP BY 1, 2""",
)
def _(spark, d):
    dated = orders_fact(spark, d).withColumn("month", F.date_format("order_date", "yyyy-MM"))
    return agg.revenue_report(dated, ["month", "partner_source"])


@query(
    "a17_daily_revenue_by_state",
    f"""SELECT strftime(order_date, '%Y-%m-%d') AS order_date, shipping_state, {REVENUE} AS revenue,
        COUNT(*) AS orders, {TICKET} AS avg_ticket FROM s GROUP BY 1, 2""",
)
def _(spark, d):
    out = agg.revenue_report(sales(spark, d), ["order_date", "shipping_state"])
    return out.withColumn("order_date", day("order_date"))


@query(
    "a18_top_ten_products",
    f"""SELECT product_id, {REVENUE} AS total_revenue, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
        CAST(ROUND(CAST({REVENUE} / SUM(quantity) AS DECIMAL(18,6)), 2) AS DOUBLE) AS avg_price FROM li
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(spark, d):
    per_product = lines(spark, d).groupBy("product_id").agg(
        total("total_amount").alias("total_revenue"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        exact_round(F.try_divide(total("total_amount"), F.sum("quantity"))).alias("avg_price"),
    )
    return agg.top_k(per_product, [By("total_revenue", desc=True), By("product_id")], 10)


@query(
    "a19_customer_360",
    f"""SELECT customer_id, {REVENUE} AS lifetime_value, COUNT(*) AS total_orders,
        strftime(MIN(order_date), '%Y-%m-%d') AS first_purchase,
        strftime(MAX(order_date), '%Y-%m-%d') AS last_purchase,
        COUNT(DISTINCT partner_source) AS num_channels FROM o GROUP BY 1""",
)
def _(spark, d):
    return agg.customer_360(orders_fact(spark, d)).withColumns(
        {c: day(c) for c in ("first_purchase", "last_purchase")}
    )


@query(
    "a20_metrics_by_state_and_category",
    f"""SELECT shipping_state, category, {REVENUE} AS revenue, COUNT(*) AS orders, {TICKET} AS avg_ticket
        FROM l JOIN c USING (customer_id) LEFT JOIN p USING (product_id) GROUP BY 1, 2""",
)
def _(spark, d):
    from lakeworks.plans.sales import customers

    fact = lines_fact(spark, d).select("customer_id", "product_id", "total_amount")
    fact = fact.join(customers(spark, d).select("customer_id", "shipping_state"), "customer_id")
    fact = fact.join(products(spark, d).select("product_id", "category"), "product_id", "left")
    return agg.revenue_report(fact, ["shipping_state", "category"])


@query(
    "a20_metrics_by_state_category_method",
    f"""SELECT shipping_state, category, payment_method, {REVENUE} AS revenue, COUNT(*) AS orders,
        {TICKET} AS avg_ticket
        FROM l JOIN c USING (customer_id) LEFT JOIN p USING (product_id) GROUP BY 1, 2, 3""",
)
def _(spark, d):
    from lakeworks.plans.sales import customers

    fact = lines_fact(spark, d).select("customer_id", "product_id", "payment_method", "total_amount")
    fact = fact.join(customers(spark, d).select("customer_id", "shipping_state"), "customer_id")
    fact = fact.join(products(spark, d).select("product_id", "category"), "product_id", "left")
    return agg.revenue_report(fact, ["shipping_state", "category", "payment_method"])


@query(
    "a21_concentration_top_ten",
    """WITH t AS (SELECT shipping_state, customer_id, SUM(CAST(total_amount AS DECIMAL(18,2))) AS v
         FROM s GROUP BY 1, 2),
       r AS (SELECT *, DENSE_RANK() OVER (PARTITION BY shipping_state ORDER BY v DESC) AS k FROM t)
       SELECT COUNT(*) FILTER (k <= 10) AS top_members, CAST(SUM(v) FILTER (k <= 10) AS DOUBLE) AS top_value,
         CAST(SUM(v) AS DOUBLE) AS all_value,
         CAST(SUM(v) FILTER (k <= 10) AS DOUBLE) * 100 / CAST(SUM(v) AS DOUBLE) AS percent FROM r""",
)
def _(spark, d):
    return agg.concentration(sales(spark, d), "shipping_state", "customer_id", "total_amount", 10)


@query(
    "a22_executive_report",
    f"""WITH m AS ({MODE}) SELECT shipping_state, {REVENUE} AS revenue, COUNT(*) AS orders,
        COUNT(DISTINCT customer_id) AS customers, {TICKET} AS avg_ticket, MIN(top_method) AS top_method,
        MIN(top_method_count) AS top_method_count FROM s JOIN m USING (shipping_state) GROUP BY 1""",
)
def _(spark, d):
    report = agg.executive_report(
        sales(spark, d), "shipping_state", "total_amount", "customer_id", "payment_method"
    )
    return report.orderBy(F.desc("revenue"))


@query(
    "a23_date_span_per_partner",
    """SELECT partner_source, strftime(MIN(order_date), '%Y-%m-%d') AS first_date,
       strftime(MAX(order_date), '%Y-%m-%d') AS last_date, COUNT(*) AS rows,
       CAST(datediff('day', MIN(order_date), MAX(order_date)) AS BIGINT) AS days FROM o GROUP BY 1""",
)
def _(spark, d):
    span = orders_fact(spark, d).groupBy("partner_source").agg(
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        F.count("*").alias("rows"),
    )
    return span.withColumn("days", F.datediff("last_date", "first_date").cast("long")).withColumns(
        {c: day(c) for c in ("first_date", "last_date")}
    )


@query(
    "a25_weekly_revenue",
    f"""SELECT strftime(date_trunc('week', order_date), '%Y-%m-%d') AS week, {REVENUE} AS revenue,
        COUNT(*) AS orders, {TICKET} AS avg_ticket FROM o GROUP BY 1""",
)
def _(spark, d):
    week = F.date_format(F.date_trunc("week", "order_date"), "yyyy-MM-dd")
    return agg.revenue_report(orders_fact(spark, d).withColumn("week", week), ["week"])


@query(
    "o01_sorted_report",
    f"""SELECT status, payment_method, {REVENUE} AS revenue, COUNT(*) AS orders, {TICKET} AS avg_ticket
        FROM o GROUP BY 1, 2""",
)
def _(spark, d):
    report = agg.revenue_report(orders_fact(spark, d), ["status", "payment_method"])
    return report.orderBy("status", F.desc("revenue"))


@query(
    "o02_top_twenty_orders",
    """SELECT order_id, customer_id, total_amount, strftime(order_date, '%Y-%m-%d') AS order_date FROM o
       ORDER BY total_amount DESC, order_id LIMIT 20""",
)
def _(spark, d):
    fact = orders_fact(spark, d).select("order_id", "customer_id", "total_amount", "order_date")
    top = agg.top_k(fact, [By("total_amount", desc=True), By("order_id")], 20)
    return top.withColumn("order_date", day("order_date"))


@query("o03_limit_after_sort", "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 5")
def _(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type")
    return events.sort(F.desc("event_id")).limit(5)
