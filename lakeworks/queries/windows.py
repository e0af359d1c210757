"""Window functions (N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeworks.functions.columns import exact_round
from lakeworks.operators import windows as win
from lakeworks.operators.aggregates import customer_360
from lakeworks.operators.skew import By, Cut, ranked, with_group_totals
from lakeworks.plans.sales import AS_OF, customers, orders_fact, sales
from lakeworks.queries.aggregates import REVENUE, SUM
from lakeworks.queries.registry import query
from lakeworks.runtime import money, total

SLICED = Cut(parts=256, hot_rows=0)  # treats every larger key as hot, to show the sliced plan
SEQ = "(PARTITION BY customer_id ORDER BY order_date, order_id"
TOTALS = f"SELECT shipping_state, customer_id, {REVENUE} AS spent FROM s GROUP BY 1, 2"


def spent(spark, d):
    return sales(spark, d).groupBy("shipping_state", "customer_id").agg(total("total_amount").alias("spent"))


RANKS = f"""WITH t AS ({TOTALS}) SELECT shipping_state, customer_id, spent,
    ROW_NUMBER() OVER (PARTITION BY shipping_state ORDER BY spent DESC, customer_id) AS row_number,
    RANK() OVER (PARTITION BY shipping_state ORDER BY spent DESC) AS rank,
    DENSE_RANK() OVER (PARTITION BY shipping_state ORDER BY spent DESC) AS dense_rank,
    COUNT(*) OVER (PARTITION BY shipping_state) AS group_rows FROM t"""


@query("n01_three_rankings", RANKS)
def _(spark, d):
    return ranked(spent(spark, d), ["shipping_state"], [By("spent", desc=True), By("customer_id")])


@query("n01_three_rankings_sliced", RANKS)
def _(spark, d):
    """Every state as a hot key, cut into slices."""
    return ranked(spent(spark, d), ["shipping_state"], [By("spent", desc=True), By("customer_id")], SLICED)


METHOD_RANKS = """SELECT order_id, payment_method,
    ROW_NUMBER() OVER (PARTITION BY payment_method ORDER BY order_date, order_id) AS row_number,
    RANK() OVER (PARTITION BY payment_method ORDER BY order_date) AS rank,
    DENSE_RANK() OVER (PARTITION BY payment_method ORDER BY order_date) AS dense_rank FROM o"""


@query("n01_order_places_with_ties", METHOD_RANKS)
def _(spark, d):
    """Orders of a payment method by date: many ties, few and big keys."""
    fact = orders_fact(spark, d).select("payment_method", "order_date", "order_id")
    out = ranked(fact, ["payment_method"], [By("order_date"), By("order_id")], SLICED)
    return out.drop("order_date", "group_rows")


@query(
    "n02_top_three_per_state",
    f"""WITH t AS ({TOTALS}), r AS (SELECT *, DENSE_RANK() OVER (PARTITION BY shipping_state ORDER BY spent DESC)
        AS place FROM t) SELECT * FROM r WHERE place <= 3""",
)
def _(spark, d):
    return win.top_per_group(spent(spark, d), ["shipping_state"], "spent", 3)


@query(
    "n03_top_hundred_customers",
    f"""WITH t AS (SELECT customer_id, {REVENUE} AS spent FROM o GROUP BY 1),
        r AS (SELECT *, DENSE_RANK() OVER (ORDER BY spent DESC) AS place FROM t) SELECT * FROM r WHERE place <= 100""",
)
def _(spark, d):
    per_customer = orders_fact(spark, d).groupBy("customer_id").agg(total("total_amount").alias("spent"))
    return win.top_overall(per_customer, "spent", 100)


@query(
    "n04_previous_and_next_order",
    f"""SELECT order_id, LAG(total_amount) OVER {SEQ}) AS previous_amount, LEAD(total_amount) OVER {SEQ}) AS next_amount,
        strftime(LAG(order_date) OVER {SEQ}), '%Y-%m-%d') AS previous_date FROM o""",
)
def _(spark, d):
    out = win.trend(orders_fact(spark, d))
    return out.select(
        "order_id", "previous_amount", "next_amount",
        F.date_format("previous_date", "yyyy-MM-dd").alias("previous_date"),
    )


CHANGE = f"""SELECT order_id, total_amount - LAG(total_amount) OVER {SEQ}) AS difference,
    (total_amount - LAG(total_amount) OVER {SEQ})) / LAG(total_amount) OVER {SEQ}) * 100 AS change_percent FROM o"""


@query("n05_change_to_previous", CHANGE)
def _(spark, d):
    return win.trend(orders_fact(spark, d)).select("order_id", "difference", "change_percent")


@query("n05_change_to_previous_sliced", CHANGE)
def _(spark, d):
    cut = Cut(parts=4096, hot_rows=4)
    return win.trend(orders_fact(spark, d), cut=cut).select("order_id", "difference", "change_percent")


@query(
    "n06_days_between_orders",
    f"""SELECT order_id, CAST(datediff('day', LAG(order_date) OVER {SEQ}), order_date) AS BIGINT) AS days_since_previous
        FROM o""",
)
def _(spark, d):
    return win.trend(orders_fact(spark, d)).select("order_id", "days_since_previous")


RUNNING = f"""SELECT order_id, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) OVER {SEQ}) AS DOUBLE) AS running_value,
    COUNT(*) OVER {SEQ}) AS running_orders,
    CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) OVER {SEQ}) AS DOUBLE) / COUNT(*) OVER {SEQ}) AS running_mean FROM o"""


@query("n07_running_totals", RUNNING)
def _(spark, d):
    out = win.running_totals(orders_fact(spark, d))
    return out.select("order_id", "running_value", "running_orders", "running_mean")


@query("n07_running_totals_sliced", RUNNING)
def _(spark, d):
    out = win.running_totals(orders_fact(spark, d), cut=Cut(parts=4096, hot_rows=4))
    return out.select("order_id", "running_value", "running_orders", "running_mean")


@query(
    "n08_moving_mean_of_three",
    f"""SELECT order_id, COUNT(*) OVER {SEQ} ROWS 2 PRECEDING) AS window_orders,
        CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) OVER {SEQ} ROWS 2 PRECEDING) AS DOUBLE)
          / COUNT(*) OVER {SEQ} ROWS 2 PRECEDING) AS moving_mean FROM o""",
)
def _(spark, d):
    return win.moving_mean(orders_fact(spark, d), 3).select("order_id", "window_orders", "moving_mean")


@query(
    "n08_remaining_value",
    f"""SELECT order_id, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) OVER {SEQ}
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS remaining_value FROM o""",
)
def _(spark, d):
    return win.remaining(orders_fact(spark, d)).select("order_id", "remaining_value")


@query(
    "n08_seven_day_range",
    """WITH g AS (SELECT shipping_state, order_date, COUNT(*) AS orders, SUM(CAST(total_amount AS DECIMAL(18,2))) AS v
         FROM s GROUP BY 1, 2)
       SELECT shipping_state, strftime(order_date, '%Y-%m-%d') AS order_date, orders, CAST(v AS DOUBLE) AS day_value,
         CAST(SUM(v) OVER (PARTITION BY shipping_state ORDER BY order_date
           RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS range_value FROM g""",
)
def _(spark, d):
    out = win.day_range(sales(spark, d), ["shipping_state"], "order_date", 7, "total_amount")
    return out.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


@query(
    "n02_top_three_with_missing_states",
    f"""WITH t AS (SELECT nullif(shipping_state, 'BRAZIL') AS shipping_state, customer_id, spent FROM ({TOTALS})),
        r AS (SELECT *, DENSE_RANK() OVER (PARTITION BY shipping_state ORDER BY spent DESC) AS place FROM t)
        SELECT * FROM r WHERE place <= 3""",
)
def _(spark, d):
    """Customers without a state are a group like any other."""
    rows = spent(spark, d).withColumn("shipping_state", F.nullif("shipping_state", F.lit("BRAZIL")))
    return win.top_per_group(rows, ["shipping_state"], "spent", 3)


@query(
    "n09_totals_with_missing_customers",
    """WITH b AS (SELECT order_id, CASE WHEN order_id % 20 = 0 THEN NULL ELSE customer_id END AS customer_id FROM o)
       SELECT order_id, customer_id, COUNT(*) OVER (PARTITION BY customer_id) AS orders_of_customer FROM b""",
)
def _(spark, d):
    """Orders without a customer get the total of all such orders, as in a window."""
    fact = orders_fact(spark, d).selectExpr("order_id", "CASE WHEN order_id % 20 <> 0 THEN customer_id END AS customer_id")
    return with_group_totals(fact, ["customer_id"], {"orders_of_customer": F.count("*")})


@query(
    "n09_recurring_customers",
    """SELECT order_id, customer_id, COUNT(*) OVER (PARTITION BY customer_id) AS orders_of_customer,
       CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) OVER (PARTITION BY customer_id) AS DOUBLE) AS spent
       FROM o QUALIFY COUNT(*) OVER (PARTITION BY customer_id) > 1""",
)
def _(spark, d):
    fact = orders_fact(spark, d).select("order_id", "customer_id", "total_amount")
    out = with_group_totals(
        fact, ["customer_id"], {"orders_of_customer": F.count("*"), "spent": total("total_amount")}
    )
    return out.where("orders_of_customer > 1").drop("total_amount")


@query(
    "n10_quartiles_and_percent_rank",
    f"""WITH t AS (SELECT customer_id, {REVENUE} AS spent FROM o GROUP BY 1) SELECT customer_id, spent,
        NTILE(4) OVER (ORDER BY spent, customer_id) AS tile, PERCENT_RANK() OVER (ORDER BY spent) AS percent_rank FROM t""",
)
def _(spark, d):
    per_customer = orders_fact(spark, d).groupBy("customer_id").agg(total("total_amount").alias("spent"))
    return win.quartiles(per_customer, [By("spent"), By("customer_id")])


@query(
    "n10_quartiles_within_state",
    f"""WITH t AS ({TOTALS}) SELECT shipping_state, customer_id, spent,
        NTILE(4) OVER (PARTITION BY shipping_state ORDER BY spent, customer_id) AS tile,
        PERCENT_RANK() OVER (PARTITION BY shipping_state ORDER BY spent) AS percent_rank FROM t""",
)
def _(spark, d):
    return win.quartiles(
        spent(spark, d), [By("spent"), By("customer_id")], keys=["shipping_state"], cut=SLICED
    )


@query(
    "n11_nulls_last",
    """WITH b AS (SELECT order_id, payment_method, CASE WHEN order_id % 7 = 0 THEN NULL ELSE total_amount END AS amount FROM o)
       SELECT order_id, amount, ROW_NUMBER() OVER (PARTITION BY payment_method ORDER BY amount DESC NULLS LAST, order_id) AS place FROM b""",
)
def _(spark, d):
    fact = orders_fact(spark, d).select(
        "order_id", "payment_method", F.expr("IF(order_id % 7 = 0, NULL, total_amount)").alias("amount")
    )
    out = ranked(fact, ["payment_method"], [By("amount", desc=True), By("order_id")])
    return out.select("order_id", "amount", F.col("row_number").alias("place"))


@query(
    "n12_first_reaching_a_million",
    f"""WITH r AS (SELECT customer_id, order_id, order_date, COUNT(*) OVER {SEQ}) AS running_orders,
          CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) OVER {SEQ}) AS DOUBLE) AS running_value FROM o)
        SELECT customer_id, order_id, strftime(order_date, '%Y-%m-%d') AS order_date, running_value, running_orders
        FROM r WHERE running_value >= 1000000
        QUALIFY ROW_NUMBER() OVER {SEQ}) = 1""",
)
def _(spark, d):
    out = win.first_crossing(orders_fact(spark, d), 1_000_000)
    return out.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


@query(
    "n13_mean_of_last_three",
    """SELECT customer_id, COUNT(*) AS orders, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS recent_mean
       FROM (SELECT * FROM o QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) <= 3)
       GROUP BY 1""",
)
def _(spark, d):
    fact = orders_fact(spark, d).select("customer_id", "order_date", "order_id", "total_amount")
    recent = win.last_rows(fact, ["customer_id"], win.ORDER, 3)
    return recent.groupBy("customer_id").agg(
        F.count("*").alias("orders"), (total("total_amount") / F.count("*")).alias("recent_mean")
    )


DECLINE = f"""WITH v AS (SELECT *, (total_amount - LAG(total_amount) OVER {SEQ})) / LAG(total_amount) OVER {SEQ}) * 100 AS ch,
    ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) AS rn FROM o),
  g AS (SELECT customer_id, CAST(SUM(CAST(ch AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean_change,
    COUNT(*) AS orders_seen, {SUM.format('total_amount')} AS recent_value FROM v WHERE rn <= 3 AND ch IS NOT NULL GROUP BY 1)"""


@query(
    "n14_churn_by_decline",
    DECLINE + """ SELECT customer_id, CAST(ROUND(CAST(mean_change AS DECIMAL(18,6)), 3) AS DOUBLE) AS mean_change, orders_seen,
       recent_value, mean_change < -30 AS at_risk FROM g""",
)
def _(spark, d):
    return win.churn_by_decline(orders_fact(spark, d)).withColumn("mean_change", exact_round("mean_change", 3))


@query(
    "n14_decline_by_state",
    DECLINE + """ SELECT shipping_state, COUNT(*) AS customers_at_risk,
       CAST(ROUND(CAST(CAST(SUM(CAST(mean_change AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) AS DECIMAL(18,6)), 2) AS DOUBLE)
         AS mean_change FROM g JOIN c USING (customer_id) WHERE mean_change < -30 GROUP BY 1""",
)
def _(spark, d):
    risky = win.churn_by_decline(orders_fact(spark, d)).where("at_risk")
    placed = risky.join(customers(spark, d).select("customer_id", "shipping_state"), "customer_id")
    mean_change = F.sum(F.col("mean_change").cast("decimal(18,4)")).cast("double") / F.count("*")
    return placed.groupBy("shipping_state").agg(
        F.count("*").alias("customers_at_risk"), exact_round(mean_change).alias("mean_change")
    )


LAST = f"""SELECT customer_id, {REVENUE} AS spent, COUNT(*) AS orders,
    datediff('day', MAX(order_date), DATE '{AS_OF}') AS days FROM o GROUP BY 1"""


@query(
    "n15_churn_by_recency",
    f"""SELECT CASE WHEN days > 90 THEN 'high' WHEN days >= 30 THEN 'medium' ELSE 'low' END AS risk,
        COUNT(*) AS customers, CAST(SUM(orders) AS BIGINT) AS orders, {SUM.format('spent')} AS value,
        {SUM.format('spent')} / CAST(SUM(orders) AS BIGINT) AS avg_ticket FROM ({LAST}) GROUP BY 1""",
)
def _(spark, d):
    return win.churn_by_recency(orders_fact(spark, d), AS_OF)


@query(
    "n15_inactive_since",
    """SELECT segment, COUNT(*) AS customers FROM c WHERE NOT EXISTS (FROM o WHERE o.customer_id = c.customer_id
       AND order_date >= DATE '2001-01-01') GROUP BY 1""",
)
def _(spark, d):
    """Customers without an order in the last months, by anti join."""
    recent = orders_fact(spark, d).where("order_date >= DATE '2001-01-01'").select("customer_id")
    idle = customers(spark, d).join(recent, "customer_id", "left_anti")
    return idle.groupBy("segment").agg(F.count("*").alias("customers"))


SEGMENT = f"""SELECT customer_id, spent, orders, days, CASE WHEN days > 90 THEN 'Em Risco'
    WHEN spent > 5000000 AND orders >= 20 AND days < 30 THEN 'VIP'
    WHEN spent > 2000000 AND orders >= 10 AND days < 60 THEN 'Gold'
    WHEN spent > 500000 AND orders >= 5 THEN 'Silver' WHEN spent > 100000 OR orders >= 2 THEN 'Bronze'
    ELSE 'Outros' END AS segment FROM ({LAST})"""


@query("n16_customer_segments", f"SELECT customer_id, segment FROM ({SEGMENT})")
def _(spark, d):
    return win.segments(orders_fact(spark, d), AS_OF, scale=1000).select("customer_id", "segment")


@query(
    "n16_segment_report",
    f"""SELECT segment, COUNT(*) AS customers, COUNT(*) * 100.0 / (SELECT COUNT(DISTINCT customer_id) FROM o)::DOUBLE AS percent,
        {SUM.format('spent')} / CAST(SUM(orders) AS BIGINT) AS avg_ticket FROM ({SEGMENT}) GROUP BY 1""",
)
def _(spark, d):
    out = win.segment_report(win.segments(orders_fact(spark, d), AS_OF, scale=1000))
    return out.withColumn("percent", F.col("percent").cast("double"))


@query(
    "n16_lifetime_of_segments",
    f"""SELECT segment, MIN(orders) AS fewest_orders, MAX(orders) AS most_orders, {SUM.format('spent')} AS value
        FROM ({SEGMENT}) GROUP BY 1""",
)
def _(spark, d):
    each = win.segments(orders_fact(spark, d), AS_OF, scale=1000)
    return each.groupBy("segment").agg(
        F.min("total_orders").alias("fewest_orders"),
        F.max("total_orders").alias("most_orders"),
        F.sum(money("lifetime_value")).cast("double").alias("value"),
    )


@query(
    "n16_first_and_last_purchase_span",
    """SELECT customer_id, CAST(datediff('day', MIN(order_date), MAX(order_date)) AS BIGINT) AS days_active FROM o GROUP BY 1""",
)
def _(spark, d):
    span = F.datediff("last_purchase", "first_purchase").cast("long")
    return customer_360(orders_fact(spark, d)).select("customer_id", span.alias("days_active"))
