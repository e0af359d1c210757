"""Joins (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeworks.functions.columns import category_key
from lakeworks.operators import joins
from lakeworks.operators.skew import Cut, skew_join
from lakeworks.operators.transform import plan_contains
from lakeworks.plans.sales import customers, lines, orders_fact, products, sales, table
from lakeworks.queries.aggregates import REVENUE
from lakeworks.queries.registry import query
from lakeworks.schemas import NO_CATEGORY, NO_NAME, NO_SEGMENT

# Part of the customers are taken away, so that joins have something to miss.
KNOWN = "customer_id % 25 <> 4"
KNOWN_SQL = f"k AS (SELECT * FROM c WHERE {KNOWN})"
# Every twentieth order has no customer.
BLANK = "CASE WHEN order_id % 20 = 0 THEN NULL ELSE customer_id END"
BLANK_SQL = f"b AS (SELECT * REPLACE ({BLANK} AS customer_id) FROM o)"


def known(spark, d):
    return customers(spark, d).where(KNOWN)


def blanked(spark, d):
    return orders_fact(spark, d).withColumn("customer_id", F.expr(BLANK))


@query(
    "j01_inner",
    f"WITH {KNOWN_SQL} SELECT segment, COUNT(*) AS orders, {REVENUE} AS revenue FROM o JOIN k USING (customer_id) GROUP BY 1",
)
def _(spark, d):
    joined = orders_fact(spark, d).join(known(spark, d), "customer_id", "inner")
    return joins.revenue_by(joined, ["segment"])


@query(
    "j02_left_outer",
    f"""WITH {KNOWN_SQL} SELECT order_id, total_amount, customer_name, segment
        FROM o LEFT JOIN k USING (customer_id)""",
)
def _(spark, d):
    joined = orders_fact(spark, d).join(known(spark, d), on="customer_id", how="left")
    return joined.select("order_id", "total_amount", "customer_name", "segment")


@query(
    "j03_right_outer",
    f"""WITH {KNOWN_SQL} SELECT customer_id, COUNT(order_id) AS orders FROM
        o RIGHT JOIN k USING (customer_id) GROUP BY 1""",
)
def _(spark, d):
    joined = orders_fact(spark, d).join(known(spark, d), "customer_id", "right")
    return joined.groupBy("customer_id").agg(F.count("order_id").alias("orders"))


@query(
    "j03_full_outer",
    f"""WITH {KNOWN_SQL}, {BLANK_SQL} SELECT customer_id, order_id, customer_name FROM b FULL JOIN k USING (customer_id)""",
)
def _(spark, d):
    joined = blanked(spark, d).join(known(spark, d), "customer_id", "full")
    return joined.select("customer_id", "order_id", "customer_name")


@query(
    "j04_left_semi",
    f"WITH {KNOWN_SQL} SELECT order_id, customer_id FROM o WHERE EXISTS (FROM k WHERE k.customer_id = o.customer_id)",
)
def _(spark, d):
    fact = orders_fact(spark, d).select("order_id", "customer_id")
    return fact.join(known(spark, d), "customer_id", "left_semi")


@query(
    "j05_left_anti_orphans",
    f"""WITH {KNOWN_SQL}, {BLANK_SQL} SELECT order_id, customer_id, total_amount FROM b
        WHERE customer_id IS NOT NULL AND NOT EXISTS (FROM k WHERE k.customer_id = b.customer_id)""",
)
def _(spark, d):
    fact = blanked(spark, d).select("order_id", "customer_id", "total_amount")
    return joins.orphans(fact, known(spark, d), "customer_id", "customer_id")


@query(
    "j05_never_bought",
    f"""WITH {KNOWN_SQL}, x AS (FROM o SEMI JOIN k USING (customer_id)) SELECT customer_id, customer_name FROM c
        WHERE NOT EXISTS (FROM x WHERE x.customer_id = c.customer_id)""",
)
def _(spark, d):
    bought = orders_fact(spark, d).join(known(spark, d), "customer_id", "left_semi")
    return customers(spark, d).select("customer_id", "customer_name").join(bought, "customer_id", "left_anti")


@query(
    "j06_different_column_names",
    """SELECT n_name, COUNT(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""",
)
def _(spark, d):
    supplier, nation = table(spark, d, "supplier"), table(spark, d, "nation")
    joined = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    return joined.groupBy("n_name").agg(F.count("*").alias("suppliers"))


@query(
    "j07_multi_key",
    """SELECT a.order_id, a.line_no, a.product_id FROM li a JOIN
       (SELECT product_id, supplier_id, MAX(total_amount) AS top FROM li GROUP BY 1, 2) t
       USING (product_id, supplier_id) WHERE a.total_amount = t.top""",
)
def _(spark, d):
    li = lines(spark, d).select("order_id", "line_no", "product_id", "supplier_id", "total_amount")
    top = li.groupBy("product_id", "supplier_id").agg(F.max("total_amount").alias("top"))
    joined = li.join(top, on=["product_id", "supplier_id"])
    return joined.where("total_amount = top").select("order_id", "line_no", "product_id")


BY_STATE = f"SELECT shipping_state, COUNT(*) AS orders, {REVENUE} AS revenue FROM s GROUP BY 1"


@query("j08_broadcast_by_measured_size", BY_STATE)
def _(spark, d):
    """The dimension is counted; only below the bound it carries the hint."""
    dim = joins.small_side(customers(spark, d).select("customer_id", "shipping_state"))
    joined = orders_fact(spark, d).join(dim, "customer_id", "left")
    return joins.revenue_by(joined, ["shipping_state"])


@query("j09_broadcast_by_threshold", BY_STATE)
def _(spark, d):
    """No hint: Spark compares the size of the files with its broadcast threshold."""
    return joins.revenue_by(sales(spark, d), ["shipping_state"])


@query("j10_sort_merge", BY_STATE)
def _(spark, d):
    dim = customers(spark, d).select("customer_id", "shipping_state").hint("merge")
    joined = orders_fact(spark, d).join(dim, "customer_id", "left")
    return joins.revenue_by(joined, ["shipping_state"])


@query("j10_shuffle_hash", BY_STATE)
def _(spark, d):
    dim = customers(spark, d).select("customer_id", "shipping_state").hint("shuffle_hash")
    joined = orders_fact(spark, d).join(dim, "customer_id", "left")
    return joins.revenue_by(joined, ["shipping_state"])


@query(
    "j11_salted_join",
    """SELECT category, COUNT(*) AS sold, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM (SELECT CASE WHEN order_id % 3 = 0 THEN 1 ELSE product_id END AS product_id, total_amount FROM li)
       JOIN p USING (product_id) GROUP BY 1""",
)
def _(spark, d):
    """A third of all lines on one product; hot products are salted, the others are not."""
    skewed = F.when(F.col("order_id") % 3 == 0, 1).otherwise(F.col("product_id")).cast("long")
    li = lines(spark, d).select(skewed.alias("product_id"), "total_amount")
    joined = skew_join(li, products(spark, d), ["product_id"], cut=Cut(parts=64, hot_rows=0))
    return joined.groupBy("category").agg(
        F.count("*").alias("sold"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double").alias("revenue"),
    )


@query(
    "j12_every_state_with_every_method",
    """SELECT n_name AS shipping_state, m.payment_method, COUNT(o.order_id) AS orders
       FROM nation CROSS JOIN (SELECT DISTINCT payment_method FROM o) m LEFT JOIN s o
         ON o.shipping_state = n_name AND o.payment_method = m.payment_method GROUP BY 1, 2""",
)
def _(spark, d):
    """A grid of two small value lists (states and methods), so that empty cells show as 0."""
    fact = sales(spark, d).groupBy("shipping_state", "payment_method").agg(F.count("*").alias("orders"))
    states = table(spark, d, "nation").select(F.col("n_name").alias("shipping_state"))
    grid = joins.for_each_value(states, fact.select("payment_method"))
    return grid.join(fact, ["shipping_state", "payment_method"], "left").fillna({"orders": 0})


CHAIN = f"""WITH {KNOWN_SQL},
  cat AS (SELECT DISTINCT 'CAT_' || lpad(CAST(CAST(ceil(product_id / 500) AS BIGINT) AS VARCHAR), 2, '0') AS category_id,
      CAST(ceil(product_id / 500) AS BIGINT) AS n FROM p),
  named AS (SELECT category_id, 'Category ' || n AS category_name FROM cat WHERE n % 4 <> 3),
  x AS (SELECT l.*, 'CAT_' || lpad(CAST(CAST(ceil(product_id / 500) AS BIGINT) AS VARCHAR), 2, '0') AS category_id FROM l)
SELECT COALESCE(category_name, 'Sem Categoria') AS category_name, COALESCE(segment, 'Sem Segmento') AS segment,
  COUNT(*) AS orders, COUNT(*) FILTER (customer_name IS NULL) AS no_name, {REVENUE} AS revenue
FROM x LEFT JOIN k USING (customer_id) LEFT JOIN named USING (category_id) GROUP BY 1, 2"""


@query("j13_three_sources_with_defaults", CHAIN)
def _(spark, d):
    """Facts, customers and categories; the category key is derived from the product number."""
    from lakeworks.plans.sales import lines_fact

    numbered = products(spark, d).select(
        category_key("product_id").alias("category_id"),
        F.ceil(F.col("product_id") / 500).alias("n"),
    )
    named = numbered.distinct().where("n % 4 <> 3").select(
        "category_id", F.concat(F.lit("Category "), "n").alias("category_name")
    )
    fact = lines_fact(spark, d).withColumn("category_id", category_key("product_id"))
    out = joins.enrich(
        fact, known(spark, d), ["customer_id"], {"customer_name": NO_NAME, "segment": NO_SEGMENT}
    )
    # added up by key before the names join: a two-digit key has many names in a large table, and lines are not repeated
    sums = out.groupBy("category_id", "segment").agg(
        F.count("*").alias("orders"),
        F.count_if(F.col("customer_name") == NO_NAME).alias("no_name"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("revenue"),
    )
    out = joins.enrich(sums, named, ["category_id"], {"category_name": NO_CATEGORY})
    return out.groupBy("category_name", "segment").agg(
        F.sum("orders").alias("orders"), F.sum("no_name").alias("no_name"), F.sum("revenue").cast("double").alias("revenue")
    )


HEALTH = f"""WITH {BLANK_SQL}, dk AS (SELECT customer_id, COUNT(*) AS copies FROM
    (SELECT customer_id FROM c WHERE {KNOWN} UNION ALL SELECT customer_id FROM c WHERE customer_id % 50 = 1) GROUP BY 1),
  j AS (SELECT b.*, copies FROM b LEFT JOIN dk USING (customer_id))
SELECT COUNT(*) AS fact_rows, CAST(SUM(COALESCE(copies, 1)) AS BIGINT) AS joined_rows,
  COUNT(copies) AS matched_rows, COUNT(*) FILTER (copies IS NULL AND customer_id IS NOT NULL) AS orphan_rows,
  CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) FILTER (copies IS NULL AND customer_id IS NOT NULL) AS DOUBLE) AS orphan_value,
  COUNT(*) FILTER (customer_id IS NULL) AS null_key_rows,
  (SELECT COUNT(*) FROM dk WHERE copies > 1) AS repeated_dim_keys,
  COUNT(*) = SUM(COALESCE(copies, 1)) AS rows_kept FROM j"""


@query("j14_join_health", HEALTH)
def _(spark, d):
    doubled = customers(spark, d).where("customer_id % 50 = 1")
    dim = known(spark, d).unionByName(doubled)
    return joins.join_health(blanked(spark, d), dim, "customer_id", "total_amount")


@query(
    "j15_orphan_repair",
    f"""WITH {KNOWN_SQL}, {BLANK_SQL} SELECT b.order_id,
        COALESCE(CAST(k.customer_id AS VARCHAR), 'UNKNOWN_CUSTOMER') AS customer_id, total_amount
        FROM b LEFT JOIN k USING (customer_id)""",
)
def _(spark, d):
    fact = blanked(spark, d).select("order_id", F.col("customer_id").cast("string"), "total_amount")
    ref = known(spark, d).select(F.col("customer_id").cast("string"))
    return joins.repair(fact, {"customer_id": (ref, "customer_id", "UNKNOWN_CUSTOMER")})


@query(
    "j16_unknown_member",
    """SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_name, segment FROM c
       UNION ALL SELECT 'UNKNOWN_CUSTOMER', NULL, 'Sem Segmento'""",
)
def _(spark, d):
    dim = customers(spark, d).select(F.col("customer_id").cast("string"), "customer_name", "segment")
    return joins.with_unknown_member(dim, customer_id="UNKNOWN_CUSTOMER", segment=NO_SEGMENT)


@query(
    "j17_revenue_lost_by_inner_join",
    f"""WITH {KNOWN_SQL}, {BLANK_SQL}, j AS (SELECT CAST(total_amount AS DECIMAL(18,2)) AS v,
          k.customer_id IS NOT NULL AS ok FROM b LEFT JOIN k USING (customer_id) WHERE b.customer_id IS NOT NULL)
        SELECT CAST(SUM(v) AS DOUBLE) AS value_total, CAST(SUM(v) FILTER (ok) AS DOUBLE) AS value_joined,
          CAST(SUM(v) FILTER (NOT ok) AS DOUBLE) AS value_lost,
          CAST(SUM(v) FILTER (NOT ok) AS DOUBLE) * 100 / CAST(SUM(v) AS DOUBLE) AS percent_lost FROM j""",
)
def _(spark, d):
    return joins.lost_value(blanked(spark, d), known(spark, d), "customer_id", "customer_id", "total_amount")


@query(
    "j17_nothing_lost_after_repair",
    """SELECT CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS value_total,
       CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS value_joined,
       CAST(0 AS DOUBLE) AS value_lost, CAST(0 AS DOUBLE) AS percent_lost FROM o""",
)
def _(spark, d):
    fact = blanked(spark, d).select("order_id", F.col("customer_id").cast("string"), "total_amount")
    dim = known(spark, d).select(F.col("customer_id").cast("string"))
    fixed = joins.repair(fact, {"customer_id": (dim, "customer_id", "UNKNOWN_CUSTOMER")})
    complete = joins.with_unknown_member(dim, customer_id="UNKNOWN_CUSTOMER")
    return joins.lost_value(fixed, complete, "customer_id", "customer_id", "total_amount")


@query("j10_strategies_in_plans", "SELECT TRUE AS broadcast, TRUE AS merge, TRUE AS hash, COUNT(*) AS orders FROM orders")
def _(spark, d):
    """What each hint makes of the plan, over the whole order table."""
    fact = orders_fact(spark, d).select("customer_id")
    dim = customers(spark, d).select("customer_id")

    def uses(hint, node):
        return F.lit(plan_contains(fact.join(dim.hint(hint), "customer_id"), node))

    return fact.agg(F.count("*").alias("orders")).withColumns(
        {
            "broadcast": uses("broadcast", "BroadcastHashJoin"),
            "merge": uses("merge", "SortMergeJoin"),
            "hash": uses("shuffle_hash", "ShuffledHashJoin"),
        }
    )
