"""The sales model over the star tables: order grain, line grain and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-01"  # newest order date; stands in for the clock


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; a single scan, no join."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 3 == 0, "partner_a")
        .when(F.col("o_orderkey") % 3 == 1, "partner_b")
        .otherwise("partner_c")
        .alias("partner_source"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, straight from the line table."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_returnflag").alias("return_flag"),
    )


def lines_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the columns of their order (both big: one shuffle each on the order key)."""
    head = orders_fact(spark, sf_dir).drop("total_amount")
    return lines(spark, sf_dir).join(head, "order_id")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the name of their state."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey"), F.col("n_name").alias("shipping_state")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
            "shipping_state",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("subcategory"),
        F.col("p_retailprice").alias("list_price"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer name, segment and state."""
    return orders_fact(spark, sf_dir).join(customers(spark, sf_dir), "customer_id", "left")


# The same views as SQL text for the checking database.
SQL_VIEWS = {
    "o": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
              CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS total_amount,
              o_orderpriority AS payment_method, o_orderstatus AS status,
              CASE o_orderkey % 3 WHEN 0 THEN 'partner_a' WHEN 1 THEN 'partner_b'
                   ELSE 'partner_c' END AS partner_source
            FROM orders""",
    "c": """SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
              c_acctbal AS balance, n_name AS shipping_state
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "p": """SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category,
              p_type AS subcategory, p_retailprice AS list_price FROM part""",
    "li": """SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no,
              l_partkey AS product_id, l_suppkey AS supplier_id, l_quantity AS quantity,
              l_extendedprice AS total_amount, l_extendedprice / l_quantity AS unit_price,
              CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS return_flag FROM lineitem""",
    "s": "SELECT o.*, c.* EXCLUDE (customer_id) FROM o LEFT JOIN c USING (customer_id)",
    "l": "SELECT li.*, o.* EXCLUDE (order_id, total_amount) FROM li JOIN o USING (order_id)",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix a SELECT (or a WITH list) with the views it reads."""
    needed = list(names) or list(SQL_VIEWS)
    ctes = ", ".join(f"{n} AS ({SQL_VIEWS[n]})" for n in SQL_VIEWS if n in needed)
    sql = sql.strip()
    if sql.upper().startswith("WITH "):
        return f"WITH {ctes}, {sql[5:]}"
    return f"WITH {ctes} {sql}"
