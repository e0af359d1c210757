"""Several reports from one joined base."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.windows import top_overall
from lakeworks.runtime import materialise, mean, money, total


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep a frame while several actions read it; spills to disk, freed at the end."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def three_reports(base: DataFrame, top: int = 100) -> dict[str, DataFrame]:
    """Revenue by state, by category, and the best customers, of one base."""
    return {
        "states": base.groupBy("shipping_state").agg(
            total("total_amount").alias("revenue"), F.count("*").alias("orders"), mean("total_amount").alias("avg_ticket")
        ),
        "categories": base.groupBy("category_name").agg(
            total("total_amount").alias("revenue"), F.count("*").alias("orders")
        ),
        "customers": top_overall(
            base.groupBy("customer_id", "customer_name").agg(total("total_amount").alias("spent")), "spent", top
        ),
    }


def _copies(fact: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    """The fact with the number of rows that a left join with the dimension makes of each of its rows."""
    repeated = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name)).where(F.col(name) > 1)
    if repeated.isEmpty():  # as a dimension should be
        return fact.withColumn(name, F.lit(1).cast("long"))
    joined = fact.join(materialise(repeated, "repeated-keys"), key, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(1).cast("long")))


def three_reports_below_joins(
    fact: DataFrame, customers: DataFrame, names: DataFrame, unnamed: str, top: int = 100
) -> dict[str, DataFrame]:
    """The same reports with the sums made before the joins: the facts are added up by each join key in one pass, and
    the dimensions join sums. A sum by one key counts a fact as often as the other key's dimension repeats it; its own
    dimension repeats the sums. `names` gives category_name by category_id, `unnamed` stands for those without."""
    weighed = _copies(_copies(fact, customers, "customer_id", "_c"), names, "category_id", "_n")
    by_customer = F.grouping("customer_id") == 0
    each = weighed.select("customer_id", "category_id", money("total_amount").alias("_a"), "_c", "_n")
    sets = each.groupingSets([("customer_id",), ("category_id",)], "customer_id", "category_id").agg(
        by_customer.alias("of_customer"),
        F.when(by_customer, F.sum(F.col("_a") * F.col("_n"))).otherwise(F.sum(F.col("_a") * F.col("_c"))).alias("amount"),
        F.when(by_customer, F.sum("_n")).otherwise(F.sum("_c")).alias("rows"),
        F.when(by_customer, F.sum(F.when(F.col("_a").isNotNull(), F.col("_n"))))
        .otherwise(F.sum(F.when(F.col("_a").isNotNull(), F.col("_c")))).alias("amounts"),
    )
    sums = materialise(sets, "sums")
    of_customers = sums.where("of_customer").drop("category_id").join(customers, "customer_id", "left")
    of_categories = sums.where("not of_customer").drop("customer_id").join(names, "category_id", "left")
    revenue, orders = F.sum("amount").cast("double"), F.sum("rows")
    return {
        "states": of_customers.groupBy("shipping_state").agg(
            revenue.alias("revenue"), orders.alias("orders"),
            F.try_divide(revenue, F.sum("amounts").cast("double")).alias("avg_ticket"),
        ),
        "categories": of_categories.groupBy(F.coalesce("category_name", F.lit(unnamed)).alias("category_name")).agg(
            revenue.alias("revenue"), orders.alias("orders")
        ),
        "customers": top_overall(of_customers.groupBy("customer_id", "customer_name").agg(revenue.alias("spent")), "spent", top),
    }
