"""Lands the order table in the forms the partners deliver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.plans.sales import customers, orders_fact, products
from lakeworks.schemas import LEGACY_NAMES, SALES
from lakeworks.sinks.files import file_system

PAGE_ROWS = 1000


def sale_rows(spark: SparkSession, sf_dir: str, fact: DataFrame | None = None) -> DataFrame:
    """Orders in the sales schema: text ids, a city with accents, some methods missing.

    Columns of `fact` beyond the order table's own are kept.
    """
    people = customers(spark, sf_dir).select("customer_id", "shipping_state")
    own = orders_fact(spark, sf_dir)
    fact = own if fact is None else fact
    more = [c for c in fact.columns if c not in own.columns]
    fact = fact.join(people, "customer_id", "left")
    return fact.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.when(F.col("customer_id").isNotNull(), F.format_string("CUST_%05d", "customer_id")).alias("customer_id"),
        F.format_string("PROD_%04d", F.col("order_id") % 5000 + 1).alias("product_id"),
        (F.col("order_id") % 20 + 1).cast("int").alias("quantity"),
        (F.col("total_amount") / (F.col("order_id") % 20 + 1)).alias("unit_price"),
        "total_amount",
        F.col("order_date").cast("timestamp").alias("order_date"),
        F.when(F.col("order_id") % 10 != 0, F.col("payment_method")).alias("payment_method"),
        F.concat(F.lit("São "), "shipping_state").alias("shipping_city"),
        "shipping_state",
        "status",
        "partner_source",
        *more,
    ).select(*SALES.fieldNames(), *more)


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with the text ids the sales rows use."""
    return products(spark, sf_dir).withColumn(
        "product_id", F.format_string("PROD_%04d", F.col("product_id") + 1)
    )


def land_legacy(rows: DataFrame, path: str) -> None:
    """Semicolon CSV in ISO-8859-1, Portuguese names, dates day first, N/A for missing."""
    back = {english: legacy for legacy, english in LEGACY_NAMES.items()}
    text = rows.withColumn("order_date", F.date_format("order_date", "dd/MM/yyyy"))
    text = text.select(*[text[f.name].cast("string").alias(back[f.name]) for f in SALES])
    text.write.options(header=True, sep=";", encoding="ISO-8859-1", nullValue="N/A").csv(path)


def land_pages(rows: DataFrame, path: str, page_rows: int = PAGE_ROWS) -> None:
    """One JSON document per page and file; a page holds at most `page_rows` sales, by order number."""
    sale = F.struct(
        *[F.col(c).cast("string").alias(c) if c == "order_date" else F.col(c) for c in SALES.fieldNames()]
    )
    number = F.floor(F.col("order_id").cast("long") / page_rows) + 1
    pages = rows.groupBy(number.alias("page")).agg(F.sort_array(F.collect_list(sale)).alias("data"))
    document = F.struct(
        F.lit("v2").alias("api_version"),
        F.lit("2024-01-15T06:00:00").alias("exported_at"),
        "page",
        F.lit(None).cast("long").alias("total_pages"),
        "data",
    )
    pages.select(F.to_json(document).alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def land_parquet(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)


def land_days(rows: DataFrame, incoming: str, key: str = "data_ref", file: str = "vendas.parquet") -> list[str]:
    """One folder per reference day, named by value only: `incoming/<day>/vendas.parquet`.

    All days are written in one job; the folders are then renamed. Returns the days.
    """
    spark = rows.sparkSession
    staged = f"{incoming}-staged"
    rows.hint("rebalance", key).write.partitionBy(key).parquet(staged)
    fs, Path = file_system(spark, incoming)
    days = []
    for status in fs.listStatus(Path(staged)):
        name = status.getPath().getName()
        if name.startswith(f"{key}="):
            day = name.split("=", 1)[1]
            fs.mkdirs(Path(f"{incoming}/{day}"))
            fs.rename(status.getPath(), Path(f"{incoming}/{day}/{file}"))
            days.append(day)
    return sorted(days)
