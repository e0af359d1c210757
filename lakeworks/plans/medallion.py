"""Three partner feeds through Bronze, Silver and Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.operators import aggregates as agg
from lakeworks.operators.skew import By
from lakeworks.operators.transform import one_per_key, union_all
from lakeworks.plans.daily import Lake
from lakeworks.quality import quarantine
from lakeworks.runtime import materialise, total
from lakeworks.schemas import SILVER
from lakeworks.sinks.tables import write
from lakeworks.sources import partners

FEEDS = ("partner_a", "partner_b", "partner_c")


def rules(as_of: str) -> dict[str, str]:
    return {
        "order_id_missing": "order_id IS NOT NULL",
        "amount_not_positive": "total_amount > 0",
        "quantity_not_positive": "quantity > 0",
        "date_missing": "order_date IS NOT NULL",
        "date_in_future": f"order_date IS NULL OR order_date <= DATE '{as_of}'",
    }


def bronze(spark: SparkSession, folders: dict[str, str], lake: Lake, ingested_at: str | None = None) -> dict:
    """Each feed as it came, one table per partner since their columns differ."""
    feeds = {
        "partner_a": partners.legacy_feed(spark, folders["partner_a"], ingested_at),
        "partner_b": partners.paged_feed(spark, folders["partner_b"], ingested_at),
        "partner_c": partners.parquet_feed(spark, folders["partner_c"], ingested_at),
    }
    return {name: write(df, f"{lake.bronze}/{name}", ["_source"], gather=False) for name, df in feeds.items()}


def unified(spark: SparkSession, lake: Lake) -> DataFrame:
    """All partners in the Silver schema."""
    return union_all(
        [
            partners.to_silver(spark.read.parquet(f"{lake.bronze}/{name}"), legacy=name == "partner_a")
            for name in FEEDS
        ]
    )


def silver(spark: SparkSession, lake: Lake, as_of: str, ingested_at: str | None = None) -> dict:
    marked = materialise(quarantine.mark(unified(spark, lake), rules(as_of)), "marked")
    valid, bad = quarantine.split(marked, critical=["order_id_missing"], at=ingested_at)
    kept = one_per_key(valid, ["order_id"], ["order_date", F.xxhash64(*valid.columns)])
    return {
        "rows": write(kept, lake.silver, ["shipping_state"], dynamic=False),
        "rejected": write(bad, lake.quarantine, ["_source"], dynamic=False),
    }


def gold_tables(sales: DataFrame) -> dict[str, DataFrame]:
    """The Gold tables name the columns they read, so new Silver columns change nothing."""
    sales = sales.select(*SILVER.fieldNames())
    # one pass for the three reports: a row for each day, state and partner
    base = materialise(agg.revenue_base(sales, ["order_date", "shipping_state", "_source"]), "gold-base")
    return {
        "daily_by_state": agg.revenue_report_from(base, ["order_date", "shipping_state"]),
        "by_state_and_partner": agg.revenue_report_from(base, ["shipping_state", "_source"]),
        "monthly_by_partner": agg.revenue_report_from(
            base.withColumn("month", F.date_format("order_date", "yyyy-MM")), ["month", "_source"]
        ),
        "top_products": agg.top_k(
            sales.groupBy("product_id").agg(
                total("total_amount").alias("total_revenue"), F.sum("quantity").alias("total_quantity")
            ),
            [By("total_revenue", desc=True), By("product_id")], 10,
        ),
        "customer_360": agg.customer_360(sales, channel="_source"),
    }


def gold(spark: SparkSession, lake: Lake) -> dict:
    made = gold_tables(spark.read.parquet(lake.silver))
    return {name: write(df, f"{lake.gold}/{name}") for name, df in made.items()}


def run(spark: SparkSession, folders: dict[str, str], lake: Lake, as_of: str, ingested_at: str | None = None) -> dict:
    """All layers; returns the row counts of each."""
    return {
        "bronze": bronze(spark, folders, lake, ingested_at),
        "silver": silver(spark, lake, as_of, ingested_at),
        "gold": gold(spark, lake),
    }
