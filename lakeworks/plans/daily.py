"""The daily batch: Bronze, Silver and Gold for one or many reference days in one run.

All days of a run share each stage's job. Every write replaces exactly the partitions of those
days, so a run can be repeated, and past days run again, without touching the others.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.operators.transform import one_per_key
from lakeworks.plans.metrics import RunLog
from lakeworks.quality import checks, gate, quarantine
from lakeworks.runtime import build_session, mean, total
from lakeworks.sinks.tables import write_refs
from lakeworks.sources.files import read_refs

REQUIRED = ("order_id", "customer_id", "product_id", "total_amount", "order_date")
RULES = {f"{c}_missing": f"{c} IS NOT NULL" for c in REQUIRED} | {
    "quantity_not_positive": "quantity > 0",
    "amount_negative": "total_amount >= 0",
}


@dataclass(frozen=True)
class Lake:
    """Where the layers lie below one base folder."""

    base: str

    def __getattr__(self, layer: str) -> str:
        if layer.startswith("_"):
            raise AttributeError(layer)
        return f"{self.base}/{layer}"


def bronze(spark: SparkSession, incoming: str, lake: Lake, refs: Sequence[str], ingested_at: str | None = None) -> dict:
    """The days' files as they are, with day, origin and time of ingestion."""
    paths = [f"{incoming}/{ref}/vendas.parquet" for ref in refs]
    raw = spark.read.option("mergeSchema", True).parquet(*paths)
    when = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    rows = raw.select(
        "*",
        F.lit("daily_sales_v1").alias("_source"),
        when.alias("_ingestion_ts"),
        F.col("_metadata.file_path").alias("_file_origin"),
        F.substring_index(F.substring_index("_metadata.file_path", "/vendas.parquet", 1), "/", -1).alias("_data_ref"),
    )
    # a file holds one day, so its rows are together already
    return {"rows": write_refs(rows, lake.bronze, "_data_ref", refs, gather=False)}


def silver(spark: SparkSession, lake: Lake, refs: Sequence[str], ingested_at: str | None = None) -> dict:
    """Valid rows, one per order and day; broken rows go to quarantine with their reasons.

    Rules come before deduplication, so a broken copy cannot push out a good one.
    """
    day = read_refs(spark, lake.bronze, "_data_ref", refs).withColumnRenamed("_data_ref", "data_ref")
    # the rules look at one row each, so both halves mark Bronze's rows: cheaper than to write all of them once more
    valid, bad = quarantine.split(
        quarantine.mark(day, RULES), critical=[n for n in RULES if n.endswith("_missing")], at=ingested_at
    )
    newest = ["_ingestion_ts", "order_date", "_file_origin", F.xxhash64(*valid.columns)]
    # the order first: rows are sorted by their keys, and a file's rows have the day in common
    kept = one_per_key(valid, ["order_id", "data_ref"], newest)
    rejected = write_refs(bad, lake.quarantine, "data_ref", refs)
    return {"rows": write_refs(kept, lake.silver, "data_ref", refs), "rejected": rejected}


def gold(spark: SparkSession, lake: Lake, refs: Sequence[str], products: DataFrame) -> dict:
    """Revenue, orders and mean ticket by day, state and category."""
    day = read_refs(spark, lake.silver, "data_ref", refs)
    sold = day.select("data_ref", "product_id", "shipping_state", "total_amount")
    named = sold.join(products.select("product_id", "category"), "product_id", "left")
    metrics = named.groupBy("data_ref", "shipping_state", "category").agg(
        total("total_amount").alias("revenue"), F.count("*").alias("orders"), mean("total_amount").alias("avg_ticket")
    )
    return {"rows": write_refs(metrics, lake.gold, "data_ref", refs)}


def run(
    spark: SparkSession, incoming: str, lake: Lake, refs: Sequence[str], products: DataFrame,
    min_rows: int = 1, ingested_at: str | None = None,
) -> dict:
    """All stages for the days, their metrics, and the checks on Gold at the end."""
    refs = sorted(refs)
    label = refs[0] if len(refs) == 1 else f"{refs[0]}..{refs[-1]}"
    log = RunLog(spark, lake.metrics, "daily_sales", label)
    out = {
        "bronze": log.stage("bronze", lambda: bronze(spark, incoming, lake, refs, ingested_at)),
        "silver": log.stage("silver", lambda: silver(spark, lake, refs, ingested_at=ingested_at)),
        "gold": log.stage("gold", lambda: gold(spark, lake, refs, products)),
    }

    def inspect():
        rows = read_refs(spark, lake.gold, "data_ref", refs)
        results = checks.run_rowwise(rows, checks.gold_checks("revenue", "shipping_state", min_rows))
        gate.gate(results, "strict")
        return {"rows": out["gold"]["rows"]}

    log.stage("checks", inspect)
    log.save()
    return out


def by_state(spark: SparkSession, source: str, target: str, refs: Sequence[str]) -> int:
    """Days from a table laid out by `dt`, revenue by state, written back by `dt`."""
    day = read_refs(spark, source, "dt", refs)
    out = day.groupBy("dt", "shipping_state").agg(
        total("total_amount").alias("revenue"), F.count("*").alias("orders")
    )
    return write_refs(out, target, "dt", refs)


def main(argv: Sequence[str] | None = None) -> int:
    """`python -m lakeworks.plans.daily --data-ref D [D ...] --input I --output O`"""
    parser = argparse.ArgumentParser()
    parser.add_argument("--data-ref", nargs="+", required=True)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    args = parser.parse_args(argv)
    spark = build_session("daily_sales")
    try:
        products = spark.read.parquet(f"{args.input}/produtos.parquet")
        run(spark, f"{args.input}/incoming", Lake(args.output), args.data_ref, products)
    except Exception as error:  # the scheduler reads the exit code
        print(f"failed: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
