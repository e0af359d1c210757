"""The three partner feeds, read and brought to one schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.functions.columns import parse_date
from lakeworks.operators.transform import normalise, union_all
from lakeworks.schemas import LEGACY, LEGACY_DATE_FORMATS, LEGACY_NAMES, PAGE, SILVER
from lakeworks.sources.files import read_json_documents, read_legacy_csv, read_parquet, with_lineage


def legacy_feed(spark: SparkSession, path: str, ingested_at: str | None = None) -> DataFrame:
    """Partner A as it comes: text columns under Portuguese names."""
    return with_lineage(read_legacy_csv(spark, path, LEGACY), "partner_a", ingested_at)


def paged_feed(spark: SparkSession, path: str, ingested_at: str | None = None) -> DataFrame:
    """Partner B, one row per sale: the pages' `data` arrays are unfolded."""
    pages = with_lineage(read_json_documents(spark, path, PAGE), "partner_b", ingested_at)
    return unfold(pages)


def unfold(pages: DataFrame) -> DataFrame:
    """Rows of the `data` array with the page they came from."""
    kept = [c for c in ("page", "_source", "_ingestion_ts", "_file_origin") if c in pages.columns]
    return pages.select(F.explode("data").alias("sale"), *kept).select("sale.*", *kept)


def parquet_feed(spark: SparkSession, path: str, ingested_at: str | None = None) -> DataFrame:
    """Partner C, already typed."""
    return with_lineage(read_parquet(spark, path), "partner_c", ingested_at)


def to_silver(bronze: DataFrame, legacy: bool = False) -> DataFrame:
    """Common names and types; dates in any of the accepted formats."""
    name = "data_pedido" if legacy else "order_date"
    if dict(bronze.dtypes)[name] == "string":
        day_first, year_first = LEGACY_DATE_FORMATS[:2]  # no text fits both; the feed's own form comes first, a misfit is dear
        formats = (day_first, year_first) if legacy else (year_first, day_first)
        date = parse_date(F.substring(F.trim(name), 1, 10), formats)
    else:
        date = F.col(name).cast("date")
    named = bronze.withColumn(name, date)
    return normalise(named, LEGACY_NAMES if legacy else {}, SILVER)


def unified(legacy: DataFrame, paged: DataFrame, parquet: DataFrame) -> DataFrame:
    return union_all([to_silver(legacy, legacy=True), to_silver(paged), to_silver(parquet)])
