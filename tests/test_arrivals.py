"""Arriving files: where a file's rows go, and what a batch costs."""

from pyspark.sql import functions as F

from lakeworks.plans.daily import Lake
from lakeworks.plans.feeds import product_rows, sale_rows
from lakeworks.plans.sales import orders_fact
from lakeworks.sinks.files import children, file_system
from lakeworks.streaming import arrivals

AT = "2001-08-01 06:00:00"


def test_places_of_files():
    found = arrivals.places(["file:///a/in/d1/f", "file:///a/in/day=d2/x/f", "file:///a/in/a=/f", "file:///a/in/f"], "file:/a/in/")
    assert [(f["_data_ref"], f["_file"]) for f in found] == [("d1", "f"), ("d2", "x~f"), ("a=", "f"), ("", "")]


def test_stream_names_files_and_reads_no_columns(spark, sf_dir, path):
    where = path("in")
    sale_rows(spark, sf_dir).write.parquet(f"{where}/d1")
    assert arrivals.file_stream(spark, where, spark.read.parquet(f"{where}/d1").schema, 10).columns == ["_file_origin"]


def test_rows_of_any_file_name_land_once(spark, sf_dir, path):
    """Names that are patterns to a reader or escaped in addresses, files in deeper folders, one of them delivered again."""
    base = path("odd")
    rows = sale_rows(spark, sf_dir, orders_fact(spark, sf_dir).limit(60)).localCheckpoint()
    fs, Path = file_system(spark, base)
    names = ["d1/a [1].parquet", "d1/deep/a [1].parquet", "day=d2/b*{x}%20.parquet"]
    for i, name in enumerate(names):
        rows.where(F.col("order_id").cast("long") % 3 == i).coalesce(1).write.parquet(f"{base}/made{i}")
        made = next(n for n in children(spark, f"{base}/made{i}") if n.endswith(".parquet"))
        fs.mkdirs(Path(f"{base}/in/{name}").getParent())
        assert fs.rename(Path(f"{base}/made{i}/{made}"), Path(f"{base}/in/{name}"))
    lake = Lake(f"{base}/lake")
    for checkpoint in ("first", "first", "second"):
        arrivals.process_new_files(
            spark, f"{base}/in", lake, f"{base}/{checkpoint}", rows.schema, product_rows(spark, sf_dir), 2, AT
        )
        bronze = spark.read.parquet(lake.bronze)
        assert bronze.count() == rows.count() == bronze.select("order_id").distinct().count()
        assert {(r[0], r[1]) for r in bronze.select("_data_ref", "_file").distinct().collect()} == {
            ("d1", "a%20%5B1%5D.parquet"), ("d1", "deep~a%20%5B1%5D.parquet"), ("d2", "b*%7Bx%7D%2520.parquet")
        }
    valid = rows.where("customer_id is not null and total_amount >= 0").count()
    assert spark.read.parquet(lake.silver).count() == valid
