"""What the plans look like."""

import pytest
from pyspark.sql import functions as F

from lakeworks import queries as registered
from lakeworks.functions import udfs
from lakeworks.operators.joins import small_side
from lakeworks.operators.skew import By
from lakeworks.operators.transform import one_per_key, plan_contains, plan_text
from lakeworks.operators.windows import ORDER, last_rows
from lakeworks.plans.sales import customers, lines_fact, orders_fact, sales, table
from lakeworks.quality import checks
from lakeworks.sinks.tables import write

QUERIES = registered.load()[0]


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    df = orders_fact(spark, sf_dir).where("total_amount > 400000").groupBy("status").count()
    text = plan_text(df)
    assert "GreaterThan(o_totalprice,400000.0)" in text
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text


def test_joins_read_only_used_columns(spark, sf_dir):
    df = lines_fact(spark, sf_dir).groupBy("payment_method").agg(F.sum("quantity"))
    text = plan_text(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text


def test_small_side_is_hinted_by_its_bytes(spark, sf_dir):
    fact, dim = orders_fact(spark, sf_dir), customers(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_contains(fact.join(small_side(dim), "customer_id"), "BroadcastHashJoin")
        assert not plan_contains(fact.join(small_side(dim, max_bytes=10), "customer_id"), "BroadcastHashJoin Inner")
        assert plan_contains(sales(spark, sf_dir), "SortMergeJoin")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partition_filter(spark, sf_dir, path):
    where = path("plan")
    write(orders_fact(spark, sf_dir).withColumn("year", F.year("order_date")), where, ["year"])
    text = plan_text(spark.read.parquet(where).where("year = 1998"))
    assert "PartitionFilters: [isnotnull(year" in text


def test_group_limit_before_the_shuffle(spark, sf_dir):
    fact = orders_fact(spark, sf_dir)
    text = plan_text(last_rows(fact, ["customer_id"], ORDER, 3))
    assert text.index("WindowGroupLimit") and "Partial" in text


def test_one_per_key_is_a_partial_aggregate(spark, sf_dir):
    text = plan_text(one_per_key(orders_fact(spark, sf_dir), ["customer_id"], ["order_date", "order_id"]))
    assert "partial_max_by" in text and "Window" not in text


def test_all_row_checks_share_one_scan(spark, sf_dir):
    df = orders_fact(spark, sf_dir)
    many = [*checks.completeness(df, df.columns), checks.validity({"a": "total_amount > 0"}), checks.volume(1)]
    text = plan_text(checks.run_rowwise(df, many))
    assert text.count("Scan parquet") == 2  # the node and its details


def test_top_k_sorts_no_frame(spark, sf_dir):
    from lakeworks.operators.aggregates import top_k

    df = top_k(table(spark, sf_dir, "lineitem"), [By("l_extendedprice", True), By("l_orderkey")], 10)
    assert plan_contains(df, "TakeOrderedAndProject")


def test_python_functions_run_on_arrow(spark, sf_dir):
    df = orders_fact(spark, sf_dir)
    assert plan_contains(df.select(udfs.ticket_band_pandas()("total_amount")), "ArrowEvalPython")
    assert plan_contains(df.select(udfs.ticket_band_udf()("total_amount")), "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(spark, sf_dir, name):
    text = plan_text(QUERIES[name](spark, sf_dir), "simple")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
