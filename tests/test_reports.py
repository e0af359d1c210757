"""Reports with the sums below the joins, against the joined base, also where dimensions repeat keys."""

import random

import pytest
from pyspark.sql import functions as F

from lakeworks.operators import aggregates as agg
from lakeworks.operators.joins import enrich
from lakeworks.operators.transform import plan_text
from lakeworks.plans.medallion import gold_tables
from lakeworks.plans.reports import three_reports, three_reports_below_joins
from lakeworks.schemas import SILVER
from lakeworks.sources.partners import to_silver
from tests.test_skew import same


@pytest.mark.parametrize("repeats", [False, True])
def test_like_the_joined_base(spark, repeats):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(8)]), rng.choice([None, "A", "B", "C", "Z"]), rng.choice([None, 10.25, 3.5, 7.1])) for _ in range(400)]
    fact = spark.createDataFrame(rows, "customer_id long, category_id string, total_amount double")
    people = [(i, f"n{i}", f"s{i % 3}") for i in range(6)] + ([(2, "twin", "s9"), (2, "n2", "s2"), (None, "no one", "s0")] if repeats else [])
    customers = spark.createDataFrame(people, "customer_id long, customer_name string, shipping_state string")
    names = spark.createDataFrame([("A", "first"), ("B", "second")] + ([("A", "also first")] if repeats else []), "category_id string, category_name string")
    base = enrich(fact.join(customers, "customer_id", "left"), names, ["category_id"], {"category_name": "none"})
    want, found = three_reports(base, 4), three_reports_below_joins(fact, customers, names, "none", 4)
    for name in want:
        columns = sorted(want[name].columns)
        same(want[name].select(columns), found[name].select(columns))
    assert found["states"].agg(F.sum("orders")).first()[0] == base.count()


def test_reports_from_one_base(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b"]), rng.choice(["x", "y"]), rng.randrange(4), rng.choice([None, 0.1, 2.35, 7.0])) for _ in range(300)]
    df = spark.createDataFrame([*rows, ("c", "x", 9, None)], "state string, partner string, day int, total_amount double")
    base = agg.revenue_base(df, ["state", "partner", "day"])
    for keys in (["state"], ["partner", "day"], ["state", "partner", "day"]):
        same(agg.revenue_report(df, keys), agg.revenue_report_from(base, keys))


def test_gold_reports_read_silver_once(spark):
    sales = spark.createDataFrame([], SILVER)
    made = gold_tables(sales)
    reports = ("daily_by_state", "by_state_and_partner", "monthly_by_partner")
    assert all("gold-base" in plan_text(made[name]) for name in reports)


def test_a_feeds_own_date_form_is_tried_first(spark):
    rows = spark.createDataFrame([("1", " 2000-08-15 00:00:00"), ("2", "17/03/1995"), ("3", "no"), ("4", None)], "order_id string, order_date string")
    silver = to_silver(rows)
    text = plan_text(silver)
    assert text.index("yyyy-MM-dd") < text.index("dd/MM/yyyy")
    found = [str(r.order_date) for r in silver.orderBy("order_id").collect()]
    assert found == ["2000-08-15", "1995-03-17", "None", "None"]
