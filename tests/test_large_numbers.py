"""Registered queries over small tables whose numbers are those of large ones."""

import pytest
from checking import TABLES, compare, database
from conftest import SF_DIR

from lakeworks import queries as registered

QUERIES, ORACLES = registered.load()


@pytest.fixture(scope="module")
def numbered(tmp_path_factory):
    """The smallest tables; one part in three, and the lines with it, gets a number 60,000 higher."""
    folder = tmp_path_factory.mktemp("numbered")
    db = database(SF_DIR)
    moved = {"part": "p_partkey", "lineitem": "l_partkey"}
    for name in TABLES:
        rows = f"SELECT * REPLACE ({moved[name]} + 60000 * CAST({moved[name]} % 3 = 0 AS INT) AS {moved[name]}) FROM {name}" if name in moved else f"FROM {name}"
        db.execute(f"COPY ({rows}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize(
    "name", ["l13_three_reports_one_base", "l13_three_reports_below_joins", "l13_three_reports_recomputed"]
)
def test_categories_beyond_two_digits(spark, numbered, name):
    assert compare(QUERIES[name](spark, numbered), database(numbered), ORACLES[name]) is None


def plan(df, kind):
    return str(getattr(df._jdf.queryExecution(), kind)()).splitlines()


def test_lines_are_added_up_before_names(spark, numbered):
    df = QUERIES["j13_three_sources_with_defaults"](spark, numbered)
    assert compare(df, database(numbered), ORACLES["j13_three_sources_with_defaults"]) is None
    nodes = [line for line in plan(df, "optimizedPlan") if "Join" in line or "Aggregate" in line]
    with_names = next(i for i, line in enumerate(nodes) if "Join" in line)
    assert "Aggregate [category_id" in nodes[with_names + 1]


def test_one_sketch_for_all_rows(spark, numbered):
    df = QUERIES["a05_approximate_distinct_within_bound"](spark, numbered)
    sketches = [line for line in plan(df, "executedPlan") if "approx_count_distinct" in line and "HashAggregate" in line]
    assert sketches and all("keys=[]" in line for line in sketches)


def test_the_list_is_broadcast_not_the_orders(spark, numbered):
    df = QUERIES["s15_rows_from_a_list"](spark, numbered)
    assert any("BroadcastHashJoin" in line and "BuildRight" in line for line in plan(df, "executedPlan"))
