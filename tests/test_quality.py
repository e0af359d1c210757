"""Quality checks on small frames with known answers, and their laws on arbitrary ones."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeworks.operators.joins import integrity_report, join_health, lost_value, orphans, repair, with_unknown_member
from lakeworks.operators.skew import Cut
from lakeworks.operators.transform import plan_text
from lakeworks.quality import checks, gate, quarantine
from lakeworks.schemas import CHECK_RESULTS

PEOPLE = [
    (11, "Ana Prado", 41, "BA"), (12, "Rui", 19, "CE"), (13, None, 0, "PA"), (12, "Rui", 19, "CE"), (14, None, 33, "AM"),
    (12, "Rui", 20, "CE"), (15, None, 52, "RS"), (16, "Téo", -4, "SC"), (17, "Lia", 28, "GO"), (18, "Noé", 61, "TO"),
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "id int, name string, age int, state string")


@pytest.fixture(scope="module")
def sold(spark):
    rows = [("a1", "K7", 12.5), ("a2", "K9", 8.0), ("a3", "K7", 30.25), ("a4", "K2", 4.75), ("a5", "K5", 9.5),
            ("a6", None, 21.0), ("a7", "K5", 0.5), ("a8", "K9", 3.0)]
    return spark.createDataFrame(rows, "order_id string, customer_id string, amount double")


@pytest.fixture(scope="module")
def clients(spark):
    return spark.createDataFrame([("K7",), ("K9",), ("K3",), ("K4",)], "customer_id string")


def by_name(results):
    return {r["check_name"]: r for r in results.collect()}


def test_results_have_the_agreed_schema(people):
    out = checks.run_rowwise(people, checks.completeness(people, ["name"]))
    assert out.schema.simpleString() == CHECK_RESULTS.simpleString()


def test_completeness(people):
    out = by_name(checks.run_rowwise(people, checks.completeness(people, {"id": 1.0, "name": 0.8, "gone": 0.1})))
    assert out["completeness_id"]["passed"] and out["completeness_id"]["metric_value"] == 1.0
    assert not out["completeness_name"]["passed"] and out["completeness_name"]["metric_value"] == 0.7
    assert not out["completeness_gone"]["passed"]


def test_empty_frame(people):
    none = people.where("id > 99")
    out = by_name(checks.run_rowwise(none, [*checks.completeness(none, ["id"]), checks.volume(1)]))
    assert out["completeness_id"]["metric_value"] == 0.0 and not out["volume"]["passed"]
    assert checks.uniqueness_report(none, ["id"]).first()["total_records"] == 0


def test_uniqueness(people):
    row = checks.uniqueness_report(people, ["id"]).first()
    assert (row["distinct_keys"], row["duplicate_keys"], row["duplicate_records"]) == (8, 1, 2)
    assert row["duplicate_pct"] == 20.0 and not row["passed"] and row["max_occurrences"] == 3


def test_validity_and_its_rates(people):
    rules = {"age": "age > 0", "named": "length(name) > 0"}
    row = checks.run_rowwise(people, [checks.validity(rules)]).first()
    assert row["metric_value"] == 0.6 and row["details"]["age"] == "0.8"
    lenient = checks.run_rowwise(people, [checks.validity(rules, null_ok=["named"])]).first()
    assert lenient["metric_value"] == 0.8


def test_integrity(sold, clients):
    row = integrity_report(sold, clients, "customer_id", "customer_id").first()
    assert (row["total_records"], row["orphan_records"], row["null_keys"]) == (7, 3, 1)
    assert row["integrity_score"] == pytest.approx(4 / 7) and row["orphan_distinct_keys"] == 2
    found = orphans(sold, clients, "customer_id", "customer_id")
    assert sorted(r["order_id"] for r in found.collect()) == ["a4", "a5", "a7"]


def test_health_counts_repeated_dimension_keys(sold, clients):
    row = join_health(sold, clients.unionByName(clients.limit(1)), "customer_id", "amount").first()
    assert (row["fact_rows"], row["joined_rows"], row["matched_rows"]) == (8, 10, 4)
    assert row["orphan_value"] == 14.75 and row["repeated_dim_keys"] == 1 and not row["rows_kept"]


def test_repair_leaves_no_orphan(sold, clients):
    fixed = repair(sold, {"customer_id": (clients, "customer_id", "nobody")})
    dim = with_unknown_member(clients, customer_id="nobody")
    assert integrity_report(fixed, dim, "customer_id", "customer_id").first()["passed"]
    assert lost_value(fixed, dim, "customer_id", "customer_id", "amount").first()["value_lost"] == 0.0
    assert lost_value(sold, clients, "customer_id", "customer_id", "amount").first()["value_lost"] == 14.75


def test_gate(people):
    bad = checks.run_rowwise(people, checks.completeness(people, ["name"]))
    with pytest.raises(gate.QualityGateError, match="completeness_name"):
        gate.gate(bad, "strict")
    assert gate.gate(bad, "lenient") == "quarantine" and gate.gate(bad, "monitor") == "record"
    warn = checks.run_rowwise(people, checks.completeness(people, ["name"], severity="warning"))
    assert gate.gate(warn, "strict") == "alert"
    assert gate.gate(checks.run_rowwise(people, [checks.volume(1)]), "strict") == "go"
    with pytest.raises(ValueError):
        gate.gate(bad, "loose")


def test_adaptive_threshold(spark):
    past = [0.95, 0.96, 0.94, 0.95, 0.97, 0.95, 0.93, 0.96]
    rows = [("c", f"2024-01-{i + 1:02d}", v) for i, v in enumerate([*past, 0.5])]
    history = spark.createDataFrame(rows, "check_name string, run_date string, metric_value double")
    last = gate.adaptive_threshold(history).orderBy(F.desc("run_date")).first()
    assert abs(last["adaptive_threshold"] - 0.92635) < 0.001 and not last["within"]


def test_schema_contract(spark, people):
    from lakeworks.schemas import schema

    out = checks.check_schema(spark, people.schema, schema(id="int", name="long", email="string"))
    states = {r["column"]: (r["state"], r["passed"]) for r in out.collect()}
    assert states == {
        "id": ("ok", True), "name": ("other type", False), "email": ("missing", False),
        "age": ("extra", True), "state": ("extra", True),
    }


def test_one_of_many_identical_copies_stays(spark):
    """Most rows are copies of one row; the key is cut all the same and one copy is valid."""
    df = spark.range(3000).select(F.lit(1).alias("id"), F.lit(7.0).alias("amount"), F.lit(0).alias("at"))
    df = df.unionByName(spark.range(10).select((F.col("id").cast("int") + 5).alias("id"), F.lit(1.0).alias("amount"), F.lit(0).alias("at")))
    for cut in (None, Cut(32, 0)):
        out = quarantine.repeated(df, ["id"], "at", "again", cut)
        assert out.where("NOT again").count() == 11 and out.count() == 3010


cell = st.one_of(st.none(), st.integers(-3, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(cell, cell, cell), min_size=1, max_size=30))
def test_laws(spark, rows):
    """Nothing is lost by a split, and the counts agree with plain Python."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, id int, ref int, amount int")
    known = spark.createDataFrame([(0,), (1,)], "ref int")
    marked = quarantine.mark(
        df, {"amount": "amount > 0"}, refs={"ref": (known, "ref", "unknown")}, unique=(["id"], "n", "again")
    )
    valid, bad = quarantine.split(marked, at="2024-01-01 00:00:00")
    assert valid.count() + bad.count() == len(rows)
    seen, good = set(), 0
    for ident, ref, amount in rows:
        again = ident is not None and ident in seen
        seen.add(ident)
        good += (amount is not None and amount > 0) and (ref is None or ref in (0, 1)) and not again
    assert valid.count() == good
    u = checks.uniqueness_report(df, ["id"]).first()
    assert (u["total_records"], u["distinct_keys"]) == (len(rows), len({r[0] for r in rows}))
    i = integrity_report(df, known, "ref", "ref").first()
    assert i["total_records"] == sum(r[1] is not None for r in rows)
    assert i["orphan_records"] == sum(r[1] is not None and r[1] not in (0, 1) for r in rows)
    rate = checks.run_rowwise(df, checks.completeness(df, ["amount"])).first()["details"]["nulls"]
    assert int(rate) == sum(r[2] is None for r in rows)


def test_copies_are_counted_in_tasks_of_bounded_size(spark):
    """A large table is dealt by key to tasks that grow with its rows; hot and null keys stay apart, all are counted."""
    rows = [(i % 700, i % 3) for i in range(4000)] + [(9999, i % 7) for i in range(2000)] + [(None, 1)] * 1500
    df = spark.createDataFrame(rows, "k int, v int")
    cut = Cut(16, hot_rows=1000)
    cold, hot = checks.dealt(df, ["k"], cut, rows_a_task=100)
    assert cold.rdd.getNumPartitions() == 75 and {r.k for r in hot.distinct().collect()} >= {9999, None}
    assert cold.count() + hot.count() == len(rows) and cold.select("k").intersect(hot.select("k")).isEmpty()
    assert len(checks.dealt(df, ["k"], Cut(16, hot_rows=7500))) == 1
    even = df.where("k < 700")
    (one,) = checks.dealt(even, ["k"], cut, rows_a_task=100)
    assert one.rdd.getNumPartitions() == 40
    want = checks.copies_and_conflicts(df, ["k"], cut=Cut(16)).first()
    keys, versions = len({k for k, _ in rows}), len(set(rows))
    assert tuple(want)[:3] == (len(rows) - keys, len(rows) - versions, versions - keys)
    assert checks.copies_and_conflicts(df, ["k"], cut=cut).first() == want
    text = plan_text(checks.copies_and_conflicts(even, ["k"], cut=cut), "simple")
    assert text.count("Exchange") == 1 and "REPARTITION_BY_NUM" in text  # nothing is joined again or shuffled twice
