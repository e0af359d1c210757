"""Data quality, quarantine and gates (Q), over a dirty copy of the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeworks.functions.columns import exact_round
from lakeworks.operators.aggregates import duplicate_impact
from lakeworks.operators.joins import flag_known, integrity_report, orphans
from lakeworks.operators.skew import Cut
from lakeworks.operators.transform import count_copies, hash_sample, union_all
from lakeworks.plans.sales import AS_OF, customers, lines, orders_fact, sales
from lakeworks.quality import checks as q
from lakeworks.quality import gate as g
from lakeworks.quality import quarantine as qt
from lakeworks.quality.defects import DIRTY_SQL, inject
from lakeworks.queries.registry import query
from lakeworks.runtime import fresh_path, total
from lakeworks.schemas import schema
from lakeworks.sinks import tables

KNOWN = "customer_id % 25 <> 4"
KNOWN_SQL = f"k AS (SELECT * FROM c WHERE {KNOWN})"
X = f"WITH {DIRTY_SQL}"
XK = f"WITH {DIRTY_SQL}, {KNOWN_SQL}"


def dirty(spark, d):
    return inject(orders_fact(spark, d), "order_id", "customer_id", "total_amount", "status", "order_date")


def known(spark, d):
    return customers(spark, d).where(KNOWN)


def flat(results):
    """Check results without the free-text details."""
    return results.select("check_name", "passed", "metric_value", "threshold", "severity")


def rate4(expression: str) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(18,6)), 4) AS DOUBLE)"


# ------------------------------------------------------------------ completeness

PROFILE = X + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) FILTER ({c} IS NULL) AS nulls, COUNT(*) AS rows,
        CAST(COUNT(*) FILTER ({c} IS NULL) * 100.0 / COUNT(*) AS DOUBLE) AS percent,
        CASE WHEN COUNT(*) FILTER ({c} IS NULL) = 0 THEN 'ok'
          WHEN COUNT(*) FILTER ({c} IS NULL) * 100.0 / COUNT(*) < 5 THEN 'attention' ELSE 'critical' END AS level FROM x"""
    for c in ("order_id", "customer_id", "order_date", "total_amount", "status")
)


@query("q01_null_profile", PROFILE)
def _(spark, d):
    wanted = ["order_id", "customer_id", "order_date", "total_amount", "status"]
    return q.null_profile(dirty(spark, d), wanted)


THRESHOLDS = {"order_id": 1.0, "customer_id": 0.99, "status": 0.95}
COMPLETENESS = X + " " + " UNION ALL ".join(
    f"""SELECT 'completeness_{c}' AS check_name, COUNT({c})::DOUBLE / COUNT(*) >= {t} AS passed,
        {rate4(f'COUNT({c})::DOUBLE / COUNT(*)')} AS metric_value, {t}::DOUBLE AS threshold, 'critical' AS severity FROM x"""
    for c, t in THRESHOLDS.items()
)


@query(
    "q02_completeness_per_column",
    COMPLETENESS + """ UNION ALL SELECT 'completeness_coupon', FALSE, 0, 0.9, 'critical'""",
)
def _(spark, d):
    """Each column with its own threshold; a column that is not there fails."""
    df = dirty(spark, d)
    return flat(q.run_rowwise(df, q.completeness(df, {**THRESHOLDS, "coupon": 0.9})))


@query(
    "q02_nan_counts_as_missing",
    """SELECT 'completeness_amount' AS check_name, CAST(SUM(CAST(order_id % 10 > 1 AS INT)) AS BIGINT) AS non_null,
       CAST(SUM(CAST(order_id % 10 <= 1 AS INT)) AS BIGINT) AS nulls, FALSE AS passed FROM o""",
)
def _(spark, d):
    df = orders_fact(spark, d).select(
        F.when(F.col("order_id") % 10 == 0, F.lit(float("nan")))
        .when(F.col("order_id") % 10 != 1, F.col("total_amount")).alias("amount")
    )
    out = q.run_rowwise(df, q.completeness(df, ["amount"]))
    details = [F.col("details")[n].cast("long").alias(n) for n in ("non_null", "nulls")]
    return out.select("check_name", *details, "passed")


@query(
    "q02_optional_columns_only_warn",
    X + f""" SELECT 'completeness_customer_id' AS check_name, FALSE AS passed,
       {rate4('COUNT(customer_id)::DOUBLE / COUNT(*)')} AS metric_value, 1.0::DOUBLE AS threshold, 'warning' AS severity,
       'alert' AS decision FROM x""",
)
def _(spark, d):
    df = dirty(spark, d)
    results = q.run_rowwise(df, q.completeness(df, ["customer_id"], threshold=1.0, severity="warning"))
    decided = g.report(results).select(g.decision("strict").alias("decision")).scalar()
    return flat(results).withColumn("decision", decided)


@query(
    "q03_lowest_completeness",
    X + f""" SELECT 'completeness' AS check_name, FALSE AS passed, {rate4('COUNT(customer_id)::DOUBLE / COUNT(*)')} AS metric_value,
       0.99::DOUBLE AS threshold, 'critical' AS severity FROM x""",
)
def _(spark, d):
    df = dirty(spark, d)
    return flat(q.run_rowwise(df, [q.least_complete(df, ["order_id", "customer_id", "status"], 0.99)]))


# ------------------------------------------------------------------ uniqueness

UNIQUE = """SELECT '{keys}' AS key_columns, CAST(SUM(n) AS BIGINT) AS total_records, COUNT(*) AS distinct_keys,
    COUNT(*) FILTER (n > 1) AS duplicate_keys, MAX(n) AS max_occurrences, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_records,
    CAST((SUM(n) - COUNT(*)) * 100.0 AS DOUBLE) / SUM(n) AS duplicate_pct, COUNT(*)::DOUBLE / SUM(n) AS uniqueness_rate,
    COUNT(*) FILTER (n > 1) = 0 AS passed FROM (SELECT {keys}, COUNT(*) AS n FROM {table} GROUP BY {keys})"""


@query("q04_uniqueness_report", X + " " + UNIQUE.format(keys="order_id", table="x"))
def _(spark, d):
    return q.uniqueness_report(dirty(spark, d), ["order_id"])


@query(
    "q05_uniqueness_rate",
    X + f""" SELECT 'uniqueness_order_id' AS check_name, COUNT(DISTINCT order_id)::DOUBLE / COUNT(*) >= 0.95 AS passed,
       {rate4('COUNT(DISTINCT order_id)::DOUBLE / COUNT(*)')} AS metric_value, 0.95::DOUBLE AS threshold, 'critical' AS severity FROM x""",
)
def _(spark, d):
    return flat(q.uniqueness(dirty(spark, d), ["order_id"], threshold=0.95))


@query("q06_approximate_uniqueness", X + " SELECT COUNT(*) AS total_records, TRUE AS near FROM x")
def _(spark, d):
    df = dirty(spark, d)
    exact = q.uniqueness_report(df, ["order_id"]).select("uniqueness_rate").scalar()
    out = q.approximate_uniqueness(df, "order_id")
    return out.select("total_records", (F.abs(F.col("approx_rate") - exact) <= 0.03).alias("near"))


@query(
    "q07_exact_and_conflicting_copies",
    """WITH r AS (SELECT order_id, line_no, product_id % 10 AS p, COUNT(*) AS n FROM li GROUP BY 1, 2, 3),
       g AS (SELECT order_id, line_no, SUM(n) AS n, COUNT(*) AS v FROM r GROUP BY 1, 2)
       SELECT CAST(SUM(n - 1) AS BIGINT) AS extra_rows, CAST(SUM(n - v) AS BIGINT) AS exact_copies,
         CAST(SUM(v - 1) AS BIGINT) AS conflicting_rows, COUNT(*) FILTER (v > 1) AS conflicting_keys FROM g""",
)
def _(spark, d):
    rows = lines(spark, d).select("order_id", "line_no", (F.col("product_id") % 10).alias("p"))
    return q.copies_and_conflicts(rows, ["order_id", "line_no"])


@query(
    "q08_copies_except_ingestion_time",
    X + """ SELECT CAST(COUNT(*) - COUNT(DISTINCT order_id) AS BIGINT) AS extra_rows,
       CAST(COUNT(*) - COUNT(DISTINCT order_id) AS BIGINT) AS exact_copies, CAST(0 AS BIGINT) AS conflicting_rows,
       CAST(0 AS BIGINT) AS conflicting_keys FROM x""",
)
def _(spark, d):
    df = dirty(spark, d)
    late = df.dropDuplicates(["order_id"]).withColumn("_ingestion_ts", F.lit(1))
    second = df.join(count_copies(df.select("order_id")).where("copies > 1"), "order_id", "left_semi")
    both = late.unionByName(second.dropDuplicates(["order_id"]).withColumn("_ingestion_ts", F.lit(2)))
    return q.copies_and_conflicts(both, ["order_id"], ignore=["_ingestion_ts"])


@query("q09_composite_key", UNIQUE.format(keys="order_id,line_no", table="li"))
def _(spark, d):
    return q.uniqueness_report(lines(spark, d), ["order_id", "line_no"])


@query(
    "q10_rows_of_repeated_keys",
    "SELECT order_id, line_no, product_id, supplier_id FROM li QUALIFY COUNT(*) OVER (PARTITION BY order_id, line_no) > 1",
)
def _(spark, d):
    """Found by an aggregate and a semi join; the second join side is one row per repeated key."""
    rows = lines(spark, d).select("order_id", "line_no", "product_id", "supplier_id")
    keys = ["order_id", "line_no"]
    many = count_copies(rows.select(*keys)).where("copies > 1").drop("copies")
    return rows.join(many, keys, "left_semi")


# ------------------------------------------------------------------ integrity

ORPHANS = XK + """, j AS (SELECT x.*, k.customer_id IS NOT NULL AS known FROM x LEFT JOIN k USING (customer_id) WHERE x.customer_id IS NOT NULL)"""


@query(
    "q11_referential_integrity",
    ORPHANS + """ SELECT 'customer_id' AS source_col, COUNT(*) AS total_records, COUNT(*) FILTER (known) AS valid_references,
       COUNT(*) FILTER (NOT known) AS orphan_records, CAST(COUNT(*) FILTER (NOT known) * 100.0 AS DOUBLE) / COUNT(*) AS orphan_pct,
       COUNT(*) FILTER (known)::DOUBLE / COUNT(*) AS integrity_score,
       COUNT(DISTINCT customer_id) FILTER (NOT known) AS orphan_distinct_keys,
       (SELECT COUNT(*) FROM x WHERE customer_id IS NULL) AS null_keys, FALSE AS passed FROM j""",
)
def _(spark, d):
    out = integrity_report(dirty(spark, d), known(spark, d), "customer_id", "customer_id")
    return out.withColumn("orphan_pct", F.col("orphan_pct").cast("double"))


@query(
    "q12_orphans_by_partner_and_month",
    ORPHANS + """ SELECT partner_source, strftime(order_date, '%Y-%m') AS month, CAST(floor(customer_id / 100) AS BIGINT) AS prefix,
       COUNT(*) AS orphans, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS value FROM j WHERE NOT known GROUP BY 1, 2, 3""",
)
def _(spark, d):
    lost = orphans(dirty(spark, d), known(spark, d), "customer_id", "customer_id")
    month = F.date_format("order_date", "yyyy-MM").alias("month")
    prefix = F.floor(F.col("customer_id") / 100).alias("prefix")
    return lost.groupBy("partner_source", month, prefix).agg(
        F.count("*").alias("orphans"), total("total_amount").alias("value")
    )


# ------------------------------------------------------------------ rules

RULES = {
    "customer_missing": "customer_id IS NOT NULL",
    "amount_not_positive": "total_amount > 0",
    "amount_inconsistent": "abs(abs(total_amount) - expected_amount) <= 0.01",
    "status_unknown": "status IN ('O', 'F', 'P')",
    "date_in_future": f"order_date <= DATE '{AS_OF}'",
}
ALL_OK = " AND ".join(f"COALESCE({r}, FALSE)" for r in RULES.values())


@query(
    "q13_validity_all_rules",
    X + f""" SELECT 'validity' AS check_name, COUNT(*) FILTER ({ALL_OK})::DOUBLE / COUNT(*) >= 0.9 AS passed,
       {rate4(f'COUNT(*) FILTER ({ALL_OK})::DOUBLE / COUNT(*)')} AS metric_value, 0.9::DOUBLE AS threshold, 'warning' AS severity FROM x""",
)
def _(spark, d):
    return flat(q.run_rowwise(dirty(spark, d), [q.validity(RULES)]))


@query(
    "q13_rate_per_rule",
    X + " " + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, {rate4(f'COUNT(*) FILTER (COALESCE({r}, FALSE))::DOUBLE / COUNT(*)')} AS rate FROM x"
        for n, r in RULES.items()
    ),
)
def _(spark, d):
    results = q.run_rowwise(dirty(spark, d), [q.validity(RULES)])
    return results.select(F.explode("details").alias("rule", "rate")).withColumn("rate", F.col("rate").cast("double"))


#: Customers whose names and segments are written in several wrong ways.
WRITTEN = """w AS (SELECT customer_id, CASE customer_id % 40 WHEN 1 THEN substr(customer_name, 1, 12) WHEN 2 THEN lower(customer_name)
    WHEN 3 THEN NULL WHEN 4 THEN customer_name || ' ' ELSE customer_name END AS customer_name,
    CASE customer_id % 25 WHEN 7 THEN 'OTHER' WHEN 8 THEN '' ELSE segment END AS segment FROM c)"""
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "q13_format_rules",
    f"""WITH {WRITTEN}, ok AS (SELECT coalesce(length(customer_name) BETWEEN 18 AND 18, FALSE) AS customer_name_length,
       coalesce(regexp_full_match(customer_name, 'Customer#[0-9]{{9}}'), FALSE) AS customer_name_pattern,
       coalesce(segment IN {SEGMENTS}, FALSE) AS segment_code FROM w),
       r AS (UNPIVOT ok ON customer_name_length, customer_name_pattern, segment_code INTO NAME rule VALUE good)
       SELECT rule, {rate4('COUNT(*) FILTER (good)::DOUBLE / COUNT(*)')} AS rate, COUNT(*) FILTER (NOT good) AS broken FROM r GROUP BY rule""",
)
def _(spark, d):
    """Length, pattern and code list, as rates of the check and as reasons of the rows."""
    k = F.col("customer_id") % 40
    name = F.col("customer_name")
    name = (
        F.when(k == 1, F.substring(name, 1, 12)).when(k == 2, F.lower(name)).when(k == 3, None).when(k == 4, F.concat(name, F.lit(" ")))
        .otherwise(name)
    )
    part = F.col("customer_id") % 25
    segment = F.when(part == 7, "OTHER").when(part == 8, "").otherwise(F.col("segment"))
    rows = customers(spark, d).select("customer_id", name.alias("customer_name"), segment.alias("segment"))
    rules = {**q.format_rules("customer_name", (18, 18), r"Customer#\d{9}"), **q.format_rules("segment", codes=SEGMENTS)}
    rates = q.run_rowwise(rows, [q.validity(rules)]).select(F.explode("details").alias("rule", "rate"))
    broken = qt.mark(rows, rules).select(F.explode("_reasons").alias("rule")).groupBy("rule").agg(F.count("*").alias("broken"))
    return rates.join(broken, "rule", "left").select("rule", F.col("rate").cast("double").alias("rate"), F.coalesce("broken", F.lit(0)).cast("long").alias("broken"))


@query(
    "q14_rules_checked_first",
    X + """ SELECT 'good' AS rule, TRUE AS ok, NULL AS error, COUNT(*) FILTER (total_amount > 0)::DOUBLE / COUNT(*) AS rate FROM x
       UNION ALL SELECT 'wrong_column', FALSE, 'UNRESOLVED_COLUMN.WITH_SUGGESTION', NULL
       UNION ALL SELECT 'bad_syntax', FALSE, 'PARSE_SYNTAX_ERROR', NULL
       UNION ALL SELECT 'no_condition', FALSE, 'NOT_A_CONDITION', NULL""",
)
def _(spark, d):
    rules = {
        "good": "total_amount > 0", "wrong_column": "amountt > 0", "bad_syntax": "total_amount > > 0",
        "no_condition": "total_amount + 1",
    }
    return q.check_rules(dirty(spark, d), rules)


@query(
    "q15_domain_sets",
    X + f""" SELECT 'domain_status' AS check_name, COUNT(*) FILTER (status IN ('O', 'F', 'P')) = COUNT(*) AS passed,
         {rate4("COUNT(*) FILTER (status IN ('O', 'F', 'P'))::DOUBLE / COUNT(*)")} AS metric_value, 1::DOUBLE AS threshold, 'warning' AS severity FROM x
       UNION ALL SELECT 'domain_customer_id', COUNT(*) FILTER (customer_id >= 10) = 0,
         {rate4("COUNT(*) FILTER (customer_id IS NULL OR customer_id < 10)::DOUBLE / COUNT(*)")}, 1, 'warning' FROM x""",
)
def _(spark, d):
    """The second set accepts a missing value, as payment methods may be missing."""
    made = [q.domain("status", ["O", "F", "P"]), q.domain("customer_id", range(10), null_ok=True)]
    return flat(q.run_rowwise(dirty(spark, d), made))


@query(
    "q16_amount_consistency",
    """SELECT COUNT(*) AS rows, COUNT(*) FILTER (abs(total_amount - quantity * unit_price) <= 0.01) AS consistent,
       COUNT(*) FILTER (abs(total_amount - quantity * unit_price) <= 0.01) = COUNT(*) AS passed FROM li""",
)
def _(spark, d):
    ok = q.holds("abs(total_amount - quantity * unit_price) <= 0.01")
    return lines(spark, d).agg(
        F.count("*").alias("rows"), F.count_if(ok).alias("consistent"), (F.count_if(ok) == F.count("*")).alias("passed")
    )


@query(
    "q17_shipped_after_ordered",
    f"""SELECT 'ship_order' AS check_name, COUNT(*) FILTER (ship_date >= order_date) = COUNT(*) AS passed,
        {rate4('COUNT(*) FILTER (ship_date >= order_date)::DOUBLE / COUNT(*)')} AS metric_value, 1::DOUBLE AS threshold,
        'critical' AS severity FROM l""",
)
def _(spark, d):
    from lakeworks.plans.sales import lines_fact

    rule = {"shipped_after_ordered": "ship_date >= order_date"}
    check = q.validity(rule, threshold=1.0, severity="critical", name="ship_order")
    return flat(q.run_rowwise(lines_fact(spark, d), [check]))


@query(
    "q18_freshness",
    X + f""" SELECT 'freshness_order_date' AS check_name, TRUE AS passed, strftime(MAX(order_date) FILTER (order_date <= DATE '{AS_OF}'), '%Y-%m-%d') AS newest,
       CAST(datediff('day', MAX(order_date) FILTER (order_date <= DATE '{AS_OF}'), DATE '{AS_OF}') AS BIGINT) AS days_old,
       COUNT(*) FILTER (order_date > DATE '{AS_OF}') AS future FROM x""",
)
def _(spark, d):
    results = q.run_rowwise(dirty(spark, d), [q.freshness("order_date", AS_OF, 7)])
    details = F.col("details")
    return results.select(
        "check_name", "passed", details["newest"].alias("newest"),
        details["days_old"].cast("long").alias("days_old"), details["future"].cast("long").alias("future"),
    )


GOLD = "g AS (SELECT shipping_state, SUM(total_amount) AS revenue FROM s GROUP BY 1)"


@query(
    "q19_gold_checks",
    f"""WITH {GOLD} SELECT * FROM (SELECT 'not_empty' AS check_name, COUNT(*) > 0 AS passed FROM g UNION ALL
        SELECT 'volume', COUNT(*) >= 100 FROM g UNION ALL SELECT 'no_negative', COUNT(*) FILTER (revenue < 0) = 0 FROM g
        UNION ALL SELECT 'no_missing_state', COUNT(*) FILTER (shipping_state IS NULL) = 0 FROM g)""",
)
def _(spark, d):
    gold = sales(spark, d).groupBy("shipping_state").agg(total("total_amount").alias("revenue"))
    return q.run_rowwise(gold, q.gold_checks("revenue", "shipping_state", 100)).select("check_name", "passed")


@query(
    "q20_schema_contract",
    """SELECT "column", state, passed, (SELECT COUNT(*) FROM orders) AS rows FROM (VALUES
       ('order_id', 'other type', FALSE), ('customer_id', 'ok', TRUE), ('total_amount', 'ok', TRUE), ('coupon', 'missing', FALSE),
       ('order_date', 'extra', TRUE), ('payment_method', 'extra', TRUE), ('status', 'extra', TRUE), ('partner_source', 'extra', TRUE))
       t("column", state, passed)""",
)
def _(spark, d):
    df = orders_fact(spark, d)
    want = schema(order_id="string", customer_id="long", total_amount="double", coupon="string")
    out = q.check_schema(spark, df.schema, want).select("column", "state", "passed")
    return out.withColumn("rows", df.agg(F.count("*")).scalar())


# ------------------------------------------------------------------ marking and quarantine

REASON_LIST = list(RULES)
NULL_OR = {n: f"CASE WHEN NOT COALESCE({r}, FALSE) THEN '{n}' END" for n, r in RULES.items()}
MARKED = XK + f""", n AS (SELECT x.*, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY order_date) > 1 AS again FROM x),
  m AS (SELECT n.*, list_filter([{', '.join(NULL_OR.values())},
      CASE WHEN n.customer_id IS NOT NULL AND k.customer_id IS NULL THEN 'customer_unknown' END,
      CASE WHEN again THEN 'repeated' END], lambda z: z IS NOT NULL) AS reasons FROM n LEFT JOIN k USING (customer_id))"""
CRITICAL = ["customer_missing", "repeated"]


def marked(spark, d, cut=None):
    return qt.mark(
        dirty(spark, d), RULES,
        refs={"customer_id": (known(spark, d), "customer_id", "customer_unknown")},
        unique=(["order_id"], "order_date", "repeated"), cut=cut,
    )


REASONS = MARKED + " SELECT order_id, array_to_string(reasons, ', ') AS reasons, COUNT(*) AS rows FROM m GROUP BY 1, 2"


@query("q21_reasons_of_every_row", REASONS)
def _(spark, d):
    text = qt.reasons_text().alias("reasons")
    return marked(spark, d).groupBy("order_id", text).agg(F.count("*").alias("rows"))


@query("q21_reasons_with_hot_keys", REASONS)
def _(spark, d):
    """The same where every repeated key counts as too big for one task."""
    text = qt.reasons_text().alias("reasons")
    out = marked(spark, d, Cut(parts=8192, hot_rows=1))
    return out.groupBy("order_id", text).agg(F.count("*").alias("rows"))


@query(
    "q22_quarantine_split",
    MARKED + f""" SELECT CASE WHEN len(reasons) = 0 THEN 'valid' ELSE 'quarantine' END AS part,
       CASE WHEN len(reasons) = 0 THEN '-' WHEN list_has_any(reasons, {CRITICAL}) THEN 'critical' ELSE 'warning' END AS severity,
       COUNT(*) AS rows, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS value FROM m GROUP BY 1, 2""",
)
def _(spark, d):
    valid, bad = qt.split(marked(spark, d), CRITICAL, at="2001-08-01 06:00:00")
    parts = [
        valid.select(F.lit("valid").alias("part"), F.lit("-").alias("severity"), "total_amount"),
        bad.select(F.lit("quarantine").alias("part"), F.col("_severity").alias("severity"), "total_amount"),
    ]
    return union_all(parts).groupBy("part", "severity").agg(
        F.count("*").alias("rows"), total("total_amount").alias("value")
    )


@query(
    "q23_first_reason",
    X + f""" SELECT CASE {' '.join(f"WHEN NOT COALESCE({r}, FALSE) THEN '{n}'" for n, r in RULES.items())} END AS reason,
       COUNT(*) AS rows FROM x WHERE NOT ({ALL_OK}) GROUP BY 1""",
)
def _(spark, d):
    rows = qt.mark(dirty(spark, d), RULES).where(F.size("_reasons") > 0)
    return rows.groupBy(qt.first_reason().alias("reason")).agg(F.count("*").alias("rows"))


@query(
    "q24_conservation",
    MARKED + """ SELECT COUNT(*) AS rows, COUNT(*) FILTER (len(reasons) = 0) AS valid, COUNT(*) FILTER (len(reasons) > 0) AS quarantined,
       TRUE AS conserved, COUNT(*) FILTER (len(reasons) > 0)::DOUBLE / COUNT(*) AS rate FROM m""",
)
def _(spark, d):
    return qt.conservation(marked(spark, d))


@query(
    "q25_breakdown_by_reason_and_partner",
    MARKED + " SELECT reason, partner_source, COUNT(*) AS rows FROM (SELECT UNNEST(reasons) AS reason, partner_source FROM m) GROUP BY 1, 2",
)
def _(spark, d):
    return qt.breakdown(marked(spark, d), "partner_source")


@query(
    "q25_rejection_by_partner",
    MARKED + """ SELECT partner_source, COUNT(*) AS rows, COUNT(*) FILTER (len(reasons) > 0) AS quarantined,
       CAST(COUNT(*) FILTER (len(reasons) > 0) * 100.0 AS DOUBLE) / COUNT(*) AS percent FROM m GROUP BY 1""",
)
def _(spark, d):
    return qt.rejection_by(marked(spark, d), "partner_source")


@query(
    "q25_reasons_from_text",
    MARKED + " SELECT reason, COUNT(*) AS rows FROM (SELECT UNNEST(reasons) AS reason FROM m) GROUP BY 1",
)
def _(spark, d):
    """From the joined text, as tables of older runs hold it."""
    text = marked(spark, d).select(qt.reasons_text().alias("text")).where("text <> ''")
    return text.select(F.explode(F.split("text", ", ")).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


@query(
    "q26_stored_by_reason_and_date",
    MARKED + """ SELECT reason, strftime(order_date, '%Y') AS date, COUNT(*) AS rows FROM
       (SELECT UNNEST(reasons) AS reason, order_date FROM m) GROUP BY 1, 2""",
)
def _(spark, d):
    _, bad = qt.split(marked(spark, d), CRITICAL, at="2001-08-01 06:00:00")
    path = fresh_path(spark, "quarantine")
    tables.write(qt.per_reason(bad, F.date_format("order_date", "yyyy")), path, ["reason", "date"])
    back = spark.read.parquet(path)
    return back.groupBy("reason", F.col("date").cast("string").alias("date")).agg(F.count("*").alias("rows"))


def old_quarantine(spark, d):
    """Quarantined rows with the day they would have come in on."""
    _, bad = qt.split(marked(spark, d), CRITICAL, at="2001-08-01 06:00:00")
    past = F.least(F.col("order_date"), F.lit(AS_OF).cast("date")).cast("timestamp")
    return bad.withColumn("_quarantine_ts", past)


OLD = MARKED + f", b AS (SELECT *, LEAST(order_date, DATE '{AS_OF}') AS day FROM m WHERE len(reasons) > 0)"


@query(
    "q27_backlog",
    OLD + f""" SELECT COUNT(*) AS rows, COUNT(*) > 1000 AS over_limit, strftime(MIN(day), '%Y-%m-%d') AS oldest,
       CAST(datediff('day', MIN(day), DATE '{AS_OF}') AS BIGINT) AS days_waiting FROM b""",
)
def _(spark, d):
    out = qt.backlog(old_quarantine(spark, d), AS_OF, limit=1000)
    return out.withColumn("oldest", F.date_format("oldest", "yyyy-MM-dd"))


@query(
    "q27_priorities",
    OLD + f""" SELECT reason, COUNT(*) AS rows, strftime(MIN(day), '%Y-%m-%d') AS first_day, strftime(MAX(day), '%Y-%m-%d') AS last_day,
       CAST(datediff('day', MIN(day), DATE '{AS_OF}') AS BIGINT) AS days_waiting
       FROM (SELECT UNNEST(reasons) AS reason, day FROM b) GROUP BY 1""",
)
def _(spark, d):
    out = qt.priorities(old_quarantine(spark, d), AS_OF)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_day", "last_day")})


@query(
    "q28_retention_to_archive",
    OLD + f""" SELECT CASE WHEN datediff('day', day, DATE '{AS_OF}') > 30 THEN 'archive' ELSE 'live' END AS part,
       COUNT(*) AS rows FROM b GROUP BY 1""",
)
def _(spark, d):
    live, archive = fresh_path(spark, "quarantine"), fresh_path(spark, "archive")
    tables.write(old_quarantine(spark, d), live)
    tables.archive_expired(spark, live, archive, "_quarantine_ts", AS_OF, 30)
    parts = [spark.read.parquet(p).select(F.lit(n).alias("part")) for n, p in (("live", live), ("archive", archive))]
    return union_all(parts).groupBy("part").agg(F.count("*").alias("rows"))


# ------------------------------------------------------------------ runs, gates, history


def config(spark, d):
    return {
        "completeness": {"columns": {"order_id": 1.0, "customer_id": 0.95}},
        "validity": {"rules": RULES, "threshold": 0.90},
        "domain": [{"column": "status", "allowed": ["O", "F", "P"], "threshold": 0.99}],
        "freshness": {"column": "order_date", "as_of": AS_OF, "max_days": 7},
        "volume": {"min_rows": 100},
        "uniqueness": [{"keys": ["order_id"], "threshold": 1.0}],
        "referential_integrity": [
            {"ref": known(spark, d), "fk": "customer_id", "pk": "customer_id", "threshold": 0.95}
        ],
    }


def line(name, rate, threshold, severity, source="x"):
    return f"""SELECT '{name}' AS check_name, {rate} >= {threshold} AS passed, {rate4(rate)} AS metric_value,
        {threshold}::DOUBLE AS threshold, '{severity}' AS severity FROM {source}"""


RESULTS = [
    line("completeness_order_id", "COUNT(order_id)::DOUBLE / COUNT(*)", 1.0, "critical"),
    line("completeness_customer_id", "COUNT(customer_id)::DOUBLE / COUNT(*)", 0.95, "critical"),
    line("validity", f"COUNT(*) FILTER ({ALL_OK})::DOUBLE / COUNT(*)", 0.90, "warning"),
    line("domain_status", "COUNT(*) FILTER (status IN ('O', 'F', 'P'))::DOUBLE / COUNT(*)", 0.99, "warning"),
    line("freshness_order_date", "1.0::DOUBLE", 1.0, "warning", "(SELECT COUNT(*) FROM x)"),
    line("volume", "CAST(COUNT(*) >= 100 AS DOUBLE)", 1.0, "critical"),
    line("uniqueness_order_id", "COUNT(DISTINCT order_id)::DOUBLE / COUNT(*)", 1.0, "critical"),
    line("integrity_customer_id", "COUNT(*) FILTER (known)::DOUBLE / COUNT(*)", 0.95, "critical", "j"),
]
RUN = ORPHANS + ", r AS (" + " UNION ALL ".join(RESULTS) + ")"


@query("q29_run_all_checks", RUN + " SELECT * FROM r")
def _(spark, d):
    return flat(q.run_all(dirty(spark, d), config(spark, d)))


REPORT = RUN + f""", t AS (SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (passed) AS passed, COUNT(*) FILTER (NOT passed) AS failed,
    COUNT(*) FILTER (NOT passed AND severity = 'critical') AS critical_failed,
    {rate4('CAST(SUM(CAST(metric_value AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*)')} AS overall_score,
    CASE WHEN COUNT(*) FILTER (NOT passed) = 0 THEN 'PASSED' ELSE 'FAILED' END AS gate_status FROM r)"""


@query("q30_report", REPORT + " SELECT * FROM t")
def _(spark, d):
    return g.report(q.run_all(dirty(spark, d), config(spark, d)))


@query("q31_gate_stops_on_critical", REPORT + " SELECT critical_failed, 'stopped' AS outcome FROM t")
def _(spark, d):
    results = q.run_all(dirty(spark, d), config(spark, d))
    try:
        outcome = g.gate(results, "strict")
    except g.QualityGateError:
        outcome = "stopped"
    return g.report(results).select("critical_failed", F.lit(outcome).alias("outcome"))


@query(
    "q32_gate_modes_by_layer",
    REPORT + """ SELECT layer, mode, CASE WHEN critical_failed > 0 THEN CASE mode WHEN 'monitor' THEN 'record' WHEN 'lenient' THEN 'quarantine'
         ELSE 'stop' END WHEN failed > 0 THEN CASE mode WHEN 'monitor' THEN 'record' ELSE 'alert' END ELSE 'go' END AS decision
       FROM t, (VALUES ('bronze', 'monitor'), ('silver', 'lenient'), ('gold', 'strict')) v(layer, mode)""",
)
def _(spark, d):
    one = g.report(q.run_all(dirty(spark, d), config(spark, d)))
    each = [
        F.struct(F.lit(layer).alias("layer"), F.lit(mode).alias("mode"), g.decision(mode).alias("decision"))
        for layer, mode in g.LAYER_MODES.items()
    ]
    return one.select(F.inline(F.array(*each)))


@query(
    "q32_gate_by_environment",
    X + """ SELECT env, COUNT(customer_id)::DOUBLE / COUNT(*) >= threshold AS passed,
       CASE WHEN COUNT(customer_id)::DOUBLE / COUNT(*) >= threshold THEN 'go' WHEN env = 'dev' THEN 'record' ELSE 'stop' END AS decision
       FROM x, (VALUES ('dev', 0.99), ('prod', 0.95)) v(env, threshold) GROUP BY env, threshold""",
)
def _(spark, d):
    df, out = dirty(spark, d), []
    for env, settings in g.ENVIRONMENTS.items():
        results = q.run_rowwise(df, q.completeness(df, ["customer_id"], settings["completeness"]))
        decided = g.report(results).select(g.decision(settings["mode"]).alias("decision")).scalar()
        out.append(results.select(F.lit(env).alias("env"), "passed", decided.alias("decision")))
    return union_all(out)


@query(
    "q33_quarantine_rate_gate",
    MARKED + """ SELECT COUNT(*) AS rows, COUNT(*) FILTER (len(reasons) > 0) AS quarantined,
       CASE WHEN COUNT(*) FILTER (len(reasons) > 0)::DOUBLE / COUNT(*) < 0.05 THEN 'silver' ELSE 'alert' END AS next FROM m""",
)
def _(spark, d):
    return g.rate_gate(qt.conservation(marked(spark, d))).select("rows", "quarantined", "next")


HISTORY = X + f""", h AS (SELECT strftime(order_date, '%Y-%m') AS run_date,
    {rate4("COUNT(*) FILTER (" + ALL_OK + ")::DOUBLE / COUNT(*)")} AS metric_value FROM x WHERE order_date <= DATE '{AS_OF}' GROUP BY 1)"""


def monthly_history(spark, d):
    """The validity of each month's orders, as if the checks had run once a month."""
    ok = F.lit(True)
    for rule in RULES.values():
        ok = ok & q.holds(rule)
    rows = dirty(spark, d).where(F.col("order_date") <= AS_OF)
    months = rows.groupBy(F.date_format("order_date", "yyyy-MM").alias("run_date")).agg(
        exact_round(q.share(F.count_if(ok), F.count("*"), 1.0), 4).alias("metric_value")
    )
    return months.withColumn("check_name", F.lit("validity"))


@query(
    "q34_trend_against_last_run",
    HISTORY + """, prev AS (SELECT *, LAG(metric_value) OVER (ORDER BY run_date) AS previous FROM h)
       SELECT run_date, metric_value, previous, CASE WHEN metric_value > previous THEN 'better' WHEN metric_value < previous THEN 'worse'
         WHEN metric_value = previous THEN 'same' END AS direction FROM prev""",
)
def _(spark, d):
    """Stored run by run; one run is stored twice and counts once."""
    path, history = fresh_path(spark, "history"), monthly_history(spark, d)
    tables.write(history, path, ["run_date"])
    again = history.where("run_date = '2000-03'").drop("run_date")
    g.keep_history(again, path, "2000-03")
    stored = spark.read.parquet(path).withColumn("run_date", F.col("run_date").cast("string"))
    return g.trend(stored).select("run_date", "metric_value", "previous", "direction")


@query(
    "q35_adaptive_threshold",
    HISTORY + """, prev AS (SELECT *, AVG(metric_value) OVER w - 2 * STDDEV_SAMP(metric_value) OVER w AS t FROM h
         WINDOW w AS (ORDER BY run_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
       SELECT run_date, CAST(ROUND(CAST(t AS DECIMAL(18,6)), 4) AS DOUBLE) AS adaptive_threshold FROM prev""",
)
def _(spark, d):
    out = g.adaptive_threshold(monthly_history(spark, d))
    return out.select("run_date", exact_round("adaptive_threshold", 4).alias("adaptive_threshold"))


@query(
    "q36_rules_per_segment",
    X + f""" SELECT {rate4("COUNT(*) FILTER (status <> 'P' OR total_amount > 0)::DOUBLE / COUNT(*)")} AS pending_positive,
       {rate4("COUNT(*) FILTER (payment_method <> '1-URGENT' OR customer_id IS NOT NULL)::DOUBLE / COUNT(*)")} AS urgent_has_customer,
       {rate4("COUNT(*) FILTER ((status <> 'P' OR total_amount > 0) AND (payment_method <> '1-URGENT' OR customer_id IS NOT NULL))::DOUBLE / COUNT(*)")} AS both
       FROM x""",
)
def _(spark, d):
    """Conditional rules: each binds some rows and lets the others pass."""
    rules = {
        "pending_positive": q.only_when("status = 'P'", "total_amount > 0"),
        "urgent_has_customer": q.only_when("payment_method = '1-URGENT'", "customer_id IS NOT NULL"),
    }
    out = q.run_rowwise(dirty(spark, d), [q.validity(rules)])
    parts = [F.col("details")[n].cast("double").alias(n) for n in rules]
    return out.select(*parts, F.col("metric_value").alias("both"))


@query(
    "q37_only_new_rows",
    X + f""" SELECT 'completeness_customer_id' AS check_name, COUNT(customer_id)::DOUBLE / COUNT(*) >= 0.95 AS passed,
       {rate4('COUNT(customer_id)::DOUBLE / COUNT(*)')} AS metric_value, COUNT(*) AS rows FROM x
       WHERE order_date BETWEEN DATE '{AS_OF}' - 60 AND DATE '{AS_OF}'""",
)
def _(spark, d):
    """On a table laid out by date only the folders of the last days are read."""
    path = fresh_path(spark, "silver")
    rows = dirty(spark, d).withColumn("ingestion_date", F.last_day("order_date"))
    tables.write(rows, path, ["ingestion_date"])
    late = spark.read.parquet(path).where(f"ingestion_date >= DATE '{AS_OF}' - 60")
    new = q.since(late, "order_date", AS_OF, 60)
    results = q.run_rowwise(new, q.completeness(new, ["customer_id"]))
    rows = F.col("details")["non_null"].cast("long") + F.col("details")["nulls"].cast("long")
    return results.select("check_name", "passed", "metric_value", rows.alias("rows"))


@query("q38_sampled_check", X + " SELECT TRUE AS near, COUNT(*) AS rows FROM x")
def _(spark, d):
    """Completeness on one order in five against all of them."""
    df = dirty(spark, d)

    def rate(rows):
        return q.run_rowwise(rows, q.completeness(rows, ["customer_id"])).select("metric_value").scalar()

    near = F.abs(rate(hash_sample(df, ["order_id"], 5)) - rate(df)) < 0.05
    return df.agg(F.count("*").alias("rows")).withColumn("near", near)


@query(
    "q39_shared_input",
    RUN + " SELECT * FROM r WHERE check_name NOT LIKE 'freshness%'",
)
def _(spark, d):
    """Several separate checks over one input that is kept while they run."""
    df = dirty(spark, d).persist()
    try:
        parts = [
            q.run_rowwise(df, [*q.completeness(df, {"order_id": 1.0, "customer_id": 0.95}), q.validity(RULES),
                               q.domain("status", ["O", "F", "P"], threshold=0.99), q.volume(100)]),
            q.uniqueness(df, ["order_id"]),
            q.integrity(df, known(spark, d), "customer_id", "customer_id", threshold=0.95),
        ]
        path = fresh_path(spark, "results")
        flat(union_all(parts)).write.parquet(path)
    finally:
        df.unpersist()
    return spark.read.parquet(path)


@query(
    "q40_injected_defects",
    X + f""" SELECT COUNT(*) AS rows, COUNT(*) FILTER (customer_id IS NULL) AS no_customer, COUNT(*) FILTER (total_amount < 0) AS negative,
       COUNT(*) - COUNT(DISTINCT order_id) AS repeated, COUNT(*) FILTER (status = 'INVALID') AS bad_status,
       COUNT(*) FILTER (order_date > DATE '{AS_OF}') AS future FROM x""",
)
def _(spark, d):
    return dirty(spark, d).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("customer_id").isNull()).alias("no_customer"),
        F.count_if(F.col("total_amount") < 0).alias("negative"),
        (F.count("*") - F.count_distinct("order_id")).alias("repeated"),
        F.count_if(F.col("status") == "INVALID").alias("bad_status"),
        F.count_if(F.col("order_date") > AS_OF).alias("future"),
    )


@query(
    "a24_duplicate_impact",
    X + """, kept AS (SELECT * FROM x QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY order_date) = 1),
       v AS (SELECT (SELECT COUNT(*) FROM x) AS rows_before, (SELECT COUNT(*) FROM kept) AS rows_after,
         (SELECT CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) FROM x) AS revenue_before,
         (SELECT CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) FROM kept) AS revenue_after)
       SELECT *, revenue_before / rows_before AS ticket_before, revenue_after / rows_after AS ticket_after,
         (revenue_before - revenue_after) * 100 / revenue_after AS inflation_percent FROM v""",
)
def _(spark, d):
    return duplicate_impact(dirty(spark, d), ["order_id"], ["order_date"], "total_amount")


@query(
    "q11_flag_known_keys",
    XK + """ SELECT COALESCE(k.customer_id IS NOT NULL, FALSE) AS known, COUNT(*) AS rows FROM x LEFT JOIN k USING (customer_id) GROUP BY 1""",
)
def _(spark, d):
    out = flag_known(dirty(spark, d), known(spark, d), "customer_id", "customer_id", "known")
    return out.groupBy("known").agg(F.count("*").alias("rows"))
