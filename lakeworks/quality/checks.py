"""Quality checks whose results are a DataFrame.

Everything that can be told from one row at a time (completeness, rules, domains, freshness,
volume) is fused into a single aggregate over the input. Uniqueness and referential integrity
each add one shuffle of (key, count) rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException, ParseException

from lakeworks.functions.columns import exact_round
from lakeworks.operators.frequent import key_hash
from lakeworks.operators.joins import integrity_report
from lakeworks.operators.skew import Cut, hot_hashes
from lakeworks.operators.transform import union_all


def present(df: DataFrame, column: str) -> Column:
    """Not null, and for floating numbers not NaN."""
    there = F.col(column).isNotNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        there = there & ~F.isnan(column)
    return there


def holds(rule: str | Column, null_ok: bool = False) -> Column:
    """A rule as a boolean without nulls: a rule that cannot be decided fails, or passes if `null_ok`."""
    return F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(null_ok))


def only_when(condition: str, rule: str) -> str:
    """A rule for some rows only, such as refunds; the others pass."""
    return f"NOT coalesce(({condition}), false) OR coalesce(({rule}), false)"


def share(part: Column, whole: Column, empty: float) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(empty))


@dataclass
class Check:
    """One line of the report: a rate from 0 to 1 that must reach a threshold."""

    name: str
    rate: Column
    threshold: float
    severity: str
    details: dict[str, Column] = field(default_factory=dict)

    def result(self) -> Column:
        texts = [F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in self.details.items()]
        empty = F.create_map().cast("map<string,string>")
        return F.struct(
            F.lit(self.name).alias("check_name"),
            (self.rate >= self.threshold).alias("passed"),
            exact_round(self.rate, 4).alias("metric_value"),
            F.lit(float(self.threshold)).alias("threshold"),
            (F.map_from_entries(F.array(*texts)) if texts else empty).alias("details"),
            F.lit(self.severity).alias("severity"),
        )


# ------------------------------------------------------------------ checks on single rows


def completeness(
    df: DataFrame, columns: Mapping[str, float] | Sequence[str], threshold: float = 0.95, severity: str = "critical"
) -> list[Check]:
    """One check per column, each with its own threshold; an unknown column fails."""
    wanted = columns if isinstance(columns, Mapping) else dict.fromkeys(columns, threshold)
    out = []
    for column, limit in wanted.items():
        if column in df.columns:
            filled = F.count_if(present(df, column))
            details = {"non_null": filled, "nulls": F.count("*") - filled}
            out.append(Check(f"completeness_{column}", share(filled, F.count("*"), 0.0), limit, severity, details))
        else:
            error = {"error": F.lit("no such column")}
            out.append(Check(f"completeness_{column}", F.lit(0.0), limit, severity, error))
    return out


def least_complete(
    df: DataFrame, columns: Sequence[str], threshold: float = 0.95, severity: str = "critical"
) -> Check:
    """One check for all columns: the lowest rate of them."""
    rates = {c: share(F.count_if(present(df, c)), F.count("*"), 0.0) for c in columns}
    lowest = F.least(*rates.values()) if len(rates) > 1 else next(iter(rates.values()))
    return Check("completeness", lowest, threshold, severity, {c: exact_round(r, 4) for c, r in rates.items()})


def validity(
    rules: Mapping[str, str | Column], threshold: float = 0.90, severity: str = "warning",
    null_ok: Iterable[str] = (), name: str = "validity",
) -> Check:
    """Share of rows that keep all rules; the details give each rule's own rate."""
    ok = {n: holds(r, n in set(null_ok)) for n, r in rules.items()}
    every = F.lit(True)
    for one in ok.values():
        every = every & one
    details = {n: exact_round(share(F.count_if(one), F.count("*"), 1.0), 4) for n, one in ok.items()}
    return Check(name, share(F.count_if(every), F.count("*"), 1.0), threshold, severity, details)


def format_rules(
    column: str, length: tuple[int, int] | None = None, pattern: str | None = None, codes: Iterable[str] | None = None
) -> dict[str, Column]:
    """Rules on how a text is written, for `validity` and `mark`: its length, a pattern that all of it fits, a list of codes."""
    value, rules = F.col(column), {}
    if length:
        rules[f"{column}_length"] = F.length(value).between(*length)
    if pattern:
        rules[f"{column}_pattern"] = value.rlike(rf"\A(?:{pattern})\z")
    if codes is not None:
        rules[f"{column}_code"] = value.isin(list(codes))
    return rules


def domain(column: str, allowed: Iterable[str], null_ok: bool = False, threshold: float = 1.0, severity: str = "warning") -> Check:
    """Share of rows whose value is one of the accepted ones."""
    ok = holds(F.col(column).isin(list(allowed)), null_ok)
    return Check(f"domain_{column}", share(F.count_if(ok), F.count("*"), 1.0), threshold, severity)


def freshness(column: str, as_of: str, max_days: int = 7, severity: str = "warning") -> Check:
    """The newest date up to `as_of` is at most `max_days` old; dates after it are counted apart."""
    day, today = F.col(column).cast("date"), F.lit(as_of).cast("date")
    newest = F.max(F.when(day <= today, day))
    fresh = F.coalesce((F.datediff(today, newest) <= max_days).cast("double"), F.lit(0.0))
    details = {"newest": newest, "days_old": F.datediff(today, newest), "future": F.count_if(day > today)}
    return Check(f"freshness_{column}", fresh, 1.0, severity, details)


def volume(min_rows: int, severity: str = "critical") -> Check:
    enough = (F.count("*") >= min_rows).cast("double")
    return Check("volume", enough, 1.0, severity, {"rows": F.count("*")})


def gold_checks(amount: str, state: str, min_rows: int) -> list[Check]:
    """Not empty, enough rows, no negative value, no missing state."""
    none = F.count("*") * 0.0
    return [
        Check("not_empty", (F.count("*") > 0).cast("double"), 1.0, "critical"),
        volume(min_rows),
        Check("no_negative", (F.count_if(F.col(amount) < 0) == none).cast("double"), 1.0, "critical",
              {"negative": F.count_if(F.col(amount) < 0)}),
        Check("no_missing_state", (F.count_if(F.col(state).isNull()) == none).cast("double"), 1.0, "critical",
              {"missing": F.count_if(F.col(state).isNull())}),
    ]


def run_rowwise(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks in one aggregate, one result row each."""
    return df.agg(F.array(*[c.result() for c in checks]).alias("results")).select(F.inline("results"))


# ------------------------------------------------------------------ checks on groups


def uniqueness_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct and repeated keys, extra rows, percent, most copies, rate.

    Null is one key. The shuffle carries one (key, count) row per key and task.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    out = counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.coalesce(F.max("_n"), F.lit(0)).alias("max_occurrences"),
    )
    extra = F.col("total_records") - F.col("distinct_keys")
    return out.select(
        F.lit(",".join(keys)).alias("key_columns"),
        "*",
        extra.alias("duplicate_records"),
        F.coalesce(F.try_divide(extra * 100.0, "total_records"), F.lit(0.0)).cast("double").alias("duplicate_pct"),
        share(F.col("distinct_keys"), F.col("total_records"), 1.0).alias("uniqueness_rate"),
        (F.col("duplicate_keys") == 0).alias("passed"),
    )


def approximate_uniqueness(df: DataFrame, key: str, rsd: float = 0.01) -> DataFrame:
    """Rate from a sketch: one pass, no shuffle of keys."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.approx_count_distinct(key, rsd).alias("approx_keys"),
        share(F.approx_count_distinct(key, rsd), F.count("*"), 1.0).alias("approx_rate"),
    )


def uniqueness(df: DataFrame, keys: Sequence[str], threshold: float = 1.0, severity: str = "critical") -> DataFrame:
    """The report as a check result; threshold 1.0 allows no repeated key."""
    details = {c: F.max(c) for c in ("total_records", "distinct_keys", "duplicate_keys", "duplicate_records", "max_occurrences")}
    check = Check(f"uniqueness_{'_'.join(keys)}", F.max("uniqueness_rate"), threshold, severity, details)
    return run_rowwise(uniqueness_report(df, keys), [check])


def integrity(
    df: DataFrame, ref: DataFrame, fk: str, pk: str, threshold: float = 1.0, severity: str = "critical"
) -> DataFrame:
    details = {c: F.max(c) for c in ("total_records", "orphan_records", "orphan_distinct_keys", "null_keys")}
    check = Check(f"integrity_{fk}", F.max("integrity_score"), threshold, severity, details)
    return run_rowwise(integrity_report(df, ref, fk, pk), [check])


#: Rows of a task that counts them by key: what it holds in memory does not grow with the table.
ROWS_A_TASK = 500_000


def dealt(df: DataFrame, keys: Sequence[str], cut: Cut | None = None, rows_a_task: int = ROWS_A_TASK) -> list[DataFrame]:
    """The rows in frames that share no key, for aggregates by the keys (and more): those of a large table dealt by
    key to as many tasks as their number asks for, which adaptive execution does not join again. Rows of hot keys are a frame
    of their own that is not dealt, so partial aggregates reduce them where they are."""
    cut, rows = cut or Cut.default(df), df.count()
    if rows <= cut.hot_rows:
        return [df]
    parts = ceil(rows / rows_a_task)
    hot = hot_hashes(df, keys, cut)
    if hot is None:
        return [df.repartition(parts, *keys)]
    is_hot = key_hash(keys) == F.col("_hash")
    hot = F.broadcast(hot.select("_hash"))
    return [df.join(hot, is_hot, "left_anti").repartition(parts, *keys), df.join(hot, is_hot, "left_semi")]


def copies_and_conflicts(
    df: DataFrame, keys: Sequence[str], ignore: Sequence[str] = (), cut: Cut | None = None
) -> DataFrame:
    """One row: extra rows in all, those that are exact copies, and those that differ somewhere.

    Columns in `ignore` (an ingestion time, say) do not count as a difference.
    """
    content = [c for c in df.columns if c not in ignore]

    def per_key(some: DataFrame) -> DataFrame:
        rows = some.groupBy(*content).agg(F.count("*").alias("_n"))
        return rows.groupBy(*keys).agg(F.sum("_n").alias("_rows"), F.count("*").alias("_versions"))

    return union_all([per_key(some) for some in dealt(df.select(*content), keys, cut)]).agg(
        F.sum(F.col("_rows") - 1).alias("extra_rows"),
        F.sum(F.col("_rows") - F.col("_versions")).alias("exact_copies"),
        F.sum(F.col("_versions") - 1).alias("conflicting_rows"),
        F.count_if(F.col("_versions") > 1).alias("conflicting_keys"),
    )


def run_all(df: DataFrame, config: Mapping) -> DataFrame:
    """Every check of a configuration: `completeness`, `validity`, `domain`, `freshness`, `volume`
    in one aggregate, then `uniqueness` (a list) and `referential_integrity` (a list)."""
    fused: list[Check] = []
    if "completeness" in config:
        fused += completeness(df, **config["completeness"])
    if "validity" in config:
        fused.append(validity(**config["validity"]))
    fused += [domain(**one) for one in config.get("domain", [])]
    if "freshness" in config:
        fused.append(freshness(**config["freshness"]))
    if "volume" in config:
        fused.append(volume(**config["volume"]))
    frames = [run_rowwise(df, fused)] if fused else []
    frames += [uniqueness(df, **one) for one in config.get("uniqueness", [])]
    frames += [integrity(df, **one) for one in config.get("referential_integrity", [])]
    return union_all(frames)


# ------------------------------------------------------------------ profiles and contracts


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: nulls, percent and level (ok, below 5 %, more); one aggregate."""
    cells = [
        F.struct(F.lit(c).alias("column"), F.count_if(~present(df, c)).alias("nulls"), F.count("*").alias("rows"))
        for c in (columns or df.columns)
    ]
    out = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    percent = F.coalesce(F.try_divide(F.col("nulls") * 100.0, "rows"), F.lit(0.0)).cast("double")
    level = F.when(F.col("percent") == 0, "ok").when(F.col("percent") < 5, "attention").otherwise("critical")
    return out.withColumn("percent", percent).withColumn("level", level)


def check_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Which rules parse and resolve against the frame, with the share of rows each holds for.

    Broken rules are found by analysis alone; the sound ones are measured in one aggregate.
    """
    sound, broken = {}, {}
    for name, rule in rules.items():
        try:
            kind = df.select(F.expr(rule)).schema[0].dataType
            if isinstance(kind, T.BooleanType):
                sound[name] = rule
            else:
                broken[name] = "NOT_A_CONDITION"
        except (AnalysisException, ParseException) as error:
            broken[name] = error.getCondition() or "ERROR"
    cells = [
        F.struct(
            F.lit(n).alias("rule"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"),
            share(F.count_if(holds(r)), F.count("*"), 1.0).alias("rate"),
        )
        for n, r in sound.items()
    ]
    cells += [
        F.struct(F.lit(n).alias("rule"), F.lit(False).alias("ok"), F.lit(e).alias("error"), F.lit(None).cast("double").alias("rate"))
        for n, e in broken.items()
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def check_schema(spark: SparkSession, have: T.StructType, want: T.StructType) -> DataFrame:
    """A column contract: missing columns and other types fail, extra columns only warn."""
    got = {f.name: f.dataType.simpleString() for f in have}
    rows = []
    for f in want:
        kind = f.dataType.simpleString()
        state = "missing" if f.name not in got else "ok" if got[f.name] == kind else "other type"
        rows.append((f.name, kind, got.get(f.name), state, state == "ok"))
    rows += [(n, None, k, "extra", True) for n, k in got.items() if n not in want.fieldNames()]
    return spark.createDataFrame(rows, "column string, expected string, found string, state string, passed boolean")


def since(df: DataFrame, column: str, as_of: str, days: int) -> DataFrame:
    """Only what arrived in the last days: on a partition column the other folders are not read."""
    start = F.date_sub(F.lit(as_of).cast("date"), days)
    return df.where((F.col(column) >= start) & (F.col(column) <= F.lit(as_of).cast("date")))
