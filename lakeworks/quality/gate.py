"""Decisions from check results, and their history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.functions.columns import exact_round
from lakeworks.sinks.tables import write

# What a failed check does at each gate mode, by layer and by environment.
MODES = ("monitor", "lenient", "strict")
LAYER_MODES = {"bronze": "monitor", "silver": "lenient", "gold": "strict"}
ENVIRONMENTS = {
    "dev": {"completeness": 0.99, "uniqueness": 1.00, "mode": "monitor"},
    "prod": {"completeness": 0.95, "uniqueness": 0.99, "mode": "strict"},
}
QUARANTINE_LIMIT = 0.05


class QualityGateError(RuntimeError):
    """A critical check failed at a strict gate."""


def report(results: DataFrame) -> DataFrame:
    """One row: checks, passed, failed, critical failures, score (mean rate) and gate status."""
    out = results.agg(
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count_if(~F.col("passed") & (F.col("severity") == "critical")).alias("critical_failed"),
        F.coalesce(
            exact_round(
                F.try_divide(F.sum(F.col("metric_value").cast("decimal(18,4)")).cast("double"), F.count("*")), 4
            ),
            F.lit(0.0),
        ).alias("overall_score"),
    )
    return out.withColumn("gate_status", F.when(F.col("failed") == 0, "PASSED").otherwise("FAILED"))


def decision(mode: str) -> Column:
    """What a report means at a gate: monitor records, lenient quarantines and goes on, strict stops."""
    if mode not in MODES:
        raise ValueError(f"gate mode {mode} is none of {MODES}")
    on_critical = {"monitor": "record", "lenient": "quarantine", "strict": "stop"}[mode]
    on_warning = "record" if mode == "monitor" else "alert"
    return (
        F.when(F.col("critical_failed") > 0, on_critical).when(F.col("failed") > 0, on_warning).otherwise("go")
    )


def gate(results: DataFrame, mode: str = "strict") -> str:
    """Act on the results: raises when the decision is to stop, else returns it.

    Only the one-row report comes to the driver, with the names of failed critical checks
    (one per configured check).
    """
    names = F.array_agg(F.when(~F.col("passed") & (F.col("severity") == "critical"), F.col("check_name")))
    row = report(results).select(decision(mode).alias("decision"), results.agg(names).scalar().alias("names")).first()
    if row["decision"] == "stop":
        raise QualityGateError("critical checks failed: " + ", ".join(sorted(n for n in row["names"] if n)))
    return row["decision"]


def rate_gate(conserved: DataFrame, limit: float = QUARANTINE_LIMIT) -> DataFrame:
    """Below the limit the valid rows go on to Silver, otherwise an alert."""
    return conserved.withColumn("next", F.when(F.col("rate") < limit, "silver").otherwise("alert"))


def keep_history(results: DataFrame, path: str, run_date: str) -> int:
    """Add the results to the history; a second run of the same day replaces its own rows."""
    return write(results.withColumn("run_date", F.lit(run_date)), path, ["run_date"], gather=False)


def trend(history: DataFrame, group: Sequence[str] = ("check_name",), value: str = "metric_value") -> DataFrame:
    """Each run against the one before: previous value, change, direction."""
    runs = Window.partitionBy(*group).orderBy("run_date")
    out = history.withColumn("previous", F.lag(value).over(runs))
    change = F.col(value) - F.col("previous")
    way = F.when(change > 0, "better").when(change < 0, "worse").when(change == 0, "same")
    return out.withColumns({"change": change, "direction": way})


def adaptive_threshold(
    history: DataFrame, runs: int = 30, deviations: float = 2.0,
    group: Sequence[str] = ("check_name",), value: str = "metric_value",
) -> DataFrame:
    """For each run the threshold its own past gives: mean - deviations * standard deviation of the
    `runs` before it; null until two runs are there."""
    past = Window.partitionBy(*group).orderBy("run_date").rowsBetween(-runs, -1)
    mean = F.avg(value).over(past)
    spread = F.stddev_samp(value).over(past)
    out = history.withColumn("adaptive_threshold", mean - deviations * spread)
    return out.withColumn("within", F.coalesce(F.col(value) >= F.col("adaptive_threshold"), F.lit(True)))
