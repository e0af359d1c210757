"""Run metrics: one JSON line per stage and run, and the questions asked of them."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.schemas import schema

METRICS = schema(
    run_job="string", data_ref="string", level="string", log_type="string", stage="string",
    records_count="long", records_rejected="long", duration_seconds="double", message="string",
)


class RunLog:
    """Collects the metrics of one run and appends them to the metrics table."""

    def __init__(self, spark: SparkSession, path: str, job: str, label: str):
        self.spark, self.path, self.job, self.label, self.rows = spark, path, job, label, []

    def stage(self, name: str, work: Callable[[], dict]) -> dict:
        """Run a stage, keep its counts and time; a failure is kept too and raised again."""
        start = time.monotonic()
        try:
            counts = work()
        except Exception as error:
            self._add("ERROR", "event", name, None, None, start, str(error))
            self.save()
            raise
        self._add("INFO", "metric", name, counts["rows"], counts.get("rejected", 0), start, None)
        return counts

    def _add(self, level, kind, stage, rows, rejected, start, message):
        took = round(time.monotonic() - start, 3)
        self.rows.append((self.job, self.label, level, kind, stage, rows, rejected, took, message))

    def save(self) -> None:
        """A handful of rows, one file per run."""
        self.spark.createDataFrame(self.rows, METRICS).coalesce(1).write.mode("append").json(self.path)
        self.rows = []


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).json(path)


def errors(log: DataFrame) -> DataFrame:
    return log.where("level = 'ERROR'")


def stage_metrics(log: DataFrame, stage: str) -> DataFrame:
    return log.where((F.col("log_type") == "metric") & (F.col("stage") == stage))


def slow_stages(log: DataFrame, seconds: float = 30.0) -> DataFrame:
    return log.where(F.col("duration_seconds") > seconds)


def rejected_per_run(log: DataFrame, stage: str = "silver") -> DataFrame:
    return stage_metrics(log, stage).groupBy("data_ref").agg(F.sum("records_rejected").alias("rejected"))


def losses(log: DataFrame, order: Sequence[str] = ("bronze", "silver", "gold")) -> DataFrame:
    """Rows per stage and percent lost against the first stage."""
    per = log.where("log_type = 'metric'").groupBy("data_ref").agg(
        *[F.max(F.when(F.col("stage") == s, F.col("records_count"))).alias(s) for s in order]
    )
    first = F.col(order[0])
    lost = [
        (F.try_divide((first - F.col(s)) * 100.0, first)).cast("double").alias(f"{s}_lost_percent")
        for s in order[1:-1]
    ]
    return per.select("*", *lost)
