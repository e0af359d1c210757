"""Session settings and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "lakeworks", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on.

    On a cluster the master and sizes come from spark-submit; `conf` adds to them.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its executor, so the setting is required there.
    """
    context = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="lakeworks-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/lakeworks/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, **options) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors.

    For a frame that several later branches read and that is dear to compute again. `options` are the writer's.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def money(column) -> Column:
    """A price as DECIMAL(18,2), so that sums do not depend on the order of addition."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(18,2)")


def total(column) -> Column:
    """Exact sum of prices, as double."""
    return F.sum(money(column)).cast("double")


def mean(column) -> Column:
    """Exact mean of prices: exact sum over non-null count, in double."""
    column = F.col(column) if isinstance(column, str) else column
    return F.try_divide(F.sum(money(column)).cast("double"), F.count(column).cast("double"))
