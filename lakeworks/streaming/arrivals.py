"""Files processed once each, as they land.

A file stream remembers in its checkpoint which files it has taken. Bronze is laid out by day
and file, and every batch overwrites just its own (day, file) partitions: a batch that runs
again after a crash, or a file delivered twice, leaves the same table, and a second file for a
day adds to the first. Silver and Gold of the touched days are then made again from Bronze.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.plans import daily
from lakeworks.sinks.tables import write

PLACE = "array<struct<_file_origin: string, _data_ref: string, _file: string>>"


def file_stream(spark: SparkSession, incoming: str, schema: T.StructType, files_per_batch: int) -> DataFrame:
    """The file of each row below `incoming/<day>/`, as `_file_origin`; none of the row's own columns is read."""
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(incoming)
    )
    return rows.select(F.col("_metadata.file_path").alias("_file_origin"))


def places(paths: Sequence[str], incoming: str) -> list[dict[str, str]]:
    """File, day and the file's name in Bronze, of files below `incoming`."""
    # the day is the first folder below `incoming`, whether the file lies there or deeper
    below = re.compile(re.escape(re.sub(r"^[a-z]+:/*", "/", incoming).rstrip("/")) + r"/(?:\w+=)?([^/]+)/(.+)$", re.ASCII)
    found = {path: below.search(path) for path in paths}
    # the file's path below its day: a repeated delivery lands in the same place, another file
    # of the same name in another folder does not
    return [
        {"_file_origin": path, "_data_ref": m[1] if m else "", "_file": m[2].replace("/", "~") if m else ""}
        for path, m in found.items()
    ]


def read_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of the files named by address, as a scan of their own: columns are pruned, files are split."""
    jvm = spark._jvm
    plain = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)).toString() for path in paths]
    named = [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in plain]  # a path is a pattern to the reader
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*named)


def land(
    spark: SparkSession, paths: Sequence[str], incoming: str, schema: T.StructType, lake: daily.Lake, products: DataFrame,
    ingested_at: str | None = None,
) -> None:
    """One batch of files into Bronze, then Silver and Gold of their days."""
    files = places(paths, incoming)  # a batch's files are bounded
    if not files:
        return
    when = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    # day and name are worked out once a file, not once a row
    named = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(files)), PLACE)))
    rows = read_files(spark, paths, schema).select("*", F.col("_metadata.file_path").alias("_file_origin"))
    rows = rows.join(F.broadcast(named), "_file_origin", "left").select(*rows.columns, "_data_ref", "_file")
    stray = F.raise_error(F.concat(F.lit("none of the batch's files: "), F.col("_file_origin")))
    rows = rows.withColumn("_file", F.coalesce("_file", stray.cast("string")))
    rows = rows.withColumns({"_source": F.lit("arrivals"), "_ingestion_ts": when})
    write(rows, lake.bronze, ["_data_ref", "_file"], gather=False)
    days = sorted({f["_data_ref"] for f in files})
    daily.silver(spark, lake, days, ingested_at=ingested_at)
    daily.gold(spark, lake, days, products)


def process_new_files(
    spark: SparkSession,
    incoming: str,
    lake: daily.Lake,
    checkpoint: str,
    schema: T.StructType,
    products: DataFrame,
    files_per_batch: int = 1000,
    ingested_at: str | None = None,
) -> int:
    """Take all files not seen yet, in bounded batches, then stop. Returns the number of batches."""
    stream = file_stream(spark, incoming, schema, files_per_batch)
    batches = 0

    def taken(batch: DataFrame, _: int) -> None:
        nonlocal batches
        paths = sorted(r[0] for r in batch.distinct().collect())
        land(spark, paths, incoming, schema, lake, products, ingested_at)
        batches += 1

    query = (
        stream.writeStream.foreachBatch(taken)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return batches
