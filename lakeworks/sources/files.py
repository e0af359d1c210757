"""Readers for CSV, JSON, Parquet and ORC. Explicit schemas are the default; inference is for profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.runtime import materialise
from lakeworks.sinks.files import children
from lakeworks.sinks.tables import read_text_keys
from lakeworks.sources.quoted_csv import fits, read_quoted_csv

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, **options) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which costs a second pass.

    Every Spark CSV option passes through: sep, encoding, nullValue, dateFormat, timestampFormat,
    multiLine, quote, escape, mode, samplingRatio, ...
    """
    reader = spark.read.options(header=True, **options)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_legacy_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, **options) -> DataFrame:
    """Semicolons, ISO-8859-1 and `N/A` for missing; the path may be a glob."""
    fixed = {"sep": ";", "encoding": "ISO-8859-1", "nullValue": "N/A"}
    return read_csv(spark, path, schema, **{**fixed, **options})


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """Files that hold one JSON object each. Such a file cannot be split between tasks, so the
    sender's page size bounds the work of a task."""
    reader = spark.read.options(multiLine=True, **options)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """One JSON object per line; lines split freely between tasks."""
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema else reader).json(path)


def read_with_corrupt(
    spark: SparkSession, path: str, schema: T.StructType, form: str = "json", **options
) -> tuple[DataFrame, DataFrame]:
    """(valid, corrupt): rows that fit the schema, and the text of those that do not.

    A reader parses only the columns a query uses, and a row would be corrupt in one query and valid in
    the next. So JSON lines are read as text and parsed in the plan, and CSV rows, which may hold quoted
    line breaks, are parsed once with all columns and written to the shared folder. Files are read in ranges
    (`quoted_csv`); only encodings of several bytes and other options that it refuses make a file one task.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    if form == "csv":
        if fits(options) and options.get("multiLine", True):
            parsed = read_quoted_csv(spark, path, wide, **options)
        else:
            parsed = read_csv(spark, path, wide, **{"multiLine": True, **options})
        rows = materialise(parsed, "parsed-csv")
        bad = F.col(CORRUPT).isNotNull()
        return rows.where(~bad).drop(CORRUPT), rows.where(bad)
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    rows = lines.select(F.from_json("value", wide, options).alias("row"))
    bad = F.col(f"row.{CORRUPT}").isNotNull()
    return rows.where(~bad).select("row.*").drop(CORRUPT), rows.where(bad).select("row.*")


def read_parquet(spark: SparkSession, path: str | Sequence[str], merge: bool = False, **options) -> DataFrame:
    """Parquet file or folder. `merge` unites the schemas of all files; other options select
    files: recursiveFileLookup, basePath, pathGlobFilter, modifiedBefore, modifiedAfter."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.options(mergeSchema=merge, **options).parquet(*paths)


def read_orc(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(**options).orc(path)


def read_external(spark: SparkSession, form: str, path: str, **options) -> DataFrame:
    """A format from a package of its own, such as avro or delta."""
    try:
        return spark.read.options(**options).format(form).load(path)
    except Exception as error:
        if "DATA_SOURCE_NOT_FOUND" in str(error) or "Failed to find" in str(error):
            raise ImportError(f"add the Spark package for {form} to the session") from error
        raise


def read_partitions(spark: SparkSession, base: str, condition: str | None = None, form: str = "parquet", **options) -> DataFrame:
    """A folder of `key=value` partitions; a condition on the key skips the other folders."""
    df = spark.read.options(**options).format(form).load(base)
    return df.where(condition) if condition else df


def read_refs(spark: SparkSession, base: str, key: str, refs: Sequence[str]) -> DataFrame:
    """The partitions `refs` of a table, the key as the text in the folder names, columns that came
    later as null before. The table's folder is listed once and only those of the refs are read; a ref
    without a folder has no rows."""
    names = set(children(spark, base))
    there = [f"{key}={ref}" for ref in refs if f"{key}={ref}" in names]
    return read_text_keys(spark, base, [key], there) if there else read_text_keys(spark, base, [key]).limit(0)


def read_day(spark: SparkSession, incoming: str, data_ref: str, file: str = "vendas.parquet") -> DataFrame:
    """The file of one day below `incoming/<day>/`, the day added as a column."""
    return spark.read.parquet(f"{incoming}/{data_ref}/{file}").withColumn("data_ref", F.lit(data_ref))


def with_lineage(df: DataFrame, source: str, ingested_at: str | None = None) -> DataFrame:
    """Add where a row came from and when. `df` must be fresh from a file reader.

    With `ingested_at` a repeated run writes the same rows; without it the clock is used.
    """
    when = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    return df.select(
        "*",
        F.lit(source).alias("_source"),
        when.alias("_ingestion_ts"),
        F.col("_metadata.file_path").alias("_file_origin"),
    )
