"""Writers for lake layers: partitioned, repeatable, checked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.operators.transform import align, one_per_key
from lakeworks.runtime import fresh_path, materialise
from lakeworks.sinks.files import children, exists, partition_columns, remove, swap_in
from lakeworks.sinks.rewrite import file_stats, finish, replace_files


#: The name Spark gives the folder of rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class EmptyWriteError(ValueError):
    """An empty frame was about to replace a table."""


class CountMismatchError(RuntimeError):
    """The rows read back are not the rows written."""


def write(df: DataFrame, path: str, keys: Sequence[str] = (), **options) -> int:
    """Write Parquet and return the number of rows, counted on the way. Options: see `write_observed`."""
    return write_observed(df, path, keys, {}, **options)["rows"]


def write_observed(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    metrics: Mapping[str, Column],
    mode: str = "overwrite",
    dynamic: bool = True,
    codec: str = "snappy",
    rows_per_file: int | None = None,
    gather: bool = True,
) -> dict:
    """Write Parquet and return `rows` and the metrics, taken by the writing tasks themselves.

    With `keys` the rows of a partition are gathered before writing (few files per partition);
    the rebalance lets Spark split a partition that holds too much, so one big day or state does
    not end in one task. `dynamic` overwrites only the partitions present in the frame.
    """
    if keys and gather:
        df = df.hint("rebalance", *keys)
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]]
    writer = df.observe(seen, *metrics).write.mode(mode).option("compression", codec)
    if keys:
        writer = writer.partitionBy(*keys)
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    there = mode == "ignore" and exists(df.sparkSession, path)
    writer.parquet(path)
    return {"rows": 0} if there else seen.get  # a skipped write runs no job to observe


def write_refs(
    df: DataFrame, path: str, key: str, refs: Sequence[str], gather: bool | None = None, **options
) -> int:
    """Replace exactly the partitions `refs` with the frame's rows of those.

    The key is written as text. A row of another ref is an error that ends the write before any
    partition changes; None among `refs` stands for rows without a key. A single ref is written as it
    comes: there is nothing to gather, and the rows save a shuffle.

    Dynamic overwrite leaves a partition alone when the frame has no rows for it; a ref that
    became empty is therefore removed after the write. Its folder tells: every write names its files anew, and a
    folder without a new file was not written. So no row has to be looked at for it.
    """
    refs, named = list(refs), [r for r in refs if r is not None]
    text = F.col(key).cast("string")
    fits = text.isin(named) if named else F.lit(False)
    fits = F.coalesce(fits, F.lit(False)) | text.isNull() if None in refs else F.coalesce(fits, F.lit(False))
    stray = F.raise_error(F.concat(F.lit(f"{key} is none of those to write: "), F.coalesce(text, F.lit("null"))))
    df = df.withColumn(key, F.when(fits, text).otherwise(stray.cast("string")))
    gather = len(refs) > 1 if gather is None else gather
    spark, folders = df.sparkSession, {r: f"{key}={NO_VALUE if r is None else r}" for r in refs}
    if len(folders) == 1:  # any row is of that ref: its number tells
        found = write_observed(df, path, [key], {}, gather=gather, **options)
        there = set(refs) if found["rows"] else set()
        old = {r: f for r, f in folders.items() if r not in there and exists(spark, f"{path}/{f}")}
    else:
        had = set(children(spark, path))
        before = {r: set(children(spark, f"{path}/{f}")) for r, f in folders.items() if f in had}
        found = write_observed(df, path, [key], {"_without": F.count_if(F.col(key).isNull())}, gather=gather, **options)
        there = {None} if found["_without"] else set()
        there |= {r for r, names in before.items() if set(children(spark, f"{path}/{folders[r]}")) - names}
        old = {r: folders[r] for r in before if r not in there}
    for folder in old.values():
        remove(spark, f"{path}/{folder}")
    return found["rows"]


def append(df: DataFrame, path: str, keys: Sequence[str] = (), **options) -> int:
    return write(df, path, keys, mode="append", **options)


def append_evolving(df: DataFrame, path: str, keys: Sequence[str] = ()) -> int:
    """Append a frame whose columns differ from the table's: shared columns take the table's type,
    new ones are added; read the table with merged schemas."""
    spark = df.sparkSession
    if exists(spark, path):
        have = {f.name: f for f in spark.read.option("mergeSchema", True).parquet(path).schema}
        shared = df.schema.__class__([have.get(f.name, f) for f in df.schema])
        df = align(df, shared)
    return append(df, path, keys)


def guarded_overwrite(df: DataFrame, path: str, keys: Sequence[str] = (), **options) -> int:
    """Overwrite, unless there is nothing to write."""
    if df.isEmpty():
        raise EmptyWriteError(f"no rows for {path}; the table is left as it is")
    return write(df, path, keys, **options)


def staged_overwrite(df: DataFrame, path: str, keys: Sequence[str] = (), **options) -> int:
    """Write beside the table, read back and count, then swap. `df` may read from `path`."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.staged-{fresh_path(spark, 'x').rsplit('-', 1)[1]}"
    rows = write(df, staged, keys, **options)
    found = spark.read.parquet(staged).count() if rows else 0
    if found != rows:
        raise CountMismatchError(f"{path}: wrote {rows} rows, found {found}")
    swap_in(spark, staged, path)
    return rows


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: number of rows and the sum of their hashes, in any order of rows."""
    columns = sorted(df.columns)
    return df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash"),
    )


def round_trip(df: DataFrame, written: DataFrame) -> DataFrame:
    """Rows before and after, and whether their contents agree."""
    a, b = fingerprint(df), fingerprint(written.select(*df.columns))
    hash_after = b.select("hash").scalar()
    return a.select(
        F.col("rows").alias("rows_before"),
        b.select("rows").scalar().alias("rows_after"),
        (F.col("hash") == hash_after).alias("same"),
    )


def read_text_keys(spark: SparkSession, path: str, keys: Sequence[str], folders: Sequence[str] | None = None) -> DataFrame:
    """A table with merged schemas, its partition columns as the text in the folder names: `01` stays `01`."""
    reader = spark.read.options(mergeSchema=True, basePath=path)
    paths = [path] if folders is None else [f"{path}/{f}" for f in folders]
    found = reader.parquet(*paths).schema
    texts = T.StructType([T.StructField(f.name, T.StringType()) if f.name in keys else f for f in found])
    return reader.schema(texts).parquet(*paths)


def upsert(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[Column | str],
    partition: str,
) -> int:
    """Insert new keys and replace known ones: the latest row of each key wins.

    Only partitions that a change lands in, or that hold a changed key so far, are read again
    and rewritten; a partition whose last rows moved away is removed.
    """
    spark = changes.sparkSession
    current = read_text_keys(spark, path, [partition])
    changes = changes.withColumn(partition, F.col(partition).cast("string"))
    changed = changes.select(*keys).distinct()
    homes = current.join(changed, list(keys), "left_semi").select(partition)
    touched = homes.unionByName(changes.select(partition)).distinct()
    # names of partitions, as many as there are folders to rewrite
    names = [r[0] for r in touched.collect()]
    inside = F.col(partition).isin([n for n in names if n is not None])
    old = current.where(inside | F.col(partition).isNull() if None in names else inside)
    merged = one_per_key(old.unionByName(changes.select(*current.columns)), keys, order)
    return write_refs(merged, path, partition, names)


def archive_expired(
    spark: SparkSession, live: str, archive: str, date: str, as_of: str, keep_days: int
) -> tuple[int, int]:
    """Move rows older than `keep_days` to the archive; returns (kept, archived).

    The archive is laid out by the day of the run, by the batch (named after the rows it holds) and then
    like the live table. So a later run adds to the archive, and a run that is repeated after it broke off
    between archive and live table replaces its own batch. Of the live table only files that hold an expired row are
    read again, and their other rows written anew beside them (`rewrite`); every other file stays.
    """
    finish(spark, live)
    keys = partition_columns(spark, live)
    age = F.datediff(F.lit(as_of).cast("date"), F.col(date).cast("date"))
    expired = F.coalesce(age > keep_days, F.lit(False))
    files = materialise(file_stats(spark, live, expired=expired), "expired-files")
    total = files.agg(F.sum("rows"), F.sum("expired")).first()
    if not total[1]:
        return total[0] or 0, 0
    touched = [r.file for r in files.where("expired > 0").select("file").collect()]  # names of files to rewrite
    folders = sorted({f.rsplit("/", 1)[0] for f in touched})
    inside = read_text_keys(spark, live, keys) if not keys else read_text_keys(spark, live, keys, _below(spark, live, folders))
    inside = inside.where(F.col("_metadata.file_path").isin(touched)) if len(touched) < 1000 else inside
    batch = fingerprint(inside.where(expired)).first()
    gone = inside.where(expired).withColumns(
        {"_archived_on": F.lit(as_of), "_batch": F.lit(f"{batch['rows']}x{batch['hash']}")}
    )
    moved = write(gone, archive, ["_archived_on", "_batch", *keys], gather=False)
    if total[0] == total[1]:  # an empty table keeps its columns
        return staged_overwrite(read_text_keys(spark, live, keys).where(~expired), live, keys), moved
    whole = [r.file for r in files.where("expired = rows").select("file").collect()]
    replace_files(spark, live, [[f] for f in touched if f not in set(whole)], ~expired, drop=whole)
    return total[0] - total[1], moved


def _below(spark: SparkSession, path: str, folders: Sequence[str]) -> list[str]:
    """Folders, named by address, as paths below the table."""
    Path, URI = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.java.net.URI
    root = Path(path).toUri().getPath().rstrip("/")
    return [Path(URI(f)).toUri().getPath()[len(root) + 1 :] for f in folders]


def layout(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """Files, bytes and rows per partition, from the file metadata Spark adds to each row."""
    rows = spark.read.parquet(path)
    files = rows.groupBy(*keys, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_bytes")).agg(
        F.count("*").alias("_rows")
    )
    return files.groupBy(*keys).agg(
        F.count("*").alias("files"),
        F.sum("_bytes").alias("bytes"),
        F.sum("_rows").alias("rows"),
        F.max("_rows").alias("rows_in_biggest_file"),
    )


def compact(spark: SparkSession, path: str, keys: Sequence[str] = (), files: int | None = None) -> int:
    """Rewrite a table with fewer files: gathered by its partition keys (found in its folders if not
    named), or as `files` even pieces of a table without any."""
    keys = list(keys) or partition_columns(spark, path)
    df = read_text_keys(spark, path, keys)
    if not keys:
        df = df.repartition(files) if files else df.hint("rebalance")
    return staged_overwrite(df, path, keys)


__all__ = [
    "CountMismatchError", "EmptyWriteError", "append", "append_evolving", "archive_expired", "compact",
    "fingerprint", "guarded_overwrite", "layout", "round_trip", "staged_overwrite", "upsert",
    "write", "write_observed", "write_refs",
]
