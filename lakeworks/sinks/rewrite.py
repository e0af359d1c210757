"""Rewriting single files of a table: only files that hold a row to change, or that are too small, are touched.

New files are made beside the table. A journal in the table then names what comes and what goes, and is the point from which
the rewrite holds: a run that dies later is brought to its end by the next `finish`, one that dies earlier has
changed nothing. Between the two a reader may find rows twice, never too few.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.runtime import fresh_path
from lakeworks.sinks.files import children, file_system

JOURNAL = "_rewrite-"


def file_stats(spark: SparkSession, path: str, **counted: Column) -> DataFrame:
    """One row for each file: `file` (its address), `bytes`, `rows` and the rows that fulfil each condition."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    conditions = [F.count_if(c).alias(name) for name, c in counted.items()]
    return rows.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count("*").alias("rows"), *conditions
    )


def packed(sizes: Mapping[str, int], target: int) -> list[list[str]]:
    """Names in groups of at most `target` together: the largest first, each into the first group with room for it."""
    groups, room = [], []
    for name, size in sorted(sizes.items(), key=lambda s: (-s[1], s[0])):
        at = next((i for i, left in enumerate(room) if size <= left), None)
        if at is None:
            groups.append([])
            room.append(target)
            at = len(groups) - 1
        groups[at].append(name)
        room[at] -= size
    return groups


def _located(spark: SparkSession, address: str):
    """A Hadoop path from the address that Spark gives a file."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(address))


def read_files(spark: SparkSession, files: Iterable[str], table: str | None = None) -> DataFrame:
    """The rows of some files with their address `_file`; with the table's folder also its partition columns."""
    reader = spark.read.option("mergeSchema", True)
    reader = reader.option("basePath", table) if table else reader
    return reader.parquet(*(_located(spark, f).toString() for f in files)).select("*", F.col("_metadata.file_path").alias("_file"))


def replace_files(
    spark: SparkSession, path: str, groups: list[list[str]], keep: Column | None = None, drop: Iterable[str] = ()
) -> int:
    """Write the rows of each group of files, those that `keep` holds for, as one file in the folder of its first; the
    groups' files go, and those of `drop`. Returns the number of files that went."""
    old, add, drop = [f for group in groups for f in group], [], list(drop)
    if old:
        add = _grouped(spark, groups, keep)
    if old or drop:
        _begin(spark, path, {"add": add, "remove": [_located(spark, f).toString() for f in [*old, *drop]]})
        finish(spark, path)
    return len(old) + len(drop)


def _grouped(spark: SparkSession, groups: list[list[str]], keep: Column | None) -> list[list[str]]:
    """Write the groups beside the table: where each new file is, and where it belongs."""
    old = [f for group in groups for f in group]
    numbers = spark.createDataFrame([(f, i) for i, group in enumerate(groups) for f in group], "_file string, _group int")
    rows = read_files(spark, old)
    rows = rows.where(keep) if keep is not None else rows
    staged = fresh_path(spark, "rewrite")
    # a group is a file's worth of rows: each goes to one task
    grouped = rows.join(F.broadcast(numbers), "_file").drop("_file").repartition(max(1, len(groups)), "_group")
    grouped.write.partitionBy("_group").parquet(staged)
    add = []
    for name in children(spark, staged):
        if not name.startswith("_group="):
            continue
        folder = _located(spark, groups[int(name.split("=")[1])][0]).getParent().toString()
        for part in children(spark, f"{staged}/{name}"):
            if part.endswith(".parquet"):
                add.append([f"{staged}/{name}/{part}", f"{folder}/part-{uuid.uuid4().hex}.parquet"])
    return add


def _begin(spark: SparkSession, path: str, journal: dict) -> None:
    """Write the journal down; it is there as a whole or not at all."""
    fs, Path = file_system(spark, path)
    written, final = Path(f"{path}/_new{JOURNAL}{uuid.uuid4().hex}"), Path(f"{path}/{JOURNAL}{uuid.uuid4().hex}")
    out = fs.create(written)
    out.write(bytearray(json.dumps(journal).encode()))
    out.close()
    fs.rename(written, final)


def finish(spark: SparkSession, path: str) -> int:
    """Bring rewrites to their end that a run has begun; every step may have been done before. Returns how many."""
    fs, Path = file_system(spark, path)
    journals = [n for n in children(spark, path) if n.startswith(JOURNAL)]
    for name in journals:
        stream = fs.open(Path(f"{path}/{name}"))
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        journal = json.loads(text)
        for source, target in journal["add"]:
            if not fs.exists(Path(target)) and not fs.rename(Path(source), Path(target)):
                raise OSError(f"cannot move {source} to {target}")
        for gone in journal["remove"]:
            fs.delete(Path(gone), False)
        fs.delete(Path(f"{path}/{name}"), False)
    return len(journals)


def compact_small(spark: SparkSession, path: str, target: int = 128 << 20, small: float = 0.5) -> int:
    """Put files below `small` of the target size together, within their folder, up to the target; all other files stay
    as they are. Returns the number of files that went."""
    finish(spark, path)
    found = file_stats(spark, path).where(F.col("bytes") < target * small).select("file", "bytes").collect()  # names of small files
    folders: dict[str, dict[str, int]] = {}
    for r in found:
        folders.setdefault(r.file.rsplit("/", 1)[0], {})[r.file] = r["bytes"]
    groups = [g for sizes in folders.values() for g in packed(sizes, target) if len(g) > 1]
    return replace_files(spark, path, groups)
